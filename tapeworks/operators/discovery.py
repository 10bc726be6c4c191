"""Listing pages to links worth fetching."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tapeworks.functions import links as L


# Hourly files of the four markets.
MARKETS = ("bxe", "cxe", "dxe", "apa")


def hourly_file(market: str) -> str:
    return rf"(?i)rts13_public_trade_data_({market})_\d{{4}}-\d{{2}}-\d{{2}}_\d{{2}}\.csv$"


HOURLY_FILE = hourly_file("|".join(MARKETS))


class LinkRule(NamedTuple):
    """What a feed looks for on a page and how it knows a file again.

    ``target`` is the column the pattern is tested on: ``text``, ``link`` or
    ``type_attr``.  ``label`` is what the manifest is asked for: the link's text,
    its ``href`` as written, or the ``file`` name.  ``once_per_file`` takes one
    link per page and file name.  ``cap`` bounds the links of a page in one run.  New
    ones count, so later runs find the rest; with ``cap_first`` all links count,
    known ones too, and links behind the first ``cap`` of a page are never found.
    """
    feed: str
    target: str
    pattern: str
    label: str = "text"
    once_per_file: bool = False
    cap: int | None = None
    cap_first: bool = False


# Feeds, patterns, and what a file is known by.
LINK_RULES = (
    LinkRule("bme", "text", r"(?i)_BMEA_posttrade\.json$"),
    LinkRule("munich/pretrade", "text", r"(?i)^pretrade\."),
    LinkRule("munich/posttrade", "text", r"(?i)^posttrade\."),
    LinkRule("lsx", "text", r"(?i)^Pretrade Daten "),
    LinkRule("boersenag", "text", r"(?i)Download der Daten für "),
    LinkRule("berlin/pretrade", "text", r"(?i)^Download der Pretrade Daten für "),
    LinkRule("berlin/posttrade", "type_attr", r"^text/comma-separated-values$"),
    LinkRule("athex", "link", r"\.csv$", label="file", once_per_file=True),
    *(LinkRule(f"cboe/{m}/hourly", "link", hourly_file(m), label="file") for m in MARKETS),
    LinkRule("deutsche-boerse", "link", r"\.json\.gz$", label="href"),
)

# How many files some feeds fetch in one run.
RUN_CAPS = {"berlin/pretrade": 50, "berlin/posttrade": 50, "deutsche-boerse": 100}


def with_caps(rules: tuple[LinkRule, ...], caps: dict[str, int] = RUN_CAPS,
              cap_first: tuple[str, ...] = ()) -> tuple[LinkRule, ...]:
    """The rules with a cap for each feed named in ``caps``."""
    return tuple(r._replace(cap=caps[r.feed], cap_first=r.feed in cap_first) if r.feed in caps else r
                 for r in rules)


def page_links(pages: DataFrame, *, html: str = "html", base: str = "url") -> DataFrame:
    """Anchors with a non-empty href: page columns, ``pos``, ``href``, ``type_attr``,
    ``text`` and the absolute ``link``."""
    keep = [c for c in pages.columns if c != html]
    # Outer form: the plain one would search every page twice (see sources.rows).
    found = pages.select(*keep, F.posexplode_outer(L.anchors(F.col(html))).alias("pos", "anchor"))
    return (found.where(F.col("anchor").isNotNull())
            .withColumn("href", L.anchor_attribute(F.col("anchor"), "href"))
            .where(F.col("href") != "")
            .withColumn("type_attr", L.anchor_attribute(F.col("anchor"), "type"))
            .withColumn("text", L.anchor_text(F.col("anchor")))
            .withColumn("link", L.absolute_url(F.col("href"), F.col(base)))
            .drop("anchor"))


def match_rules(found: DataFrame, rules: tuple[LinkRule, ...] = LINK_RULES) -> DataFrame:
    """One row per link and feed that wants it, with ``label`` and the rule's terms.

    The rules are tested as columns of the same row and the hits exploded; a
    link can serve several feeds, and no pairs are formed by a join.  A link whose
    label is empty is left out.
    """
    label = {"text": F.col("text"), "href": F.col("href"), "file": L.last_segment(F.col("link"))}
    hits = F.array_compact(F.array(*[
        F.when(F.col(r.target).rlike(r.pattern), F.struct(
            F.lit(r.feed).alias("feed"), label[r.label].alias("label"),
            F.lit(r.once_per_file).alias("once_per_file"),
            F.lit(r.cap).cast("int").alias("cap"), F.lit(r.cap_first).alias("cap_first")))
        for r in rules]))
    return (found.withColumn("_hit", F.explode_outer(hits)).where(F.col("_hit").isNotNull())
            .select("*", "_hit.*").drop("_hit").where(F.col("label") != ""))


def market_files(found: DataFrame, link: str = "link") -> DataFrame:
    """Hourly market files with their market in lower case."""
    return (found.where(F.col(link).rlike(HOURLY_FILE))
            .withColumn("market", F.lower(F.regexp_extract(F.col(link), HOURLY_FILE, 1))))


def listing_counts(found: DataFrame, *keys: str) -> DataFrame:
    return found.groupBy(*keys).agg(F.count("*").alias("files"))


def last_link_per_file(found: DataFrame, section: list[str], order: list[str],
                       link: str = "link") -> DataFrame:
    """One link per section and file name: the last link, at the first place."""
    named = found.withColumn("file", L.last_segment(F.col(link)))
    return named.groupBy(*section, "file").agg(
        F.max_by(link, F.struct(*order)).alias(link), F.min(F.struct(*order)).alias("_first")
    ).select(*section, "file", link, *[F.col(f"_first.{c}").alias(c) for c in order])


def capped(found: DataFrame, which: Column, page: str = "page_id", order: tuple = ("pos",)) -> DataFrame:
    """Rows for which ``which`` holds, cut to their ``cap`` for each feed and page."""
    place = F.row_number().over(W.partitionBy("feed", page).orderBy(*order))
    held = found.where(which).withColumn("_place", place).where(
        F.col("_place") <= F.col("cap")).drop("_place")
    return found.where(~which).unionByName(held)


def newer_than_mark(found: DataFrame, marks: DataFrame, link: str = "link",
                    feed: str = "feed") -> DataFrame:
    """Links stamped after the feed's mark (``feed, mark``); without a mark, all.

    ``stamped_at`` is null for a link without a readable stamp: those are nobody's
    news, see ``unstamped``.
    """
    stamped = found.withColumn("stamped_at", L.link_minute(F.col(link)))
    return (stamped.join(marks.select(F.col(feed), "mark"), feed, "left")
            .where(F.col("stamped_at") > F.coalesce("mark", F.lit(0).cast("timestamp"))).drop("mark"))


def unstamped(found: DataFrame, link: str = "link") -> DataFrame:
    """Links whose stamp can't be read."""
    return found.where(L.link_minute(F.col(link)).isNull())


def oldest_minutes(fresh: DataFrame, cap: int | None, feed: str = "feed") -> DataFrame:
    """The oldest links of each feed: whole minutes, as long as they begin within ``cap``."""
    if cap is None:
        return fresh
    place = F.rank().over(W.partitionBy(feed).orderBy("stamped_at"))
    return fresh.withColumn("place", place).where(F.col("place") <= cap).drop("place")


def advance_marks(marks: DataFrame, fetched: DataFrame, feed: str = "feed") -> DataFrame:
    """The marks after a run: the newest fetched stamp, or the old mark."""
    newest = fetched.groupBy(feed).agg(F.max("stamped_at").alias("newest"))
    return (marks.select(feed, "mark").join(newest, feed, "full")
            .select(feed, F.greatest("mark", "newest").alias("mark")))
