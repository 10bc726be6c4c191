"""URL filters: host-suffix and path-prefix expressions looked up in a rule table.

Each URL is expanded into (host suffix, path prefix) expressions, as many as the
rules' own label counts and path lengths ask for.  Expressions meet the rules in
an equi-join on a short digest prefix; full digests confirm the match, and the
longest rule text wins (then the longer host, then block before allow).

A null URL, or one without ``://``, has an empty host and path and fits no rule;
``default`` is the verdict where no rule fits.  Rows are judged one by one, so
repeated rows and other columns play no part; an empty table gives an empty
result, an empty rule table the default verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_DIGITS = 8
RULES = "host string, path string, verdict string"


def host_of(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path), 256)


def compiled(rules: DataFrame) -> DataFrame:
    """Rules with their digests, lengths and label counts."""
    host = F.translate("host", UPPER, LOWER)
    return (rules.select(host.alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
            .dropDuplicates()
            .select(F.concat("rule_host", "rule_path").alias("rule"), "verdict",
                    F.length("rule_host").alias("host_chars"),
                    F.length("rule_path").alias("path_chars"),
                    F.size(F.split("rule_host", r"\.")).alias("labels"),
                    _digest(F.col("rule_host"), F.col("rule_path")).alias("digest"))
            .withColumn("short", F.left("digest", F.lit(PREFIX_DIGITS))))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Host, path, winning rule and verdict of each page."""
    table = compiled(rules)
    # One row: the shapes of expressions worth making.  Distinct label counts
    # and path lengths stay few however many rules there are.
    shapes = table.agg(F.collect_set("labels").alias("label_counts"),
                       F.collect_set("path_chars").alias("path_lengths")).first()
    # URLs are expanded once each: rows with the same URL share the work.
    parsed = pages.select("page_id", F.col("url").cast("string"))
    urls = parsed.groupBy("url").agg(F.count(F.lit(1)).alias("_n")).select(
        "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.array(*[F.when(F.size(labels) >= n, F.array_join(
        F.slice(labels, F.size(labels) - (n - 1), F.lit(n)), ".")) for n in sorted(shapes.label_counts)])
    prefixes = F.array(*[F.when(F.length("path") >= n, F.left("path", F.lit(n)))
                         for n in sorted(shapes.path_lengths)])
    if not shapes.label_counts:
        return parsed.select("page_id", host_of(F.col("url")).alias("host"),
                             path_of(F.col("url")).alias("path"),
                             F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    asked = (urls.where(F.col("host") != "")
             .select("url", F.explode(F.array_compact(suffixes)).alias("suffix"), "path")
             .select("url", "suffix", F.explode(F.array_compact(prefixes)).alias("prefix"))
             .select("url", _digest(F.col("suffix"), F.col("prefix")).alias("asked"),
                     F.length("suffix").alias("asked_host"))
             .withColumn("asked_short", F.left("asked", F.lit(PREFIX_DIGITS))))
    hits = asked.join(table, (F.col("asked_short") == F.col("short"))
                      & (F.col("asked") == F.col("digest"))
                      & (F.col("asked_host") == F.col("host_chars")))
    order = F.struct(F.length("rule").alias("chars"), "host_chars",
                     (F.col("verdict") == "block").alias("block"), "rule", "verdict")
    best = hits.groupBy("url").agg(F.max(order).alias("best")).select(
        "url", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("fitting"))
    return parsed.join(best, "url", "left").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "rule",
        F.coalesce("fitting", F.lit(default)).alias("verdict"))
