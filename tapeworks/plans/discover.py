"""Listing pages to the links of a run."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from tapeworks.functions import links as L
from tapeworks.operators.discovery import (
    LINK_RULES, LinkRule, advance_marks, capped, last_link_per_file, match_rules,
    newer_than_mark, oldest_minutes, page_links, unstamped,
)
from tapeworks.operators.manifest import not_seen

FOUND = ("feed", "label", "link", "page_id", "pos", "cap", "cap_first")


def discover(pages: DataFrame, bronze: DataFrame, *, rules: tuple[LinkRule, ...] = LINK_RULES,
             tried: DataFrame | None = None) -> DataFrame:
    """Pages → anchors → absolute links → wanted → one per file → unseen → capped.

    How a feed's files are known, deduplicated and capped is the rule's business;
    a label counts as seen whatever exchange it was seen under.  ``LINK_RULES`` have no
    caps, see ``with_caps``.  Links that a cap turns away are found by the next run.

    ``tried`` has the labels (``label``) whose download has failed before: under a cap
    they come after all others, so files that fail don't keep others from their turn.
    """
    wanted = match_rules(page_links(pages), rules)
    once = F.col("once_per_file")
    files = last_link_per_file(wanted.where(once), ["feed", "page_id", "cap", "cap_first"], ["pos"])
    links = wanted.where(~once).select(*FOUND).unionByName(
        files.withColumn("label", F.col("file")).select(*FOUND))
    has_cap = F.col("cap").isNotNull()
    if any(r.cap_first and r.cap is not None for r in rules):
        links = capped(links, has_cap & F.col("cap_first"))
    new, order = not_seen(links, bronze, ["label"]), ("pos",)
    if any(r.cap is not None and not r.cap_first for r in rules):
        if tried is not None:
            failed = tried.select("label").distinct().withColumn("_failed", F.lit(True))
            new, order = new.join(failed, "label", "left"), (F.col("_failed").isNotNull(), "pos")
        new = capped(new, has_cap & ~F.col("cap_first"), order=order)
    return new.withColumn("file", L.last_segment(F.col("link"))).select(
        *(c for c in FOUND if c not in ("cap", "cap_first")), "file")


class Pointed(NamedTuple):
    """Links to fetch, the marks once they are, and links without a readable stamp."""
    fresh: DataFrame
    marks: DataFrame
    rejects: DataFrame


def discover_after_mark(found: DataFrame, marks: DataFrame, *, cap: int | None = None,
                        link: str = "link") -> Pointed:
    """Links newer than their feed's mark, oldest first, and the marks after them.

    Minutes are fetched whole, so a mark never passes a link that a cap has left.
    """
    fresh = oldest_minutes(newer_than_mark(found, marks, link), cap)
    return Pointed(fresh, advance_marks(marks, fresh), unstamped(found, link))
