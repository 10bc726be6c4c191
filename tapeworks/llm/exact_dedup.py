"""Exact deduplication that holds up when one text makes up a third of the rows.

1. Locally: rows of one scan task are grouped by (digest, text), so a task sends
   one row for each text however many copies it holds.
2. Salted: those rows meet by (digest, text, salt); a hot text is spread over
   ``salts`` tasks.
3. Globally: one row for each salt and text is combined to the winner.

Texts are grouping keys themselves at every stage, so equal digests of unequal
texts never merge; should that ever happen (no such pair is known), the operator
stops with an error instead of guessing.  Each document then learns its winner by digest: winners of
large groups, of which there are few by their very size, are broadcast, so the
join that shuffles never sees a hot key.

Null texts count as empty texts, and empty texts equal each other; texts of any
length are compared whole.  Among equal
texts the largest doc_id stays; repeated rows with that doc_id all carry
``kept`` (they can't be told apart).  A null doc_id never wins against another
and is kept only if its whole group has null ids.  An empty table gives an empty
result; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.staging import staged, unused

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SALTS = 16
# A group is large from this share of all rows on, so at most SHARE are large.
SHARE = 1000


def normal(text: Column) -> Column:
    """A-Z lower-cased, nothing else; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def winners(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row for each digest: how many different texts have it, keep_id, group_size."""
    rows = docs.select(F.col("doc_id").cast("long"), normal(F.col("text")).alias("body"))
    keyed = rows.withColumn("digest", F.unhex(F.sha2("body", 256)))
    counted = lambda n, best: (F.sum(n).alias("n"), F.max(best).alias("best"))
    salted = (keyed.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
              .groupBy("digest", "body", "salt").agg(*counted(F.lit(1), "doc_id")))
    merged = salted.groupBy("digest", "body").agg(*counted("n", "best"))
    return merged.groupBy("digest").agg(
        F.count(F.lit(1)).alias("variants"), F.max("best").alias("keep_id"),
        F.sum("n").alias("group_size"))


def group(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """keep_id, group_size, kept and digest of every row."""
    best = staged(winners(docs, salts), "winners")
    total = best.agg(F.sum("group_size"), F.max("variants")).first()
    if (total[1] or 1) > 1:
        raise ValueError("two different texts share a SHA-256 digest")
    rows = docs.select(F.col("doc_id").cast("long"),
                       F.unhex(F.sha2(normal(F.col("text")), 256)).alias("digest"))
    large = F.col("group_size") * SHARE >= F.lit(total[0] or 0)
    best = best.select("digest", "keep_id", "group_size")
    hot = F.broadcast(best.where(large))
    cold_rows = rows.join(hot, "digest", "left_anti")
    joined = rows.join(hot, "digest").unionByName(cold_rows.join(best.where(~large), "digest"))
    return joined.select("doc_id", "keep_id", "group_size",
                         F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                         F.lower(F.hex("digest")).alias("text_sha256"))


def kept_documents(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One document of each text, with all its columns."""
    digest, keep = unused(docs, "_digest"), unused(docs, "_keep")
    best = staged(winners(docs, salts), "winners").select(
        F.col("digest").alias(digest), F.col("keep_id").alias(keep))
    # The pair of digest and id is no hot key, however many copies a text has.
    return docs.join(best, F.col("doc_id").cast("long").eqNullSafe(F.col(keep)) & (
        F.unhex(F.sha2(normal(F.col("text")), 256)) == F.col(digest)), "left_semi")
