"""Merkle manifest of a dataset: content-addressed nodes, and proofs by descent.

Every row is a leaf, the SHA-256 of its fields.  The leaves of a source, by
doc_id, form a tree of runs of ``FAN`` nodes; its top is the source's subroot, and
the subroots, by source, form another tree up to the root.

* **Store.**  A record maps a node's digest to its children's digests; records
  are kept height by height.  A run is grouped by source and rank, so a group
  never has more than ``FAN`` rows, however many rows a source has.
* **Ranks.**  Digests (not texts) are sorted by range over all tasks.  A task
  numbers the rows of each source it holds; one row for each task then tells how
  many rows of its first source lie in earlier tasks.
* **Descent.**  Requests name a rank; its base-``FAN`` digits are the way from the
  root.  One join opens the nodes of a height by digest, one picks the children
  whose prefix is asked for and adds the others as a path segment.  Requests with
  the same prefix go down as one row, so upper nodes aren't hot; they part at the
  last height.  Reversed, the segments are the proof from the leaf to the root.

Nulls are part of a leaf like any value; null sources come first and form one
source, null doc_ids come first in theirs.  Rows with one doc_id in a source are
ordered by their digest, so equal rows get neighbouring ranks and proofs that may
differ.  Empty texts and texts of any length are hashed whole.  An empty table has
no root and no proofs.  Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.llm.staging import staged

# Children of a full node: one digit of a rank.
FAN, DIGIT_BITS = 16, 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SEGMENT = "array<struct<left: string, right: string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else byte count, colon and value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """Digest of a row's fields, some of them given by other columns."""
    return digest(*(field(changed.get(name, F.col(name))) for name in FIELDS))


def leaves(docs: DataFrame, **more: Column) -> DataFrame:
    """One short row for each document: source key, doc_id, leaf, and what ``more`` adds."""
    source = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))
    return docs.select(source.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
                       leaf().alias("node"), *(c.alias(name) for name, c in more.items()))


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """``rank`` of each row in its ``tree``, by ``order``."""
    spark = rows.sparkSession
    schema = T.StructType([*rows.schema.fields, T.StructField("part", T.IntegerType()),
                           T.StructField("place", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            tree = batch.column("tree")
            first = np.empty(n, bool)
            first[0] = tree[0].as_py() != last
            first[1:] = np.asarray(pc.not_equal(tree[1:], tree[:-1]))
            at = np.arange(n)
            head = np.maximum.accumulate(np.where(first, at, -1))
            place = np.where(head < 0, at + count, at - head)
            last, count = tree[n - 1].as_py(), int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(place)],
                [*batch.schema.names, "part", "place"])

    laid = staged(rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
                  .mapInArrow(number, schema), "ranks")
    # One row for each sorted task.
    ends = laid.groupBy("part").agg(F.min("tree").alias("first"),
                                    F.max(F.struct("tree", "place")).alias("last")).collect()
    starts, tree, total = [], None, 0
    for row in sorted(ends, key=lambda r: r.part):
        before = total if row.first == tree else 0
        total = row.last.place + 1 + (before if row.last.tree == row.first else 0)
        tree = row.last.tree
        starts.append((row.part, row.first, before))
    starts = F.broadcast(spark.createDataFrame(starts, "part int, first string, before long"))
    here = F.when(F.col("tree") == F.col("first"), F.col("before")).otherwise(0)
    return laid.join(starts, "part").select(*rows.columns, (F.col("place") + here).alias("rank"))


def grown(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Records ``(node, children)`` by height, and ``(tree, node, depth)`` of each tree's top."""
    records, tops, level = [], [], nodes.select("tree", "rank", "node")
    while True:
        run = F.sort_array(F.collect_list(F.struct("rank", "node")))
        runs = staged(level.groupBy("tree", F.shiftright("rank", DIGIT_BITS).alias("prefix"))
                      .agg(run.getField("node").alias("children"))
                      .select("tree", "prefix", "children",
                              digest(F.array_join("children", "")).alias("node")), name)
        # A tree whose first run has one node has no other: that node is its top.
        alone = (F.col("prefix") == 0) & (F.size("children") == 1)
        tops.append(runs.where(alone).select("tree", F.col("children")[0].alias("node"),
                                             F.lit(len(records)).alias("depth")))
        more = runs.where(~alone)
        if more.isEmpty():
            break
        records.append(more.select("node", "children"))
        level = more.select("tree", F.col("prefix").alias("rank"), "node")
    top = tops[0]
    for other in tops[1:]:
        top = top.unionByName(other)
    return records, top


@dataclass
class Manifest:
    """The store: records of both trees by height, the subroots, and the root."""

    leaves: DataFrame              # tree, doc_id, node, ..., rank
    records: list[DataFrame]       # node, children; of all sources
    sources: DataFrame             # tree, node (subroot), depth, rank
    source_records: list[DataFrame]
    root: str | None


def build(rows: DataFrame) -> Manifest:
    """The store of the rows of ``leaves``."""
    # Staged first: sorting by range reads its input twice.
    numbered = ranked(staged(rows, "leaves"), "doc_id", "node")
    records, subroots = grown(numbered, "records")
    sources = ranked(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source"),
                                     "node", "depth"), "source")
    source_records, top = grown(sources, "source_records")
    root = top.first()
    return Manifest(numbered, records,
                    sources.select(F.col("source").alias("tree"), "node", "depth", "rank"),
                    source_records, root.node if root else None)


def descended(frontier: DataFrame, records: list[DataFrame], requests: DataFrame) -> DataFrame:
    """Follow each request's digits down from its tree's top.

    ``frontier`` (tree, node, depth, path) has one row for each tree; ``requests``
    (tree, rank, ...) get the node they reach, the tree's ``top``, and their path.
    """
    prefixes = [requests.select("tree", F.col("rank").alias("child"))]
    for _ in records[1:]:
        prefixes.append(staged(prefixes[-1].select(
            "tree", F.shiftright("child", DIGIT_BITS).alias("child")).distinct(), "prefixes"))

    def digit(rank: str) -> Column:
        return F.col(rank).bitwiseAND(FAN - 1).cast("int")

    def segment(at: Column) -> Column:
        left = F.slice("children", F.lit(1), at)
        right = F.slice("children", at + 2, F.lit(FAN))
        return F.array(F.struct(F.array_join(left, "").alias("left"),
                                F.array_join(right, "").alias("right")))

    frontier = frontier.select("tree", F.lit(0).cast("long").alias("prefix"), "node", "depth", "path",
                               F.col("node").alias("top"))
    for height in range(len(records), 1, -1):
        opened = frontier.where(F.col("depth") == height).join(records[height - 1], "node")
        asked = prefixes[height - 1].select(
            F.col("tree"), F.col("child"), F.shiftright("child", DIGIT_BITS).alias("prefix"))
        chosen = opened.join(asked, ["tree", "prefix"]).select(
            "tree", F.col("child").alias("prefix"), F.col("children")[digit("child")].alias("node"),
            (F.col("depth") - 1).alias("depth"),
            F.concat("path", segment(digit("child"))).alias("path"), "top")
        frontier = staged(frontier.where(F.col("depth") < height).unionByName(chosen), "frontier")
    lone = frontier.where(F.col("depth") == 0).select(
        "tree", "prefix", "path", "top", F.array("node").alias("children"), F.lit(True).alias("lone"))
    runs = lone
    if records:
        runs = frontier.where(F.col("depth") == 1).join(records[0], "node").select(
            "tree", "prefix", "path", "top", "children", F.lit(False).alias("lone")).unionByName(lone)
    asked = requests.withColumn("prefix", F.shiftright("rank", DIGIT_BITS))
    path = F.when(F.col("lone"), F.col("path")).otherwise(F.concat("path", segment(digit("rank"))))
    others = [c for c in requests.columns if c not in ("tree", "rank", "node")]
    return asked.drop("node").join(runs, ["tree", "prefix"]).select(
        "tree", "rank", *others, F.col("children")[digit("rank")].alias("node"), "top",
        path.alias("path"))


def proofs(store: Manifest, requests: DataFrame) -> DataFrame:
    """``requests`` (tree, rank, ...) with ``leaf``, ``subroot``, ``root`` and ``path``, leaf to root.

    A segment of the path holds the digests to the left and to the right of the
    way at one height, each side as one text.
    """
    spark = requests.sparkSession
    start = spark.createDataFrame([("", store.root)] if store.root else [], "tree string, node string")
    start = start.select("tree", "node", F.lit(len(store.source_records)).alias("depth"),
                         F.array().cast(SEGMENT).alias("path"))
    asked = store.sources.join(requests.select("tree").distinct(), "tree", "left_semi").select(
        F.lit("").alias("tree"), "rank", F.col("tree").alias("source"), F.col("depth").alias("below"))
    sources = staged(descended(start, store.source_records, asked).select(
        F.col("source").alias("tree"), "node", F.col("below").alias("depth"), "path"), "frontier")
    others = [c for c in requests.columns if c not in ("tree", "rank", "node")]
    return descended(sources, store.records, requests).select(
        *others, F.col("node").alias("leaf"), F.col("top").alias("subroot"),
        F.lit(store.root).alias("root"), F.reverse("path").alias("path"))


def siblings(path: Column) -> Column:
    """All digests of a path as one text."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["left"], node, s["right"]))
