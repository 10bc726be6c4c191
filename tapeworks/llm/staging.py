"""Tables staged in the shared folder, and the exchange between chunks and shards.

``chunked`` stores the documents once, cut into chunks of bounded size and
bucketed by chunk, so that later passes group them without moving texts.
A pass asks its questions in rows ``(shard, chunk, ...)``; the shard task sees
each distinct key once per chunk, however many copies a chunk holds, and sends
its answer back as ``(chunk, shard, ...)``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.llm.arrays import slices
from tapeworks.session import workspace

CHUNK_BYTES = 4 << 20


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it again."""
    path = workspace(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def identified(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` only: other columns, whatever their names, play no part."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def unused(docs: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``docs`` doesn't have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def chunked(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, *, carry: bool = False) -> DataFrame:
    """Documents in chunks of about ``chunk_bytes`` text bytes; a longer text is a chunk of its own.

    With ``carry`` the other columns come along as one struct, ``rest``.
    """
    rows = identified(docs)
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    if carry and rest:
        rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                           F.struct(*(F.col(f"`{c}`") for c in rest)).alias("rest"))
    schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("row", T.IntegerType()),
                           *rows.schema.fields])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        row = size = 0
        for batch in batches:
            for part in slices(batch, chunk_bytes):
                here = part["text"].nbytes
                if row and size + here > chunk_bytes:
                    chunk, row, size = chunk + 1, 0, 0
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, chunk)), pa.array(np.arange(row, row + n, dtype=np.int32)),
                     *part.columns], ["chunk", "row", *part.schema.names])
                row, size = row + n, size + here

    spark = docs.sparkSession
    table = f"chunks_{uuid.uuid4().hex}"
    (rows.mapInArrow(number, schema).write.format("parquet")
     .option("compression", "zstd").option("path", workspace(spark, "chunks"))
     .bucketBy(partitions(spark), "chunk").sortBy("chunk", "row").saveAsTable(table))
    return spark.table(table)


def ordered(table: pa.Table) -> pa.Table:
    """The chunk's rows in their order."""
    return table.sort_by("row")


def ask(chunks: DataFrame, question: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """Rows for the shards from each chunk."""
    return chunks.groupBy("chunk").applyInArrow(question, schema)


def tell(chunks: DataFrame, answers: DataFrame,
         use: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Each chunk together with the answers for it."""
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(use, schema)


def shards_for(keys: int, per_shard: int, spark: SparkSession) -> int:
    """Enough shards for bounded groups, and several for each task."""
    return max(4 * partitions(spark), -(-keys // per_shard))


def blob(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def join_by_hot_key(rows: DataFrame, table: DataFrame, key: str, size: str, total: int,
                    share: int = 1000) -> DataFrame:
    """Inner join of rows with one row per key; ``size`` says how many rows a key has.

    Keys with a ``share``-th of all rows or more, of which there are at most
    ``share``, are broadcast; the join that shuffles never sees them.
    """
    large = F.col(size) * share >= F.lit(total)
    hot = F.broadcast(table.where(large))
    return rows.join(hot, key).unionByName(
        rows.join(hot.select(key), key, "left_anti").join(table.where(~large), key))


def components(edges: DataFrame, name: str) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``: the least node reachable.

    Alternates two star rewirings until nothing changes; each round is a few
    joins and aggregations, staged in the shared folder.
    """
    spark = edges.sparkSession

    def state(df: DataFrame):
        row = df.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long"))).first()
        return row[0], row[1]

    def star(pairs: DataFrame, upward: bool) -> DataFrame:
        """Point every node's neighbours (the larger or the smaller ones) at the least of them all."""
        turned = pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))
        near = pairs.unionByName(turned) if upward else pairs.select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = near.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root"))
        moved = near.join(least, "a").where(F.col("b") > F.col("a") if upward else F.lit(True)).select(
            F.col("b").alias("a"), F.col("root").alias("b"))
        if not upward:
            moved = moved.unionByName(least.select("a", F.col("root").alias("b")))
        return moved.where("a <> b").distinct()

    pairs = staged(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before = state(pairs)
    while before[0]:
        pairs = staged(star(star(pairs, True), False), name)
        after = state(pairs)
        if after == before:
            break
        before = after
    roots = pairs.select(F.col("b").alias("node")).distinct()
    return spark.createDataFrame([], "node long, component long").unionByName(
        pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))).unionByName(
        roots.select("node", F.col("node").alias("component")))
