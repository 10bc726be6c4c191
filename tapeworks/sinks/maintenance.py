"""Compaction and retention of silver files, as manifest events.

Compaction and retention only retire files: they stay where they are, and readers
that go through the manifest (``sources.silver.read_live``) see only files with status
``written``.  ``purgeable`` then tells which retired files nobody can need any more,
and ``purge`` deletes those and says so in the manifest.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tapeworks.operators.manifest import ManifestTables
from tapeworks.sinks.parquet import silver_rows, write_silver, written_files
from tapeworks.sources.silver import in_files, read_silver

# Executors need pyarrow, but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Files below this size are small.
SMALL_BYTES = 128 << 20


def small_files(silver: DataFrame, table: str, small_bytes: int = SMALL_BYTES) -> DataFrame:
    return silver.where((F.col("table") == table) & (F.col("status") == "written")
                        & (F.col("bytes_size") < small_bytes))


def crowded_partitions(silver: DataFrame, table: str, min_files: int,
                       small_bytes: int = SMALL_BYTES) -> DataFrame:
    """Partitions with at least ``min_files`` small files that would fit fewer files."""
    fewer = F.ceil(F.col("bytes") / small_bytes)
    return (small_files(silver, table, small_bytes).groupBy("partition_path")
            .agg(F.count("*").alias("files"), F.sum("rows").alias("rows"),
                 F.sum("bytes_size").alias("bytes"))
            .where((F.col("files") >= min_files) & (F.col("files") > fewer)))


def compact(spark: SparkSession, manifest: ManifestTables, root: str, table: str, *,
            min_files: int = 2, small_bytes: int = SMALL_BYTES, now: float,
            event_no: int = 1) -> None:
    """Rewrite the small files of crowded partitions into few sorted ones.

    Large files are left alone, and so is a partition whose small files would not
    become fewer: a compaction that follows another finds nothing to do.

    New files and the old ones' new status enter the manifest in one append, so
    a reader sees either the old files or the new ones, and a job that dies
    before that leaves everything as it was.
    """
    state = manifest.silver()
    old = small_files(state, table, small_bytes).join(
        crowded_partitions(state, table, min_files, small_bytes).select("partition_path"),
        "partition_path", "left_semi")
    rows = in_files(read_silver(spark, root, table, "bronze_sha256"), old)
    pass_id = write_silver(rows, root, table, lineage=True)
    fresh = silver_rows(written_files(spark, root, table, state, pass_id=pass_id), F.lit(now))
    retired = old.withColumn("status", F.lit("compacted")).withColumn("written_at", F.lit(now))
    manifest.record_silver(fresh.unionByName(retired.select(*fresh.columns)), event_no)


def expired(silver: DataFrame, cutoff_day: str | Column, now: float) -> DataFrame:
    """Status events for live files of days before ``cutoff_day`` (yyyy-MM-dd)."""
    day = F.regexp_replace(F.regexp_extract(
        "partition_path", r"/(year=\d{4}/month=\d{2}/day=\d{2})/", 1), r"/?[a-z]+=", "-")
    limit = F.lit(cutoff_day) if isinstance(cutoff_day, str) else cutoff_day
    return (silver.where((F.col("status") == "written") & (F.substring(day, 2, 10) < limit))
            .withColumn("status", F.lit("expired")).withColumn("written_at", F.lit(now)))


# What a file is called once it is retired.
RETIRED = ("compacted", "expired")


def purgeable(silver: DataFrame, *, now: float, grace: float, readers: DataFrame | None = None) -> DataFrame:
    """Retired files that may be deleted.

    A file is retired at the time of the event that made it so.  It must have been so
    for ``grace`` seconds, for readers that listed the manifest before, and since
    before every time that a reader still looks at: ``readers`` (``as_of``) has those.
    Who reads the state of a time at or after a file's retirement doesn't see the file.
    """
    # One line; no readers, no bound.
    oldest = None if readers is None else readers.agg(F.min("as_of")).first()[0]
    limit = now - grace if oldest is None else min(now - grace, oldest)
    return silver.where(F.col("status").isin(*RETIRED) & (F.col("written_at") <= limit))


def purge(spark: SparkSession, manifest: ManifestTables, *, now: float, grace: float,
          readers: DataFrame | None = None, event_no: int = 3) -> None:
    """Delete what is ``purgeable`` now.

    Two phases: the files get status ``purging``, then they are deleted, then they get
    ``purged``.  A run that dies between them leaves files that the next one finds by
    their status; deleting a file that is gone is no error.
    """
    due = purgeable(manifest.silver(), now=now, grace=grace, readers=readers)
    manifest.record_silver(due.withColumn("status", F.lit("purging")).withColumn("written_at", F.lit(now)), event_no)
    marked = manifest.silver().where("status = 'purging'")

    def delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        for batch in batches:
            for uri in batch.column("target_uri").to_pylist():
                # Listed as by Spark: file:/a or file:///a.
                store, path = fs.FileSystem.from_uri(
                    "file:///" + uri[5:].lstrip("/") if uri.startswith("file:") else uri)
                if store.get_file_info(path).type != fs.FileType.NotFound:
                    store.delete_file(path)
            yield batch

    gone = marked.select("target_uri").mapInArrow(delete, "target_uri string")
    manifest.record_silver(marked.join(gone, "target_uri", "left_semi").withColumn(
        "status", F.lit("purged")).withColumn("written_at", F.lit(now)), event_no + 1)
