"""Deduplication of a stream that accounts for every row.

Spark's own ``dropDuplicatesWithinWatermark`` drops late rows without a trace.  Here
each batch is split in three, ``kept``, ``repeats`` and ``late``, written below one
folder as ``batch=<number>``; a batch that runs again replaces its own files.  What a
batch has to know of earlier ones are tables too: the keys kept so far, by batch, and
a line with each batch's newest time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.streaming import StreamingQuery

PARTS = ("kept", "repeats", "late")


def _earlier(spark: SparkSession, folder: str, name: str, number: int, schema: str) -> DataFrame:
    """A table's rows of batches before ``number``."""
    if number == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(f"{schema}, batch long").parquet(f"{folder}/{name}").where(
        F.col("batch") < number).drop("batch")


def split_batch(batch: DataFrame, number: int, keys: list[str], folder: str, *, delay: str,
                order: tuple[str, ...] = ()) -> None:
    """Write the three parts of one batch.

    The mark is the newest ``event_ts`` of earlier batches less ``delay``.  A row
    before it is late.  Of the others, a row repeats a key that an earlier batch kept
    and whose time plus ``delay`` the mark hasn't passed, or that comes first in its
    own batch by ``event_ts`` and ``order``.  A row without a whole key repeats none.
    """
    spark, wait = batch.sparkSession, F.expr(f"interval {delay}")
    types = dict(batch.dtypes)
    seen_schema = ", ".join(f"`{k}` {types[k]}" for k in keys) + ", event_ts timestamp"
    # One line for each earlier batch.
    newest = _earlier(spark, folder, "marks", number, "newest timestamp").agg(F.max("newest")).first()[0]
    mark = F.lit(newest).cast("timestamp") - wait
    seen = _earlier(spark, folder, "seen", number, seen_schema)
    # Passed keys aren't read: their time is pushed down to the files' statistics.
    seen = seen.where(F.col("event_ts") > mark - wait).groupBy(*keys).agg(F.lit(True).alias("_known"))

    lacking = F.lit(False)
    for key in keys:
        lacking = lacking | F.col(key).isNull()
    late = F.coalesce(F.col("event_ts") < mark, F.lit(False))
    place = F.row_number().over(W.partitionBy(*keys, "_own", "_late").orderBy("event_ts", *order))
    parts = (batch.withColumn("_late", late)
             .withColumn("_own", F.when(lacking, F.monotonically_increasing_id()))
             .withColumn("_place", place).join(seen, keys, "left")
             .withColumn("part", F.when(F.col("_late"), "late").when(
                 F.col("_known").isNotNull() | (F.col("_place") > 1), "repeats").otherwise("kept"))
             .select(*batch.columns, "part"))
    path = f"{folder}/parts/batch={number}"
    parts.write.mode("overwrite").partitionBy("part").parquet(path)
    done = spark.read.schema(parts.schema).parquet(path)
    done.where((F.col("part") == "kept")).select(*keys, "event_ts").dropna(subset=keys).write.mode(
        "overwrite").parquet(f"{folder}/seen/batch={number}")
    done.agg(F.max("event_ts").alias("newest")).write.mode("overwrite").parquet(
        f"{folder}/marks/batch={number}")


def stream_split(rows: DataFrame, keys: list[str], folder: str, *, checkpoint: str, delay: str = "1 day",
                 order: tuple[str, ...] = ()) -> StreamingQuery:
    """``split_batch`` for every batch of a stream."""
    def run(batch: DataFrame, number: int) -> None:
        split_batch(batch, number, keys, folder, delay=delay, order=order)

    return (rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_parts(spark: SparkSession, folder: str, columns: DataFrame) -> DataFrame:
    """All rows with ``part`` (see ``PARTS``) and ``batch``; ``columns`` gives the rest."""
    schema = ", ".join(f"`{n}` {t}" for n, t in columns.dtypes) + ", part string, batch long"
    return spark.read.schema(schema).parquet(f"{folder}/parts")
