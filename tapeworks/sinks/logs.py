"""Log entries, one directory per exchange and asset type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

LOG_PARTITIONS = ("exchange", "asset_type")
LOG_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in (
    "timestamp", "level", "message", *LOG_PARTITIONS)])


def append_logs(entries: DataFrame, root: str) -> None:
    """Append ``exchange, asset_type, timestamp, level, message``."""
    laid = (entries.select(*LOG_SCHEMA.names)
            .hint("rebalance", *[F.col(c) for c in LOG_PARTITIONS])
            .sortWithinPartitions(*LOG_PARTITIONS, "timestamp"))
    laid.write.mode("append").partitionBy(*LOG_PARTITIONS).parquet(root)


def read_logs(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(root)
