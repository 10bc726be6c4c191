"""Reader of the typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tapeworks.schema import SCHEMAS
from tapeworks.sinks.parquet import DIRECTORY_COLUMNS, PARTITION_COLUMNS


def silver_schema(table: str, *extra: str) -> T.StructType:
    """Stored schema: table columns, optional extra strings, path columns as text."""
    names = [*extra, *PARTITION_COLUMNS]
    return T.StructType(list(SCHEMAS[table].fields)
                        + [T.StructField(n, T.StringType()) for n in names])


def read_silver(spark: SparkSession, root: str, table: str, *extra: str) -> DataFrame:
    """One table with its pinned schema.

    Filters on ``p_exchange``, ``p_year``, ``p_month``, ``p_day`` and
    ``p_instrument_type`` prune directories; filters on ``event_ts`` and ``isin``
    prune row groups through the sorted files' statistics.
    """
    return spark.read.schema(silver_schema(table, *extra)).parquet(f"{root}/{table}")


def read_live(spark: SparkSession, root: str, table: str, silver: DataFrame) -> DataFrame:
    """Rows of the files the manifest lists as written.

    Files not registered yet, compacted or expired are left out.  The manifest's
    directories are part of the join, so directories without a live file are
    pruned before they are opened.
    """
    live = silver.where((F.col("table") == table) & (F.col("status") == "written"))
    return in_files(read_silver(spark, root, table), live)


def in_files(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of a silver table that lie in the manifest's ``files``."""
    # The names in a manifest path.
    names = ("exchange", "year", "month", "day", "instrument_type")
    parts = [F.regexp_extract("partition_path", f"/{n}=([^/]*)", 1).alias(c)
             for n, c in zip(names, DIRECTORY_COLUMNS, strict=True)]
    wanted = files.select(F.col("target_uri").alias("_file"), *parts)
    return (rows.withColumn("_file", F.col("_metadata.file_path"))
            .join(wanted, ["_file", *DIRECTORY_COLUMNS], "left_semi").drop("_file"))


def read_nanosecond_parquet(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Import files that store ``columns`` as nanosecond timestamps.

    Values are cut to microseconds, the precision of every timestamp here.  Spark
    reads nanoseconds as whole numbers if it is told so, which is set in the session;
    other columns aren't concerned.
    """
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    df = spark.read.parquet(path)
    for name in columns:
        df = df.withColumn(name, F.timestamp_micros(F.expr(f"`{name}` div 1000")))
    return df
