"""Instrument master and legacy label lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tapeworks.schema import BRONZE_SCHEMA, MASTER_COLUMNS
from tapeworks.sources.rows import string_struct


def clean_master(df: DataFrame, order: str) -> DataFrame:
    """Trim all columns, '' to null; ``row_no`` tells which row came later."""
    return df.select(
        *[F.nullif(F.btrim(F.col(c), F.lit(" \t\r\n\f\x0b")), F.lit("")).alias(c)
          for c in MASTER_COLUMNS], F.col(order).alias("row_no"))


def read_master_csv(spark: SparkSession, path: str) -> DataFrame:
    """Master file with a header in any column order; unknown columns are ignored.

    A missing file gives an empty master.
    """
    try:
        raw = spark.read.option("header", "true").option("escape", '"').csv(path)
    except Exception as failure:
        if "PATH_NOT_FOUND" not in str(failure):
            raise
        raw = spark.createDataFrame([], string_struct(list(MASTER_COLUMNS)))
    for name in MASTER_COLUMNS:
        if name not in raw.columns:
            raw = raw.withColumn(name, F.lit(None).cast("string"))
    return clean_master(raw.withColumn("_no", F.monotonically_increasing_id()), "_no")


def read_label_list(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of labels in one file: column ``label``."""
    try:
        raw = spark.read.text(path, wholetext=True)
    except Exception as failure:
        if "PATH_NOT_FOUND" not in str(failure):
            raise
        raw = spark.createDataFrame([], T.StructType([T.StructField("value", T.StringType())]))
    return explode_labels(raw, "value")


def explode_labels(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.explode(F.from_json(column, "array<string>")).alias("label"))


def legacy_bronze_rows(labels: DataFrame, *, exchange: str = "legacy",
                       scraped_at: Column) -> DataFrame:
    """Labels of files fetched before the manifest existed, as ingested rows."""
    values = {
        "sha256": F.concat(F.lit("legacy:"), F.col("label")), "exchange": F.lit(exchange),
        "label": F.col("label"), "source_uri": F.concat(F.lit("legacy://"), F.col("label")),
        "bytes_size": F.lit(0), "scraped_at": scraped_at, "status": F.lit("ingested"),
    }
    return labels.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in BRONZE_SCHEMA.fields])


def label_only_rows(labels: DataFrame, *, exchange: Column, scraped_at: Column) -> DataFrame:
    """Labels marked as seen without a file."""
    values = {
        "sha256": F.concat(F.lit("label-only:"), exchange, F.lit(":"), F.col("label")),
        "exchange": exchange, "label": F.col("label"),
        "source_uri": F.concat(F.lit("label-only://"), exchange, F.lit("/"), F.col("label")),
        "bytes_size": F.lit(0), "scraped_at": scraped_at, "status": F.lit("ingested"),
    }
    return labels.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in BRONZE_SCHEMA.fields])
