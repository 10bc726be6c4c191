"""Raw payload bytes by URI."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Schemes of manifest rows that never had a payload.
VIRTUAL_SCHEMES = ("label-only://", "legacy://")


def is_virtual(uri: Column) -> Column:
    return uri.startswith(VIRTUAL_SCHEMES[0]) | uri.startswith(VIRTUAL_SCHEMES[1])


def scan_payload_files(spark: SparkSession, path: str | list[str], glob: str | None = None,
                       ) -> DataFrame:
    """``source_uri, content`` for every file below ``path`` on any file system.

    Name the folders of the pending files rather than the whole landing zone: the
    content of every file below is read.  For files as they arrive, see
    ``streaming.passes.stream_payload_files``.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(F.col("path").alias("source_uri"), "content")


def plain_uri(uri: Column) -> Column:
    """Local URIs in one spelling: a manifest may hold ``/x``, ``file:/x`` or ``file:///x``."""
    return F.regexp_replace(uri, r"^file:/+", "/")


def attach_content(files: DataFrame, payloads: DataFrame) -> DataFrame:
    """Add ``content`` to manifest rows.

    ``payloads`` holds the bytes under ``source_uri`` (or ``sha256``).  Virtual
    rows get empty content; a row whose payload is missing gets null.  A payload
    delivered twice counts once (of different contents under one URI, the first in
    byte order).  Payloads no file asks for are dropped before they are sorted.
    """
    key = "sha256" if "sha256" in payloads.columns else "source_uri"
    if key == "source_uri":
        side = payloads.select(plain_uri(F.col("source_uri")).alias("_key"), "content")
        joined = files.withColumn("_key", plain_uri(F.col("source_uri")))
    else:
        side = payloads.select(F.col("sha256").alias("_key"), "content")
        joined = files.withColumn("_key", F.col("sha256"))
    keys = joined.where(~is_virtual(F.col("source_uri"))).select("_key").distinct()
    side = side.join(keys, "_key", "left_semi").groupBy("_key").agg(
        F.min(F.col("content").cast("binary")).alias("content"))
    return (joined.join(side, "_key", "left").drop("_key")
            .withColumn("content", F.when(is_virtual(F.col("source_uri")), F.lit(b""))
                        .otherwise(F.col("content").cast("binary"))))
