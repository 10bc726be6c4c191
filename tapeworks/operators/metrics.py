"""Counters and gauges as tables: ``name, description, labels, value, at``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tapeworks.functions.parsing import double_text


def label_key(labels: Column) -> Column:
    """A label map as a sorted array of entries, which can be grouped and ordered."""
    return F.coalesce(F.array_sort(F.map_entries(labels)),
                      F.array().cast("array<struct<key:string,value:string>>"))


def counters(increments: DataFrame) -> DataFrame:
    """Sum of increments per series; the first description of a name stays."""
    series = increments.groupBy("name", label_key(F.col("labels")).alias("labels")).agg(
        F.sum("value").alias("value"), F.min("at").alias("first_at"),
        F.min_by("description", "at").alias("description"))
    return _describe(series)


def gauges(settings: DataFrame) -> DataFrame:
    """Last value per series."""
    series = settings.groupBy("name", label_key(F.col("labels")).alias("labels")).agg(
        F.max_by("value", "at").alias("value"), F.min("at").alias("first_at"),
        F.min_by("description", "at").alias("description"))
    return _describe(series)


def _describe(series: DataFrame) -> DataFrame:
    names = series.groupBy("name").agg(F.min_by("description", "first_at").alias("description"),
                                       F.min("first_at").alias("name_at"))
    return series.select("name", "labels", "value").join(names, "name")


def summary(series: DataFrame) -> DataFrame:
    return series.groupBy("name").agg(F.sum("value").alias("total"),
                                      F.count("*").alias("series"))


def exposition(series: DataFrame) -> DataFrame:
    """Text lines with their sort keys ``name_at, name, part, labels``.

    Names come in the order of first use, series in label order; every metric is
    declared a counter.  Sort and write the ``line`` column to get the text.
    """
    heads = series.groupBy("name").agg(F.min("name_at").alias("name_at"),
                                       F.min("description").alias("description"))
    nothing = F.array().cast("array<struct<key:string,value:string>>")
    helps = heads.where(F.coalesce("description", F.lit("")) != "").select(
        "name_at", "name", F.lit(0).alias("part"), nothing.alias("labels"),
        F.concat(F.lit("# HELP "), "name", F.lit(" "), "description").alias("line"))
    types = heads.select("name_at", "name", F.lit(1).alias("part"), nothing.alias("labels"),
                         F.concat(F.lit("# TYPE "), "name", F.lit(" counter")).alias("line"))
    pairs = F.array_join(F.transform("labels", lambda e: F.concat(
        e["key"], F.lit('="'), e["value"], F.lit('"'))), ",")
    tags = F.when(F.size("labels") == 0, F.lit("")).otherwise(
        F.concat(F.lit("{"), pairs, F.lit("}")))
    values = series.select("name_at", "name", F.lit(2).alias("part"), "labels",
                           F.concat("name", tags, F.lit(" "), double_text(F.col("value")))
                           .alias("line"))
    return helps.unionByName(types).unionByName(values)


def write_exposition(lines: DataFrame, path: str) -> None:
    (lines.orderBy("name_at", "name", "part", "labels").select("line")
     .write.mode("overwrite").text(path))


# Descriptions of the counters.
FILES_INGESTED = "Bronze files successfully ingested to silver"
ROWS_INGESTED = "Silver rows produced by ingest"
FILES_DOWNLOADED = "Files downloaded"
BYTES_DOWNLOADED = "Bytes downloaded"
DOWNLOAD_FAILURES = "Download failures"


def landing_increments(landed: DataFrame, failures: DataFrame, method: str, at: Column) -> DataFrame:
    """The download counters: files and bytes from landed bronze rows, failures from a
    table with their ``exchange``."""
    def of(df: DataFrame, name: str, text: str, value: Column) -> DataFrame:
        labels = F.create_map(F.lit("exchange"), "root", F.lit("method"), F.lit(method))
        return (df.groupBy(F.substring_index("exchange", "/", 1).alias("root"))
                .agg(value.cast("double").alias("value"))
                .select(F.lit(name).alias("name"), F.lit(text).alias("description"),
                        labels.alias("labels"), "value"))

    return (of(landed, "scraper_files_total", FILES_DOWNLOADED, F.count("*"))
            .unionByName(of(landed, "scraper_bytes_total", BYTES_DOWNLOADED, F.sum("bytes_size")))
            .unionByName(of(failures, "scraper_download_failures_total", DOWNLOAD_FAILURES,
                            F.count("*"))).withColumn("at", at))


def ingest_increments(outcomes: DataFrame, at: Column) -> DataFrame:
    """The counters an ingest pass adds to, from its outcome table."""
    files = (outcomes.where((F.col("outcome") == "ok"))
             .groupBy(F.substring_index("exchange", "/", 1).alias("root"))
             .agg(F.count("*").cast("double").alias("value"))
             .select(F.lit("ingest_files_total").alias("name"),
                     F.lit(FILES_INGESTED).alias("description"),
                     F.create_map(F.lit("exchange"), "root").alias("labels"), "value"))
    rows = (outcomes.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("double").alias("value"))
            .select(F.lit("ingest_rows_total").alias("name"),
                    F.lit(ROWS_INGESTED).alias("description"),
                    F.create_map().cast("map<string,string>").alias("labels"), "value"))
    return files.unionByName(rows).withColumn("at", at)
