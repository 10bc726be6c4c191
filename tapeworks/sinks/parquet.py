"""Partitioned, sorted Parquet and its registration in the manifest."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from tapeworks.functions.layout import date_parts, partition_dir, partition_value
from tapeworks.schema import SCHEMAS
from tapeworks.session import SHUFFLED_ONCE, settings

# Path columns have names of their own, so the values inside the files stay
# readable as they were written (a path only holds the cleaned text).
DIRECTORY_COLUMNS = ("p_exchange", "p_year", "p_month", "p_day", "p_instrument_type")
# The innermost directory names the write, so a write finds its own files again
# and one that is repeated replaces them.
PARTITION_COLUMNS = (*DIRECTORY_COLUMNS, "p_pass")
# Shuffled bytes behind one file, which one task reads and sorts; Spark's default would make
# files too small.  A full file has to be larger than what compaction calls small.
FILE_BYTES = "192m"
# The same for files that are written again later, so that even wide rows are sorted in memory.
PASS_BYTES = "96m"
# Bytes of files that one task reads and sorts when rows are written again; sorted rows take
# about ten times their bytes in a file, and what doesn't fit a task's memory is spilled.
DEALT_BYTES = "48m"
# Columns that hold digests, mostly: they travel as bytes.
DIGEST_COLUMNS = ("source_msg_hash", "bronze_sha256")
# Columns that differ from row to row, in the order in which they travel, behind those that repeat:
# texts of one length, texts of varying length, which shift what is behind them, and numbers.
MOVED_LAST = (*DIGEST_COLUMNS, "isin", "trade_id", "ticker", "figi", "trade_flag_canonical",
              "trade_flags_raw", "seq", "event_ts")
SORT_COLUMNS = ("event_ts", "isin", "seq")
ROW_GROUP_ROWS = 65_536

# Columns shown for sample rows, where a table has them.
PREVIEW_COLUMNS = (
    "event_ts", "exchange", "data_type", "isin", "ticker", "trade_price", "trade_size",
    "bid_price", "ask_price", "open", "close", "volume", "trade_flag_canonical",
)


def path_value(value: Column) -> Column:
    """Cleaned text for a path column, never a constant to the optimizer.

    A feed's rows often carry a constant exchange.  Spark drops constants from a
    sort, no longer sees the order its writer wants, and replaces the sort by one
    on the path columns alone; an empty piece of the time keeps the column in.
    """
    return never_constant(partition_value(value))


def never_constant(value: Column) -> Column:
    return F.concat(value, F.left(date_parts(F.col("event_ts"))[0], F.lit(0)))


def _directory() -> list[Column]:
    year, month, day = date_parts(F.col("event_ts"))
    return [path_value(F.col("exchange")), year, month, day, path_value(F.col("instrument_type"))]


def _directory_order() -> list[Column]:
    """Keys in whose order directories follow one another: dates in place of their parts.

    Dealing by ranges computes its keys twice for each row, for the sample too.
    """
    return [partition_value(F.col("exchange")), F.to_date("event_ts"),
            partition_value(F.col("instrument_type"))]


def with_partition_columns(df: DataFrame, pass_id: str) -> DataFrame:
    return df.withColumns(dict(zip(PARTITION_COLUMNS, (
        *_directory(), never_constant(F.lit(pass_id))), strict=True)))


def _sort_keys(df: DataFrame) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in SORT_COLUMNS if c in df.columns]


def lay_out(df: DataFrame, partition_columns: tuple[str, ...], ranges: int | None = None) -> DataFrame:
    """Bring the rows of a directory together and sort them inside it.

    ``rebalance`` gives a directory few files and still splits one that holds a
    large share of all rows over many tasks (a plain repartition would send it
    to one), but the files of such a directory cover the same times.

    With ``ranges`` rows are dealt by sampled bounds of directory, time and ISIN to so
    many tasks: a large directory is cut where its time is, and its files follow one
    another.  The sample reads the input once more, so that is for tables.

    Partition columns lead the sort, so the writer adds no second one.
    """
    keys = [F.col(c) for c in partition_columns]
    dealt = df.hint("rebalance", *keys) if ranges is None else df.repartitionByRange(
        ranges, *keys, *_sort_keys(df))
    return dealt.sortWithinPartitions(*partition_columns, *_sort_keys(df))


def packed(text: Column) -> Column:
    """A text as bytes: a lower-case hex text by its value, any other as it is."""
    value = F.unhex(text)
    return F.when(F.lower(F.hex(value)) == text, F.concat(F.lit(b"\1"), value)).otherwise(
        F.concat(F.lit(b"\0"), text.cast("binary")))


def unpacked(data: Column) -> Column:
    rest = F.substr(data, F.lit(2))
    return F.when(F.substr(data, F.lit(1), F.lit(1)) == F.lit(b"\1"), F.lower(F.hex(rest))).otherwise(
        rest.cast("string"))


def moved_order(df: DataFrame) -> list[str]:
    """The columns in the order in which they travel.

    A shuffle's compression finds what repeats from row to row if it is at the same place
    in each.  Other numbers than those of ``MOVED_LAST`` are the very last.
    """
    def rank(field: T.StructField) -> int:
        if field.name in MOVED_LAST:
            return 1 + MOVED_LAST.index(field.name)
        numbers = (T.DoubleType, T.LongType, T.IntegerType)
        return 1 + len(MOVED_LAST) if isinstance(field.dataType, numbers) else 0

    return [f.name for f in sorted(df.schema.fields, key=rank)]


def silver_layout(df: DataFrame, pass_id: str, ranges: int | None = None, dealt: bool = False) -> DataFrame:
    """Rows with their path columns, laid out as by ``lay_out``.

    Little is moved: digests travel as bytes, and the path columns are made where the
    rows arrive.  On the way a number stands for the directory; should two share one,
    they are in the same tasks and still two directories.  Rows that are ``dealt``
    already stay in their tasks and are sorted there.

    Little is sorted, too: the pass is the same for all rows, so it is no part of them
    until they are written.
    """
    names = df.columns
    digests = [] if dealt else [c for c in DIGEST_COLUMNS if c in names]
    rows = df.withColumns({c: packed(F.col(c)) for c in digests}).select(*moved_order(df))
    if dealt:
        laid = df
    elif ranges is None:
        laid = rows.withColumn("_directory", F.xxhash64(*_directory())).hint("rebalance", F.col("_directory"))
    else:
        laid = rows.repartitionByRange(ranges, *_directory_order(), *_sort_keys(df))
    placed = laid.select(*names).withColumns(dict(zip(DIRECTORY_COLUMNS, _directory(), strict=True)))
    # Cheap, as rows that are compared have it made; Spark knows it again behind the sort.
    own = F.concat(F.lit(pass_id), F.left("p_day", F.lit(0)))
    return (placed.sortWithinPartitions(*DIRECTORY_COLUMNS, own, *_sort_keys(df))
            .withColumn("p_pass", own).withColumns({c: unpacked(F.col(c)) for c in digests}))


def parquet_writer(df: DataFrame, *, compression: str = "snappy",
                   row_group_rows: int = ROW_GROUP_ROWS):
    return (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .option("compression", compression)
            .option("parquet.block.row.count.limit", str(row_group_rows))
            .option("parquet.writer.version", "PARQUET_2_0"))


def write_silver(df: DataFrame, root: str, table: str, *, compression: str = "snappy",
                 row_group_rows: int = ROW_GROUP_ROWS, lineage: bool = False,
                 pass_id: str | None = None, ranges: int | None = None,
                 dealt: bool = False, file_bytes: str = FILE_BYTES) -> str:
    """Append rows of one table; returns the id its files carry in their path.

    A write that is repeated under the id of an earlier one replaces its files.
    With ``lineage`` the payload digest column ``bronze_sha256`` is stored behind
    the table's own columns; readers of the pinned schema never see it.  ``ranges``
    clusters large directories by time (see ``lay_out``).  Rows that come from files of
    this layout are ``dealt``: they are written again without being moved.  A task sorts
    ``file_bytes`` of shuffled rows, five times that in memory.
    """
    names = [f.name for f in SCHEMAS[table].fields] + (["bronze_sha256"] if lineage else [])
    pass_id = pass_id or uuid.uuid4().hex
    laid = silver_layout(df.select(*names), pass_id, ranges, dealt)
    with settings(df.sparkSession, {
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": file_bytes,
            **({"spark.sql.files.maxPartitionBytes": DEALT_BYTES} if dealt else {}), **SHUFFLED_ONCE}):
        (parquet_writer(laid, compression=compression, row_group_rows=row_group_rows)
         .partitionBy(*PARTITION_COLUMNS).parquet(f"{root}/{table}"))
    return pass_id


def written_files(spark: SparkSession, root: str, table: str, known: DataFrame, *,
                  pass_id: str | None = None) -> DataFrame:
    """Files below ``root`` the manifest does not list, with rows per payload.

    With ``pass_id`` only that write's directories are opened.  One line per file
    and payload digest.
    """
    from tapeworks.sources.silver import read_silver
    rows = read_silver(spark, root, table, "bronze_sha256").select(
        F.col("_metadata.file_path").alias("target_uri"),
        F.col("_metadata.file_size").alias("bytes_size"),
        "bronze_sha256", *PARTITION_COLUMNS)
    if pass_id is not None:
        rows = rows.where(F.col("p_pass") == pass_id)
    exchange, year, month, day, instrument = [F.col(c) for c in DIRECTORY_COLUMNS]
    path = F.concat(F.lit(f"{table}/exchange="), exchange, F.lit("/year="), year,
                    F.lit("/month="), month, F.lit("/day="), day,
                    F.lit("/instrument_type="), instrument)
    counted = rows.groupBy("target_uri", "bytes_size", path.alias("partition_path"),
                           "bronze_sha256").agg(F.count("*").alias("rows"))
    return (counted.join(known.select("target_uri"), "target_uri", "left_anti")
            .withColumn("table", F.lit(table)))


def silver_rows(files: DataFrame, written_at: Column) -> DataFrame:
    """Manifest rows of written files; the digest is set when one payload fed the file."""
    return (files.groupBy("target_uri", "table", "partition_path", "bytes_size").agg(
                F.sum("rows").alias("rows"), F.count("*").alias("_payloads"),
                F.min("bronze_sha256").alias("_sha"))
            .withColumn("bronze_sha256", F.when(F.col("_payloads") == 1, F.col("_sha")))
            .withColumn("written_at", written_at).withColumn("status", F.lit("written"))
            .drop("_payloads", "_sha"))


def write_plan(df: DataFrame, table: str) -> DataFrame:
    """What a write would produce, per directory; nothing is written."""
    where = partition_dir(table, F.col("exchange"), F.col("event_ts"), F.col("instrument_type"))
    return (df.groupBy(where.alias("partition_path")).agg(F.count("*").alias("rows"))
            .select(F.lit(table).alias("table"), "partition_path", "rows",
                    F.lit(len(SCHEMAS[table])).alias("columns"),
                    F.lit("event_ts ASC, isin ASC").alias("sort_order")))


def write_plan_totals(plan: DataFrame) -> DataFrame:
    return plan.agg(F.count("*").alias("partitions"), F.sum("rows").alias("records"),
                    F.count_distinct("table").alias("tables"))


def sample_rows(df: DataFrame, table: str, rows: int = 5) -> DataFrame:
    """The first rows of each directory in file order, preview columns only.

    Spark limits each task to ``rows`` per directory before the shuffle.
    """
    where = partition_dir(table, F.col("exchange"), F.col("event_ts"), F.col("instrument_type"))
    shown = [c for c in PREVIEW_COLUMNS if c in df.columns]
    place = F.row_number().over(W.partitionBy("partition_path").orderBy(*_sort_keys(df)))
    keep = list(dict.fromkeys([*shown, *[c for c in SORT_COLUMNS if c in df.columns]]))
    return (df.withColumn("partition_path", where).select("partition_path", *keep)
            .withColumn("place", place).where(F.col("place") <= rows)
            .select("partition_path", "place", *shown))
