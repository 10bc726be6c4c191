"""Queries on writers: partitions, manifest states, compaction, retention, logs."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from tapeworks import fixtures as X
from tapeworks.catalog.registry import CENTS, NOTIONAL, duck_time, query
from tapeworks.catalog.rows import TRADES, clock, money
from tapeworks.operators.manifest import ManifestTables
from tapeworks.session import workspace
from tapeworks.sinks import logs, maintenance, parquet as P
from tapeworks.sinks.estimate import estimate
from tapeworks.sources.silver import read_live, read_silver

_PATH = """concat('trades/exchange=', exchange, '/year=', strftime(event_ts, '%Y'), '/month=',
  strftime(event_ts, '%m'), '/day=', strftime(event_ts, '%d'), '/instrument_type=',
  coalesce(instrument_type, 'unknown'))"""


@query("q_partition_plan", f"""
with {TRADES} select 'trades' as "table", {_PATH} as partition_path, count(*) as rows,
  26 as "columns", 'event_ts ASC, isin ASC' as sort_order from trades_v group by all""")
def partition_plan(spark, sf_dir):
    return P.write_plan(X.trade_rows(spark, sf_dir), "trades")


@query("q_partition_totals", f"""
with {TRADES} select count(distinct {_PATH}) as partitions, count(*) as records, 1::bigint as tables
from trades_v""")
def partition_totals(spark, sf_dir):
    return P.write_plan_totals(P.write_plan(X.trade_rows(spark, sf_dir), "trades"))


@query("q_partition_size", f"""
with {TRADES} select {_PATH} as partition_path, count(*) as rows, true as close from trades_v group by 1""")
def partition_size(spark, sf_dir):
    """The size that a write would have, next to the size it has: within 30 %."""
    rows, folder = X.trade_rows(spark, sf_dir), workspace(spark, "sized")
    P.write_silver(rows, folder, "trades")
    files = P.written_files(spark, folder, "trades", ManifestTables(spark, f"{folder}/_none").silver())
    real = files.groupBy("partition_path").agg(F.sum("bytes_size").alias("real"))
    close = F.abs(F.col("bytes") - F.col("real")) <= 0.3 * F.col("real")
    return estimate(rows, "trades").join(real, "partition_path", "left").select(
        "partition_path", "rows", F.coalesce(close, F.lit(False)).alias("close"))


@query("q_partition_head", f"""
with {TRADES} select partition_path, cast(place as int) as place, {duck_time('event_ts')} as event_time, isin from (
  select *, {_PATH} as partition_path, row_number() over (
    partition by {_PATH} order by event_ts, isin nulls last, seq) as place from trades_v)
where place <= 5""")
def partition_head(spark, sf_dir):
    return P.sample_rows(X.trade_rows(spark, sf_dir), "trades").select(
        "partition_path", "place", clock("event_ts").alias("event_time"), "isin")


_BY_DAY = f"""
with {TRADES} select exchange, cast(event_ts as date)::varchar as day, count(*) as records,
  cast(sum(size) as bigint) as size, {CENTS.format(NOTIONAL)} as notional
from trades_v group by all"""


def _by_day(df):
    return (df.groupBy("exchange", F.date_format("event_ts", "yyyy-MM-dd").alias("day"))
            .agg(F.count("*").alias("records"), F.sum("trade_size").cast("long").alias("size"),
                 money("notional").alias("notional")))


@query("q_sink_roundtrip", _BY_DAY)
def sink_roundtrip(spark, sf_dir):
    folder = workspace(spark, "roundtrip")
    P.write_silver(X.trade_rows(spark, sf_dir), folder, "trades", compression="zstd")
    return _by_day(read_silver(spark, folder, "trades"))


@query("q_clustered_files", f"""
with {TRADES} select {_PATH} as partition_path, count(*) as rows, true as in_order from trades_v group by 1""")
def clustered_files(spark, sf_dir):
    """Trades written in 100 ranges: the files of a directory follow one another in time."""
    folder = workspace(spark, "clustered")
    P.write_silver(X.trade_rows(spark, sf_dir), folder, "trades", ranges=100)
    path = F.concat_ws("/", *P.DIRECTORY_COLUMNS)
    files = read_silver(spark, folder, "trades").groupBy(path.alias("path"), F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("rows"), F.min("event_ts").alias("first"), F.max("event_ts").alias("last"))
    before = F.lag("last").over(W.partitionBy("path").orderBy("first", "last"))
    parts = F.split("path", "/")
    return files.withColumn("before", before).groupBy(F.concat(*[x for i, n in enumerate((
        "trades/exchange=", "/year=", "/month=", "/day=", "/instrument_type=")) for x in (
            F.lit(n), parts[i])]).alias("partition_path")).agg(
        F.sum("rows").alias("rows"), F.every(F.coalesce(F.col("first") >= F.col("before"), F.lit(True))).alias("in_order"))


def _append(spark, manifest, folder, table, rows, at):
    pass_id = P.write_silver(rows, folder, table, lineage="bronze_sha256" in rows.columns)
    manifest.record_silver(P.silver_rows(P.written_files(
        spark, folder, table, manifest.silver(), pass_id=pass_id), F.lit(at)))


def _written(spark, sf_dir, appends=1):
    """Trades written with lineage and registered, once per append."""
    folder = workspace(spark, "silver")
    manifest = ManifestTables(spark, f"{folder}/_manifest")
    rows = X.trade_rows(spark, sf_dir, "size").withColumnRenamed("size", "bronze_sha256")
    rows = rows.withColumn("bronze_sha256", F.col("trade_size").cast("int").cast("string"))
    for i in range(appends):
        part = rows.where(F.col("seq") % appends == i) if appends > 1 else rows
        _append(spark, manifest, folder, "trades", part, float(i))
    return folder, manifest


@query("q_silver_manifest", f"""
with {TRADES} select {_PATH} as partition_path, 'written' as status, count(*) as rows
from trades_v group by 1""")
def silver_manifest(spark, sf_dir):
    _, manifest = _written(spark, sf_dir)
    return manifest.silver().groupBy("partition_path", "status").agg(F.sum("rows").alias("rows"))


@query("q_lineage", f"""
with {TRADES} select {_PATH} as partition_path, cast(cast(size as int) as varchar) as bronze_sha256,
  count(*) as rows from trades_v group by all""")
def lineage(spark, sf_dir):
    folder, manifest = _written(spark, sf_dir)
    files = P.written_files(spark, folder, "trades", manifest.silver().limit(0))
    return files.groupBy("partition_path", "bronze_sha256").agg(F.sum("rows").alias("rows"))


@query("q_compact", _BY_DAY)
def compact(spark, sf_dir):
    """Two appends, one compaction: the live rows are the same rows."""
    folder, manifest = _written(spark, sf_dir, appends=2)
    maintenance.compact(spark, manifest, folder, "trades", min_files=2, now=10.0)
    return _by_day(read_live(spark, folder, "trades", manifest.silver()))


@query("q_compact_files", f"""
with {TRADES} select {_PATH} as partition_path, cast(count(*) as bigint) as live_rows,
  case when count(distinct seq % 2) = 2 then count(*) else 0 end as compacted_rows
from trades_v group by 1""")
def compact_files(spark, sf_dir):
    """Directories that got two files are rewritten, once."""
    folder, manifest = _written(spark, sf_dir, appends=2)
    maintenance.compact(spark, manifest, folder, "trades", now=10.0)
    # A second one finds nothing to do.
    maintenance.compact(spark, manifest, folder, "trades", now=11.0, event_no=2)
    rows = F.col("rows")
    return manifest.silver().groupBy("partition_path").agg(
        F.sum(F.when(F.col("status") == "written", rows)).alias("live_rows"),
        F.sum(F.when(F.col("status") == "compacted", rows).otherwise(0)).alias("compacted_rows"))


@query("q_expire", _BY_DAY.replace("from trades_v", "from trades_v "
                                   "where event_ts >= timestamp '2025-08-04'"))
def expire(spark, sf_dir):
    folder, manifest = _written(spark, sf_dir)
    manifest.record_silver(maintenance.expired(manifest.silver(), "2025-08-04", 10.0), 1)
    return _by_day(read_live(spark, folder, "trades", manifest.silver()))


@query("q_purgeable", f"""
with {TRADES}, appends as (select {_PATH} as partition_path, seq % 2 as append, count(*) as rows,
  min(cast(event_ts as date)) as day from trades_v group by 1, 2)
select partition_path, case when count(*) = 2 then 'compacted' else 'expired' end as status,
  sum(rows)::bigint as rows
from appends group by 1 having count(*) = 2 or min(day) < date '2025-08-04'""")
def purgeable(spark, sf_dir):
    """Files due for deletion: those retired at 10 and 20.  What expired at 300,000 is
    past its grace too, but a reader still looks at the state of 200,000."""
    folder, manifest = _written(spark, sf_dir, appends=2)
    maintenance.compact(spark, manifest, folder, "trades", now=10.0)
    # What was never compacted (directories of one append) expires early, the rest late.
    single = manifest.silver().where((F.col("status") == "written") & (F.col("written_at") < 10.0))
    manifest.record_silver(maintenance.expired(single, "2025-08-04", 20.0), 2)
    manifest.record_silver(maintenance.expired(manifest.silver(), "2025-08-04", 300_000.0), 3)
    readers = spark.createDataFrame([(200_000.0,), (400_000.0,)], "as_of double")
    due = maintenance.purgeable(manifest.silver(), now=500_000.0, grace=86_400.0, readers=readers)
    return due.groupBy("partition_path", "status").agg(F.sum("rows").alias("rows"))


# --- states in time --------------------------------------------------------------------------

def _appends(spark, sf_dir):
    """Three appends of trades by line number, and one of quotes with the second."""
    folder = workspace(spark, "appends")
    manifest = ManifestTables(spark, f"{folder}/_manifest")
    empty = F.lit(None).cast("string")
    trades = X.trade_rows(spark, sf_dir).withColumn("bronze_sha256", empty)
    for i in range(3):
        _append(spark, manifest, folder, "trades", trades.where(F.col("seq") % 3 == i), 100.0 + i)
        if i == 1:
            _append(spark, manifest, folder, "quotes",
                    X.quote_rows(spark, sf_dir).withColumn("bronze_sha256", empty), 101.0)
    return folder, manifest


@query("q_snapshot_asof", _BY_DAY.replace("from trades_v", "from trades_v where seq % 3 < 2"))
def snapshot_asof(spark, sf_dir):
    """Rows of the files that the manifest listed at the second append's time."""
    folder, manifest = _appends(spark, sf_dir)
    return _by_day(read_live(spark, folder, "trades", manifest.silver(as_of=101.0)))


@query("q_snapshot_stats", """
select 'trades' as "table", 3::bigint as snapshots, count(*) as records,
  count(*) filter (where l_linenumber % 3 < 2) as first_two from lineitem
union all select 'quotes', 1, count(*), count(*) from orders""")
def snapshot_stats(spark, sf_dir):
    """Appends and rows per table, in all and up to the second append."""
    _, manifest = _appends(spark, sf_dir)
    return manifest.silver().groupBy("table").agg(
        F.count_distinct("written_at").alias("snapshots"), F.sum("rows").alias("records"),
        F.sum(F.when(F.col("written_at") <= 101.0, F.col("rows"))).alias("first_two"))


# --- logs -----------------------------------------------------------------------------------

def log_entries(spark, sf_dir):
    return X.table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO").alias("level"),
        F.col("props").alias("message"),
        F.concat(F.lit("venue"), F.col("user_id") % 5).alias("exchange"),
        F.col("event_type").alias("asset_type"))


LOG_SQL = """
select concat('venue', user_id % 5) as exchange, event_type as asset_type,
  case when event_type = 'error' then 'ERROR' else 'INFO' end as level, count(*) as entries,
  min(strftime(ts, '%Y-%m-%dT%H:%M:%S')) as first, max(props) as last_message
from events group by all"""


def log_summary(df):
    return df.groupBy("exchange", "asset_type", "level").agg(
        F.count("*").alias("entries"), F.min("timestamp").alias("first"),
        F.max("message").alias("last_message"))


@query("q_log_partitions", LOG_SQL)
def log_partitions(spark, sf_dir):
    folder = workspace(spark, "logs")
    logs.append_logs(log_entries(spark, sf_dir), folder)
    return log_summary(logs.read_logs(spark, folder))
