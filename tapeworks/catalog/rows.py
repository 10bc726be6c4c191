"""Queries on typed rows: flags, hashes, enrichment, checks, routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeworks import fixtures as X
from tapeworks.catalog.registry import (
    CENTS, NOTIONAL, duck_flag, duck_time, duck_trade_hash, query,
)
from tapeworks.functions.parsing import notional
from tapeworks.functions.flags import canonical_trade_flag
from tapeworks.operators import enrich as E, manifest as M, registry as R, validate as V
from tapeworks.functions.layout import partition_value

TRADES = f"trades_v as ({X.trades_sql(X.DUCK, 'lineitem')})"


def money(column: str):
    """Exact sum of amounts that have two decimals."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")


def clock(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


@query("q_trade_turnover", f"""
with {TRADES}, master as ({X.master_sql('part')}),
last_isin as (select trim(isin) k, arg_max(trim(asset_class), row_no) a from master
              where trim(isin) <> '' group by 1),
last_ticker as (select trim(ticker) k, arg_max(trim(asset_class), row_no) a from master
                where trim(ticker) <> '' group by 1),
last_figi as (select trim(figi) k, arg_max(trim(asset_class), row_no) a from master
              where trim(figi) <> '' group by 1)
select exchange, replace(coalesce(t.instrument_type, i.a, k.a, f.a, 'unknown'), ' ', '_') as instrument_type,
  {duck_flag('flags_raw')} as trade_flag_canonical, count(*) as trades,
  {CENTS.format(NOTIONAL)} as notional
from trades_v t left join last_isin i on t.isin = i.k left join last_ticker k on t.ticker = k.k
  left join last_figi f on t.figi = f.k
group by all""")
def trade_turnover(spark, sf_dir):
    """Enriched trades per venue, instrument type and canonical flag."""
    rows = E.enrich(X.trade_rows(spark, sf_dir), X.master_v(spark, sf_dir))
    return (rows.groupBy("exchange", partition_value(F.col("instrument_type"))
                         .alias("instrument_type"), "trade_flag_canonical")
            .agg(F.count("*").alias("trades"), money("notional").alias("notional")))


@query("q_flag_canonical", f"""
with {TRADES} select {duck_flag('flags_raw')} as trade_flag_canonical, count(*) as trades,
  {CENTS.format(NOTIONAL)} as notional from trades_v group by 1""")
def flag_canonical(spark, sf_dir):
    v = X.trades_v(spark, sf_dir)
    return (v.select(canonical_trade_flag(F.col("flags_raw")).alias("trade_flag_canonical"),
                     notional(F.col("price"), F.col("size")).alias("notional"))
            .groupBy("trade_flag_canonical")
            .agg(F.count("*").alias("trades"), money("notional").alias("notional")))


@query("q_row_hash", f"""
with {TRADES} select trade_id, {duck_time('event_ts')} as event_time,
  {duck_trade_hash()} as source_msg_hash from trades_v""")
def row_hashes(spark, sf_dir):
    return X.trade_rows(spark, sf_dir).select(
        "trade_id", clock("event_ts").alias("event_time"), "source_msg_hash")


@query("q_dedupe_hash", f"""
with {TRADES} select exchange, count(*) as trades,
  count(distinct {duck_trade_hash()}) as kept from trades_v group by 1""")
def dedupe_hash(spark, sf_dir):
    rows = X.trade_rows(spark, sf_dir)
    # Every column given to the operator travels with its row.
    kept = M.first_per_key(rows.select("source_msg_hash", "event_ts", "seq", "exchange"),
                           ["source_msg_hash"], ["event_ts", "seq"])
    return (rows.groupBy("exchange").agg(F.count("*").alias("trades"))
            .join(kept.groupBy("exchange").agg(F.count("*").alias("kept")), "exchange"))


@query("q_dedupe_trade_id", f"""
with {TRADES}, prints as (
  select * replace (case when seq % 3 > 0 then trade_id end as trade_id), {duck_trade_hash()} as hash
  from trades_v)
select trade_id, {duck_time('event_ts')} as event_time, exchange, hash as source_msg_hash from prints
qualify trade_id is null or row_number() over (partition by trade_id order by event_ts, hash) = 1""")
def dedupe_trade_id(spark, sf_dir):
    """Keys are an argument: here the print's own id, first print kept.  A third of the
    prints have no id and are nobody's copies."""
    rows = X.trade_rows(spark, sf_dir).select(
        F.when(F.col("seq") % 3 > 0, F.col("trade_id")).alias("trade_id"), "event_ts", "exchange",
        "source_msg_hash")
    kept = M.first_per_key(rows, ["trade_id"], ["event_ts", "source_msg_hash"])
    return kept.select("trade_id", clock("event_ts").alias("event_time"), "exchange",
                       "source_msg_hash")


_ENRICHED = f"""
with {TRADES}, master as (
  select nullif(trim(isin), '') isin, nullif(trim(ticker), '') ticker,
    nullif(trim(figi), '') figi, nullif(trim(asset_class), '') asset_class,
    nullif(trim(currency), '') currency, row_no from ({X.master_sql('part')})),
by_isin as (select *, 1 as hit from master where isin is not null
  qualify row_number() over (partition by isin order by row_no desc) = 1),
by_ticker as (select *, 1 as hit from master where ticker is not null
  qualify row_number() over (partition by ticker order by row_no desc) = 1),
by_figi as (select *, 1 as hit from master where figi is not null
  qualify row_number() over (partition by figi order by row_no desc) = 1),
found as (
  select t.*,
    case when i.hit = 1 then i.isin when k.hit = 1 then k.isin else f.isin end r_isin,
    case when i.hit = 1 then i.ticker when k.hit = 1 then k.ticker else f.ticker end r_ticker,
    case when i.hit = 1 then i.figi when k.hit = 1 then k.figi else f.figi end r_figi,
    case when i.hit = 1 then i.asset_class when k.hit = 1 then k.asset_class
         else f.asset_class end r_class,
    case when i.hit = 1 then i.currency when k.hit = 1 then k.currency
         else f.currency end r_currency
  from trades_v t left join by_isin i on t.isin = i.isin
    left join by_ticker k on t.ticker = k.ticker left join by_figi f on t.figi = f.figi),
enriched as (
  select trade_id, exchange, coalesce(isin, r_isin) as isin, coalesce(ticker, r_ticker) as ticker,
    coalesce(figi, r_figi) as figi, coalesce(instrument_type, r_class) as instrument_type,
    coalesce(currency, r_currency) as currency,
    (isin is null and r_isin is not null) or (ticker is null and r_ticker is not null)
      or (figi is null and r_figi is not null) or (instrument_type is null and r_class is not null)
      or (currency is null and r_currency is not null) as touched
  from found)"""


@query("q_enrich", _ENRICHED + " select * from enriched")
def enrich(spark, sf_dir):
    rows = E.enrich(X.trade_rows(spark, sf_dir), X.master_v(spark, sf_dir))
    return rows.select("trade_id", "exchange", "isin", "ticker", "figi", "instrument_type",
                       "currency", "touched")


@query("q_enrich_count", _ENRICHED
       + " select count(*) filter (where touched) as touched, count(*) as records from enriched")
def enrich_count(spark, sf_dir):
    return E.enrich_count(E.enrich(X.trade_rows(spark, sf_dir), X.master_v(spark, sf_dir)))


def _spoiled(spark, sf_dir):
    """Trades with errors put in by quantity."""
    quantity = F.col("trade_size")
    return (X.trade_rows(spark, sf_dir)
            .withColumn("event_ts", F.when(quantity != 1, F.col("event_ts")))
            .withColumn("exchange", F.when(~quantity.isin(1, 2), F.col("exchange")))
            .withColumn("data_type", F.when(quantity == 3, "bogus")
                        .when(quantity == 4, F.lit(None)).otherwise(F.col("data_type")))
            .withColumn("trade_flag_canonical", F.when(quantity.isin(3, 5), "not_a_flag")
                        .when(quantity == 6, F.lit(None))
                        .otherwise(F.col("trade_flag_canonical"))))


@query("q_validate_rejects", """
select case l_quantity when 1 then 'missing:event_ts' when 2 then 'missing:exchange'
  when 3 then 'data_type:bogus' when 4 then 'missing:data_type'
  when 5 then 'flag:not_a_flag' else 'valid' end as reason, count(*) as records
from lineitem group by 1""")
def validate_rejects(spark, sf_dir):
    valid, rejects = V.split_valid(_spoiled(spark, sf_dir), "trades")
    return (valid.select(F.lit("valid").alias("reason"))
            .unionAll(rejects.select("reject_reason"))
            .groupBy("reason").agg(F.count("*").alias("records")))


@query("q_route_tables", """
select 'trades' as "table", count(*) as records, 26 as "columns" from lineitem
union all select 'quotes', count(*), 25 from orders
union all select 'bars', count(*), 27 from events where value >= 1
union all select 'unknown', count(*), 0 from events where value < 1""")
def route_tables(spark, sf_dir):
    mixed = X.mixed_rows(spark, sf_dir)
    counts = [df.agg(F.count("*").alias("records"))
              .select(F.lit(name).alias("table"), "records", F.lit(len(df.columns)).alias("columns"))
              for name, df in V.route(mixed).items()]
    unknown = V.unknown_table_rows(mixed).agg(F.count("*").alias("records")).select(
        F.lit("unknown").alias("table"), "records", F.lit(0).alias("columns"))
    for part in counts:
        unknown = unknown.unionByName(part)
    return unknown


@query("q_all_events", f"""
with {TRADES}
select 'trades' as "table", exchange, data_type, cast(event_ts as date)::varchar as day,
  count(*) as records from (select *, 'post_trade' as data_type from trades_v) group by all
union all
select 'quotes', concat('venue', o_custkey % 5), 'pre_trade',
  make_timestamp(({X.FIRST_DAY} + o_orderkey % 604800) * 1000000)::date::varchar, count(*)
from orders group by all
union all
select 'bars', 'BOG-HDAT', 'post_trade', cast(ts as date)::varchar, count(*)
from events group by all""")
def all_events(spark, sf_dir):
    view = V.all_events({n: build(spark, sf_dir) for n, build in X.TABLE_ROWS.items()})
    return (view.groupBy("table", "exchange", "data_type",
                         F.date_format("event_ts", "yyyy-MM-dd").alias("day"))
            .agg(F.count("*").alias("records")))


@query("q_route_adapter", f"""
with bronze_v as ({X.bronze_sql(X.DUCK, 'events')}),
registry(feed, adapter, code, mic, data_type) as (values
  ('berlin/pretrade', 'rts13', 'BERA', 'BERA', 'pre_trade'),
  ('berlin/posttrade', 'rts13', 'BERA', 'BERA', 'post_trade'),
  ('berlin', 'rts13', 'BERA', 'BERA', 'post_trade'),
  ('athex', 'rts13', 'ATHEX', 'ASEX', 'post_trade'),
  ('cboe', 'rts13', 'CBOE', null, 'post_trade'),
  ('bme', 'bme', 'BME', 'BMEX', 'post_trade'),
  ('bme/post-trade', 'bme', 'BME', 'BMEX', 'post_trade'),
  ('bank-of-greece', 'hdat', 'BOG-HDAT', 'HDAT', 'post_trade'),
  ('bank-of-greece/Pre-Trade', 'hdat', 'BOG-HDAT', 'HDAT', 'pre_trade'),
  ('bank-of-greece/Post-Trade', 'hdat', 'BOG-HDAT', 'HDAT', 'post_trade'))
select b.exchange as feed, case when e.feed is not null then e.adapter else r.adapter end as adapter,
  case when e.feed is not null then e.code else r.code end as exchange,
  case when e.feed is not null then e.mic else r.mic end as mic,
  case when e.feed is not null then e.data_type else r.data_type end as data_type,
  count(*) as files
from bronze_v b left join registry e on b.exchange = e.feed
  left join registry r on string_split(b.exchange, '/')[1] = r.feed
group by all""")
def route_adapter(spark, sf_dir):
    routed = R.resolve_adapter(X.bronze_v(spark, sf_dir))
    return (routed.groupBy(F.col("exchange").alias("feed"), "route.adapter",
                           F.col("route.exchange").alias("code"), "route.mic", "route.data_type")
            .agg(F.count("*").alias("files")).withColumnRenamed("code", "exchange"))


@query("q_value_checks", f"""
with {TRADES}, parts as (
  select *, list_transform(string_split(reverse(array_to_string(list_transform(
      string_split(isin, ''), lambda c: case when c between 'A' and 'Z'
        then cast(ord(c) - 55 as varchar) else c end), '')), ''),
      lambda d: cast(d as int)) as digits from trades_v),
tested as (
  select *, price * case when size < 3 then -1 else 1 end as p,
    list_sum(list_transform(digits, lambda d, i:
      case when i % 2 = 0 then case when d > 4 then d * 2 - 9 else d * 2 end else d end)) as total
  from parts)
select array_to_string(list_filter([
    case when p < 0 then 'negative:trade_price' end,
    case when isin is not null and total % 10 <> 0 then 'isin_checksum' end,
    case when event_ts < timestamp '2025-08-02' or event_ts > timestamp '2025-08-07'
      then 'event_ts_range' end], lambda x: x is not null), ',') as checks, count(*) as records
from tested group by 1""")
def value_checks(spark, sf_dir):
    rows = (X.trade_rows(spark, sf_dir).drop("notional").withColumn(
        "trade_price", F.when(F.col("trade_size") < 3, -F.col("trade_price"))
        .otherwise(F.col("trade_price"))).withColumn("notional", F.lit(None).cast("double")))
    checked = V.value_checks(rows, "trades", earliest=F.lit("2025-08-02").cast("timestamp"),
                             latest=F.lit("2025-08-07").cast("timestamp"))
    return checked.groupBy(F.array_join("checks", ",").alias("checks")).agg(
        F.count("*").alias("records"))


@query("q_sequence_checks", f"""
with {TRADES}, per_number as (
  select concat(exchange, '.csv') as source_file, seq, count(*) as n from trades_v group by all)
select source_file, cast(sum(n) as bigint) as records, count(*) filter (where n > 1) as repeated,
  min(seq) as first, max(seq) as last, count(seq) as numbers,
  count(*) filter (where n > 1) = 0 and min(seq) = 1 and max(seq) = count(seq)
    and sum(n) = count(seq) as ok
from per_number group by 1""")
def sequence_checks(spark, sf_dir):
    return V.sequence_checks(X.trade_rows(spark, sf_dir))
