"""Operator inputs derived from the generic test tables.

Every derivation keeps all rows of its table.  Where the same derivation is also
needed by the SQL that checks a query, it is written once as SQL for both
engines; ``DUCK`` and ``SPARK`` hold the few functions that differ.  Payload
documents are built inside one row each, so their number and size follow the
table and no group of rows is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapeworks.functions.flags import canonical_trade_flag
from tapeworks.functions.hashing import trade_hash
from tapeworks.functions.parsing import notional
from tapeworks.sources.reference_data import clean_master
from tapeworks.sources.rows import schema_version, typed_select
from tapeworks.schema import SCHEMAS

SPARK = {"epoch": "unix_seconds(cast({} as timestamp))"}
DUCK = {"epoch": "cast(floor(epoch({})) as bigint)"}

FIRST_DAY = 1754006400          # 2025-08-01 00:00:00 UTC
INGEST_TS = 1754300000

FEEDS = ("berlin/pretrade", "berlin/posttrade", "berlin/other", "athex/AXE", "cboe/bxe/hourly",
         "bme", "bme/post-trade/x", "bank-of-greece/Pre-Trade", "bank-of-greece/x",
         "munich/pretrade", "lsx", "berlinx")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _stamp(dialect: dict, seconds: str) -> str:
    if dialect is SPARK:
        return f"timestamp_seconds({seconds})"
    return f"make_timestamp(cast({seconds} as bigint) * 1000000)"


def choice(key: str, options: tuple[str | None, ...]) -> str:
    """SQL: the option number ``key`` modulo the number of options."""
    n = len(options)
    arms = " ".join(f"when {i} then " + ("null" if o is None else f"'{o}'")
                    for i, o in enumerate(options))
    return f"(case ({key}) % {n} {arms} end)"


# --- trades -----------------------------------------------------------------

def trades_sql(dialect: dict, source: str) -> str:
    """trades_v: one trade per order line."""
    when = (f"{FIRST_DAY} + (l_orderkey % 8) * 86400"
            " + (l_partkey * 97 + l_linenumber * 13 + l_suppkey) % 86400")
    part = "lpad(cast(l_partkey as string), 10, '0')"
    return f"""
select {_stamp(dialect, when)} as event_ts,
  concat('venue', cast(l_suppkey % 5 as string)) as exchange,
  case when l_linenumber in (5, 7) then null when l_suppkey % 9 = 0 then concat('ZZ', {part})
       else concat('XX', {part}) end as isin,
  case when l_linenumber = 7 then concat('T', cast(l_partkey as string)) end as ticker,
  case when l_linenumber = 5 then concat('BBG', {part}) end as figi,
  case when l_linenumber = 6 then null else 'equity' end as instrument_type,
  case when l_linenumber % 2 = 0 then 'EUR' end as currency,
  l_extendedprice / nullif(l_quantity, 0) as price, l_quantity as size,
  concat(cast(l_orderkey as string), '-', cast(l_linenumber as string)) as trade_id,
  case concat(l_returnflag, l_linestatus) when 'RO' then 'LRGS' when 'RF' then 'BENC,LRGS'
       when 'AF' then ' npft; DLAY' when 'NO' then 'ZZZZ' when 'NF' then 'CANC' end as flags_raw,
  cast(l_linenumber as bigint) as seq
from {source}"""


def trades_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(trades_sql(SPARK, "{lineitem}"), lineitem=table(spark, sf_dir, "lineitem"))


def trade_rows(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """trades_v with the full schema of ``trades``."""
    v = trades_v(spark, sf_dir)
    values = {c: F.col(c) for c in ("event_ts", "exchange", "isin", "ticker", "figi",
                                    "instrument_type", "currency", "trade_id", "seq")}
    values.update({
        "ingest_ts": F.timestamp_seconds(F.lit(INGEST_TS)), "data_type": F.lit("post_trade"),
        "schema_version": schema_version(), "trade_price": F.col("price"),
        "trade_size": F.col("size"), "notional": notional(F.col("price"), F.col("size")),
        "trade_flags_raw": F.col("flags_raw"),
        "trade_flag_canonical": canonical_trade_flag(F.col("flags_raw")),
        "source_file": F.concat("exchange", F.lit(".csv")),
        "source_msg_hash": trade_hash(F.col("exchange"), F.col("isin"), F.col("event_ts"),
                                      F.col("price"), F.col("size"), F.col("flags_raw"))})
    return typed_select(v, "trades", values, *extra)


def quote_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quote per order."""
    values = {
        "event_ts": F.timestamp_seconds(F.lit(FIRST_DAY) + F.col("o_orderkey") % 604800),
        "ingest_ts": F.timestamp_seconds(F.lit(INGEST_TS)), "data_type": F.lit("pre_trade"),
        "exchange": F.concat(F.lit("venue"), (F.col("o_custkey") % 5).cast("string")),
        "instrument_type": F.lit("equity"), "schema_version": schema_version(),
        "bid_price": F.col("o_totalprice"), "ask_price": F.col("o_totalprice") + 1,
        "bid_size": F.lit(1.0), "ask_size": F.lit(2.0), "book_level": F.lit(1),
        "snapshot": F.col("o_orderstatus") == "O"}
    return typed_select(table(spark, sf_dir, "orders"), "quotes", values)


def bar_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar per event."""
    values = {
        "event_ts": F.date_trunc("day", F.col("ts").cast("timestamp")),
        "ingest_ts": F.timestamp_seconds(F.lit(INGEST_TS)), "data_type": F.lit("post_trade"),
        "exchange": F.lit("BOG-HDAT"), "isin": F.concat(F.lit("GR"), F.col("user_id")),
        "instrument_type": F.lit("bond"), "schema_version": schema_version(),
        "bar_interval": F.lit("1d"), "close": F.col("value"), "trades_count": F.lit(1)}
    return typed_select(table(spark, sf_dir, "events"), "bars", values)


# --- instrument master --------------------------------------------------------

def master_sql(source: str) -> str:
    """master_v: two rows per part; the second, later one repeats the keys of
    every seventh part and has keys of its own otherwise."""
    key = "lpad(cast(p_partkey as string), 10, '0')"
    first = f"""
select concat('XX', {key}) as isin,
  case when p_partkey % 10 = 0 then '' else concat(' T', cast(p_partkey as string)) end as ticker,
  concat('BBG', {key}) as figi, p_type as asset_class, 'DE' as country,
  {choice('p_size', ('EUR', ' USD ', ''))} as currency, p_partkey as row_no
from {source}"""
    second = f"""
select case when p_partkey % 7 = 0 then concat('XX', {key}) else concat('YY', {key}) end,
  '', case when p_partkey % 14 = 0 then concat('BBG', {key}) else '' end,
  concat('late ', p_type), '', 'CHF', p_partkey + 1000000000000
from {source}"""
    return f"{first} union all {second}"


def master_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.sql(master_sql("{part}"), part=table(spark, sf_dir, "part"))
    return clean_master(raw, "row_no")


# --- bronze -------------------------------------------------------------------

def bronze_sql(dialect: dict, source: str) -> str:
    """bronze_v: one file per event."""
    seconds = dialect["epoch"].format("ts")
    return f"""
select cast(event_id as string) as sha256, {choice('user_id', FEEDS)} as exchange,
  concat(event_type, '-', cast(event_id as string), '.csv') as label,
  concat('/data/', cast(event_id as string)) as source_uri, event_id % 1000 as bytes_size,
  cast({seconds} as double) as scraped_at, cast(null as string) as data_type,
  case event_type when 'error' then 'failed' when 'signup' then 'downloaded'
       else 'ingested' end as status,
  cast(null as double) as ingested_at, cast(null as string) as error
from {source}"""


def bronze_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(bronze_sql(SPARK, "{events}"), events=table(spark, sf_dir, "events"))


def last_scrape(spark: SparkSession, sf_dir: str) -> float:
    """Newest landing time, the clock of the checks."""
    return bronze_v(spark, sf_dir).agg(F.max("scraped_at")).first()[0]


# --- payload documents ----------------------------------------------------------

CSV_FEEDS = ("berlin/pretrade", "berlin", "athex/AXE", "cboe/bxe/hourly")
CSV_FLAGS = ("", "LRGS", "BENC;LRGS", " npft ; DLAY", "ZZZZ", "CANC", "SI")


def csv_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CSV payload per document, one record per text line.

    The line itself travels along as a quoted note, so quotes and commas of real
    text pass through the CSV rules.  Three header layouts take turns.
    """
    docs = table(spark, sf_dir, "documents")
    record = f"""
      concat_ws(',',
        case when length(l) % 13 = 5 then 'NOT_A_TIMESTAMP' else date_format(timestamp_seconds(
          {FIRST_DAY} + (doc_id % 20) * 86400 + (doc_id * 131 + i * 17 + length(l)) % 86400),
          "yyyy-MM-dd'T'HH:mm:ss'Z'") end,
        case when i % 11 = 0 then '' else concat('DE', lpad(cast(doc_id as string), 10, '0')) end,
        cast(length(l) / 8.0D as string), cast(i % 50 as string), 'EUR',
        concat(cast(doc_id as string), '-', cast(i as string)),
        {choice('length(l)', CSV_FLAGS)},
        concat('"', replace(l, '"', '""'), '"'))"""
    header = choice("doc_id", (
        "TradingDateTime,ISIN,Price,Quantity,Currency,TradeID,Flags,Note",
        "timestamp,isin,price,quantity,currency,transactionid,flags,note",
        "TradeTime,ISIN,PRICE,QUANTITY,CURRENCY,TradeID,FLAGS,NOTE"))
    return docs.select(
        "doc_id", F.concat("lang", F.lit("-"), "doc_id", F.lit(".csv")).alias("label"),
        F.expr(choice("doc_id", CSV_FEEDS)).alias("exchange"),
        F.expr(f"encode(concat({header}, '\\n', array_join(transform(split(text, '\\n'), "
               f"(l, i) -> {record}), '\\n'), '\\n'), 'UTF-8')").alias("content"))


def csv_rows_sql() -> str:
    """The records of ``csv_payloads`` as the reader should see them (DuckDB)."""
    flags = choice("length(l)", CSV_FLAGS)
    return f"""
lines as (
  select doc_id, lang, unnest(string_split(text, chr(10))) as l,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 as i
  from documents),
csv_rows as (
  select doc_id, concat(lang, '-', doc_id, '.csv') as source_file,
    {choice('doc_id', CSV_FEEDS)} as exchange,
    row_number() over (partition by doc_id order by i) as seq,
    make_timestamp(({FIRST_DAY} + (doc_id % 20) * 86400
                    + (doc_id * 131 + i * 17 + length(l)) % 86400) * 1000000) as event_ts,
    case when i % 11 = 0 then null else concat('DE', lpad(cast(doc_id as varchar), 10, '0')) end
      as isin,
    length(l) / 8.0::double as price, cast(i % 50 as double) as size,
    concat(doc_id, '-', i) as trade_id, nullif({flags}, '') as flags_raw
  from lines where length(l) % 13 <> 5)"""


BME_ROOTS = ("list", "trades", "data", "malformed", "scalar", "empty")


def bme_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON payload per order, with one to three trades in six kinds of document."""
    orders = table(spark, sf_dir, "orders")
    item = f"""to_json(named_struct(
      'trading_datetime', case when k = 1 then '' end,
      'timestamp', date_format(timestamp_seconds(
          {FIRST_DAY} + (o_orderkey * 7 + k * 3601) % 604800), 'yyyy-MM-dd HH:mm:ss'),
      'price', case when k = 2 then cast(null as string) else cast(o_totalprice as string) end,
      'Price', case when k = 2 then o_totalprice else 1.5D end,
      'volume', case when k = 0 then 0 else 10 * k end, 'quantity', '4',
      'ISIN', concat('ES', lpad(cast(o_custkey as string), 10, '0')),
      'flags', {choice('o_custkey', CSV_FLAGS)}, 'trade_id', concat(o_orderkey, ':', k)))"""
    items = (f"concat('[', array_join(transform(sequence(0L, o_custkey % 3), k -> {item}), ','),"
             " ']')")
    content = f"""case o_orderkey % 6 when 0 then {items}
      when 1 then concat('{{"trades":', {items}, '}}')
      when 2 then concat('{{"trades":[],"data":', {items}, '}}')
      when 3 then concat({items}, ' x') when 4 then '"text"' else '{{}}' end"""
    return orders.select("o_orderkey", F.concat("o_orderkey", F.lit(".json")).alias("label"),
                         F.lit("bme").alias("exchange"),
                         F.expr(content).cast("binary").alias("content"))


def bme_rows_sql() -> str:
    return f"""
bme_rows as (
  select o_orderkey, concat(o_orderkey, '.json') as source_file, k + 1 as seq,
    make_timestamp(({FIRST_DAY} + (o_orderkey * 7 + k * 3601) % 604800) * 1000000) as event_ts,
    concat('ES', lpad(cast(o_custkey as varchar), 10, '0')) as isin, o_totalprice as price,
    case when k = 0 then 4.0 else 10.0 * k end::double as size,
    concat(o_orderkey, ':', k) as trade_id,
    nullif({choice('o_custkey', CSV_FLAGS)}, '') as flags_raw
  from (select *, unnest(generate_series(0, o_custkey % 3)) as k from orders)
  where o_orderkey % 6 < 3)"""


def hdat_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bond document with two bars per event; ``signup`` events carry a trade
    count that refuses the document."""
    events = table(spark, sf_dir, "events")
    item = """concat('{"date":"', date_format(ts, 'yyyy-MM-dd'), '","isin":"GR',
      lpad(cast(user_id as string), 10, '0'), '","open":', cast(value as string),
      ',"high":"', cast(value + k as string), '","low":', cast(k as string), ',"close":',
      cast(value as string), ',"volume":', cast(event_id as string), ',"vwap":null,"trades":',
      case when k = 0 then '0' when event_type = 'signup' then '"1.5"' else '"12"' end, '}')"""
    content = ("concat('{\"data\":[', array_join(transform(array(0, 1), "
               f"k -> {item}), ','), ']}}')")
    return events.select("event_id", F.concat("event_id", F.lit(".json")).alias("label"),
                         F.lit("bank-of-greece/Pre-Trade").alias("exchange"),
                         F.expr(content).cast("binary").alias("content"))


def hdat_rows_sql() -> str:
    return """
hdat_rows as (
  select event_id, concat(event_id, '.json') as source_file, date_trunc('day', ts) as event_ts,
    concat('GR', lpad(cast(user_id as varchar), 10, '0')) as isin, value as open,
    value + k as high, cast(k as double) as low, value as close,
    cast(event_id as double) as volume, case when k = 1 then 12 end as trades_count
  from (select *, unnest([0, 1]) as k from events)
  where event_type <> 'signup')"""


def ingest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All payloads as pending files of one pass, with feeds that have no adapter
    (every feed name of ``munich``), virtual rows and a missing payload among them."""
    extra = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), "c_custkey").alias("label"),
        F.when(F.col("c_custkey") % 3 == 0, "munich/pretrade").otherwise("berlin").alias("exchange"),
        F.when(F.col("c_custkey") % 3 == 1, F.lit(b"")).alias("content"))
    parts = [p.select("label", "exchange", "content") for p in (
        csv_payloads(spark, sf_dir), bme_payloads(spark, sf_dir), hdat_payloads(spark, sf_dir),
        extra)]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    # Payloads differ in size by orders of magnitude: spread them by bytes.  Digests are made
    # where the payloads arrive; they would be a third of what is moved.
    return union.hint("rebalance").withColumn("sha256", F.sha2(F.concat_ws("/", "exchange", "label"), 256))


# --- pages and messages -----------------------------------------------------------

MARKET_NAMES = ("bxe", "CXE", "dxe", "apa", "zzz")


def listing_pages_sql(source: str) -> str:
    """Pages with a file listing appended: hourly CSVs, a repeated file under a
    second address, a post-trade JSON, links known by type or text, a stamped file,
    and anchors that a comment, a script or a quoted ``>`` might blur."""
    return f"""
select page_id, url, concat(html,
  '<a href="files/rts13_public_trade_data_', {choice('page_id', MARKET_NAMES)},
  '_2025-08-0', cast(page_id % 9 + 1 as string), '_0', cast(page_id % 7 as string),
  '.csv"> hour ', cast(page_id as string), ' </a>',
  '<a href="//cdn.example.org/a/f', cast(page_id % 50 as string), '.csv">one</a>',
  '<A class=x href=''/b/f', cast(page_id % 50 as string), '.csv''>two</A>',
  '<a href="https://x.example.org/d?id=', cast(page_id as string), '&amp;z=1">',
  '<b>2025-08-01</b>', cast(page_id as string), '_BMEA_posttrade.json</a>',
  '<a type="text/comma-separated-values" href="/p/t', cast(page_id % 40 as string),
  '">post ', cast(page_id % 40 as string), '</a>',
  '<a href="/p/pre?d=', cast(page_id as string), '">Download der Pretrade Daten für ',
  cast(page_id % 30 as string), '</a>',
  '<a href="/z/DEUR-2025-08-01T', cast(page_id % 10 + 10 as string), '_00.json.gz">gz</a>',
  '<!-- <a href="/old/f', cast(page_id as string), '.csv">commented</a> > -->',
  '<script type="x">let a = "<a href=''/js.csv''>written</a>";</script>',
  '<a title="1 > 0, href=no" href="/gt/', cast(page_id as string), '.csv">gt <!-- <b> --></a>',
  '<a href="">none</a>') as html
from {source}"""


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(listing_pages_sql("{pages}"), pages=table(spark, sf_dir, "pages"))


def messages_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per conversation turn; every third turn carries a link, turns
    have zero to two attachments."""
    talks = table(spark, sf_dir, "conversations")
    return talks.select(
        F.concat("role", F.lit("@example.org")).alias("sender"),
        F.concat(F.lit("desk"), F.col("conv_id") % 20).alias("recipient"), "conv_id", "turn",
        F.timestamp_seconds(F.lit(FIRST_DAY) + F.col("conv_id") * 3600 + F.col("turn"))
        .alias("received_at"),
        F.when(F.col("turn") % 3 == 0, F.concat(
            "text", F.lit(' <a href="HTTPS://dl.luxse.com/dl?v='), "conv_id", F.lit("-"), "turn",
            F.lit('">x</a>'))).otherwise(F.col("text")).alias("text"),
        F.expr("""slice(array(
            named_struct('disposition', 'attachment', 'filename', concat('in/', role, '.xlsx'),
                         'content', encode(text, 'UTF-8')),
            named_struct('disposition', 'inline', 'filename', 'logo.png',
                         'content', encode('x', 'UTF-8'))), 1, cast(turn % 3 as int))""")
        .alias("attachments"))


def mixed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One mixed batch: trades, quotes, bars, and rows for a table nobody knows."""
    parts = [trade_rows(spark, sf_dir).withColumn("table", F.lit("trades")),
             quote_rows(spark, sf_dir).withColumn("table", F.lit("quotes")),
             bar_rows(spark, sf_dir).withColumn(
                 "table", F.when(F.col("close") < 1, "ticks").otherwise("bars"))]
    mixed = parts[0]
    for part in parts[1:]:
        mixed = mixed.unionByName(part, allowMissingColumns=True)
    return mixed


TABLE_ROWS = {"trades": trade_rows, "quotes": quote_rows, "bars": bar_rows}
assert set(TABLE_ROWS) == set(SCHEMAS)
