"""The three typed tables, their vocabularies and the state tables."""

from __future__ import annotations

from pyspark.sql import types as T

SCHEMA_VERSION = "2.0.0"

# Vocabularies stored as plain strings.
DATA_TYPES = ("pre_trade", "post_trade")
TRADE_FLAGS = (
    "normal", "large_in_scale", "benchmark", "negotiated", "dark", "offbook",
    "agency_cross", "systematic_internaliser", "late_publication",
    "cancellation", "amendment", "unknown",
)
BRONZE_STATUSES = ("downloaded", "ingested", "failed")
SILVER_STATUSES = ("written", "compacted", "expired")


_TYPES = {
    "ts": T.TimestampType(), "long": T.LongType(), "int": T.IntegerType(),
    "double": T.DoubleType(), "string": T.StringType(), "bool": T.BooleanType(),
}


def _fields(text: str) -> list[T.StructField]:
    """``name:type`` words to fields; a trailing ``!`` marks a required one."""
    fields = []
    for word in text.split():
        name, kind = word.rstrip("!").split(":")
        fields.append(T.StructField(name, _TYPES[kind], nullable=not word.endswith("!")))
    return fields


# Column names, order and types of the typed tables.
_COMMON = """
event_ts:ts! publication_ts:ts received_ts:ts ingest_ts:ts! seq:long
exchange:string! mic:string data_type:string!
isin:string ticker:string figi:string venue_instrument_id:string
instrument_type:string currency:string venue_segment:string
source_file:string source_url:string source_msg_hash:string schema_version:string!
"""
_OWN = {
    "trades": """
trade_price:double trade_size:double trade_id:string notional:double side:string
trade_flag_canonical:string trade_flags_raw:string
""",
    "quotes": """
bid_price:double bid_size:double ask_price:double ask_size:double
book_level:int snapshot:bool
""",
    "bars": """
bar_interval:string open:double high:double low:double close:double volume:double
vwap:double trades_count:long
""",
}

COMMON_FIELDS = _fields(_COMMON)
COMMON_COLUMNS = [f.name for f in COMMON_FIELDS]
REQUIRED_COLUMNS = [f.name for f in COMMON_FIELDS if not f.nullable]
TABLES = tuple(_OWN)
SCHEMAS = {name: T.StructType(COMMON_FIELDS + _fields(own)) for name, own in _OWN.items()}

# State tables.  Times are epoch seconds, as users of the manifest expect.
BRONZE_SCHEMA = T.StructType(_fields("""
sha256:string! exchange:string! label:string! source_uri:string! bytes_size:long!
scraped_at:double! data_type:string status:string! ingested_at:double error:string
"""))
SILVER_SCHEMA = T.StructType(_fields("""
target_uri:string! table:string! partition_path:string! rows:long! bytes_size:long!
written_at:double! bronze_sha256:string status:string!
"""))
RUN_LOG_SCHEMA = T.StructType(_fields("""
run_id:string! started_at:double! ended_at:double exchange:string
files_new:long files_skip:long rows_total:long error:string
"""))
MASTER_COLUMNS = ("isin", "ticker", "figi", "asset_class", "country", "currency")
