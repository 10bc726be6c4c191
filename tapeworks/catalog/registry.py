"""Collects queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tapeworks.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is its equivalent for DuckDB."""
    def add(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        run.__name__, run.__doc__ = build.__name__, build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build
    return add


# DuckDB expressions shared by the checks -------------------------------------

def duck_flag(raw: str) -> str:
    """Canonical flag of a raw flag column."""
    tokens = (f"list_filter(list_transform(string_split(replace(coalesce({raw}, ''), ';', ','), "
              "','), lambda t: upper(trim(t))), lambda t: t <> '')")
    groups = (
        ("large_in_scale", "'LRGS','LIS'"), ("benchmark", "'BENC'"),
        ("negotiated", "'NPFT','NLIQ'"), ("dark", "'DARK','RFPT'"),
        ("systematic_internaliser", "'SI','SDIV'"), ("offbook", "'OILQ','NOFF'"),
        ("agency_cross", "'MOFF'"), ("late_publication", "'DLAY'"), ("cancellation", "'CANC'"),
        ("amendment", "'AMND'"))
    arms = " ".join(f"when list_has_any({tokens}, [{codes}]) then '{flag}'"
                    for flag, codes in groups)
    return f"case when len({tokens}) = 0 then 'normal' {arms} else 'unknown' end"


def duck_time(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def duck_hash(*parts: str) -> str:
    return "sha256(" + " || '|' || ".join(f"coalesce({p}, '')" for p in parts) + ")"


def duck_trade_hash(exchange: str = "exchange") -> str:
    return duck_hash(exchange, "isin", duck_time("event_ts") + " || '+00:00'",
                     "cast(price as varchar)", "cast(size as varchar)", "flags_raw")


NOTIONAL = "case when price <> 0 and size <> 0 then price * size end"
CENTS = "cast(sum(cast({} as decimal(18,2))) as double)"
