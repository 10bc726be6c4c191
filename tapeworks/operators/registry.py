"""Which adapter reads a feed."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tapeworks.functions.layout import feed_root


class Adapter(NamedTuple):
    feed: str
    adapter: str
    exchange: str
    mic: str | None
    data_type: str


# Feed path, format, exchange code, market code, kind of data.
ADAPTERS = (
    Adapter("berlin/pretrade", "rts13", "BERA", "BERA", "pre_trade"),
    Adapter("berlin/posttrade", "rts13", "BERA", "BERA", "post_trade"),
    Adapter("berlin", "rts13", "BERA", "BERA", "post_trade"),
    Adapter("athex", "rts13", "ATHEX", "ASEX", "post_trade"),
    Adapter("cboe", "rts13", "CBOE", None, "post_trade"),
    Adapter("bme", "bme", "BME", "BMEX", "post_trade"),
    Adapter("bme/post-trade", "bme", "BME", "BMEX", "post_trade"),
    Adapter("bank-of-greece", "hdat", "BOG-HDAT", "HDAT", "post_trade"),
    Adapter("bank-of-greece/Pre-Trade", "hdat", "BOG-HDAT", "HDAT", "pre_trade"),
    Adapter("bank-of-greece/Post-Trade", "hdat", "BOG-HDAT", "HDAT", "post_trade"),
)


def resolve_adapter(df: DataFrame, feed: str = "exchange", *,
                    adapters: tuple[Adapter, ...] = ADAPTERS) -> DataFrame:
    """Add ``route``: the adapter of the whole feed path, else of its first segment.

    The registry is code, so it enters the plan as one literal map: a lookup
    inside the projection, no join.
    """
    def entry(a: Adapter) -> Column:
        return F.struct(F.lit(a.adapter).alias("adapter"), F.lit(a.exchange).alias("exchange"),
                        F.lit(a.mic).cast("string").alias("mic"),
                        F.lit(a.data_type).alias("data_type"))

    table = F.create_map(*[c for a in adapters for c in (F.lit(a.feed), entry(a))])
    name = F.col(feed)
    return df.withColumn("route", F.coalesce(F.try_element_at(table, name),
                                             F.try_element_at(table, feed_root(name))))
