"""Partition values and directory names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tapeworks.functions.parsing import blank_to_null


def partition_value(value: Column) -> Column:
    """Null and '' become ``unknown``; characters unfit for a path become ``_``."""
    return F.regexp_replace(F.coalesce(blank_to_null(value), F.lit("unknown")),
                            r"[/\\ =]", "_")


def date_parts(event_ts: Column) -> tuple[Column, Column, Column]:
    # Formatting a time is dear, so it is done once; a year may have more than four characters.
    day = F.date_format(event_ts, "yyyy-MM-dd")
    return F.substring_index(day, "-", 1), F.substring(day, -5, 2), F.substring(day, -2, 2)


def partition_dir(table: str | Column, exchange: Column, event_ts: Column,
                  instrument_type: Column) -> Column:
    """``trades/exchange=…/year=…/month=…/day=…/instrument_type=…``."""
    year, month, day = date_parts(event_ts)
    name = F.lit(table) if isinstance(table, str) else table
    return F.concat(name, F.lit("/exchange="), partition_value(exchange),
                    F.lit("/year="), year, F.lit("/month="), month, F.lit("/day="), day,
                    F.lit("/instrument_type="), partition_value(instrument_type))


def feed_root(feed: Column) -> Column:
    return F.substring_index(feed, "/", 1)
