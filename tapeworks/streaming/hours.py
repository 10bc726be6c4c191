"""Hourly files of each feed as a stream that also speaks for feeds that send nothing.

A windowed aggregation has no line for an hour without rows.  Here each feed has
state with an event-time timer at the end of its hour: when the watermark, which any
feed moves, passes it, the hour's line is given, with zeros if need be, and the next
hour begins.  Feeds that are expected enter by the initial state, so one that never
sends anything has its lines from the first hour on.

A feed's rows are dealt to ``shards`` keys, so a feed with a third of all rows isn't
one task's; lines are added up by who reads them.
"""

from __future__ import annotations

import sys
from collections import Counter

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

# Executors need pandas and pyarrow, but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LINES = "exchange string, window_start timestamp, files long, failed long"


class FeedHours(StatefulProcessor):
    """Counts of the hours that are open, and the first hour not yet given."""

    def __init__(self, step: int):
        self.step = step

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "start long", "files long, failed long")
        self.next = handle.getValueState("next", "start long")

    def expect(self, start: int) -> None:
        """From ``start`` on, hours are given; never again those that were."""
        if not self.next.exists() or start < self.next.get()[0]:
            self.next.update((start,))
            self.handle.registerTimer((start + self.step) * 1000)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.expect(int(initialState["since"].iloc[0]))

    def handleInputRows(self, key, rows, timerValues):
        files, failed = Counter(), Counter()
        for part in rows:
            start = part["second"] - part["second"] % self.step
            files.update(start.tolist())
            failed.update(start[part["failed"]].tolist())
        for start, n in files.items():
            before = self.open.getValue((start,)) if self.open.containsKey((start,)) else (0, 0)
            self.open.updateValue((start,), (before[0] + n, before[1] + failed[start]))
        if files:
            self.expect(min(files))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        over, start, lines = timerValues.getCurrentWatermarkInMs() // 1000, self.next.get()[0], []
        while start + self.step <= over:
            files, failed = self.open.getValue((start,)) if self.open.containsKey((start,)) else (0, 0)
            lines.append((key[0], pd.Timestamp(start, unit="s"), files, failed))
            if files:
                self.open.removeKey((start,))
            start += self.step
        if lines:
            self.next.update((start,))
            self.handle.registerTimer((start + self.step) * 1000)
        yield pd.DataFrame(lines, columns=["exchange", "window_start", "files", "failed"])

    def close(self) -> None:
        pass


def feed_hours(files: DataFrame, expected: DataFrame, *, since: int, step: int = 3600,
               delay: str = "1 hour", shards: int = 8) -> DataFrame:
    """``LINES`` of a stream of bronze rows with a time ``scraped_ts``.

    ``expected`` has the feeds (``exchange``) that have a line for every step from
    ``since`` (seconds) on; other feeds have theirs from their first file on.  A row
    behind the watermark is counted no more.
    """
    shard = F.pmod(F.xxhash64("sha256"), F.lit(shards)).cast("int")
    rows = files.withWatermark("scraped_ts", delay).select(
        "exchange", shard.alias("shard"), "scraped_ts", F.unix_seconds("scraped_ts").alias("second"),
        F.coalesce(F.col("status") == "failed", F.lit(False)).alias("failed"))
    first = expected.select("exchange", F.lit(0).alias("shard"),
                            F.lit(since - since % step).cast("long").alias("since")).distinct()
    return rows.groupBy("exchange", "shard").transformWithStateInPandas(
        FeedHours(step), LINES, "append", "eventTime", first.groupBy("exchange", "shard"))
