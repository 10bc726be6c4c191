"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings every operator relies on.
RUNTIME_CONF = {
    # All market times are UTC; date parts and hash texts depend on it.
    "spark.sql.session.timeZone": "UTC",
    # The default form of times in files has no statistics, so no filter could skip by them.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # A repeated JSON key is legal input: the last one wins.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Hours of feeds hold several states a key, which the default store refuses; and dedupe
    # keeps one key per row inside the watermark, which belongs off the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# For a write whose plan is run once: what it shuffled is deleted as soon as it ends, not when
# the driver happens to collect the plan.
SHUFFLED_ONCE = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings that hold for a while."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def build_session(app_name: str = "tapeworks", *, master: str | None = None,
                  **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {
        **RUNTIME_CONF,
        **{k.replace("_", "."): v for k, v in conf.items()},
    }.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names the shared folder.  Only where it is unset and
    one process does all the work (tests) a temporary folder is chosen, and
    recorded in the session so that later calls stay together.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("tapeworks.workspace", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tapeworks-")
        spark.conf.set("tapeworks.workspace", base)
    if "://" not in base:
        base = os.path.abspath(base)
    return f"{base.rstrip('/')}/tapeworks/{name}-{uuid.uuid4().hex[:12]}"
