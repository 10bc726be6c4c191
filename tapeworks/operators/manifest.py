"""The file manifest as append-only event tables and the states folded from them.

A bronze event is either a landing (``kind='landed'``, all columns of the
bronze table) or a status change (``kind='status'``: sha256, status, error).
Events are ordered by ``(event_at, event_no)``.  All folds are single
aggregations with map-side combine, so a digest that occurs in a third of all
events is reduced where it is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tapeworks.functions.hashing import error_text
from tapeworks.schema import BRONZE_SCHEMA, RUN_LOG_SCHEMA, SILVER_SCHEMA

BRONZE_EVENT_SCHEMA = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("event_at", T.DoubleType()),
     T.StructField("event_no", T.LongType())]
    + [T.StructField(f.name, f.dataType) for f in BRONZE_SCHEMA.fields])
SILVER_EVENT_SCHEMA = T.StructType(
    [T.StructField("event_no", T.LongType())]
    + [T.StructField(f.name, f.dataType) for f in SILVER_SCHEMA.fields])


def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None))
                       .cast(f.dataType).alias(f.name) for f in schema.fields])


# --- events -----------------------------------------------------------------

def landing_events(rows: DataFrame, event_no: Column | None = None) -> DataFrame:
    """Bronze rows as landing events, ordered by their landing time."""
    number = F.lit(0) if event_no is None else event_no
    return _conform(rows.withColumn("kind", F.lit("landed"))
                    .withColumn("event_at", F.col("scraped_at"))
                    .withColumn("event_no", number), BRONZE_EVENT_SCHEMA)


def status_events(outcomes: DataFrame, event_at: Column, event_no: Column | None = None,
                  ) -> DataFrame:
    """Status changes from ``sha256, status, error``; errors are cut to 1024."""
    number = F.lit(0) if event_no is None else event_no
    return _conform(outcomes.select(
        "sha256", "status", error_text(F.col("error")).alias("error"),
        F.lit("status").alias("kind"), event_at.alias("event_at"), number.alias("event_no"),
    ), BRONZE_EVENT_SCHEMA)


# --- folds ------------------------------------------------------------------

def fold_bronze(events: DataFrame) -> DataFrame:
    """Current bronze table.

    * first landing wins: a second one with the same digest adds nothing;
    * the last status change after it wins; ``ingested`` clears the error and
      sets ``ingested_at``, ``failed`` leaves an earlier ``ingested_at`` alone;
    * a status change for a digest that has not landed is void.
    """
    order = F.struct("event_at", "event_no")
    # Events with equal order are told apart by their content, the same way each time.
    landing_order = F.struct("event_at", "event_no", "exchange", "label")
    status_order = F.struct("event_at", "event_no", "status")
    landed = F.struct(*[f.name for f in BRONZE_SCHEMA.fields if f.name != "sha256"])
    is_landing, is_status = F.col("kind") == "landed", F.col("kind") == "status"
    state = (events.groupBy("sha256").agg(
        F.min_by(F.when(is_landing, landed), F.when(is_landing, landing_order)).alias("first"),
        F.min(F.when(is_landing, order)).alias("landed_at"),
        F.max_by(F.when(is_status, F.struct("status", "error")),
                 F.when(is_status, status_order)).alias("last"),
        F.max(F.when(is_status, order)).alias("changed_at"),
        F.max(F.when(is_status & (F.col("status") == "ingested"), order)).alias("ingested_at"),
    ).where(F.col("first").isNotNull()))
    changed = F.coalesce(F.col("changed_at") > F.col("landed_at"), F.lit(False))
    ingested = F.coalesce(F.col("ingested_at") > F.col("landed_at"), F.lit(False))
    values = {f.name: F.col(f"first.{f.name}") for f in BRONZE_SCHEMA.fields
              if f.name != "sha256"}
    values["sha256"] = F.col("sha256")
    values["status"] = F.when(changed, F.col("last.status")).otherwise(values["status"])
    values["ingested_at"] = F.when(ingested, F.col("ingested_at.event_at")).otherwise(
        values["ingested_at"])
    values["error"] = F.when(
        changed, F.when(F.col("last.status") == "failed", F.col("last.error"))
    ).otherwise(values["error"])
    return state.select(*[values[f.name].alias(f.name) for f in BRONZE_SCHEMA.fields])


def fold_silver(events: DataFrame) -> DataFrame:
    """Current silver table: per file URI the last event replaces the row."""
    rest = F.struct(*[f.name for f in SILVER_SCHEMA.fields if f.name != "target_uri"])
    state = events.groupBy("target_uri").agg(
        F.max_by(rest, F.struct("written_at", "event_no")).alias("s"))
    return state.select(*[F.col("target_uri") if f.name == "target_uri"
                          else F.col(f"s.{f.name}").alias(f.name) for f in SILVER_SCHEMA.fields])


def _event(events: DataFrame) -> Column:
    return F.struct(*[F.col(c) for c in events.columns])


def bronze_base(events: DataFrame) -> DataFrame:
    """The few events of each digest that decide its state, now and with any later ones:
    the first landing, the last status change and the last one to ``ingested``.

    A fold takes least and greatest events, so folding these with what follows them
    gives what all events would.
    """
    event, is_status = _event(events), F.col("kind") == "status"
    first = F.when(F.col("kind") == "landed", F.struct("event_at", "event_no", "exchange", "label"))
    last = F.when(is_status, F.struct("event_at", "event_no", "status"))
    done = F.when(is_status & (F.col("status") == "ingested"), F.struct("event_at", "event_no"))
    kept = F.array_distinct(F.array_compact(F.array("first", "last", "done")))
    return events.groupBy("sha256").agg(
        F.min_by(event, first).alias("first"), F.max_by(event, last).alias("last"),
        F.max_by(event, done).alias("done")).select(F.explode(kept).alias("e")).select("e.*")


def silver_base(events: DataFrame) -> DataFrame:
    """The last event of each file."""
    return events.groupBy("target_uri").agg(F.max_by(
        _event(events), F.struct("written_at", "event_no")).alias("e")).select("e.*")


# --- dedupe -----------------------------------------------------------------

def first_per_key(batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first in ``order``; rows without a whole key all stay.

    An aggregation rather than a window: repeated keys shrink before the shuffle.  A row
    without a whole key is a group of its own, so the batch is read once.
    """
    rest = [c for c in batch.columns if c not in keys]
    lacking = F.lit(False)
    for key in keys:
        lacking = lacking | F.col(key).isNull()
    own = F.when(lacking, F.monotonically_increasing_id())
    best = batch.withColumn("_own", own).groupBy(*keys, "_own").agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in batch.columns])


def not_seen(batch: DataFrame, bronze: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key columns do not occur in the manifest.

    ``['exchange', 'label']`` tests a label within its feed, ``['label']`` in any
    feed, ``['sha256']`` the content, ``['label', 'sha256']`` a file whose name
    never changes.
    """
    return batch.join(bronze.select(*keys).distinct(), keys, "left_anti")


# --- queries ----------------------------------------------------------------

def pending(bronze: DataFrame, exchange: str | None = None, limit: int | None = None,
            ) -> DataFrame:
    """Files to ingest, oldest first; all of them unless ``limit`` is given.
    ``exchange`` is the whole feed path."""
    rows = bronze.where(F.col("status") == "downloaded")
    if exchange:
        rows = rows.where(F.col("exchange") == exchange)
    rows = rows.orderBy("scraped_at", "sha256")
    return rows if limit is None else rows.limit(limit)


def stats(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Files per layer and status."""
    layers = (bronze.select(F.lit("bronze").alias("layer"), "status")
              .unionAll(silver.select(F.lit("silver").alias("layer"), "status")))
    return layers.groupBy("layer", "status").agg(F.count("*").alias("files"))


def files_per_day(bronze: DataFrame) -> DataFrame:
    day = F.date_format(F.timestamp_seconds("scraped_at"), "yyyy-MM-dd")
    return bronze.groupBy("exchange", day.alias("day"), "status").agg(
        F.count("*").alias("files"), F.sum("bytes_size").alias("bytes"))


def run_log_rows(outcomes: DataFrame, *, run_id: str, started_at: Column, ended_at: Column,
                 ) -> DataFrame:
    """One line per feed from a pass's outcomes (see ``plans.ingest``)."""
    rows = outcomes.groupBy("exchange").agg(
        F.count_if(F.col("outcome").isin("ok", "empty")).alias("files_new"),
        F.count_if(F.col("outcome") == "no_adapter").alias("files_skip"),
        F.sum("rows").alias("rows_total"), F.min("error").alias("error"))
    # The feed makes the id unique within the pass.
    return _conform(rows.withColumn("run_id", F.concat(F.lit(f"{run_id}:"), "exchange"))
                    .withColumn("started_at", started_at).withColumn("ended_at", ended_at),
                    RUN_LOG_SCHEMA)


# --- storage ----------------------------------------------------------------

class ManifestTables:
    """Event tables below one folder.  One writer at a time; many readers.

    Events are appended to the folder of the current epoch.  ``rebase`` reduces what
    has been so far to a base and begins a new epoch: from then on a state is read
    from the base and the events since, whatever the length of the history.  Old
    epochs stay for reads of an earlier time.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except Exception as failure:
            if "PATH_NOT_FOUND" not in str(failure):
                raise
            return self.spark.createDataFrame([], schema)

    def _append(self, df: DataFrame, name: str) -> None:
        df.write.mode("append").parquet(f"{self.root}/{name}")

    def _epoch(self, name: str) -> int:
        """The newest epoch whose base is complete; there is a line for each."""
        heads = self._read(f"{name}_heads", T.StructType([T.StructField("epoch", T.LongType())]))
        return heads.agg(F.max("epoch")).first()[0] or 0

    def _events(self, name: str, schema: T.StructType, *, every: bool = False) -> DataFrame:
        """The base and the events since, or all events there have been."""
        stored = T.StructType([*schema.fields, T.StructField("epoch", T.LongType())])
        events = self._read(name, stored)
        if every:
            return events.drop("epoch")
        epoch = self._epoch(name)
        events = events.where(F.col("epoch") >= epoch)
        if epoch:
            events = events.unionByName(self._read(f"{name}_base", stored).where(F.col("epoch") == epoch))
        return events.drop("epoch")

    def _add(self, df: DataFrame, name: str) -> None:
        self._append(df, f"{name}/epoch={self._epoch(name)}")

    def rebase(self) -> None:
        """Begin new epochs, each with a base of the state so far.

        The line that makes a base the current one is written last; a base that a dead
        run has left without one is replaced.
        """
        for name, schema, reduce in (("bronze_events", BRONZE_EVENT_SCHEMA, bronze_base),
                                     ("silver_events", SILVER_EVENT_SCHEMA, silver_base)):
            epoch = self._epoch(name) + 1
            reduce(self._events(name, schema)).write.mode("overwrite").parquet(
                f"{self.root}/{name}_base/epoch={epoch}")
            self._append(self.spark.range(epoch, epoch + 1).toDF("epoch"), f"{name}_heads")

    def bronze(self) -> DataFrame:
        return fold_bronze(self._events("bronze_events", BRONZE_EVENT_SCHEMA))

    def silver(self, as_of: float | None = None) -> DataFrame:
        """Current silver table, or the one after all events up to ``as_of``."""
        events = self._events("silver_events", SILVER_EVENT_SCHEMA, every=as_of is not None)
        return fold_silver(events if as_of is None else events.where(F.col("written_at") <= as_of))

    def run_log(self) -> DataFrame:
        return self._read("run_log", RUN_LOG_SCHEMA)

    def append_events(self, events: DataFrame) -> None:
        """Bronze events in their stored form."""
        self._add(_conform(events, BRONZE_EVENT_SCHEMA), "bronze_events")

    def land(self, rows: DataFrame) -> None:
        self._add(landing_events(rows), "bronze_events")

    def mark(self, outcomes: DataFrame, event_at: Column) -> None:
        self._add(status_events(outcomes, event_at), "bronze_events")

    def record_silver(self, rows: DataFrame, event_no: int = 0) -> None:
        self._add(_conform(rows.withColumn("event_no", F.lit(event_no)),
                           SILVER_EVENT_SCHEMA), "silver_events")

    def log_run(self, rows: DataFrame) -> None:
        self._append(rows, "run_log")

    def import_labels(self, rows: DataFrame) -> int:
        """Append label rows that are not there yet; returns how many were given."""
        self.land(not_seen(rows.dropDuplicates(["sha256"]), self.bronze(), ["sha256"]))
        return rows.count()
