"""Data-quality gates over the bronze manifest."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


class Rule(NamedTuple):
    exchange: str
    min_files: int = 0
    max_failure_rate: float = 0.10


# Feed text, least number of files, highest share of failures.
DEFAULT_RULES = (
    Rule("berlin", 20, 0.10),
    Rule("cboe", 20, 0.10),
    Rule("athex", 3, 0.10),
    Rule("bme", 1, 0.20),
    Rule("bank-of-greece", 1, 0.20),
)

# Statuses that count, and the texts of the messages below.
_COUNTED = ("downloaded", "ingested", "failed")


def _percent(share: Column) -> Column:
    return F.concat(F.rint(share * 100).cast("long").cast("string"), F.lit("%"))


def rule_counts(spark: SparkSession, bronze: DataFrame, rules: tuple[Rule, ...], *,
                cutoff: Column) -> DataFrame:
    """Files and failures per rule since ``cutoff`` (inclusive)."""
    per_feed = (bronze.where((F.col("scraped_at") >= cutoff) & F.col("status").isin(*_COUNTED))
                .groupBy("exchange").agg(F.count("*").alias("files"),
                                         F.count_if(F.col("status") == "failed").alias("failed")))
    return _per_rule(spark, per_feed, rules)


def _per_rule(spark: SparkSession, per_feed: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Files and failures per rule.

    A rule covers every feed whose name contains its text, with ``%`` and ``_``
    as wildcards and without case, so one feed may count for several rules.
    ``per_feed`` has one line per feed; the rules enter as a literal array that is
    filtered per feed, so no pairs are formed by a join.
    """
    patterns = F.array(*[F.struct(F.lit(i).alias("rule_no"), F.lit(
        "%" + r.exchange.replace("\\", "\\\\") + "%").alias("pattern"))
        for i, r in enumerate(rules)])
    matched = F.filter(patterns, lambda p: F.ilike(F.col("exchange"), p["pattern"]))
    sums = (per_feed.select("files", "failed", F.explode(matched).alias("p"))
            .groupBy(F.col("p.rule_no").alias("rule_no"))
            .agg(F.sum("files").alias("files"), F.sum("failed").alias("failed")))
    given = spark.createDataFrame(
        [(i, r.exchange, r.min_files, float(r.max_failure_rate)) for i, r in enumerate(rules)],
        "rule_no int, exchange string, min_files long, max_failure_rate double")
    return (given.join(sums, "rule_no", "left").na.fill(0, ["files", "failed"]))


def check(spark: SparkSession, bronze: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES, *,
          now: float | Column, window_hours: float = 24.0) -> DataFrame:
    """Failed rules with a message; no rows means healthy.

    Too few files is reported before the failure rate is looked at.
    """
    end = F.lit(now) if isinstance(now, (int, float)) else now
    return _failed(rule_counts(spark, bronze, rules, cutoff=end - F.lit(window_hours * 3600)), window_hours)


def check_hours(spark: SparkSession, hours: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES, *,
                end: Column, window_hours: int = 24) -> DataFrame:
    """Failed rules over the lines (exchange, window_start, files, failed) of the
    ``window_hours`` before ``end``; they may come from a stream (``streaming.hours``)."""
    since = end - F.make_interval(hours=F.lit(window_hours))
    per_feed = hours.where((F.col("window_start") >= since) & (F.col("window_start") < end)).groupBy(
        "exchange").agg(F.sum("files").alias("files"), F.sum("failed").alias("failed"))
    return _failed(_per_rule(spark, per_feed, rules), window_hours)


def _failed(counts: DataFrame, window_hours: float) -> DataFrame:
    rate = F.col("failed") / F.nullif(F.col("files"), F.lit(0))
    few = F.concat(F.lit("DQ: exchange="), "exchange", F.lit(" got "),
                   F.col("files").cast("string"),
                   F.lit(f" files in last {window_hours:g}h (expected >= "),
                   F.col("min_files").cast("string"), F.lit(")"))
    high = F.concat(F.lit("DQ: exchange="), "exchange", F.lit(" failure rate "),
                    F.col("failed").cast("string"), F.lit("/"), F.col("files").cast("string"),
                    F.lit("="), _percent(rate), F.lit(" exceeds max="),
                    _percent(F.col("max_failure_rate")))
    message = (F.when(F.col("files") < F.col("min_files"), few)
               .when(rate > F.col("max_failure_rate"), high))
    return (counts.withColumn("message", message).where(F.col("message").isNotNull())
            .select("rule_no", "exchange", "files", "failed", "message"))
