"""Raw payloads into the bronze manifest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tapeworks.functions.hashing import payload_digest, payload_size
from tapeworks.functions.layout import feed_root
from tapeworks.operators.manifest import not_seen
from tapeworks.schema import BRONZE_SCHEMA
from tapeworks.session import workspace


def bronze_candidates(payloads: DataFrame, *, feed: str = "feed", label: str = "label",
                      content: str = "content", uri: str = "source_uri",
                      exchange: Column | None = None, scraped_at: Column,
                      data_type: Column | None = None) -> DataFrame:
    """Digest and size of each payload in the form of bronze rows.

    The exchange is the first segment of the feed path unless given; pass the
    whole path to keep routes such as ``berlin/pretrade`` apart.
    """
    values = {
        "sha256": payload_digest(F.col(content)),
        "exchange": feed_root(F.col(feed)) if exchange is None else exchange,
        "label": F.col(label), "source_uri": F.col(uri),
        "bytes_size": payload_size(F.col(content)), "scraped_at": scraped_at,
        "status": F.lit("downloaded"),
        "data_type": F.lit(None) if data_type is None else data_type,
    }
    return payloads.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                             for f in BRONZE_SCHEMA.fields])


def select_new(spark: SparkSession, candidates: DataFrame, bronze: DataFrame, *,
               label_keys: tuple[str, ...] = ("exchange", "label")) -> DataFrame:
    """The payloads that land, as if they came one by one in (scraped_at, sha256,
    label) order: a payload lands unless its label or its digest is taken, by the
    manifest or by one that landed before it in this batch.  A key that is null is
    nobody's rival.

    A payload turned away takes nothing, so one later in the order may still
    land, and conflicts form chains.  A round lands the payloads that are first in
    both their label and their digest.  Where a payload has one rival before it, its
    fate is the opposite of that rival's: such chains, of any length, are followed to
    their heads by pointer doubling and settled in the same round.  Then the rest is
    looked at again without what that rules out; only payloads with two rivals that
    are undecided themselves wait for a further round.

    The first round nearly always settles everything, so chains are followed from
    the second on.  Rounds are cut by tables in the shared folder.
    """
    labels = list(label_keys)
    order = F.struct("scraped_at", "sha256", "exchange", "label").alias("place")
    rest = not_seen(not_seen(candidates, bronze, labels), bronze, ["sha256"])
    # A payload delivered twice under one name is one candidate.
    names = [c for c in candidates.columns if c not in ("sha256", *labels)]
    rest = rest.groupBy("sha256", *labels).agg(
        F.min_by(F.struct(*names), F.struct("scraped_at", "exchange", "label")).alias("_r")
    ).select("sha256", *labels, "_r.*").withColumn("place", order)
    folder = workspace(spark, "landing")

    def table(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    rest, landed, turn = table(rest, "rest-0"), [], 0
    while turn == 0 or not rest.isEmpty():
        settled = table(_settled(rest, labels, lambda df, name: table(df, f"{name}-{turn}"), turn > 0),
                        f"settled-{turn}")
        winners = settled.where("won").drop("won")
        landed.append(winners)
        turn += 1
        rest = table(settled.where("not won").drop("won")
                     .join(winners.select(*labels), labels, "left_anti")
                     .join(winners.select("sha256"), "sha256", "left_anti"), f"rest-{turn}")
    result = landed[0]
    for part in landed[1:]:
        result = result.unionByName(part)
    return result.drop("place").select(*candidates.columns)


def _settled(rest: DataFrame, labels: list[str], table: Callable[[DataFrame, str], DataFrame],
             chains: bool) -> DataFrame:
    """``rest`` with ``won``: which payloads land in this round.

    Groups are only reduced to their first two places, so a key that a third of all
    payloads share is no burden.
    """
    columns = rest.columns

    def first(df: DataFrame, keys: list[str], name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.min("place").alias(name))

    # Null keys find no partner, which leaves such payloads first.
    ranked = (rest.join(first(rest, labels, "label_1"), labels, "left")
              .join(first(rest, ["sha256"], "sha_1"), "sha256", "left")
              .withColumn("label_1", F.coalesce("label_1", "place"))
              .withColumn("sha_1", F.coalesce("sha_1", "place")))
    by_label, by_sha = F.col("place") == F.col("label_1"), F.col("place") == F.col("sha_1")
    if not chains:
        return ranked.select(*columns, (by_label & by_sha).alias("won"))
    ranked = table(ranked, "ranked")
    second_label = first(ranked.where(~by_label), labels, "label_2")
    second_sha = first(ranked.where(~by_sha), ["sha256"], "sha_2")
    rival = (F.when(by_label & (F.col("place") == F.col("sha_2")), F.col("sha_1"))
             .when(by_sha & (F.col("place") == F.col("label_2")), F.col("label_1")))
    # Each link says whether a payload fares as the one it points to, or the other way.
    links = table(ranked.join(second_label, labels, "left").join(second_sha, "sha256", "left")
                  .select("place", rival.alias("to"), F.lit(True).alias("opposite"))
                  .where(F.col("to").isNotNull()), "links-0")
    step = 0
    while True:
        step += 1
        ahead = links.select(F.col("place").alias("to"), F.col("to").alias("next"),
                             F.col("opposite").alias("turned"))
        links = table(links.join(ahead, "to", "left").select(
            "place", F.coalesce("next", "to").alias("to"),
            (F.col("opposite") != F.coalesce("turned", F.lit(False))).alias("opposite"),
            F.col("next").isNotNull().alias("moved")), f"links-{step}")
        if links.where("moved").isEmpty():
            break
        links = links.drop("moved")
    heads = ranked.where(by_label & by_sha).select(F.col("place").alias("to"))
    chained = links.where("not opposite").join(heads, "to", "left_semi").select("place", F.lit(True).alias("chained"))
    return ranked.join(chained, "place", "left").select(
        *columns, ((by_label & by_sha) | F.col("chained").isNotNull()).alias("won"))
