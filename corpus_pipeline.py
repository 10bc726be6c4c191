"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, with the
columns of ``documents``; the last returns the pieces of the sequences.  Between
stages the rows are written and read again, so a stage starts from a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapeworks.llm import exact_dedup, forest_dedup, packing, quality, suffix_dedup
from tapeworks.llm.queries import table, vocabulary
from tapeworks.llm.staging import staged
from tapeworks.session import configure

# Fixed value: from this Jaccard similarity of five-word shingles a document is a near copy.
NEAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words, lines and n-grams don't repeat too much."""
    configure(spark)
    return quality.kept_documents(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, A-Z lower-cased."""
    configure(spark)
    return exact_dedup.kept_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate component, at a similarity of 0.8."""
    configure(spark)
    return forest_dedup.kept_documents(docs, NEAR_PERCENT)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that an earlier document has."""
    configure(spark)
    return suffix_dedup.without_repeats(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    configure(spark)
    return packing.packed(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("quality_rules", quality_rules), ("exact_copies", exact_copies),
          ("near_copies", near_copies), ("repeated_passages", repeated_passages),
          ("sequences", sequences)]
# Near-duplicate components have no bounded SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
