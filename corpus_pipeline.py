"""From raw documents to shards of a training mix, one operator per stage.

Each stage takes (spark, docs, sf_dir) and returns documents; its result is written as Parquet and
read again as the next stage's input. The last adds ``shard`` and ``slot``.
"""

from pyspark.sql import DataFrame, SparkSession

from galewire.llm import decontamination, mixing, near_copies, quality_rules, sharding
from galewire.llm.text import table
from galewire.sources.scratch import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy of the rule ledger keeps."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: SimHash over five-word shingles, similarity 0.8."""
    return near_copies.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than a trace of a benchmark item."""
    tests = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return decontamination.drop_contaminated(docs, tests)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and place in it."""
    return sharding.shard_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

# DuckDB has no XXH64 with a seed, so SQL cannot express the second stage; tests/llm compares the
# stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
