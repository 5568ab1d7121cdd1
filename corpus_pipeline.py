"""The corpus pipeline: language, near duplicates, benchmarks, mix, shards.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the
last return the columns of ``documents``. ``run`` writes what a stage returns to the shared
folder and reads it again for the next, so that a lost executor costs tasks and not stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfpulse.llm.decontaminate import without_contaminated
from shelfpulse.llm.language import in_known_language
from shelfpulse.llm.minhash import without_near_duplicates
from shelfpulse.llm.mixing import mixed
from shelfpulse.llm.sharding import shard
from shelfpulse.scratch import kept, stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SHARDS = 8


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in none of the learned languages go."""
    return in_known_language(docs.select(*COLUMNS))


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at 0.8 on shingles of five words, one stays."""
    return without_near_duplicates(docs.select(*COLUMNS), width=5, least=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_contaminated(
        docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), short=True
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed(docs.select(*COLUMNS))


def shard_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A shard and a slot for each document."""
    return shard(docs, SHARDS)


STAGES = [
    ("language_id", language_id),
    ("minhash_dedup", minhash_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("shard_documents", shard_documents),
]

#: The network of the first stage is beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what they staged goes when the last one is written."""

    def staged() -> DataFrame:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        for name, step in STAGES[:-1]:
            docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
        return STAGES[-1][1](spark, docs, sf_dir)

    return kept(spark, staged, "pipeline")
