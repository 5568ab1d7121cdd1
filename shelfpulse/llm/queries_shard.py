"""Query of the sharding operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfpulse.llm.common import table
from shelfpulse.llm.sharding import shard


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


QUERIES = {"op5_sharding": op5_sharding}
ORACLES: dict[str, str] = {}
