"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from shelfpulse.llm import (
    queries_caps,
    queries_chat,
    queries_decontaminate,
    queries_infill,
    queries_language,
    queries_lm,
    queries_minhash,
    queries_mix,
    queries_quality,
    queries_search,
    queries_shard,
    queries_tokens,
    queries_warc,
)
from shelfpulse.scratch import kept

Query = Callable[[SparkSession, str], DataFrame]

LLM_QUERIES: dict[str, Query] = {}
LLM_ORACLES: dict[str, str] = {}


def _kept(name: str, query: Query, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query's rows; what it staged on the way goes."""
    return kept(spark, lambda: query(spark, sf_dir), name)


for module in (
    queries_language,
    queries_tokens,
    queries_minhash,
    queries_warc,
    queries_lm,
    queries_decontaminate,
    queries_caps,
    queries_shard,
    queries_chat,
    queries_mix,
    queries_quality,
    queries_infill,
    queries_search,
):
    for name, query in module.QUERIES.items():
        LLM_QUERIES[name] = partial(_kept, name, query)
    LLM_ORACLES.update(module.ORACLES)
