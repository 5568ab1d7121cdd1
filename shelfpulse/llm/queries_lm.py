"""Query of the language model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfpulse.llm.common import table
from shelfpulse.llm.lm import scores


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"))


QUERIES = {"op6_lm_scoring": op6_lm_scoring}
ORACLES: dict[str, str] = {}
