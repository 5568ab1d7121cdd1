"""Query of the language identifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfpulse.llm.common import table
from shelfpulse.llm.language import with_language


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return with_language(docs).select("doc_id", "held_out", "lang_pred", "score")


QUERIES = {"op1_language_id": op1_language_id}
ORACLES: dict[str, str] = {}
