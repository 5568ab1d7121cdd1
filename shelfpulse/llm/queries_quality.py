"""Query of the quality classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfpulse.llm.common import table
from shelfpulse.llm.quality import with_quality


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_quality(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "score", "predicted"
    )


QUERIES = {"op11_quality": op11_quality}
#: Trained weights are beyond SQL; tests hold the updates and features against plain loops.
ORACLES: dict[str, str] = {}
