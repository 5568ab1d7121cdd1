"""Query of the decontamination operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfpulse.llm.common import table
from shelfpulse.llm.decontaminate import contaminated


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contaminated(docs, items, short=True)


QUERIES = {"op7_decontaminate": op7_decontaminate}
ORACLES: dict[str, str] = {}
