"""Query of the token counter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfpulse.llm.common import table
from shelfpulse.llm.tokens import with_token_counts


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return with_token_counts(table(spark, sf_dir, "documents"), path)


QUERIES = {"op2_token_counts": op2_token_counts}
ORACLES: dict[str, str] = {}
