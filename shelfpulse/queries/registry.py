"""Registration by decorator."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfpulse.scratch import kept

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def presented(df: DataFrame) -> DataFrame:
    """Days as text and decimals as doubles: forms that every client shows alike."""

    def shown(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        return column

    return df.select(*[shown(field) for field in df.schema.fields])


def query(sql: str) -> Callable[[Query], Query]:
    """Register the function under its own name, with its SQL counterpart."""

    def register(run: Query) -> Query:
        @wraps(run)
        def shown(spark: SparkSession, sf_dir: str) -> DataFrame:
            return kept(spark, lambda: presented(run(spark, sf_dir)), run.__name__)

        QUERIES[run.__name__] = shown
        ORACLES[run.__name__] = sql
        return shown

    return register
