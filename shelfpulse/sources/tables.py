"""Readers for catalog tables and small literal rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shelfpulse.functions.dates import DayWindow


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_window(
    spark: SparkSession,
    name: str,
    as_of: dt.date | str,
    days: int = 7,
    *,
    include_future: bool = False,
    day: str = "dt",
) -> DataFrame:
    """Rows dated at most ``days`` days before ``as_of``; undated rows are out.

    The predicate is a plain range on the partition column. Days after ``as_of`` come along
    only with ``include_future``.
    """
    window = DayWindow.trailing(as_of, days, include_future=include_future)
    return spark.table(name).where(window.holds(day))


def from_rows(spark: SparkSession, rows: Sequence[object], schema: T.StructType | str) -> DataFrame:
    """A few literal rows (seeds, rules) under a declared schema.

    Dicts bind by name, so their key order does not matter.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    bound = [
        tuple(row.get(name) for name in schema.names) if isinstance(row, dict) else row
        for row in rows
    ]
    return spark.createDataFrame(bound, schema)
