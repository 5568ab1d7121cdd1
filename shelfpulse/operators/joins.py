"""Equality joins in which null matches null."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_same(
    df: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on equal keys, null being equal to null; the keys of ``other`` stay behind.

    Still a hash or sort-merge join: null-safe equality is an equality to the planner.
    """
    names = {key: f"_other_{key}" for key in keys}
    same = [F.col(key).eqNullSafe(F.col(name)) for key, name in names.items()]
    joined = df.join(other.withColumnsRenamed(names), reduce(lambda a, b: a & b, same), how)
    return joined.drop(*names.values())
