"""Ranks over all rows without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfpulse.operators.joins import join_same
from shelfpulse.scratch import stage


def rank_within(
    df: DataFrame, metric: str, within: Sequence[str], *, dense: bool = False, into: str = "rank"
) -> DataFrame:
    """Rank by ``metric`` descending inside each group; nulls rank last.

    Only the distinct metric values of a group are ordered, with their counts: equal rows
    collapse before the shuffle. Meant for counts, of which ``n`` rows can hold no more
    than about ``sqrt(2 n)`` distinct values per group.
    """
    levels = df.groupBy(*within, metric).agg(F.count("*").alias("_rows"))
    ahead = Window.partitionBy(*within).orderBy(F.desc_nulls_last(metric))
    ranked = levels.select(*within, metric, _ranks_ahead(ahead, dense, "_rows").alias(into))
    return join_same(df, ranked, [*within, metric])


def rank_all(
    df: DataFrame, metric: str, *, dense: bool = False, into: str = "rank", slices: int | None = None
) -> DataFrame:
    """Rank all rows by ``metric`` descending; nulls rank last.

    The distinct metric values are cut into ranges. Ranks run inside each range, and the
    totals of the ranges before it are added, so the only rows that meet in one task are
    a range and the list of range totals. Rows and ranges are staged: they are read twice
    and must be the same both times. Without ``slices``, AQE sizes the ranges.
    """
    df = stage(df, "ranked")
    falling = F.desc_nulls_last(metric)
    levels = df.groupBy(metric).agg(F.count("*").alias("_rows"))
    ranges = [slices, falling] if slices else [falling]
    levels = levels.repartitionByRange(*ranges).withColumn("_slice", F.spark_partition_id())
    levels = stage(levels, "levels")
    step = F.count("*") if dense else F.sum("_rows")
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        levels.groupBy("_slice")
        .agg(step.alias("_total"))
        .select("_slice", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    )
    inner = _ranks_ahead(Window.partitionBy("_slice").orderBy(falling), dense, "_rows")
    ranked = (
        levels.withColumn("_inner", inner)
        .join(offsets, "_slice")
        .select(metric, (F.col("_before") + F.col("_inner")).cast("bigint").alias(into))
    )
    return join_same(df, ranked, [metric])


def _ranks_ahead(ordered: Window, dense: bool, rows: str) -> Column:
    """Rank of a level among the levels of its window."""
    if dense:
        return F.row_number().over(ordered).cast("bigint")
    preceding = ordered.rowsBetween(Window.unboundedPreceding, -1)
    return (F.coalesce(F.sum(rows).over(preceding), F.lit(0)) + 1).cast("bigint")


def top_k(df: DataFrame, metric: str, k: int, tie: str = "appid") -> DataFrame:
    """The ``k`` largest rows, ties by ``tie``; each partition keeps only ``k`` rows."""
    return df.orderBy(F.desc_nulls_last(metric), F.asc(tie)).limit(k)
