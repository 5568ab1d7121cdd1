"""ADS: rankings and growth from the daily figures."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfpulse.functions.dates import Days, DayWindow
from shelfpulse.operators.metrics import positive_rate
from shelfpulse.operators.ranking import rank_all, rank_within, top_k
from shelfpulse.scratch import stage


def recent_totals(
    daily: DataFrame, as_of: dt.date | str, days: int = 7, *, sales: str = "add_review_num"
) -> DataFrame:
    """Sales and GMV per game over the ``days`` calendar days that end with ``as_of``."""
    window = DayWindow.trailing(as_of, days - 1)
    return (
        daily.where(window.holds(F.col("dt").cast("date")))
        .groupBy("appid")
        .agg(F.sum(sales).alias("sales"), F.sum("gmv").alias("gmv"))
    )


def rank_history(
    daily: DataFrame, days: int = 7, *, sales: str = "add_review_num", only: Days | None = None
) -> DataFrame:
    """The rankings of ``recent_totals`` for every day: dt, appid, sales, gmv and their ranks.

    A figure counts on its own day and the ``days - 1`` after it, so it is dealt to these days
    and summed: a game is on a day's board as long as it sold within the span, whether it sold
    that day or not. Boards end with the newest day of ``daily``. ``only`` asks for some days,
    for which the figures of their spans are read.
    """
    dated = daily.withColumn("dt", F.col("dt").cast("date"))
    last = dated.agg(F.max("dt")).scalar()
    if only is not None:
        span = {day - dt.timedelta(n) for day in only.days for n in range(days)}
        dated = dated.where(Days(frozenset(span)).holds("dt"))
    spread = F.explode(F.sequence("dt", F.least(F.date_add("dt", days - 1), last)))
    totals = dated.select("appid", sales, "gmv", spread.alias("dt"))
    if only is not None:
        totals = totals.where(only.holds("dt"))
    totals = stage(
        totals.groupBy("dt", "appid").agg(F.sum(sales).alias("sales"), F.sum("gmv").alias("gmv")),
        "history",
    )
    ranked = rank_within(totals, "sales", ["dt"], into="sales_rank")
    return rank_within(ranked, "gmv", ["dt"], into="gmv_rank")


def rate_history(trend: DataFrame, min_reviews: int = 1) -> DataFrame:
    """Positive rate of a game up to each of its days, and its dense rank on that day.

    The running sums of a game go over its days, not its reviews.
    """
    upto = Window.partitionBy("appid").orderBy("dt")
    running = trend.select(
        "dt",
        "appid",
        F.sum("review_count").over(upto).alias("reviews"),
        F.sum("positive_count").over(upto).alias("positive"),
    ).where(F.col("reviews") >= min_reviews)
    rated = running.withColumn("positive_rate", positive_rate("positive", "reviews"))
    return rank_within(stage(rated, "rates"), "positive_rate", ["dt"], dense=True, into="rate_rank")


def sales_rank(totals: DataFrame) -> DataFrame:
    return rank_all(totals.select("appid", "sales"), "sales", into="sales_rank")


def gmv_rank(totals: DataFrame) -> DataFrame:
    return rank_all(totals.select("appid", "gmv"), "gmv", into="gmv_rank")


def positive_rate_rank(trend: DataFrame, min_reviews: int = 1) -> DataFrame:
    """Games with at least ``min_reviews`` reviews, dense rank by positive rate."""
    totals = (
        trend.groupBy("appid")
        .agg(F.sum("review_count").alias("reviews"), F.sum("positive_count").alias("positive"))
        .where(F.col("reviews") >= min_reviews)
        .withColumn("positive_rate", positive_rate("positive", "reviews"))
    )
    return rank_all(totals, "positive_rate", dense=True, into="rate_rank")


def total_gmv(gmv: DataFrame) -> DataFrame:
    """GMV per day over all games."""
    return gmv.groupBy("dt").agg(F.sum("gmv").alias("gmv"))


def gmv_growth(gmv: DataFrame) -> DataFrame:
    """Daily GMV against the day before that has any.

    The first day has no change, a zero base no rate. The single window sees one row per
    calendar day.
    """
    return _growth(total_gmv(gmv), Window.orderBy("dt"))


def gmv_growth_by_game(gmv: DataFrame) -> DataFrame:
    """The same per game; a window sees the days of one game."""
    return _growth(gmv.select("appid", "dt", "gmv"), Window.partitionBy("appid").orderBy("dt"))


def _growth(daily: DataFrame, before: Window) -> DataFrame:
    change = F.col("gmv") - F.col("prev_gmv")
    base = F.nullif(F.col("prev_gmv"), F.lit(0).cast("decimal(1,0)"))
    return daily.withColumn("prev_gmv", F.lag("gmv").over(before)).withColumns(
        {
            "gmv_change": change,
            "gmv_growth": change.cast("double") / base.cast("double"),
        }
    )


def top_games(totals: DataFrame, metric: str = "gmv", k: int = 10) -> DataFrame:
    return top_k(totals, metric, k)
