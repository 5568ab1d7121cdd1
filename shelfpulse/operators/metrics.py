"""DWS: reviews joined with games, and daily figures per game."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpulse.functions.dates import Days, DayWindow
from shelfpulse.operators.ranking import rank_within
from shelfpulse.operators.rows import purchased
from shelfpulse.schemas import MONEY
from shelfpulse.scratch import stage


def overview(dwd: DataFrame, game: DataFrame, *, price: str = "price_final_cny") -> DataFrame:
    """Purchased reviews with the price of their game; reviews of unknown games drop out.

    No broadcast is forced: the dimension is broadcast while it is below the session's
    threshold, beyond that AQE splits the partitions of popular games.
    """
    return purchased(dwd).join(game.select("appid", price), "appid").select(*dwd.columns, price)


def daily_sales(dwd: DataFrame) -> DataFrame:
    """Purchased reviews per game and day. One purchased review is one sale."""
    return purchased(dwd).groupBy("appid", "dt").agg(F.count("*").alias("sales"))


def priced(sales: DataFrame, game: DataFrame, *, price: str, scale: Decimal | int) -> DataFrame:
    """GMV of sales counts per game and day.

    All rows of a count share one price, so the price is joined after counting. A game
    that is listed twice contributes once per listing, as in a row-wise join. A null price
    adds nothing but its sales count.
    """
    amount = F.col("sales") * F.col(price).cast(MONEY)
    if scale != 1:
        amount = amount * F.lit(Decimal(str(scale)))
    return (
        sales.join(game.select("appid", price), "appid")
        .groupBy("appid", "dt")
        .agg(
            F.sum(amount).cast(MONEY).alias("gmv"),
            F.sum("sales").alias("add_review_num"),
        )
    )


def daily_gmv(
    dwd: DataFrame, game: DataFrame, *, price: str = "price_final_cny", scale: Decimal | int = 1
) -> DataFrame:
    """appid, dt, gmv, add_review_num.

    The reviews are counted before the join: only one row per game and day is shuffled,
    however many reviews a game has.
    """
    return priced(daily_sales(dwd), game, price=price, scale=scale)


def daily_buyers(dwd: DataFrame, *, approximate: bool = False) -> DataFrame:
    """Distinct buyers per game and day."""
    buyers: Column = (
        F.approx_count_distinct("author_id")
        if approximate
        else F.count_distinct("author_id")
    )
    return purchased(dwd).groupBy("appid", "dt").agg(buyers.alias("buyers"))


#: Base-2 logarithm of a sketch's cells; its counts are off by 1.5 % in a standard deviation.
SKETCH_SIZE = 12


def buyer_sketches(dwd: DataFrame) -> DataFrame:
    """Per game and day: the exact number of buyers, and a sketch of who they are.

    Sketches of several days merge, numbers do not: see ``buyers_over``.
    """
    return (
        purchased(dwd)
        .groupBy("appid", "dt")
        .agg(
            F.count_distinct("author_id").alias("buyers"),
            F.hll_sketch_agg("author_id", SKETCH_SIZE).alias("sketch"),
        )
    )


def buyers_over(sketches: DataFrame, days: DayWindow | Days) -> DataFrame:
    """About how many different buyers a game had on some days; no review is read again."""
    merged = sketches.where(days.holds("dt")).groupBy("appid")
    return merged.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("buyers"))


def exact_buyers_over(dwd: DataFrame, days: DayWindow | Days) -> DataFrame:
    """The same counted exactly, from the reviews."""
    bought = purchased(dwd).where(days.holds("dt"))
    return bought.groupBy("appid").agg(F.count_distinct("author_id").alias("buyers"))


def trend_1d(dwd: DataFrame) -> DataFrame:
    """Per game and day: sales, buyers, reviews, positive reviews, positive rate, sales rank.

    The count of reviews is the heat of the day, the positive rate its rating trend.
    """
    bought = F.col("bought")
    daily = (
        dwd.groupBy("appid", "dt")
        .agg(
            F.count_if(bought).alias("sales"),
            F.count_distinct(F.when(bought, F.col("author_id"))).alias("buyers"),
            F.count("*").alias("review_count"),
            F.count_if("voted_up").alias("positive_count"),
        )
        .withColumn("positive_rate", positive_rate("positive_count", "review_count"))
    )
    # Staged because the rank reads it twice: the reviews are scanned once.
    return rank_within(stage(daily, "trend"), "sales", ["dt"], into="sales_rank")


def positive_rate(positive: str, total: str) -> Column:
    return F.col(positive).cast("double") / F.nullif(F.col(total), F.lit(0)).cast("double")


def review_profile(df: DataFrame) -> DataFrame:
    """Per game: reviews, positive and negative ones, first and last creation time."""
    return df.groupBy("appid").agg(
        F.count("*").alias("total_reviews"),
        F.count_if("voted_up").alias("positive_reviews"),
        F.count_if(~F.col("voted_up")).alias("negative_reviews"),
        F.min("created_date").alias("first_created"),
        F.max("created_date").alias("last_created"),
    )


def game_profile(game: DataFrame, *, price: str = "price_final_cny") -> DataFrame:
    """Games, average price (0 if there is none) and games on sale, in one pass."""
    return game.agg(
        F.count("*").alias("games"),
        average_price(price).alias("average_price"),
        F.count_if(F.col("discount_percent") > 0).alias("discounted_games"),
    )


def average_price(price: str = "price_final_cny") -> Column:
    return F.coalesce(F.avg(price).cast("double"), F.lit(0.0))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))
