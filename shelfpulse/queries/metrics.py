"""Joins with the dimension and daily figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfpulse.operators import metrics
from shelfpulse.operators.rows import discounted, purchased, split_votes
from shelfpulse.queries.registry import query
from shelfpulse.queries.standins import GAMES_SQL, GMV_SQL, SALES_SQL, games, sales, table


@query(f"""
WITH {SALES_SQL}, {GAMES_SQL}
SELECT s.appid, s.recommendationid, s.author_id, s.created_date,
       CAST(s.dt AS VARCHAR) AS dt, s.bought, s.voted_up,
       CAST(g.price_final_cny AS DOUBLE) AS price_final_cny
FROM sales s JOIN games g ON s.appid = g.appid
WHERE s.bought
""")
def overview_wide(spark, sf_dir):
    return metrics.overview(sales(spark, sf_dir), games(spark, sf_dir))


@query(f"""
WITH {GMV_SQL}
SELECT appid, CAST(dt AS VARCHAR) AS dt, CAST(gmv AS DOUBLE) AS gmv,
       CAST(add_review_num AS BIGINT) AS add_review_num
FROM gmv
""")
def daily_gmv(spark, sf_dir):
    return metrics.daily_gmv(sales(spark, sf_dir), games(spark, sf_dir))


@query(f"""
WITH {SALES_SQL}
SELECT appid, CAST(dt AS VARCHAR) AS dt, count(DISTINCT author_id) AS buyers
FROM sales WHERE bought GROUP BY appid, dt
""")
def daily_sales_distinct(spark, sf_dir):
    return metrics.daily_buyers(sales(spark, sf_dir))


TREND_SELECT = """
SELECT appid, CAST(dt AS VARCHAR) AS dt, sales, buyers, review_count, positive_count,
       round(CAST(positive_count AS DOUBLE) / review_count, 6) AS positive_rate,
       rank() OVER (PARTITION BY dt ORDER BY sales DESC) AS sales_rank
FROM (
    SELECT appid, dt,
           count(*) FILTER (WHERE bought) AS sales,
           count(DISTINCT author_id) FILTER (WHERE bought) AS buyers,
           count(*) AS review_count,
           count(*) FILTER (WHERE voted_up) AS positive_count
    FROM sales GROUP BY appid, dt
) daily
"""


@query(f"WITH {SALES_SQL} {TREND_SELECT}")
def trend_1d(spark, sf_dir):
    trend = metrics.trend_1d(sales(spark, sf_dir))
    return trend.withColumn("positive_rate", F.round("positive_rate", 6))


@query(f"""
WITH {SALES_SQL}
SELECT appid, count(*) AS total_reviews,
       count(*) FILTER (WHERE voted_up) AS positive_reviews,
       count(*) FILTER (WHERE NOT voted_up) AS negative_reviews,
       min(created_date) AS first_created, max(created_date) AS last_created
FROM sales GROUP BY appid
""")
def review_profile(spark, sf_dir):
    return metrics.review_profile(sales(spark, sf_dir))


@query(f"""
WITH {GAMES_SQL}
SELECT count(*) AS games,
       round(coalesce(CAST(sum(price_final_cny) AS DOUBLE) / count(price_final_cny), 0), 4)
           AS average_price,
       count(*) FILTER (WHERE discount_percent > 0) AS discounted_games
FROM games
""")
def game_profile(spark, sf_dir):
    profile = metrics.game_profile(games(spark, sf_dir))
    return profile.withColumn("average_price", F.round("average_price", 4))


@query("""
SELECT p_type AS genres,
       round(coalesce(CAST(sum(CAST(p_retailprice AS DECIMAL(18, 4))) AS DOUBLE)
             / count(p_retailprice), 0), 4) AS average_price
FROM part GROUP BY p_type
""")
def average_price(spark, sf_dir):
    by_genre = games(spark, sf_dir).groupBy("genres")
    return by_genre.agg(F.round(metrics.average_price(), 4).alias("average_price"))


@query("SELECT count(*) AS row_count FROM lineitem")
def row_count(spark, sf_dir):
    return metrics.row_count(table(spark, sf_dir, "lineitem"))


@query(f"""
WITH {SALES_SQL}
SELECT appid, recommendationid, author_id, created_date FROM sales WHERE bought
""")
def purchased_reviews(spark, sf_dir):
    bought = purchased(sales(spark, sf_dir))
    return bought.select("appid", "recommendationid", "author_id", "created_date")


@query(f"""
WITH {GAMES_SQL}
SELECT appid, name, CAST(discount_percent AS BIGINT) AS discount_percent
FROM games WHERE discount_percent > 0
""")
def discounted_games(spark, sf_dir):
    return discounted(games(spark, sf_dir)).select("appid", "name", "discount_percent")


@query(f"""
WITH {SALES_SQL}
SELECT voted_up, appid, count(*) AS reviews FROM sales GROUP BY voted_up, appid
""")
def vote_split(spark, sf_dir):
    positive, negative = split_votes(sales(spark, sf_dir))
    return (
        positive.unionByName(negative)
        .groupBy("voted_up", "appid")
        .agg(F.count("*").alias("reviews"))
    )
