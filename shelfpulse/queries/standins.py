"""The test tables in the roles of the data model.

``events`` are reviews of games (``props.k``) by users, ``part`` is the game dimension,
``documents`` with ``labels`` are review texts with votes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-30"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their game and day."""
    return table(spark, sf_dir, "events").withColumns(
        {
            "appid": F.get_json_object("props", "$.k").cast("bigint"),
            "dt": F.to_date("ts"),
            "created_date": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        }
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned reviews: a purchase event is a review backed by a purchase."""
    return events(spark, sf_dir).select(
        "appid",
        F.col("event_id").cast("string").alias("recommendationid"),
        F.col("user_id").cast("string").alias("author_id"),
        "created_date",
        "dt",
        (F.col("event_type") == "purchase").alias("bought"),
        (F.col("event_type") != "error").alias("voted_up"),
    )


SALES_SQL = """
sales AS (
    SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS appid,
           CAST(event_id AS VARCHAR) AS recommendationid,
           CAST(user_id AS VARCHAR) AS author_id,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_date,
           CAST(ts AS DATE) AS dt,
           event_type = 'purchase' AS bought,
           event_type <> 'error' AS voted_up
    FROM events
)
"""


def discount() -> Column:
    return F.greatest(F.col("p_size") - 25, F.lit(0)).cast("bigint")


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("appid"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("genres"),
        F.col("p_retailprice").cast("decimal(18,4)").alias("price_final_cny"),
        discount().alias("discount_percent"),
    )


GAMES_SQL = """
games AS (
    SELECT p_partkey AS appid, p_name AS name, p_type AS genres,
           CAST(p_retailprice AS DECIMAL(18, 4)) AS price_final_cny,
           greatest(p_size - 25, 0) AS discount_percent
    FROM part
)
"""

GMV_SQL = f"""
{SALES_SQL},
{GAMES_SQL},
gmv AS (
    SELECT s.appid, s.dt, sum(g.price_final_cny) AS gmv, count(*) AS add_review_num
    FROM sales s JOIN games g ON s.appid = g.appid
    WHERE s.bought
    GROUP BY s.appid, s.dt
)
"""


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review texts with the vote where there is one."""
    return (
        table(spark, sf_dir, "documents")
        .join(table(spark, sf_dir, "labels"), "doc_id", "left")
        .select("doc_id", "text", "lang", "source", "quality", "toxic")
    )


TEXTS_SQL = """
texts AS (
    SELECT d.doc_id, d.text, d.lang, d.source, l.quality, l.toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)
"""
