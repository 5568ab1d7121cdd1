"""Rankings and growth."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfpulse.functions.dates import DayWindow
from shelfpulse.operators import boards, metrics
from shelfpulse.queries.registry import query
from shelfpulse.queries.standins import AS_OF, GMV_SQL, SALES_SQL, games, sales, texts
from shelfpulse.scratch import stage

RECENT_SQL = f"""
{GMV_SQL},
recent AS (
    SELECT appid, CAST(sum(add_review_num) AS BIGINT) AS sales, sum(gmv) AS gmv
    FROM gmv
    WHERE dt BETWEEN DATE '2024-01-24' AND DATE '{AS_OF}'
    GROUP BY appid
)
"""


def _gmv(spark, sf_dir):
    return metrics.daily_gmv(sales(spark, sf_dir), games(spark, sf_dir))


def _recent(spark, sf_dir):
    return boards.recent_totals(_gmv(spark, sf_dir), AS_OF)


@query(f"""
WITH {GMV_SQL}, days AS (
    SELECT CAST(d AS DATE) AS dt FROM (SELECT unnest(generate_series(
        (SELECT min(dt) FROM gmv)::TIMESTAMP, (SELECT max(dt) FROM gmv)::TIMESTAMP, INTERVAL 1 DAY)) AS d)
), dense AS (
    SELECT days.dt, games.appid, g.gmv, g.add_review_num
    FROM days CROSS JOIN (SELECT DISTINCT appid FROM gmv) games
    LEFT JOIN gmv g ON g.dt = days.dt AND g.appid = games.appid
), spans AS (
    SELECT dt, appid, sum(add_review_num) OVER span AS sales, sum(gmv) OVER span AS gmv
    FROM dense WINDOW span AS (
        PARTITION BY appid ORDER BY dt RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)
)
SELECT CAST(dt AS VARCHAR) AS dt, appid, CAST(sales AS BIGINT) AS sales, CAST(gmv AS DOUBLE) AS gmv,
       rank() OVER (PARTITION BY dt ORDER BY sales DESC) AS sales_rank,
       rank() OVER (PARTITION BY dt ORDER BY gmv DESC) AS gmv_rank
FROM spans WHERE sales IS NOT NULL
""")
def rank_history(spark, sf_dir):
    return boards.rank_history(stage(_gmv(spark, sf_dir), "gmv"))


@query(f"""
WITH {SALES_SQL}, daily AS (
    SELECT appid, dt, count(*) AS n, count(*) FILTER (WHERE voted_up) AS up FROM sales GROUP BY ALL
), running AS (
    SELECT dt, appid, CAST(sum(n) OVER upto AS BIGINT) AS reviews, CAST(sum(up) OVER upto AS BIGINT) AS positive
    FROM daily WINDOW upto AS (PARTITION BY appid ORDER BY dt)
)
SELECT CAST(dt AS VARCHAR) AS dt, appid, reviews, positive,
       round(CAST(positive AS DOUBLE) / reviews, 6) AS positive_rate,
       dense_rank() OVER (PARTITION BY dt ORDER BY CAST(positive AS DOUBLE) / reviews DESC) AS rate_rank
FROM running WHERE reviews >= 5
""")
def rate_history(spark, sf_dir):
    trend = metrics.trend_1d(sales(spark, sf_dir))
    return boards.rate_history(trend, 5).withColumn("positive_rate", F.round("positive_rate", 6))


BUYERS_SQL = f"""
WITH {SALES_SQL}
SELECT appid, count(DISTINCT author_id) AS buyers FROM sales
WHERE bought AND dt BETWEEN DATE '2024-01-24' AND DATE '{AS_OF}' GROUP BY appid
"""
WEEK = DayWindow.between("2024-01-24", AS_OF)


@query(BUYERS_SQL)
def buyers_7d(spark, sf_dir):
    return metrics.exact_buyers_over(sales(spark, sf_dir), WEEK)


@query(f"SELECT appid, TRUE AS is_near FROM ({BUYERS_SQL}) b")
def buyers_sketch_7d(spark, sf_dir):
    """Merged sketches of the days, within 10 % of the exact number."""
    sketches = stage(metrics.buyer_sketches(sales(spark, sf_dir)), "sketches")
    about = metrics.buyers_over(sketches, WEEK).withColumnRenamed("buyers", "about")
    exact = metrics.exact_buyers_over(sales(spark, sf_dir), WEEK)
    near = F.abs(F.col("about") - F.col("buyers")) <= 0.1 * F.col("buyers")
    return exact.join(about, "appid").select("appid", near.alias("is_near"))


@query(f"WITH {RECENT_SQL} SELECT appid, sales, CAST(gmv AS DOUBLE) AS gmv FROM recent")
def totals_7d(spark, sf_dir):
    return _recent(spark, sf_dir)


@query(f"""
WITH {RECENT_SQL}
SELECT appid, sales, rank() OVER (ORDER BY sales DESC) AS sales_rank FROM recent
""")
def sales_rank_7d(spark, sf_dir):
    return boards.sales_rank(_recent(spark, sf_dir))


@query(f"""
WITH {RECENT_SQL}
SELECT appid, CAST(gmv AS DOUBLE) AS gmv, rank() OVER (ORDER BY gmv DESC) AS gmv_rank
FROM recent
""")
def gmv_rank_7d(spark, sf_dir):
    return boards.gmv_rank(_recent(spark, sf_dir))


@query("""
WITH rated AS (
    SELECT d.source AS appid, CAST(count(*) AS BIGINT) AS reviews,
           CAST(sum(l.quality) AS BIGINT) AS positive
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id
    GROUP BY d.source HAVING count(*) >= 5
)
SELECT appid, reviews, positive,
       round(CAST(positive AS DOUBLE) / reviews, 6) AS positive_rate,
       dense_rank() OVER (ORDER BY CAST(positive AS DOUBLE) / reviews DESC) AS rate_rank
FROM rated
""")
def positive_rate_rank(spark, sf_dir):
    voted = texts(spark, sf_dir).where(F.col("quality").isNotNull())
    daily = voted.groupBy(F.col("source").alias("appid")).agg(
        F.count("*").alias("review_count"),
        F.count_if(F.col("quality") == 1).alias("positive_count"),
    )
    ranked = boards.positive_rate_rank(daily, min_reviews=5)
    return ranked.withColumn("positive_rate", F.round("positive_rate", 6))


@query(f"""
WITH {GMV_SQL}
SELECT CAST(dt AS VARCHAR) AS dt, CAST(sum(gmv) AS DOUBLE) AS gmv FROM gmv GROUP BY dt
""")
def daily_total_gmv(spark, sf_dir):
    return boards.total_gmv(_gmv(spark, sf_dir))


GROWTH = """
CAST(dt AS VARCHAR) AS dt, CAST(gmv AS DOUBLE) AS gmv, CAST(prev AS DOUBLE) AS prev_gmv,
CAST(gmv - prev AS DOUBLE) AS gmv_change,
round(CAST(gmv - prev AS DOUBLE) / nullif(CAST(prev AS DOUBLE), 0), 6) AS gmv_growth
"""


@query(f"""
WITH {GMV_SQL},
total AS (SELECT dt, sum(gmv) AS gmv FROM gmv GROUP BY dt),
stepped AS (SELECT *, lag(gmv) OVER (ORDER BY dt) AS prev FROM total)
SELECT {GROWTH} FROM stepped
""")
def gmv_growth(spark, sf_dir):
    growth = boards.gmv_growth(_gmv(spark, sf_dir))
    return growth.withColumn("gmv_growth", F.round("gmv_growth", 6))


@query(f"""
WITH {GMV_SQL},
stepped AS (SELECT *, lag(gmv) OVER (PARTITION BY appid ORDER BY dt) AS prev FROM gmv)
SELECT appid, {GROWTH} FROM stepped
""")
def gmv_growth_by_game(spark, sf_dir):
    growth = boards.gmv_growth_by_game(_gmv(spark, sf_dir))
    return growth.withColumn("gmv_growth", F.round("gmv_growth", 6))


@query(f"""
WITH {RECENT_SQL}
SELECT appid, sales, CAST(gmv AS DOUBLE) AS gmv
FROM recent ORDER BY recent.gmv DESC, appid LIMIT 10
""")
def top_games(spark, sf_dir):
    return boards.top_games(_recent(spark, sf_dir), "gmv", 10)
