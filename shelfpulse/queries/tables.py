"""Table maintenance and exports, on tables in a scratch database."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from shelfpulse.functions.dates import DayWindow, age_days
from shelfpulse.operators import metrics
from shelfpulse.operators.rows import discounted, remaining
from shelfpulse.queries.registry import query
from shelfpulse.queries.standins import (
    AS_OF,
    GAMES_SQL,
    GMV_SQL,
    events,
    games,
    sales,
    table,
)
from shelfpulse.schemas import GMV, GMV_COMMENTS
from shelfpulse.scratch import scratch_database, scratch_path, stage
from shelfpulse.sinks import (
    append_table,
    delete_window,
    ensure_table,
    export_jdbc,
    overwrite_from_sql,
    refresh_window,
    replace_or_backup,
    replace_table,
    table_days,
    verify_count,
    write_csv_backup,
)
from shelfpulse.sources import from_rows, read_table, read_window

JDBC_URL = "spark.shelfpulse.jdbc.url"
WEEK = DayWindow.trailing(AS_OF, 7)


def partly_dated(spark, sf_dir):
    """Events as reviews; sign-ups carry no day."""
    return events(spark, sf_dir).select(
        "appid",
        F.col("event_id").cast("string").alias("recommendationid"),
        "event_type",
        F.when(F.col("event_type") != "signup", F.col("dt")).alias("dt"),
    )


def stored_sales(spark, sf_dir, label):
    """The same as a day-partitioned table."""
    name = f"{scratch_database(spark, label)}.sales"
    replace_table(partly_dated(spark, sf_dir), name, partition_by="dt")
    return name


STORED_SQL = """
stored AS (
    SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS appid,
           CAST(event_id AS VARCHAR) AS recommendationid, event_type,
           CASE WHEN event_type <> 'signup' THEN CAST(ts AS DATE) END AS dt
    FROM events
)
"""


@query("SELECT p_partkey, p_name FROM part")
def table_replace(spark, sf_dir):
    name = f"{scratch_database(spark, 'replace')}.game"
    part = table(spark, sf_dir, "part")
    replace_table(part.select("p_partkey", "p_brand"), name)
    replace_table(part.select("p_partkey", "p_name"), name)
    return read_table(spark, name)


@query("""
SELECT event_id, event_type FROM events
""")
def table_append(spark, sf_dir):
    name = f"{scratch_database(spark, 'append')}.batches"
    source = table(spark, sf_dir, "events").select("event_type", "event_id")
    bought = F.coalesce(F.col("event_type") == "purchase", F.lit(False))
    replace_table(source.where(bought), name)
    append_table(source.where(~bought).select("event_id", "event_type"), name)
    return read_table(spark, name)


@query("SELECT p_partkey, p_name FROM part")
def empty_guard(spark, sf_dir):
    name = f"{scratch_database(spark, 'guard')}.game"
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    replace_table(part, name)
    replace_table(part.where("p_partkey < 0"), name, skip_empty=True)
    return read_table(spark, name)


@query("SELECT 'events' AS table_name, count(*) AS row_count FROM events")
def write_count(spark, sf_dir):
    name = stored_sales(spark, sf_dir, "counted")
    return metrics.row_count(spark.table(name)).select(F.lit("events").alias("table_name"), "row_count")


@query(f"""
WITH {STORED_SQL}
SELECT appid, recommendationid, CAST(dt AS VARCHAR) AS dt,
       CAST(date_diff('day', dt, DATE '{AS_OF}') AS INTEGER) AS age
FROM stored WHERE date_diff('day', dt, DATE '{AS_OF}') BETWEEN 0 AND 7
""")
def window_scan(spark, sf_dir):
    recent = read_window(spark, stored_sales(spark, sf_dir, "scan"), AS_OF, 7)
    return recent.select("appid", "recommendationid", "dt", age_days("dt", AS_OF).alias("age"))


@query(f"""
WITH {STORED_SQL}
SELECT appid, recommendationid, CAST(dt AS VARCHAR) AS dt FROM stored
WHERE NOT coalesce(date_diff('day', dt, DATE '{AS_OF}') <= 7, false)
""")
def window_delete(spark, sf_dir):
    name = stored_sales(spark, sf_dir, "deleted")
    delete_window(spark, name, DayWindow.trailing(AS_OF, 7, include_future=True))
    return spark.table(name).select("appid", "recommendationid", "dt")


@query(f"""
WITH {STORED_SQL}
SELECT appid, recommendationid, CAST(dt AS VARCHAR) AS dt FROM stored
WHERE NOT coalesce(date_diff('day', dt, DATE '{AS_OF}') <= 7, false)
""")
def window_delete_rows(spark, sf_dir):
    kept = remaining(partly_dated(spark, sf_dir), age_days("dt", AS_OF) <= 7)
    return kept.select("appid", "recommendationid", "dt")


@query(f"""
WITH {STORED_SQL},
incoming AS (
    SELECT appid, 'new' || recommendationid AS recommendationid, event_type, dt FROM stored
    WHERE event_type IN ('purchase', 'signup') AND (dt IS NULL OR dt >= DATE '2024-01-23')
          AND (appid IN (SELECT p_partkey FROM part WHERE p_size > 25) OR dt IS NULL)
),
refreshed AS (SELECT DISTINCT appid FROM incoming WHERE dt IS NOT NULL)
SELECT appid, recommendationid, event_type, CAST(dt AS VARCHAR) AS dt FROM stored
WHERE dt IS NULL OR dt < DATE '2024-01-23' OR appid NOT IN (SELECT appid FROM refreshed)
UNION ALL
SELECT appid, recommendationid, event_type, CAST(dt AS VARCHAR) FROM incoming
""")
def window_refresh(spark, sf_dir):
    name = stored_sales(spark, sf_dir, "refreshed")
    fetched = spark.table(name).where(F.col("event_type").isin("purchase", "signup"))
    # Only games on sale were crawled again; all others keep their days.
    on_sale = discounted(games(spark, sf_dir)).select("appid")
    dated = fetched.where(WEEK.holds("dt")).join(on_sale, "appid", "left_semi")
    incoming = dated.unionByName(fetched.where(F.col("dt").isNull()))
    renamed = F.concat(F.lit("new"), "recommendationid")
    staged = stage(incoming.withColumn("recommendationid", renamed), "incoming")
    refresh_window(staged, name, WEEK, keys=["appid"])
    # A second run must change nothing.
    refresh_window(staged, name, WEEK, keys=["appid"])
    return spark.table(name).select("appid", "recommendationid", "event_type", "dt")


@query(f"""
WITH {STORED_SQL}
SELECT CAST(dt AS VARCHAR) AS dt, count(*) AS reviews FROM stored
WHERE dt IS NOT NULL GROUP BY dt
""")
def day_layout(spark, sf_dir):
    name = stored_sales(spark, sf_dir, "layout")
    parts = spark.sql(f"SHOW PARTITIONS {name}")
    days = parts.select(F.substring_index("partition", "=", -1).try_cast("date").alias("dt"))
    reviews = spark.table(name).groupBy("dt").agg(F.count("*").alias("reviews"))
    return days.join(reviews, "dt")


@query(f"""
WITH {GMV_SQL}
SELECT CAST(appid AS VARCHAR) AS appid, CAST(dt AS VARCHAR) AS dt, CAST(gmv AS DOUBLE) AS gmv,
       CAST(add_review_num AS BIGINT) AS add_review_num
FROM gmv
""")
def gmv_insert_overwrite(spark, sf_dir):
    name = f"{scratch_database(spark, 'gmv')}.dws_sale_gmv"
    for _ in range(2):
        ensure_table(spark, name, GMV, comments=GMV_COMMENTS)
    fact, dim = f"{name}_fact", f"{name}_game"
    replace_table(sales(spark, sf_dir), fact)
    replace_table(games(spark, sf_dir), dim)
    statement = f"""
        INSERT OVERWRITE TABLE {name}
        WITH sold AS (
            SELECT appid, left(created_date, 10) AS day, count(*) AS copies
            FROM {fact} WHERE bought GROUP BY ALL
        ),
        amounts AS (
            SELECT sold.*, copies * price_final_cny AS amount FROM sold JOIN {dim} USING (appid)
        )
        SELECT CAST(appid AS STRING), day, CAST(sum(amount) AS DECIMAL(18, 4)), sum(copies)
        FROM amounts GROUP BY appid, day
    """
    # The second run replaces the first.
    overwrite_from_sql(spark, statement, partitioned=False)
    overwrite_from_sql(spark, statement, partitioned=False)
    return read_table(spark, name)


def jdbc_url(spark):
    """The database of ``spark.shelfpulse.jdbc.url``; in a local session one in memory.

    The in-memory database lives in one process, so it cannot serve executors elsewhere.
    """
    configured = spark.conf.get(JDBC_URL, None)
    if configured:
        return configured
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {JDBC_URL} to a database that the executors can reach")
    spark.sparkContext._jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")
    return f"jdbc:derby:memory:export{uuid.uuid4().hex[:12]};create=true"


@query(f"""
WITH {GMV_SQL}
SELECT appid, CAST(dt AS VARCHAR) AS dt, CAST(gmv AS DOUBLE) AS gmv,
       CAST(add_review_num AS BIGINT) AS add_review_num
FROM gmv
""")
def export_roundtrip(spark, sf_dir):
    url, name = jdbc_url(spark), f"gmv_{uuid.uuid4().hex[:12]}"
    gmv = metrics.daily_gmv(sales(spark, sf_dir), games(spark, sf_dir))
    dated = stage(gmv.withColumn("dt", F.col("dt").cast("string")), "export")
    for _ in range(2):
        export_jdbc(dated, url, name)
    back = spark.read.format("jdbc").options(url=url, dbtable=name).load()
    return back.select("appid", "dt", "gmv", "add_review_num")


@query(f"WITH {GAMES_SQL} SELECT CAST(appid AS VARCHAR) AS appid, name, genres FROM games")
def csv_backup_roundtrip(spark, sf_dir):
    dimension = games(spark, sf_dir).select("appid", "name", "genres")
    path = scratch_path(spark, "csv_backup")
    write_csv_backup(dimension, path)
    # The database does not exist, so the table write fails and the copy is taken again.
    if replace_or_backup(dimension, "no_such_database.game", path) != "csv":
        raise AssertionError("the table write was expected to fail")
    return spark.read.option("header", True).csv(path)
