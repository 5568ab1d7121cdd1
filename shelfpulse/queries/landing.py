"""Landing zone: pages and details written as JSON from the test tables, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfpulse.operators.reviews import (
    flatten_games as flatten_details,
    flatten_reviews as flatten_pages,
    query_summary as summarize,
    valid_pages,
)
from shelfpulse.queries.registry import query
from shelfpulse.queries.standins import events, table, texts
from shelfpulse.scratch import scratch_path
from shelfpulse.functions.dates import epoch_to_text
from shelfpulse.sources import (
    from_rows,
    intact_pages,
    read_game_details,
    read_review_pages,
    read_seed,
    unreadable_pages,
)

# Documents per page: a page collects a bounded range of ids.
PAGE_SPAN = 100


def document_pages(spark, sf_dir):
    """Pages of texts by source; only some review fields are present."""
    item = F.struct(
        F.col("doc_id").cast("string").alias("recommendationid"),
        F.col("text").alias("review"),
        F.col("lang").alias("language"),
        (F.col("quality") == 1).alias("voted_up"),
        F.col("toxic").alias("votes_up"),
        F.struct(F.col("source").alias("id")).alias("author"),
        F.col("quality").isNotNull().alias("bought"),
    )
    page = (F.floor(F.col("doc_id") / PAGE_SPAN) + 1).cast("int")
    appid = F.substring("source", 4, 10).cast("bigint")
    positive = F.count_if(F.col("quality") == 1)
    rated = F.count("quality")
    return (
        texts(spark, sf_dir)
        .withColumns({"appid": appid, "page": page})
        .groupBy("appid", "page")
        .agg(
            F.sort_array(F.collect_list(item)).alias("reviews"),
            F.when(
                rated > 0, F.struct(positive.alias("total_positive"), rated.alias("total_reviews"))
            ).alias("query_summary"),
        )
        .select(
            "appid",
            "page",
            F.lit(1).alias("success"),
            F.concat(F.lit("c"), F.col("page")).alias("cursor"),
            "query_summary",
            "reviews",
        )
    )


def landed(spark, pages, label):
    path = scratch_path(spark, label)
    pages.write.json(path)
    return path


PAGES_SQL = f"""
pages AS (
    SELECT CAST(substr(d.source, 4) AS BIGINT) AS appid, d.doc_id // {PAGE_SPAN} + 1 AS page,
           count(*) AS n_reviews, count(l.quality) AS rated,
           coalesce(sum(CASE WHEN l.quality = 1 THEN 1 ELSE 0 END), 0) AS positive
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    GROUP BY 1, 2
)
"""


@query(f"""
WITH {PAGES_SQL}
SELECT appid, page, 1 AS success, 'c' || page AS cursor, n_reviews FROM pages
""")
def review_page_scan(spark, sf_dir):
    path = landed(spark, document_pages(spark, sf_dir), "pages")
    pages = intact_pages(read_review_pages(spark, path))
    return pages.select("appid", "page", "success", "cursor", F.size("reviews").alias("n_reviews"))


@query(f"""
WITH {PAGES_SQL}
SELECT 'intact' AS kind, count(*) AS landed_lines FROM pages
UNION ALL SELECT 'unreadable', count(*) FROM pages
""")
def unreadable_page_scan(spark, sf_dir):
    path = scratch_path(spark, "cut_pages")
    line = F.to_json(F.struct("*"))
    lines = document_pages(spark, sf_dir).select(line.alias("value"))
    cut = F.expr("left(value, CAST(length(value) / 2 AS INT))")
    lines.unionByName(lines.select(cut.alias("value"))).write.text(path)
    pages = read_review_pages(spark, path)
    marked = intact_pages(pages).select(F.lit("intact").alias("kind")).unionByName(
        unreadable_pages(pages).select(F.lit("unreadable").alias("kind"))
    )
    return marked.groupBy("kind").agg(F.count("*").alias("landed_lines"))


@query("""
SELECT CAST(substr(d.source, 4) AS BIGINT) AS appid, CAST(d.doc_id AS VARCHAR) AS recommendationid,
       d.text AS review, d.lang AS language, coalesce(l.quality = 1, false) AS voted_up,
       coalesce(l.toxic, 0) AS votes_up, 0 AS votes_funny, 0 AS comment_count,
       d.source AS author_id, CAST(NULL AS INTEGER) AS author_num_reviews,
       l.quality IS NOT NULL AS bought, false AS received_for_free,
       CAST(NULL AS VARCHAR) AS developer_response, CAST(NULL AS VARCHAR) AS created_date
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def flatten_reviews(spark, sf_dir):
    path = landed(spark, document_pages(spark, sf_dir), "reviews")
    flat = flatten_pages(intact_pages(read_review_pages(spark, path)))
    return flat.select(
        "appid",
        "recommendationid",
        "review",
        "language",
        "voted_up",
        "votes_up",
        "votes_funny",
        "comment_count",
        "author_id",
        "author_num_reviews",
        "bought",
        "received_for_free",
        "developer_response",
        "created_date",
    )


@query(f"""
WITH {PAGES_SQL}
SELECT appid, 'N/A' AS review_score_desc,
       CAST(CASE WHEN rated > 0 THEN positive ELSE 0 END AS BIGINT) AS total_positive,
       CAST(0 AS BIGINT) AS total_negative, rated AS total_reviews
FROM pages WHERE page = 1
""")
def query_summary(spark, sf_dir):
    path = landed(spark, document_pages(spark, sf_dir), "summaries")
    return summarize(intact_pages(read_review_pages(spark, path)))


@query("""
WITH pages AS (
    SELECT conv_id AS appid, turn + 1 AS page, length(text) < 40 AS is_empty,
           'c' || CASE WHEN role = 'system' OR contains(text, 'zz') OR length(text) > 900
                       THEN turn ELSE turn + 1 END AS cursor
    FROM conversations
),
stepped AS (
    SELECT *, is_empty OR cursor = lag(cursor, 1, '*') OVER (PARTITION BY appid ORDER BY page)
              AS stops
    FROM pages
),
marked AS (
    SELECT *, coalesce(max(CASE WHEN stops THEN 1 ELSE 0 END) OVER (
        PARTITION BY appid ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        AS stopped
    FROM stepped
)
SELECT appid, CAST(page AS INTEGER) AS page, cursor FROM marked
WHERE stopped = 0 AND NOT is_empty
""")
def paging_stop(spark, sf_dir):
    # Short turns play empty pages, long ones answer with the cursor they were asked with.
    long = (F.col("role") == "system") | F.contains("text", F.lit("zz")) | (F.length("text") > 900)
    turn = F.when(long, F.col("turn")).otherwise(F.col("turn") + 1)
    full = F.length("text") >= 40
    pages = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("appid"),
        (F.col("turn") + 1).cast("int").alias("page"),
        F.concat(F.lit("c"), turn).alias("cursor"),
        F.when(full, F.array("text")).otherwise(F.array().cast("array<string>")).alias("reviews"),
    )
    # Small blocks make listings cross their borders.
    return valid_pages(pages, block=2).select("appid", "page", "cursor")


def part_details(spark, sf_dir, raised=0):
    """Detail responses of all parts as JSON lines keyed by id; some fields are absent.

    ``raised`` is added to the prices.
    """
    size = F.col("p_size")
    cents = F.round(F.col("p_retailprice") * 100).cast("bigint") + raised
    data = F.struct(
        F.col("p_name").alias("name"),
        F.array("p_brand").alias("developers"),
        F.when(size >= 5, F.array("p_brand", "p_type")).alias("publishers"),
        F.struct(F.lit("2024").alias("date"), (size > 40).alias("coming_soon")).alias(
            "release_date"
        ),
        F.when(
            size > 1,
            F.struct(
                cents.alias("initial"),
                (cents - size).alias("final"),
                size.cast("bigint").alias("discount_percent"),
            ),
        ).alias("price_overview"),
        F.array(
            F.struct(F.col("p_type").alias("description")),
            F.struct(F.lit(None).cast("string").alias("description")),
        ).alias("genres"),
        F.create_map(
            F.lit("windows"), F.lit(True), F.lit("mac"), size > 25, F.lit("linux"), size < 10
        ).alias("platforms"),
    )
    detail = F.struct((size < 50).alias("success"), data.alias("data"))
    keyed = F.to_json(F.create_map(F.col("p_partkey").cast("string"), detail))
    return table(spark, sf_dir, "part").select(keyed.alias("value"), "p_partkey")


@query("""
SELECT p_partkey AS appid, p_name AS name, p_brand AS developers,
       CASE WHEN p_size >= 5 THEN p_brand || '、' || p_type ELSE '' END AS publishers,
       '2024' AS release_date, p_size > 40 AS coming_soon,
       CASE WHEN p_size > 1 THEN CAST(round(p_retailprice * 100) AS BIGINT) END
           AS price_initial_cny,
       CASE WHEN p_size > 1 THEN CAST(round(p_retailprice * 100) AS BIGINT) - p_size END
           AS price_final_cny,
       CASE WHEN p_size > 1 THEN CAST(p_size AS BIGINT) END AS discount_percent,
       p_type || '、' AS genres,
       'windows' || CASE WHEN p_size > 25 THEN '、mac' ELSE '' END
                 || CASE WHEN p_size < 10 THEN '、linux' ELSE '' END AS platforms,
       '' AS short_description
FROM part WHERE p_size < 50
""")
def flatten_games(spark, sf_dir):
    path = scratch_path(spark, "details")
    part_details(spark, sf_dir).select("value").write.text(path)
    return flatten_details(read_game_details(spark, path))


@query("""
SELECT p.p_name AS name, p.p_partkey AS appid, coalesce(e.reviews, 0) AS reviews
FROM part p LEFT JOIN (
    SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS appid, count(*) AS reviews
    FROM events GROUP BY 1
) e ON p.p_partkey = e.appid
""")
def seed_join(spark, sf_dir):
    path = scratch_path(spark, "seed")
    part = table(spark, sf_dir, "part")
    part.select(F.concat_ws(":", "p_name", "p_partkey").alias("value")).write.text(path)
    reviews = events(spark, sf_dir).groupBy("appid").agg(F.count("*").alias("reviews"))
    joined = read_seed(spark, path).join(reviews, "appid", "left")
    return joined.select("name", "appid", F.coalesce("reviews", F.lit(0)).alias("reviews"))


@query("""
SELECT k.label, e.event_type, count(*) AS reviews
FROM events e JOIN (VALUES ('purchase', 'sale'), ('error', 'fault'), ('view', NULL),
                           ('click', 'look'), ('signup', 'start'))
     k(event_type, label) ON e.event_type = k.event_type
GROUP BY k.label, e.event_type
""")
def typed_rows_join(spark, sf_dir):
    kinds = from_rows(
        spark,
        [
            {"label": "sale", "event_type": "purchase"},
            {"event_type": "error", "label": "fault"},
            {"event_type": "view"},
            {"event_type": "click", "label": "look"},
            {"event_type": "signup", "label": "start"},
        ],
        "event_type STRING, label STRING",
    )
    reviews = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("reviews"))
    return reviews.join(kinds, "event_type").select("label", "event_type", "reviews")


# Values beyond any calendar, as a review with a broken clock has them.
BROKEN_SECONDS = 10**14


@query(f"""
SELECT event_id, CASE WHEN event_type <> 'view' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS shown
FROM events
""")
def odd_epochs(spark, sf_dir):
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    odd = F.when(F.col("event_type") == "view", seconds + BROKEN_SECONDS).otherwise(seconds)
    return table(spark, sf_dir, "events").select("event_id", epoch_to_text(odd).alias("shown"))
