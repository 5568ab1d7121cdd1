"""Scalar functions, filters, duplicates, labels and quality rules."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfpulse.functions import (
    age_days,
    clean_text as clean_expression,
    day_of,
    epoch_to_text,
    label_by_rules,
    labels_by,
)
from shelfpulse.functions.labels import CATEGORIES
from shelfpulse.operators import cleaning, quality, rows
from shelfpulse.operators.labelling import label_by_rule_table, label_texts
from shelfpulse.queries.registry import query
from shelfpulse.queries.standins import (
    AS_OF,
    SALES_SQL,
    TEXTS_SQL,
    events,
    games,
    sales,
    table,
    texts,
)
from shelfpulse.schemas import struct

CLEAN = r"trim(regexp_replace({}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_date FROM events")
def epoch_text(spark, sf_dir):
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    stamped = table(spark, sf_dir, "events").select("event_id", seconds.alias("seconds"))
    return stamped.select("event_id", epoch_to_text("seconds").alias("created_date"))


@query(f"""
SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS created_day,
       date_diff('day', CAST(ts AS DATE), DATE '{AS_OF}') AS age
FROM events
""")
def day_age(spark, sf_dir):
    dated = events(spark, sf_dir).select("event_id", day_of("created_date").alias("created_day"))
    return dated.withColumn("age", age_days("created_day", AS_OF).cast("bigint"))


@query(f"SELECT doc_id, {CLEAN.format('text')} AS clean_content FROM documents")
def clean_text(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", clean_expression("text").alias("clean_content"))


@query(f"""
WITH {TEXTS_SQL}
SELECT doc_id, coalesce(quality, 0) AS quality, coalesce(toxic = 1, false) AS toxic FROM texts
""")
def missing_defaults(spark, sf_dir):
    votes = texts(spark, sf_dir).select("doc_id", "quality", (F.col("toxic") == 1).alias("toxic"))
    return rows.with_defaults(votes, {"quality": 0, "toxic": False})


@query("""
SELECT CAST(p_partkey AS BIGINT) AS appid, p_name AS name,
       CAST(NULL AS BIGINT) AS price_initial_cny,
       TRY_CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS brand,
       TRY_CAST(p_type AS BIGINT) AS kind
FROM part
""")
def schema_conform(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        F.col("p_type").alias("kind"),
        F.replace("p_brand", F.lit("Brand#"), F.lit("")).alias("brand"),
        F.col("p_name").alias("name"),
        F.col("p_partkey").cast("string").alias("appid"),
        "p_size",
    )
    declared = struct(
        appid=T.LongType(),
        name=T.StringType(),
        price_initial_cny=T.LongType(),
        brand=T.IntegerType(),
        kind=T.LongType(),
    )
    return rows.conform(part, declared)


@query("""
SELECT doc_id, quality FROM labels WHERE quality = 1
""")
def success_filter(spark, sf_dir):
    voted = texts(spark, sf_dir).select("doc_id", "quality")
    return rows.successful(voted, "quality")


@query("""
SELECT event_id FROM events
WHERE event_type = 'signup' OR ts >= TIMESTAMP '2024-01-23 12:00:00'
""")
def lookback_cutoff(spark, sf_dir):
    # Sign-ups play the rows without a time, which pass.
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    stamped = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") != "signup", seconds).alias("timestamp_created"),
    )
    return rows.within(stamped, f"{AS_OF} 12:00:00", 7).select("event_id")


@query(f"WITH {TEXTS_SQL} SELECT doc_id, quality, toxic FROM texts WHERE quality IS NOT NULL")
def drop_nulls(spark, sf_dir):
    whole = rows.drop_nulls(texts(spark, sf_dir), ["doc_id", "quality"])
    return whole.select("doc_id", "quality", "toxic")


@query("SELECT DISTINCT lang, source, text FROM documents")
def distinct_rows(spark, sf_dir):
    return rows.distinct_rows(table(spark, sf_dir, "documents").select("lang", "source", "text"))


@query("SELECT DISTINCT lang, text, doc_id % 3 AS part FROM documents")
def distinct_wide(spark, sf_dir):
    """Every second document is there three times, the others once."""
    documents = table(spark, sf_dir, "documents").select(
        "lang", "text", (F.col("doc_id") % 3).alias("part"), "doc_id"
    )
    copies = F.when(F.col("doc_id") % 2 == 0, F.array_repeat(F.lit(0), 3)).otherwise(F.array(F.lit(0)))
    return rows.distinct_wide(documents.select("lang", "text", "part", F.explode(copies).alias("c")).drop("c"))


@query(f"""
WITH {SALES_SQL}
SELECT appid, recommendationid, created_date, 'known_game' AS broken
FROM sales WHERE appid NOT IN (SELECT p_partkey FROM part WHERE p_size < 30)
""")
def orphan_reviews(spark, sf_dir):
    """Reviews of games that the dimension does not have."""
    known = table(spark, sf_dir, "part").where("p_size < 30").select(F.col("p_partkey").alias("appid"))
    checked = quality.check_references(sales(spark, sf_dir), known, ["appid"], "known_game")
    return checked.quarantine.select(
        "appid", "recommendationid", "created_date", F.array_join("broken_rules", ",").alias("broken")
    )


@query(f"""
WITH {SALES_SQL}
SELECT 'known_game' AS rule, count(*) AS checked_rows,
       count(*) FILTER (WHERE appid NOT IN (SELECT p_partkey FROM part WHERE p_size < 30)) AS failed_rows
FROM sales
""")
def orphan_report(spark, sf_dir):
    known = table(spark, sf_dir, "part").where("p_size < 30").select(F.col("p_partkey").alias("appid"))
    return quality.check_references(sales(spark, sf_dir), known, ["appid"], "known_game").report


@query("""
SELECT doc_id, source FROM (
    SELECT doc_id, source, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n
    FROM documents
) ranked WHERE n = 1
""")
def dedup_latest(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return rows.dedup_latest(documents, ["text"], [F.asc("doc_id")]).select("doc_id", "source")


@query(f"""
WITH {SALES_SQL}
SELECT appid, recommendationid, created_date FROM (
    SELECT *, row_number() OVER (
        PARTITION BY appid ORDER BY created_date, CAST(recommendationid AS BIGINT)) AS n
    FROM sales
) ranked WHERE n <= 10
""")
def cap_per_game(spark, sf_dir):
    order = ["created_date", F.col("recommendationid").cast("bigint")]
    capped = rows.cap_per_key(
        sales(spark, sf_dir), ["appid"], order, 10, spread_by=["recommendationid"]
    )
    return capped.select("appid", "recommendationid", "created_date")


@query("SELECT p_partkey AS appid, p_name AS name FROM part ORDER BY p_partkey LIMIT 5")
def preview_rows(spark, sf_dir):
    return rows.preview(games(spark, sf_dir), 5, ["appid", "name"], order=["appid"])


@query("""
SELECT user_id, count(*) AS reviews FROM events GROUP BY user_id
""")
def accumulate_batches(spark, sf_dir):
    source = table(spark, sf_dir, "events").select("user_id", "event_type")
    kind = F.coalesce("event_type", F.lit(""))
    first = ("purchase", "view", "error")
    batches = [source.where(kind == name) for name in first]
    batches.append(source.where(~kind.isin(*first)))
    return rows.accumulate(*batches).groupBy("user_id").agg(F.count("*").alias("reviews"))


# Words of the invented test texts, with labels of the fixed set.
TEXT_RULES = {
    "画面": ("The", "ouen"),
    "剧情": ("TION", "eaux"),
    "玩法": ("und", "sch"),
    "音效": ("ando", "que"),
    "价格": ("price", "er"),
}


def _label_sql(text: str) -> str:
    """Most hits first, earlier label on a tie."""
    hits = {
        label: " + ".join(f"CAST(contains(lower({text}), '{word.lower()}') AS INTEGER)" for word in words)
        for label, words in TEXT_RULES.items()
    }
    best = "greatest(" + ", ".join(hits.values()) + ")"
    cases = " ".join(f"WHEN {count} = {best} THEN '{label}'" for label, count in hits.items())
    return f"CASE WHEN {best} = 0 THEN '其他' {cases} END"


def _text_rules(text):
    return label_by_rules(text, TEXT_RULES)


@query(f"""
WITH cleaned AS (SELECT doc_id, {CLEAN.format('text')} AS clean_content FROM documents)
SELECT doc_id, {_label_sql('clean_content')} AS category FROM cleaned
""")
def classify_rules(spark, sf_dir):
    cleaned = cleaning.add_clean_content(table(spark, sf_dir, "documents"), "text")
    return cleaning.classify(cleaned, _text_rules).select("doc_id", "category")


@query("""
SELECT doc_id, CASE WHEN contains(text, 'the') THEN '剧情' ELSE '其他' END AS category
FROM documents
""")
def batch_classifier(spark, sf_dir):
    def make_model():
        # A stand-in for a model: one answer of the label set, one outside it.
        return lambda batch: [" 剧情\n" if "the" in text else "unknown" for text in batch]

    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labelled = cleaning.classify(documents, labels_by(make_model), text="text")
    return labelled.select("doc_id", "category")


# Rules taken from the texts: the words at some places of each document.
RULE_WORDS_SQL = f"""
rule_words AS (
    SELECT DISTINCT word, ({list(CATEGORIES[:7])})[length(word) % 7 + 1] AS label
    FROM (SELECT lower(unnest(string_split(text, ' ')[2:6])) AS word FROM documents) w
    WHERE word <> ''
)
"""


@query(f"""
WITH {RULE_WORDS_SQL}, texts AS (
    SELECT DISTINCT lower(text) AS t FROM documents
), hits AS (
    SELECT t, label, count(*) AS hits FROM texts JOIN rule_words ON contains(t, word) GROUP BY ALL
), best AS (
    SELECT t, label, row_number() OVER (
        PARTITION BY t ORDER BY hits DESC, list_position({list(CATEGORIES)}, label)) AS n
    FROM hits
)
SELECT d.doc_id, coalesce(b.label, '其他') AS category
FROM documents d LEFT JOIN best b ON lower(d.text) = b.t AND b.n = 1
""")
def classify_rule_table(spark, sf_dir):
    """Thousands of words, which no single expression could hold."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    word = F.explode(F.slice(F.split(F.lower("text"), " "), 2, 5))
    words = documents.select(word.alias("word")).where("word <> ''").distinct()
    label = F.element_at(F.array(*[F.lit(x) for x in CATEGORIES[:7]]), F.char_length("word") % 7 + 1)
    labelled = label_by_rule_table(documents, words.withColumn("label", label), "text")
    return labelled.select("doc_id", "category")


@query("""
SELECT doc_id, CASE WHEN contains(text, 'the') THEN '剧情' ELSE '其他' END AS category
FROM documents
""")
def batch_classifier_once(spark, sf_dir):
    """The model gets 16 texts at a time, and copies of a text once."""

    def make_model():
        def model(texts):
            if len(texts) > 16 or len(set(texts)) < len(texts):
                raise ValueError("the batch is not as asked for")
            return ["剧情" if "the" in text else "unknown" for text in texts]

        return model

    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return label_texts(documents, make_model, "text", batch_size=16).select("doc_id", "category")


@query(f"""
WITH {TEXTS_SQL},
cleaned AS (
    SELECT DISTINCT source, lang, text AS review, quality, {CLEAN.format('text')} AS clean_content
    FROM texts
)
SELECT source, lang, review, quality, clean_content, {_label_sql('clean_content')} AS category
FROM cleaned WHERE quality IS NOT NULL
""")
def clean_reviews(spark, sf_dir):
    raw = texts(spark, sf_dir).select("source", "lang", F.col("text").alias("review"), "quality")
    return cleaning.clean_reviews(raw, ["review", "quality"], _text_rules)


LINE_RULES = {
    "quantity_in_range": (F.col, "l_quantity", 1, 45),
    "discount_in_range": (F.col, "l_discount", 0.0, 0.07),
    "tax_in_range": (F.col, "l_tax", 0.0, 0.06),
}


def _line_rules():
    return {
        name: column(field).between(low, high)
        for name, (column, field, low, high) in LINE_RULES.items()
    }


@query(
    " UNION ALL ".join(
        f"""SELECT '{name}' AS rule, count(*) AS checked_rows,
            count(*) FILTER (WHERE NOT ({field} BETWEEN {low} AND {high})) AS failed_rows
            FROM lineitem"""
        for name, (_, field, low, high) in LINE_RULES.items()
    )
    + """
    UNION ALL SELECT 'unique_l_orderkey_l_linenumber', count(*),
           count(*) FILTER (WHERE copies > 1)
    FROM (SELECT count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies FROM lineitem) c
    """
)
def quality_report(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return quality.check(lines, _line_rules(), unique=["l_orderkey", "l_linenumber"]).report


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax,
       concat_ws(',', CASE WHEN NOT (l_quantity BETWEEN 1 AND 45) THEN 'quantity_in_range' END,
                 CASE WHEN NOT (l_discount BETWEEN 0.0 AND 0.07) THEN 'discount_in_range' END,
                 CASE WHEN NOT (l_tax BETWEEN 0.0 AND 0.06) THEN 'tax_in_range' END) AS broken
FROM lineitem
WHERE NOT (l_quantity BETWEEN 1 AND 45 AND l_discount BETWEEN 0.0 AND 0.07
           AND l_tax BETWEEN 0.0 AND 0.06)
""")
def quality_quarantine(spark, sf_dir):
    bad = quality.check(table(spark, sf_dir, "lineitem"), _line_rules()).quarantine
    return bad.select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_discount",
        "l_tax",
        F.array_join("broken_rules", ",").alias("broken"),
    )


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def repeated_keys(spark, sf_dir):
    return quality.repeated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


PROFILED = {
    "doc_id": "bigint",
    "text": "string",
    "lang": "string",
    "source": "string",
    "quality": "int",
    "toxic": "int",
}


@query(
    f"WITH {TEXTS_SQL} "
    + " UNION ALL ".join(
        f"""SELECT {i} AS position, '{name}' AS column_name, '{kind}' AS column_type,
            count(*) AS row_count, count(*) - count({name}) AS null_count FROM texts"""
        for i, (name, kind) in enumerate(PROFILED.items())
    )
)
def column_profile(spark, sf_dir):
    return quality.column_profile(texts(spark, sf_dir))
