"""Hot keys against brute force, and the shape of the plans."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfpulse.functions import clean_text, label_by_rules
from shelfpulse.functions.dates import Days, DayWindow
from shelfpulse.operators import metrics, quality, rows
from shelfpulse.operators.bloom import MOST_WORDS, bloom_filter, may_hold, words_for
from shelfpulse.operators.cleaning import clean_reviews
from shelfpulse.operators.ranking import rank_all, rank_within
from shelfpulse.operators.reviews import valid_pages
from shelfpulse.queries import QUERIES
from shelfpulse.queries.standins import games, sales


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows share one key, and many of them are copies."""
    rng = random.Random(7)
    data = []
    for i in range(6000):
        key = 1 if i % 3 == 0 else rng.randrange(2, 400)
        data.append((key, i, rng.randrange(50), f"text {rng.randrange(20)}"))
    df = spark.createDataFrame(data, "k INT, id INT, v INT, t STRING").repartition(16)
    return df, data


def test_cap_of_a_hot_key(hot):
    df, data = hot
    groups = defaultdict(list)
    for k, i, v, _ in data:
        groups[k].append((v, i))
    expected = sorted((k, i) for k, group in groups.items() for _, i in sorted(group)[:10])
    capped = rows.cap_per_key(df, ["k"], ["v", "id"], 10, spread_by=["id"], spread=8)
    assert sorted((r.k, r.id) for r in capped.collect()) == expected


def test_latest_of_many_copies(hot):
    df, data = hot
    latest = {}
    for _, i, _, t in data:
        latest[t] = max(latest.get(t, -1), i)
    kept = rows.dedup_latest(df, ["t"], [F.desc("id")])
    assert {r.t: r.id for r in kept.collect()} == latest


def test_unique_rule_on_a_hot_key(hot):
    df, data = hot
    counts = Counter(k for k, *_ in data)
    checked = quality.check(df, {}, unique=["k"])
    assert checked.quarantine.count() == sum(n for n in counts.values() if n > 1)
    assert checked.good.count() == sum(1 for n in counts.values() if n == 1)


def ranks(data, dense):
    levels = sorted({v for v in data if v is not None}, reverse=True)
    order = levels + ([None] if None in data else [])
    if dense:
        return {v: i + 1 for i, v in enumerate(order)}
    counts, ahead, result = Counter(data), 0, {}
    for v in order:
        result[v] = ahead + 1
        ahead += counts[v]
    return result


@pytest.mark.parametrize("dense", [False, True])
@pytest.mark.parametrize("slices", [1, 7, None])
def test_rank_with_a_hot_value(spark, dense, slices):
    rng = random.Random(11)
    data = [5 if i % 3 == 0 else rng.choice([None, *range(400)]) for i in range(2000)]
    df = spark.createDataFrame(list(enumerate(data)), "id INT, v INT")
    expected = ranks(data, dense)
    got = {r.id: r["rank"] for r in rank_all(df, "v", dense=dense, slices=slices).collect()}
    assert got == {i: expected[v] for i, v in enumerate(data)}


def test_rank_of_nothing(spark):
    assert rank_all(spark.createDataFrame([], "v INT"), "v").collect() == []


@pytest.mark.parametrize("dense", [False, True])
def test_rank_within_groups(hot, dense):
    df, data = hot
    groups = defaultdict(list)
    for k, _, v, _ in data:
        groups[k].append(v)
    expected = {k: ranks(vs, dense) for k, vs in groups.items()}
    got = rank_within(df, "v", ["k"], dense=dense).collect()
    assert len(got) == len(data)
    assert all(r["rank"] == expected[r.k][r.v] for r in got)


listing = st.lists(
    st.tuples(st.booleans(), st.sampled_from(["a", "b", "c", "*", None])), min_size=1, max_size=12
)


def crawl(pages):
    """Follow the cursors of one listing page by page."""
    asked, kept = "*", []
    for number, (full, cursor) in enumerate(pages, start=1):
        if not full:
            break
        kept.append(number)
        if (cursor or "*") == asked:
            break
        asked = cursor or "*"
    return kept


@settings(max_examples=6, deadline=None)
@given(st.lists(listing, min_size=1, max_size=40))
def test_paging_like_a_crawl(spark, listings):
    data = [
        (app, number, cursor, ["r"] if full else [])
        for app, pages in enumerate(listings)
        for number, (full, cursor) in enumerate(pages, start=1)
    ]
    df = spark.createDataFrame(data, "appid INT, page INT, cursor STRING, reviews ARRAY<STRING>")
    expected = sorted((app, n) for app, pages in enumerate(listings) for n in crawl(pages))
    got = sorted((r.appid, r.page) for r in valid_pages(df, block=3).collect())
    assert got == expected


# Plans


def test_gmv_counts_before_the_join(spark, sf_dir):
    text = plan(metrics.daily_gmv(sales(spark, sf_dir), games(spark, sf_dir)))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,props:string>" in text
    # One shuffle of the facts, and it carries partial counts.
    facts = text[: text.index("BroadcastExchange")]
    assert facts.count("Exchange hashpartitioning") <= 1
    assert "partial_count(1)" in text
    assert "Python" not in text


def test_group_limits_run_before_the_shuffle(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = plan(rows.dedup_latest(documents, ["text"], [F.asc("doc_id")]))
    final, exchange, partial = (
        text.index(part)
        for part in ("row_number(), 1, Final", "Exchange hashpartitioning", "row_number(), 1, Partial")
    )
    assert final < exchange < partial
    capped = rows.cap_per_key(sales(spark, sf_dir), ["appid"], ["created_date"], 5, spread_by=["dt"])
    assert plan(capped).count("Partial") == 2


def test_cleaning_stays_in_the_jvm(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    reviews = documents.withColumnsRenamed({"text": "review"})
    text = plan(clean_reviews(reviews, ["review"]))
    assert "Python" not in text and "NestedLoop" not in text and "Cartesian" not in text
    labelled = documents.select(label_by_rules(clean_text("text")))
    assert "Exchange" not in plan(labelled)


# The remaining queries write tables, or ship single-row results.
READ_ONLY = [
    "daily_gmv", "daily_sales_distinct", "overview_wide", "review_profile", "dedup_latest",
    "distinct_rows", "cap_per_game", "clean_reviews", "quality_report", "quality_quarantine",
    "seed_join", "paging_stop", "top_games", "positive_rate_rank", "sales_rank_7d",
]


@pytest.mark.parametrize("name", READ_ONLY)
def test_no_products_and_no_forced_broadcast(spark, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    text = plan(result)
    assert "Cartesian" not in text and "NestedLoop" not in text
    assert "BatchEvalPython" not in text
    logical = result._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in logical


def test_dimension_beyond_the_threshold_is_shuffled(spark, sf_dir):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        wide = metrics.overview(sales(spark, sf_dir), games(spark, sf_dir))
        assert "SortMergeJoin" in plan(wide)
        gmv = metrics.daily_gmv(sales(spark, sf_dir), games(spark, sf_dir))
        # The second grouping reuses the partitioning of the join.
        assert plan(gmv).count("Exchange hashpartitioning") == 3
        assert gmv.count() > 0
    finally:
        spark.conf.set(key, before)


def test_unique_rows_are_not_shuffled(spark, monkeypatch):
    wide = spark.range(5000).selectExpr("id", "repeat(cast(id AS string), 40) AS text", "CAST(NULL AS INT) AS n")
    df = wide.unionByName(wide.where("id % 10 = 0")).unionByName(wide.where("id = 30"))
    shuffled = []
    distinct = rows.distinct_rows
    monkeypatch.setattr(rows, "distinct_rows", lambda df: shuffled.append(df.count()) or distinct(df))
    out = rows.distinct_wide(df)
    assert sorted(out.collect()) == sorted(wide.collect())
    # Of 5,501 rows those that repeat, 1,001, and a few that the filter takes for such.
    assert 1001 <= shuffled[0] < 1300
    few = rows.distinct_wide(df, most_words=64)
    assert shuffled[1] > shuffled[0]
    assert sorted(few.collect()) == sorted(wide.collect())


def test_distinct_of_odd_values(spark):
    values = [(1.0, "a"), (-0.0, None), (0.0, None), (float("nan"), "a"), (float("nan"), "a"), (None, None), (None, None), (1.0, "b")]
    df = spark.createDataFrame(values, "x DOUBLE, s STRING").withColumn("l", F.array("x"))
    assert rows.distinct_wide(df).count() == rows.distinct_rows(df).count() == 5
    assert rows.distinct_wide(df.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, 2), (1, 2)], "`a.b` INT, c INT")
    assert rows.distinct_wide(odd).count() == 1


def test_bloom_filter_knows_its_keys(spark):
    keys = spark.range(3000).select(F.xxhash64("id").alias("h"))
    words = words_for(3000)
    assert words == 1024 and words_for(0) == 64 and words_for(10**12) == MOST_WORDS
    known = bloom_filter(keys, words)
    asked = spark.range(13_000).withColumn("known", may_hold(known, F.xxhash64("id"), words))
    got = {r["inside"]: r["share"] for r in asked.groupBy((F.col("id") < 3000).alias("inside")).agg(F.avg(F.col("known").cast("int")).alias("share")).collect()}
    assert got[True] == 1.0 and got[False] < 0.05


def test_references_against_a_join(spark, hot):
    fact = spark.range(4000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 0 THEN NULL ELSE id % 900 END AS k", "id")
    dimension = spark.range(0, 900, 2).selectExpr("id AS k").unionByName(spark.range(7, 8).selectExpr("id AS k"))
    for words in (MOST_WORDS, 64):
        checked = quality.check_references(fact, dimension, ["k"], "known", most_words=words)
        orphans = fact.where("k IS NOT NULL").join(dimension.distinct(), "k", "left_anti")
        assert sorted(checked.quarantine.drop("broken_rules").collect()) == sorted(orphans.select("k", "id").collect())
        assert checked.good.count() + orphans.count() == 4000
        assert checked.good.where("k IS NULL").count() == fact.where("k IS NULL").count() > 0
        assert checked.report.first() == ("known", 4000, orphans.count())
    assert "Window" not in plan(checked.good)


def test_sketches_merge_over_days(spark):
    days = "CAST(date_add(DATE'2024-01-01', CAST(id % 9 AS INT)) AS DATE) AS dt"
    bought = spark.range(60_000).selectExpr("id % 2 AS appid", days, "CAST(id % 7919 AS STRING) AS author_id", "id % 5 > 0 AS bought")
    sketches = metrics.buyer_sketches(bought)
    for window in (DayWindow.between("2024-01-02", "2024-01-05"), DayWindow.between("2024-01-01", "2024-01-09")):
        exact = {r.appid: r.buyers for r in metrics.exact_buyers_over(bought, window).collect()}
        for r in metrics.buyers_over(sketches, window).collect():
            assert abs(r.buyers - exact[r.appid]) < 0.06 * exact[r.appid]
    one = sketches.where("appid = 0 AND dt = DATE'2024-01-03'").first().buyers
    assert one == bought.where("appid = 0 AND dt = DATE'2024-01-03' AND bought").select("author_id").distinct().count()


def test_some_days_of_the_history(spark):
    from shelfpulse.operators import boards

    daily = spark.createDataFrame(
        [(1, "2024-01-01", 1.0, 5), (2, "2024-01-03", 9.0, 1), (1, "2024-01-09", 2.0, 1)],
        "appid LONG, dt STRING, gmv DOUBLE, add_review_num LONG",
    )
    whole = boards.rank_history(daily)
    only = Days(frozenset({dt.date(2024, 1, 7), dt.date(2024, 1, 8), dt.date(2024, 1, 12)}))
    some = boards.rank_history(daily, only=only)
    wanted = sorted(tuple(r) for r in whole.select(*some.columns).where(only.holds("dt")).collect())
    assert sorted(tuple(r) for r in some.collect()) == wanted and len(wanted) == 3
    assert whole.agg(F.max("dt")).first()[0] == dt.date(2024, 1, 9)
