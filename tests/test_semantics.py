"""Edge rows of each operator, expected values worked out by hand."""

from __future__ import annotations

import datetime as dt
import json
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfpulse.functions import (
    CATEGORIES,
    age_days,
    clean_text,
    created_day,
    day_of,
    enabled_keys,
    epoch_to_text,
    join_field,
    join_list,
    label_by_rules,
    labels_by,
)
from shelfpulse.functions.dates import DayWindow
from shelfpulse.operators import boards, metrics, quality, rows
from shelfpulse.operators.cleaning import clean_reviews
from shelfpulse.operators.reviews import (
    flatten_games,
    flatten_reviews,
    newest_games,
    query_summary,
    valid_pages,
)
from shelfpulse.schemas import GAME, GAME_DATA, ODS_REVIEW, struct
from shelfpulse.sources import (
    from_rows,
    intact_pages,
    read_game_details,
    read_review_pages,
    read_seed,
    unreadable_pages,
)


def values(df, *columns):
    return [tuple(row) for row in (df.select(*columns) if columns else df).collect()]


def shape(schema):
    return [(field.name, field.dataType) for field in schema.fields]


def land(tmp_path, name, lines):
    path = tmp_path / name
    path.write_text("\n".join(lines), encoding="utf-8")
    return str(path)


# Landed pages


def test_review_fields_absent_null_and_set(spark, tmp_path):
    page = {
        "crawl_dt": "2024-01-02",
        "appid": 7,
        "page": 1,
        "success": 1,
        "cursor": "c",
        "reviews": [
            {"recommendationid": "1"},
            {"recommendationid": "2", "voted_up": None, "votes_up": None, "author": None},
            {
                "recommendationid": "3",
                "review": "ok",
                "voted_up": True,
                "votes_up": 5,
                "weighted_vote_score": "0.5",
                "timestamp_created": 1700000000,
                "author": {"id": "s", "num_reviews": 4, "deck_playtime_at_review": 1.5},
                "bought": True,
                "developer_response": "thanks",
            },
        ],
    }
    pages = read_review_pages(spark, land(tmp_path, "p.json", [json.dumps(page)]))
    flat = flatten_reviews(pages, carry=["crawl_dt"])
    assert flat.columns == [*ODS_REVIEW.names, "crawl_dt", "page", "pos", "dt"]
    assert shape(flat.select(*ODS_REVIEW.names).schema) == shape(ODS_REVIEW)
    first, second, third = flat.orderBy("pos").collect()
    for row in (first, second):
        assert row.review == "" and row.voted_up is False and row.votes_up == 0
        assert row.votes_funny == 0 and row.comment_count == 0
        assert row.bought is False and row.received_for_free is False
        assert row.written_during_early_access is False and row.on_handheld is False
        assert row.language is None and row.author_id is None
        assert row.developer_response is None and row.created_date is None and row.dt is None
    assert third.author_id == "s" and third.author_num_reviews == 4
    assert third.author_deck_playtime_at_review == 1.5
    assert third.weighted_vote_score == 0.5 and third.votes_up == 5 and third.appid == 7
    assert third.created_date == "2023-11-14 22:13:20" and third.updated_date is None
    assert third.dt == dt.date(2023, 11, 14)


def test_one_bad_value_does_not_cost_the_page(spark, tmp_path):
    page = {
        "appid": 1,
        "page": 1,
        "reviews": [
            {"recommendationid": "1", "votes_up": 4294967295, "weighted_vote_score": 0},
            {"recommendationid": "2", "votes_up": "many", "weighted_vote_score": "n/a"},
            {"recommendationid": "3", "votes_up": 3},
        ],
    }
    path = land(tmp_path, "p.json", [json.dumps(page), '{"appid": 2, "reviews": [{"reco'])
    pages = read_review_pages(spark, path)
    flat = flatten_reviews(intact_pages(pages))
    got = values(flat.orderBy("pos"), "recommendationid", "votes_up", "weighted_vote_score")
    # The count that does not fit is unknown; the one that is no number counts as missing.
    assert got == [("1", None, 0.0), ("2", 0, None), ("3", 3, None)]
    assert unreadable_pages(pages).count() == 1


def test_place_columns_from_folders(spark, tmp_path):
    folder = tmp_path / "crawl_dt=2024-01-05" / "appid=42" / "page=3"
    folder.mkdir(parents=True)
    (folder / "response.json").write_text('{"success": 1, "reviews": [{"review": "x"}]}')
    row = read_review_pages(spark, str(tmp_path)).first()
    assert (row.crawl_dt, row.appid, row.page) == (dt.date(2024, 1, 5), 42, 3)


PAGES = "appid LONG, page INT, cursor STRING, reviews ARRAY<STRING>"


@pytest.mark.parametrize("block", [1, 2, 1024])
def test_paging_stops(spark, block):
    full, empty = ["r"], []
    pages = spark.createDataFrame(
        [
            # empty third page, then more
            (1, 1, "a", full), (1, 2, "b", full), (1, 3, "c", empty), (1, 4, "d", full),
            # cursor repeated on page 2
            (2, 1, "a", full), (2, 2, "a", full), (2, 3, "b", full),
            # first page answers with the first cursor, or with none
            (3, 1, "*", full), (3, 2, "b", full),
            (4, 1, None, full), (4, 2, "b", full),
            # missing list
            (5, 1, "a", None), (5, 2, "b", full),
            # nothing stops
            (6, 1, "a", full), (6, 2, "b", full), (6, 3, "c", full),
            # pages without a number, a listing without a game
            (8, None, "a", full), (8, 1, "*", full), (8, 2, "b", full),
            (None, 1, "a", full), (None, 2, "a", full), (None, 3, "b", full),
            # a page landed twice is one step
            (7, 1, "a", full), (7, 1, "a", full), (7, 2, "b", full),
        ],
        PAGES,
    )
    kept = values(valid_pages(pages, block=block).orderBy("appid", "page"), "appid", "page")
    assert kept == [
        (None, 1), (None, 2), (1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (4, 1), (6, 1), (6, 2), (6, 3),
        (7, 1), (7, 1), (7, 2), (8, None), (8, 1),
    ]


def test_query_summary_defaults(spark, tmp_path):
    lines = [
        {"appid": 1, "page": 1, "success": 1, "query_summary": {"total_positive": 3}},
        {"appid": 2, "page": 1, "success": 1},
        {"appid": 3, "page": 1, "success": 2, "query_summary": {"total_positive": 9}},
        {"appid": 4, "page": 2, "success": 1, "query_summary": {"total_positive": 9}},
    ]
    pages = read_review_pages(spark, land(tmp_path, "p.json", map(json.dumps, lines)))
    got = values(query_summary(pages).orderBy("appid"))
    assert got == [(1, "N/A", 3, 0, 0), (2, "N/A", 0, 0, 0)]


# Game details


def test_game_details(spark, tmp_path):
    full = {
        "name": "One",
        "developers": ["A", "B"],
        "publishers": [],
        "release_date": {"date": "1 Jan", "coming_soon": False},
        "price_overview": {"initial": 100, "final": 80, "discount_percent": 20},
        "genres": [{"description": "x"}, {"id": "2"}],
        "platforms": {"windows": True, "mac": False, "linux": True},
        "short_description": "s",
    }
    lines = [
        json.dumps({"11": {"success": True, "data": full}}),
        json.dumps({"12": {"success": True, "data": {"name": "Two"}}}),
        json.dumps({"13": {"success": False}, "14": {"data": full}}),
        json.dumps({"bad": {"success": True, "data": {"name": "Three"}}}),
    ]
    games = flatten_games(read_game_details(spark, land(tmp_path, "g.json", lines)))
    assert shape(games.schema) == shape(GAME)
    one, two, three = games.orderBy("name").collect()[0], *games.orderBy(F.desc("name")).collect()[:2]
    assert tuple(one) == (
        11, "One", "A、B", "", "1 Jan", False, 100, 80, 20, "x、", "windows、linux", "s",
    )
    assert tuple(two) == (12, "Two", "", "", None, None, None, None, None, "", "", "")
    assert three.appid is None and three.name == "Three"


def test_last_crawl_of_game_details(spark, tmp_path):
    for crawl, name in (("2024-01-01", "old"), ("2024-01-02", "new")):
        (tmp_path / f"crawl_dt={crawl}").mkdir()
        land(tmp_path, f"crawl_dt={crawl}/g.json", [
            json.dumps({"1": {"success": True, "data": {"name": name}}})
        ])
    assert values(newest_games(read_game_details(spark, str(tmp_path))), "name") == [("new",)]


def test_list_expressions(spark):
    row = spark.createDataFrame([(None, None, None)], struct(
        a=GAME_DATA["developers"].dataType,
        g=GAME_DATA["genres"].dataType,
        p=GAME_DATA["platforms"].dataType,
    ))
    assert values(row, join_list("a"), join_field("g", "description"), enabled_keys("p")) == [
        ("", "", "")
    ]


def test_seed_lines(spark, tmp_path):
    path = land(tmp_path, "seed.txt", ["星露谷物语:413150", "a:b:7", " gap : 8 ", "no id:", "junk"])
    assert sorted(values(read_seed(spark, path))) == [("a:b", 7), ("gap", 8), ("星露谷物语", 413150)]


def test_rows_bind_by_name(spark):
    got = from_rows(spark, [{"b": None, "a": 1}, {"b": "x"}], "a INT, b STRING")
    assert values(got) == [(1, None), (None, "x")]


# Expressions


def test_epoch(spark):
    stamps = spark.createDataFrame([(None,), (0,), (1700000000,)], "s LONG")
    assert values(stamps, epoch_to_text("s"), created_day("s")) == [
        (None, None),
        (None, None),
        ("2023-11-14 22:13:20", dt.date(2023, 11, 14)),
    ]


def test_day_text(spark):
    texts = spark.createDataFrame([("2024-01-02 23:59:59",), ("n/a",), (None,)], "t STRING")
    day = day_of("t")
    assert values(texts, day, age_days(day, "2024-01-09")) == [
        (dt.date(2024, 1, 2), 7),
        (None, None),
        (None, None),
    ]


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        ("好评!!  good_game", "好评 good game"),
        ("___", ""),
        (None, None),
        ("a²b", "a²b"),
        ("", ""),
        ("\tÉté\n—  ¡hola! ", "Été hola"),
        ("１２ 한국어 カタカナ", "１２ 한국어 カタカナ"),
    ],
)
def test_clean_text(spark, raw, clean):
    assert values(spark.createDataFrame([(raw,)], "t STRING"), clean_text("t")) == [(clean,)]


def test_clean_text_like_python(spark, sf_dir):
    import re

    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    texts += ["好评！！画面_很好…… 10/10", "a b c", "x​y"]
    got = values(spark.createDataFrame([(t,) for t in texts], "t STRING"), "t", clean_text("t"))
    for raw, clean in got:
        assert clean == re.sub(r"[\s\W_]+", " ", raw).strip()


def test_labels(spark):
    texts = ["画面 很好", "剧情 故事 画面", "价格 画面", "nothing", "", None]
    got = values(spark.createDataFrame([(t,) for t in texts], "t STRING"), label_by_rules("t"))
    assert got == [("画面",), ("剧情",), ("画面",), ("其他",), ("其他",), ("其他",)]
    assert CATEGORIES[-1] == "其他" and len(CATEGORIES) == 8
    with pytest.raises(ValueError, match="outside"):
        label_by_rules("t", {"no such label": ["x"]})


def test_own_model(spark):
    def make_model():
        seen = []

        def model(batch):
            seen.append(len(batch))
            return [{"a": "剧情", "b": " 玩法\n"}.get(text, "made up") for text in batch]

        return model

    texts = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "t STRING").coalesce(1)
    got = values(texts, labels_by(make_model)("t"))
    assert got == [("剧情",), ("玩法",), ("其他",), ("其他",)]


# Row filters


def test_cutoff(spark):
    noon = int(dt.datetime(2024, 1, 30, 12, tzinfo=dt.UTC).timestamp())
    week = noon - 7 * 86400
    stamps = spark.createDataFrame([(None,), (0,), (week,), (week - 1,), (noon,)], "s LONG")
    kept = rows.within(stamps, "2024-01-30 12:00:00", 7, "s")
    assert values(kept) == [(None,), (0,), (week,), (noon,)]
    assert rows.within(stamps, "2024-01-30 12:00:00", 0, "s").count() == 5


def test_delete_condition_keeps_unknown(spark):
    days = spark.createDataFrame(
        [(None,), ("2024-01-23",), ("2024-01-22",), ("2024-01-31",)], "d STRING"
    ).select(F.to_date("d").alias("d"))
    kept = rows.remaining(days, age_days("d", "2024-01-30") <= 7)
    assert values(kept) == [(None,), (dt.date(2024, 1, 22),)]
    window = DayWindow.trailing("2024-01-30", 7)
    assert [d for (d,) in values(days.where(window.holds("d")))] == [dt.date(2024, 1, 23)]
    future = DayWindow.trailing("2024-01-30", 7, include_future=True)
    assert days.where(future.holds("d")).count() == 2


def test_drop_nulls(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0), (None, "b", 1.0), (3, None, 1.0), (4, "d", math.nan)],
        "i INT, s STRING, x DOUBLE",
    )
    assert values(rows.drop_nulls(df, ["i"]), "s") == [("a",), (None,), ("d",)]
    assert values(rows.drop_nulls(df, ["i", "x"]), "i") == [(1,), (3,)]
    assert values(rows.drop_nulls(df), "i") == [(1,)]


def test_distinct_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a")], "i INT, s STRING")
    assert sorted(values(rows.distinct_rows(df)), key=str) == [(1, "a"), (1, None)]


def test_cap_after_cutoff(spark):
    df = spark.createDataFrame([(1, 0, 5), (1, 1, 100), (1, 2, 100)], "k INT, pos INT, s LONG")
    recent = rows.within(df, "1970-01-01 00:01:40", 1, "s").where("s >= 100")
    kept = rows.cap_per_key(recent, ["k"], ["pos"], 2, spread_by=["pos"])
    assert sorted(values(kept, "pos")) == [(1,), (2,)]


def test_success_needs_true(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "success BOOLEAN")
    assert rows.successful(df).count() == 1


def test_conform(spark):
    df = spark.createDataFrame([("7", "x", "gone")], "b STRING, a STRING, extra STRING")
    got = rows.conform(df, ODS_REVIEW)
    assert shape(got.schema) == shape(ODS_REVIEW) and got.first().review is None
    narrow = from_rows(spark, [("9999999999", "1")], "big STRING, small STRING")
    typed = rows.conform(
        narrow, struct(small=ODS_REVIEW["votes_up"].dataType, big=ODS_REVIEW["votes_up"].dataType)
    )
    assert values(typed) == [(1, None)]


def test_preview_is_small_and_ordered(spark):
    df = spark.range(100).withColumn("x", -F.col("id"))
    assert values(rows.preview(df, 3, ["id"], order=["x"])) == [(99,), (98,), (97,)]
    assert rows.preview(df, 3).count() == 3


def test_votes_split(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "voted_up BOOLEAN")
    up, down = rows.split_votes(df)
    assert (up.count(), down.count()) == (1, 1)


def test_clean_reviews_order(spark):
    df = spark.createDataFrame(
        [(1, "a", "好评!", 5, None), (1, "a", "好评!", 5, None), (1, None, "x", 5, None)],
        "appid INT, recommendationid STRING, review STRING, timestamp_created INT, "
        "developer_response STRING",
    )
    kept = clean_reviews(df)
    assert values(kept, "recommendationid", "clean_content", "category") == [("a", "好评", "其他")]
    assert clean_reviews(df, required=None).count() == 0


# Figures

SALES = "appid LONG, dt DATE, bought BOOLEAN, author_id STRING, voted_up BOOLEAN"
DAY, NEXT = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


@pytest.fixture(scope="module")
def sold(spark):
    return spark.createDataFrame(
        [
            (1, DAY, True, "u", True),
            (1, DAY, True, "u", True),
            (1, DAY, True, "v", False),
            (1, DAY, False, "w", True),
            (1, NEXT, True, "u", True),
            (2, DAY, True, "u", True),
            (3, DAY, True, "u", True),
            (1, DAY, None, "x", None),
        ],
        SALES,
    )


@pytest.fixture(scope="module")
def priced_games(spark):
    return spark.createDataFrame([(1, 10), (2, None)], "appid LONG, price_final_cny LONG")


def test_gmv(sold, priced_games):
    gmv = metrics.daily_gmv(sold, priced_games)
    assert dict(gmv.dtypes)["gmv"] == "decimal(18,4)"
    assert sorted(values(gmv, "appid", "dt", "gmv", "add_review_num")) == [
        (1, DAY, Decimal(30), 3),
        (1, NEXT, Decimal(10), 1),
        (2, DAY, None, 1),
    ]
    scaled = metrics.daily_gmv(sold, priced_games, scale=Decimal("0.01"))
    assert scaled.where("appid = 1 AND dt = '2024-01-01'").first().gmv == Decimal("0.3")


def test_gmv_equals_row_wise_join_with_doubled_and_partly_null_prices(spark, sold):
    doubled = spark.createDataFrame(
        [(1, 10), (1, 5), (2, None), (2, 4)], "appid LONG, price_final_cny LONG"
    )
    wide = metrics.overview(sold, doubled)
    row_wise = wide.groupBy("appid", "dt").agg(
        F.sum("price_final_cny").cast("decimal(18,4)").alias("gmv"),
        F.count("*").alias("add_review_num"),
    )
    gmv = metrics.daily_gmv(sold, doubled)
    assert sorted(values(gmv, *row_wise.columns)) == sorted(values(row_wise))


def test_gmv_total_equals_overview(sold, priced_games):
    total = metrics.daily_gmv(sold, priced_games).agg(F.sum("gmv")).first()[0]
    assert total == metrics.overview(sold, priced_games).agg(F.sum("price_final_cny")).first()[0]


def test_trend(sold):
    trend = metrics.trend_1d(sold)
    columns = ["appid", "dt", "sales", "buyers", "review_count", "positive_count", "sales_rank"]
    assert sorted(values(trend, *columns)) == [
        (1, DAY, 3, 2, 5, 3, 1),
        (1, NEXT, 1, 1, 1, 1, 1),
        (2, DAY, 1, 1, 1, 1, 2),
        (3, DAY, 1, 1, 1, 1, 2),
    ]
    assert trend.where("appid = 1 AND dt = '2024-01-01'").first().positive_rate == 0.6


def test_approximate_buyers(sold):
    exact = metrics.daily_buyers(sold)
    near = metrics.daily_buyers(sold, approximate=True)
    assert sorted(values(exact)) == sorted(values(near))


def test_profiles(spark):
    reviews = spark.createDataFrame(
        [(1, True, "2024-01-02"), (1, False, "2024-01-01"), (1, None, None)],
        "appid INT, voted_up BOOLEAN, created_date STRING",
    )
    assert values(metrics.review_profile(reviews)) == [(1, 3, 1, 1, "2024-01-01", "2024-01-02")]
    games = spark.createDataFrame(
        [(100, 20), (None, 0), (50, None)], "price_final_cny LONG, discount_percent LONG"
    )
    assert values(metrics.game_profile(games)) == [(3, 75.0, 1)]
    assert values(metrics.game_profile(games.limit(0))) == [(0, 0.0, 0)]


GMV = "appid LONG, dt DATE, gmv DECIMAL(18,4), add_review_num LONG"


def test_growth(spark):
    days = [dt.date(2024, 1, d) for d in range(1, 5)]
    gmv = spark.createDataFrame(
        [
            (1, days[0], Decimal(0), 0),
            (1, days[1], Decimal(10), 1),
            (2, days[1], Decimal(10), 1),
            (1, days[2], Decimal(30), 1),
            (1, days[3], Decimal(15), 1),
        ],
        GMV,
    )
    got = values(boards.gmv_growth(gmv).orderBy("dt"), "gmv", "gmv_change", "gmv_growth")
    assert got == [
        (Decimal(0), None, None),
        (Decimal(20), Decimal(20), None),
        (Decimal(30), Decimal(10), 0.5),
        (Decimal(15), Decimal(-15), -0.5),
    ]
    second = boards.gmv_growth_by_game(gmv).where("appid = 2")
    assert values(second, "prev_gmv", "gmv_change", "gmv_growth") == [(None, None, None)]


def test_recent_totals_are_seven_days(spark):
    first = dt.date(2024, 1, 24)
    gmv = spark.createDataFrame(
        [
            (1, first - dt.timedelta(days=1), Decimal(100), 100),
            (1, first, Decimal(1), 2),
            (1, dt.date(2024, 1, 30), Decimal(2), 3),
            (1, dt.date(2024, 1, 31), Decimal(100), 100),
        ],
        GMV,
    )
    assert values(boards.recent_totals(gmv, "2024-01-30")) == [(1, 5, Decimal(3))]


def test_rate_rank_is_dense_and_has_a_minimum(spark):
    trend = spark.createDataFrame(
        [(1, 4, 4), (2, 4, 4), (3, 4, 2), (4, 1, 1)],
        "appid INT, review_count LONG, positive_count LONG",
    )
    ranked = boards.positive_rate_rank(trend, min_reviews=2)
    assert sorted(values(ranked, "appid", "rate_rank")) == [(1, 1), (2, 1), (3, 2)]


def test_top_games_break_ties_by_id(spark):
    totals = spark.createDataFrame([(3, 5), (1, 5), (2, 9), (4, None)], "appid INT, gmv INT")
    assert values(boards.top_games(totals, "gmv", 3), "appid") == [(2,), (1,), (3,)]


# Quality


def test_check_splits_and_counts(spark):
    df = spark.createDataFrame([(1, 5), (1, 6), (2, -1), (3, None), (None, 1), (None, 2)], "k INT, v INT")
    checked = quality.check(df, {"positive": F.col("v") > 0}, unique=["k"])
    assert sorted(values(checked.good, "k", "v"), key=str) == [(3, None), (None, 1), (None, 2)]
    bad = sorted((k, v, tuple(b)) for k, v, b in values(checked.quarantine, "k", "v", "broken_rules"))
    assert bad == [(1, 5, ("unique_k",)), (1, 6, ("unique_k",)), (2, -1, ("positive",))]
    assert sorted(values(checked.report)) == [("positive", 6, 1), ("unique_k", 6, 2)]
    assert checked.good.columns == ["k", "v"]


def test_column_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a INT, `b.c` STRING")
    assert values(quality.column_profile(df)) == [
        (0, "a", "int", 2, 1),
        (1, "b.c", "string", 2, 2),
    ]
