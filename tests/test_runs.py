"""First load, daily run and backfill from landed files."""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfpulse.__main__ import parser, settings_from
from shelfpulse.functions.dates import DayWindow
from shelfpulse.operators.metrics import buyers_over
from shelfpulse.operators.reviews import newest_summaries, page_entries
from shelfpulse.plans import backfill, layers, run_daily, run_full
from shelfpulse.plans.runs import take_in
from shelfpulse.schemas import GMV, TREND, with_day
from shelfpulse.scratch import scratch_path, stage
from shelfpulse.settings import JdbcTarget, Settings
from shelfpulse.sinks import append_table
from shelfpulse.sources.landing import intact_pages, located, read_review_pages, unreadable_pages
from shelfpulse.streaming import Manifest, ingest_new


def test_the_driver_holds_one_step_at_a_time(spark, database, monkeypatch):
    settings = Settings(namespace=database, review_landing="", game_landing="", checkpoint="")
    gmv = [("1", "2024-01-01", Decimal(1), 1)]
    tables = {"gmv": (gmv, GMV), "trend": ([], with_day(TREND))}
    for role, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.saveAsTable(settings.table(role))
    building, most = [], []

    def replace(df, name, **options):
        building.append(name)
        most.append(len(building))
        time.sleep(0.2)
        building.remove(name)

    monkeypatch.setattr(layers, "replace_table", replace)
    layers.build_boards(spark, settings, dt.date(2024, 1, 1))
    assert most == [1, 1, 1, 1]


def test_a_step_that_fails_does_not_keep_the_others_from_running():
    ran = []

    def fails(text):
        ran.append(text)
        raise ValueError(text)

    with pytest.raises(ValueError, match="first"):
        layers.in_turn(lambda: fails("first"), lambda: fails("second"), lambda: ran.append("third"))
    assert ran == ["first", "second", "third"]


def stamp(day, hour=12):
    moment = dt.datetime.fromisoformat(day).replace(hour=hour, tzinfo=dt.UTC)
    return int(moment.timestamp())


def review(rid, day, author="u", bought=True, up=True, text="好评 画面"):
    return {
        "recommendationid": rid,
        "review": text,
        "timestamp_created": stamp(day) if day else None,
        "voted_up": up,
        "author": {"id": author},
        "bought": bought,
    }


class Zone:
    """A landing zone in a folder."""

    def __init__(self, root):
        self.root = root
        self.reviews, self.games = root / "reviews", root / "games"
        self.reviews.mkdir(), self.games.mkdir()

    def page(self, crawl, appid, page, reviews, cursor=None):
        folder = self.reviews / f"crawl_dt={crawl}"
        folder.mkdir(exist_ok=True)
        line = {
            "appid": appid,
            "page": page,
            "success": 1,
            "cursor": cursor or f"c{page}",
            "reviews": reviews,
        }
        (folder / f"{appid}-{page}-{uuid.uuid4().hex[:6]}.json").write_text(json.dumps(line))

    def price(self, **prices):
        lines = [
            json.dumps({k[1:]: {"success": True, "data": {"name": k, "price_overview": {"final": v}}}})
            for k, v in prices.items()
        ]
        (self.games / "details.json").write_text("\n".join(lines))


@pytest.fixture
def zone(tmp_path):
    return Zone(tmp_path)


@pytest.fixture
def settings(spark, zone, database):
    spark.sparkContext._jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")
    url = f"jdbc:derby:memory:r{uuid.uuid4().hex[:10]};create=true"
    return Settings(
        review_landing=str(zone.reviews),
        game_landing=str(zone.games),
        checkpoint=scratch_path(spark, "stream"),
        namespace=database,
        csv_backup=str(zone.root / "backup"),
        export=JdbcTarget(url=url),
    )


def gmv(spark, settings):
    rows = spark.table(settings.table("gmv")).collect()
    return sorted((r.appid, r.dt, r.gmv, r.add_review_num) for r in rows)


def ids(spark, settings, role):
    return sorted(r.recommendationid for r in spark.table(settings.table(role)).collect())


def test_first_load_then_daily(spark, zone, settings):
    zone.price(g1=10, g2=20)
    zone.page("2024-01-20", 1, 1, [review("a", "2024-01-10"), review("b", "2024-01-15")])
    zone.page("2024-01-20", 1, 2, [review("c", "2024-01-20", "v"), review("old", "2023-10-01")])
    zone.page("2024-01-20", 2, 1, [review("d", "2024-01-18"), review("e", "2024-01-18", bought=False)])
    zone.page("2024-01-20", 2, 2, [])
    zone.page("2024-01-20", 2, 3, [review("after the end", "2024-01-18")])
    run_full(spark, settings, "2024-01-20")
    assert ids(spark, settings, "ods_review") == ["a", "b", "c", "d", "e", "old"]
    assert gmv(spark, settings) == [
        ("1", "2023-10-01", Decimal(10), 1),
        ("1", "2024-01-10", Decimal(10), 1),
        ("1", "2024-01-15", Decimal(10), 1),
        ("1", "2024-01-20", Decimal(10), 1),
        ("2", "2024-01-18", Decimal(20), 1),
    ]
    dwd = spark.table(settings.table("dwd_review"))
    assert {r.category for r in dwd.collect()} == {"画面"} and len(dwd.columns) == 30
    assert ids(spark, settings, "overview") == ["a", "b", "c", "d", "old"]
    ranked = spark.table(settings.table("sales_rank")).collect()
    assert sorted((r.appid, r.sales, r.sales_rank) for r in ranked) == [("1", 2, 1), ("2", 1, 2)]
    assert spark.table(settings.table("growth")).count() == 5
    back = spark.read.format("jdbc").options(
        url=settings.export.url, dbtable=settings.export.table
    )
    assert back.load().count() == 5

    # Game 1 is crawled again: b was edited, c withdrawn, f is new. Game 2 has no new rows.
    zone.price(g1=10, g2=20)
    zone.page("2024-01-22", 1, 1, [review("b", "2024-01-15", bought=False), review("f", "2024-01-22")])
    zone.page("2024-01-22", 2, 1, [])
    run_daily(spark, settings, "2024-01-22")
    assert ids(spark, settings, "ods_review") == ["a", "b", "d", "e", "f", "old"]
    expected = [
        ("1", "2023-10-01", Decimal(10), 1),
        ("1", "2024-01-10", Decimal(10), 1),
        ("1", "2024-01-22", Decimal(10), 1),
        ("2", "2024-01-18", Decimal(20), 1),
    ]
    assert gmv(spark, settings) == expected
    assert ids(spark, settings, "overview") == ["a", "d", "f", "old"]

    # A second run the same day finds nothing new and changes nothing.
    run_daily(spark, settings, "2024-01-22")
    assert gmv(spark, settings) == expected
    assert ids(spark, settings, "dwd_review") == ["a", "b", "d", "e", "f", "old"]

    # A new price applies to the whole history.
    zone.price(g1=11, g2=20)
    run_daily(spark, settings, "2024-01-23")
    assert gmv(spark, settings)[1] == ("1", "2024-01-10", Decimal(11), 1)
    wide = spark.table(settings.table("overview")).where("recommendationid = 'a'")
    assert wide.first().price_final_cny == 11


def test_crawl_that_lands_in_two_parts(spark, zone, settings):
    day = dt.date(2024, 1, 20)
    zone.page("2024-01-20", 1, 1, [review("a", "2024-01-20")])
    assert day in take_in(spark, settings).days
    assert ids(spark, settings, "ods_review") == ["a"]
    zone.page("2024-01-20", 1, 2, [review("b", "2024-01-20"), review("c", "2024-01-14")])
    take_in(spark, settings)
    assert ids(spark, settings, "ods_review") == ["a", "b", "c"]


def test_backfill(spark, zone, settings):
    zone.price(g1=10)
    for crawl in ("2024-01-05", "2024-01-15", "2024-01-25"):
        zone.page(crawl, 1, 1, [review(f"r{crawl[-2:]}", crawl)])
    run_full(spark, settings, "2024-01-25")
    before = gmv(spark, settings)
    assert len(before) == 3
    for role in ("ods_review", "dwd_review", "trend"):
        name = settings.table(role)
        spark.sql(f"ALTER TABLE {name} DROP PARTITION (dt = '2024-01-15')")
    backfill(spark, settings, "2024-01-12", "2024-01-20")
    assert gmv(spark, settings) == before
    assert ids(spark, settings, "ods_review") == ["r05", "r15", "r25"]


def test_required_columns_and_keys(spark, zone, settings):
    from dataclasses import replace

    zone.price(g1=10)
    zone.page("2024-01-20", 1, 1, [review(str(i), "2024-01-20") for i in range(30)])
    capped = replace(settings, export=None)
    run_full(spark, capped, "2024-01-20")
    assert ids(spark, capped, "ods_review") == sorted(str(i) for i in range(30))
    single = replace(capped, dedup_keys=("appid", "timestamp_created"))
    layers.build_dwd(spark, single, None)
    assert ids(spark, single, "dwd_review") == ["0"]
    strict = replace(capped, required=None)
    layers.build_dwd(spark, strict, None)
    assert spark.table(strict.table("dwd_review")).count() == 0


def test_quality_rules_divert_rows(spark, zone, settings):
    from dataclasses import replace

    zone.price(g1=10)
    zone.page(
        "2024-01-20",
        1,
        1,
        [review("a", "2024-01-20"), review("b", "2024-01-20", text="!!"), review("c", "2024-01-19")],
    )
    rules = {"has_text": "clean_content <> ''", "has_author": "author_id IS NOT NULL"}
    checked = replace(settings, quality_rules=rules)
    run_full(spark, checked, "2024-01-20")
    assert ids(spark, checked, "dwd_review") == ["a", "c"]
    assert ids(spark, checked, "quarantine") == ["b"]

    def report():
        rows = spark.table(checked.table("quality")).collect()
        return {(r.rule, str(r.dt)): (r.checked_rows, r.failed_rows) for r in rows}

    first = {("has_text", "2024-01-20"): (2, 1), ("has_author", "2024-01-20"): (2, 0),
             ("has_text", "2024-01-19"): (1, 0), ("has_author", "2024-01-19"): (1, 0)}
    assert report() == first
    # A later run adds its days and leaves the counts of others.
    zone.page("2024-02-20", 1, 1, [review("d", "2024-02-20", text="!!")])
    run_daily(spark, checked, "2024-02-20")
    assert report() == {**first, ("has_text", "2024-02-20"): (1, 1), ("has_author", "2024-02-20"): (1, 0)}


def test_reviews_of_unknown_games_are_reported(spark, zone, settings):
    from dataclasses import replace

    zone.price(g1=10)
    zone.page("2024-01-20", 1, 1, [review("a", "2024-01-20")])
    zone.page("2024-01-20", 2, 1, [review("b", "2024-01-20"), review("c", "2024-01-19")])
    strict = replace(settings, known_games_only=True, quality_rules={"no_c": "recommendationid <> 'c'"})
    run_full(spark, strict, "2024-01-20")
    assert ids(spark, strict, "dwd_review") == ["a"]
    held = spark.table(strict.table("quarantine")).collect()
    assert sorted((r.recommendationid, *r.broken_rules) for r in held) == [("b", "known_game"), ("c", "no_c")]
    rows = spark.table(strict.table("quality")).collect()
    assert {(r.rule, r.dt.day): (r.checked_rows, r.failed_rows) for r in rows} == {
        ("no_c", 20): (2, 0), ("no_c", 19): (1, 1), ("known_game", 20): (2, 1)
    }


def test_history_and_sketches_follow_the_runs(spark, zone, settings):
    from dataclasses import replace

    full = replace(settings, rank_history=True, buyer_sketches=True)
    zone.price(g1=10, g2=1)
    zone.page("2024-01-20", 1, 1, [review("a", "2024-01-12", "u"), review("b", "2024-01-20", "u")])
    zone.page("2024-01-20", 2, 1, [review("c", "2024-01-19", "v"), review("d", "2024-01-20", "u")])
    run_full(spark, full, "2024-01-20")

    def boards():
        rows = spark.table(full.table("history")).collect()
        return {(str(r.dt), r.appid): (r.sales, r.sales_rank, r.gmv_rank) for r in rows}

    first = boards()
    assert first["2024-01-18", "1"] == (1, 1, 1) and ("2024-01-19", "1") not in first
    assert first["2024-01-20", "1"] == (1, 2, 1) and first["2024-01-20", "2"] == (2, 1, 2)
    zone.page("2024-01-22", 1, 1, [review("b", "2024-01-20", "u"), review("e", "2024-01-21", "w"), review("f", "2024-01-22", "w")])
    run_daily(spark, full, "2024-01-22")
    later = boards()
    assert later["2024-01-22", "1"] == (3, 1, 1) and later["2024-01-22", "2"] == (2, 2, 2)
    assert later["2024-01-18", "1"] == (1, 1, 1)
    sketches = spark.table(full.table("buyers"))
    about = {r.appid: r.buyers for r in buyers_over(sketches, DayWindow.between("2024-01-19", "2024-01-22")).collect()}
    assert about == {1: 2, 2: 2}


def test_newest_rating_summary_is_kept(spark, zone, settings):
    def summary(crawl, game, positive):
        folder = zone.reviews / f"crawl_dt={crawl}"
        folder.mkdir(exist_ok=True)
        line = {"appid": game, "page": 1, "success": 1, "query_summary": {"total_positive": positive}, "reviews": [review(f"{crawl}{game}", crawl)]}
        (folder / f"{game}-summary.json").write_text(json.dumps(line))

    zone.price(g1=10)
    summary("2024-01-10", 1, 5), summary("2024-01-20", 1, 7), summary("2024-01-10", 2, 3)
    run_full(spark, settings, "2024-01-20")
    held = lambda: {r.appid: r.total_positive for r in spark.table(settings.table("summary")).collect()}
    assert held() == {1: 7, 2: 3}
    summary("2024-01-21", 2, 4), summary("2024-01-15", 1, 6)
    run_daily(spark, settings, "2024-01-21")
    assert held() == {1: 7, 2: 4}


def test_nothing_landed_writes_nothing(spark, zone, settings):
    zone.price(g1=10)
    zone.page("2024-01-20", 1, 1, [review("a", "2024-01-20")])
    run_full(spark, settings, "2024-01-20")
    for file in zone.reviews.rglob("*.json"):
        file.write_text(json.dumps({"appid": 1, "page": 1, "crawl_dt": "2024-01-20", "reviews": []}))
    (zone.games / "details.json").write_text(json.dumps({"1": {"success": False}}))
    run_full(spark, settings, "2024-01-20")
    assert ids(spark, settings, "ods_review") == ["a"]
    assert spark.table(settings.table("game")).count() == 1


def test_game_listed_twice_counts_once(spark, zone, settings):
    zone.price(g1=10)
    details = zone.games / "details.json"
    details.write_text(details.read_text() + "\n" + details.read_text())
    zone.page("2024-01-20", 1, 1, [review("a", "2024-01-20")])
    run_full(spark, settings, "2024-01-20")
    assert gmv(spark, settings) == [("1", "2024-01-20", Decimal(10), 1)]


def test_daily_run_before_anything_landed(spark, zone, settings):
    zone.price(g1=10)
    run_daily(spark, settings, "2024-01-20")
    assert not spark.catalog.tableExists(settings.table("ods_review"))


def test_command_line_settings(monkeypatch):
    monkeypatch.setenv("SHELFPULSE_JDBC_PASSWORD", "secret")
    args = parser().parse_args(
        "daily --reviews r --games g --checkpoint c --rank-days 9 --as-of 2024-01-30 "
        "--jdbc-url jdbc:x --jdbc-user root".split()
    )
    made = settings_from(args)
    assert made.rank_days == 9 and made.review_landing == "r"
    assert made.export.properties == {"user": "root", "password": "secret"}
    assert made.export.batch_size == 5000 and made.export.table == "ads_dashboard"


def test_failed_batch_runs_again(spark, zone, tmp_path, database):
    zone.page("2024-01-20", 1, 1, [review("a", "2024-01-20")])
    checkpoint = str(tmp_path / "checkpoint")
    seen = []

    def fail(pages):
        raise RuntimeError("table is locked")

    known = Manifest(str(zone.reviews), f"{database}.pages")
    with pytest.raises(Exception, match="locked"):
        ingest_new(spark, known, checkpoint, fail)
    ingest_new(spark, known, checkpoint, lambda pages: seen.append(pages.count()))
    ingest_new(spark, known, checkpoint, lambda pages: seen.append(pages.count()))
    assert seen == [1]


def test_crawls_that_pile_up_lose_nothing(spark, zone, settings):
    zone.price(g1=10)
    zone.page("2024-01-05", 1, 1, [review("a", "2024-01-01"), review("b", "2024-01-05")])
    zone.page("2024-01-13", 1, 1, [review("c", "2024-01-10"), review("ahead", "2024-02-02")])
    zone.page("2024-01-30", 1, 1, [review("d", "2024-01-30"), review("late", "2023-12-01")])
    run_daily(spark, settings, "2024-01-20")
    every = ["a", "ahead", "b", "c", "d", "late"]
    assert ids(spark, settings, "ods_review") == every
    assert ids(spark, settings, "dwd_review") == every
    # A part of an older crawl lands late: it does not take back what a newer one owns.
    zone.page("2024-01-31", 1, 1, [review("d", "2024-01-30", bought=False)])
    run_daily(spark, settings, "2024-01-31")
    zone.page("2024-01-30", 1, 2, [review("e", "2024-01-22")])
    run_daily(spark, settings, "2024-01-31")
    assert ids(spark, settings, "ods_review") == sorted([*every, "e"])
    d = spark.table(settings.table("ods_review")).where("recommendationid = 'd'").first()
    assert d.bought is False


def test_full_run_reads_what_it_marks(spark, zone, settings):
    zone.price(g1=10)
    zone.page("2024-01-20", 1, 1, [review("a", "2024-01-20"), review("nowhen", None)])
    zone.page("2024-01-21", 1, 1, [review("a", "2024-01-20"), review("b", "2024-01-21")])
    run_full(spark, settings, "2024-01-20")
    run_daily(spark, settings, "2024-01-21")
    assert ids(spark, settings, "ods_review") == ["a", "b", "nowhen"]
    assert ids(spark, settings, "dwd_review") == ["a", "b"]
    run_full(spark, settings, "2024-06-01")
    assert ids(spark, settings, "ods_review") == ["a", "b", "nowhen"]


def test_backfill_leaves_the_boards_at_the_newest_day(spark, zone, settings):
    zone.price(g1=10, g2=20)
    zone.page("2024-01-10", 1, 1, [review("a", "2024-01-10"), review("b", "2024-01-09")])
    zone.page("2024-01-30", 2, 1, [review("c", "2024-01-30")])
    run_full(spark, settings, "2024-01-30")
    top = lambda: [r.appid for r in spark.table(settings.table("sales_rank")).collect()]
    assert top() == ["2"]
    backfill(spark, settings, "2024-01-09", "2024-01-11")
    assert top() == ["2"]
    backfill(spark, settings, "2024-01-09", "2024-01-11", as_of="2024-01-11")
    assert top() == ["1"]


def test_games_over_several_crawls(spark, zone, settings):
    def listed(crawl, *lines):
        folder = zone.games / f"crawl_dt={crawl}"
        folder.mkdir()
        (folder / "details.json").write_text("\n".join(lines))

    def line(appid, name, price, success=True):
        data = {"name": name} | ({"price_overview": {"final": price}} if price is not None else {})
        return json.dumps({appid: {"success": success, "data": data}})

    listed("2024-01-01", line("1", "one", 10), line("2", "two", 20), line("3", "three", 30))
    listed("2024-01-09", line("1", "new", 12), line("2", "two!", None), line("2", "two", None))
    listed("2024-01-10", line("1", "failed", 99, success=False))
    zone.page("2024-01-20", 1, 1, [review("a", "2024-01-20")])
    zone.page("2024-01-20", 3, 1, [review("b", "2024-01-20")])
    run_full(spark, settings, "2024-01-20")
    games = {r.appid: (r.name, r.price_final_cny) for r in spark.table(settings.table("game")).collect()}
    assert games == {1: ("new", 12), 2: ("two!", 20), 3: ("three", 30)}
    assert [(r[0], r[2]) for r in gmv(spark, settings)] == [("1", Decimal(12)), ("3", Decimal(30))]


def test_a_new_price_touches_only_days_of_its_game(spark, zone, settings):
    zone.price(g1=10, g2=20)
    zone.page("2024-01-20", 1, 1, [review("a", "2024-01-02"), review("b", "2024-01-20")])
    zone.page("2024-01-20", 2, 1, [review("c", "2024-01-05"), review("d", "2024-01-02")])
    run_full(spark, settings, "2024-01-20")
    wide = lambda: spark.table(settings.table("overview"))
    files = lambda day: {r[0] for r in wide().where(f"dt = '{day}'").selectExpr("_metadata.file_name").collect()}
    kept, changed = files("2024-01-05"), files("2024-01-02")
    zone.price(g1=11, g2=20)
    run_daily(spark, settings, "2024-02-20")
    assert files("2024-01-05") == kept and files("2024-01-02").isdisjoint(changed)
    prices = {r.recommendationid: r.price_final_cny for r in wide().collect()}
    assert prices == {"a": 11, "b": 11, "c": 20, "d": 20}


def test_unreadable_pages_and_odd_times_are_kept(spark, zone, settings):
    zone.price(g1=10)
    odd = review("odd", "2024-01-20") | {"timestamp_updated": 10**14, "timestamp_created": -(10**13)}
    zone.page("2024-01-20", 1, 1, [review("a", "2024-01-20"), odd])
    (zone.reviews / "crawl_dt=2024-01-20" / "cut.json").write_text('{"appid": 1, "page": 2, "rev')
    run_full(spark, settings, "2024-01-20")
    assert ids(spark, settings, "ods_review") == ["a", "odd"]
    counts = lambda: [(str(r.crawl_dt), r.pages) for r in spark.table(settings.table("intake")).collect()]
    assert counts() == [("2024-01-20", 1)]
    run_full(spark, settings, "2024-01-20")
    assert counts() == [("2024-01-20", 1)]


def test_own_label_rules(spark, zone, settings, tmp_path):
    from dataclasses import replace

    zone.price(g1=10)
    zone.page("2024-01-20", 1, 1, [review("a", "2024-01-20", text="Very FAST"), review("b", "2024-01-20", text="Great GRAPHICS")])
    run_full(spark, replace(settings, label_rules={"优化": ["fast"]}), "2024-01-20")
    labels = lambda: {r.recommendationid: r.category for r in spark.table(settings.table("dwd_review")).collect()}
    assert labels() == {"a": "优化", "b": "其他"}
    run_full(spark, settings, "2024-01-20")
    assert labels() == {"a": "其他", "b": "画面"}
    rules = tmp_path / "rules.json"
    rules.write_text('{"价格": ["cheap"]}')
    args = parser().parse_args(f"full --reviews r --games g --checkpoint c --label-rules {rules}".split())
    assert settings_from(args).label_rules == {"价格": ["cheap"]}


def test_failed_game_table_is_an_error(spark, zone, settings, monkeypatch):
    from shelfpulse.sinks import tables

    zone.price(g1=10)

    def fail(*args, **kwargs):
        raise OSError("no space")

    monkeypatch.setattr(tables, "replace_table", fail)
    with pytest.raises(RuntimeError, match="backup"):
        layers.load_games(spark, settings)
    assert spark.read.option("header", True).csv(settings.csv_backup).count() == 1


def test_backfill_does_not_bring_back_removed_reviews(spark, zone, settings):
    """A crawl without reviews in the window owns its days all the same."""
    zone.price(g1=10)
    zone.page("2024-01-16", 1, 1, [review("r", "2024-01-15"), review("s", "2024-01-16")])
    zone.page("2024-01-20", 1, 1, [review("t", "2024-01-19")])
    run_full(spark, settings, "2024-01-20")
    assert ids(spark, settings, "ods_review") == ["t"]
    backfill(spark, settings, "2024-01-14", "2024-01-15")
    assert ids(spark, settings, "ods_review") == ["t"]
    # What a fault left behind goes: the landing zone tells whose day it is.
    stale = spark.table(settings.table("ods_review")).select(
        *[F.lit("r").alias(c) if c == "recommendationid" else F.lit(dt.date(2024, 1, 15)).alias(c) if c == "dt" else c
          for c in spark.table(settings.table("ods_review")).columns]
    )
    append_table(stage(stale, "stale"), settings.table("ods_review"))
    assert ids(spark, settings, "ods_review") == ["r", "t"]
    backfill(spark, settings, "2024-01-14", "2024-01-15")
    assert ids(spark, settings, "ods_review") == ["t"]


def test_backfill_keeps_what_the_landing_zone_does_not_tell(spark, zone, settings):
    zone.price(g1=10)
    zone.page("2024-01-05", 1, 1, [review("a", "2024-01-05")])
    zone.page("2024-01-20", 1, 1, [review("b", "2024-01-20")])
    run_full(spark, settings, "2024-01-20")
    for file in (zone.reviews / "crawl_dt=2024-01-05").iterdir():
        file.unlink()
    backfill(spark, settings, "2024-01-04", "2024-01-20")
    assert ids(spark, settings, "ods_review") == ["a", "b"]


def test_backfill_opens_the_files_of_the_window_only(spark, zone, settings, monkeypatch):
    opened = []
    read = Manifest.read

    def spy(self, spark, paths):
        opened.append(sorted(path.split("crawl_dt=")[1][:10] for path in paths))
        return read(self, spark, paths)

    monkeypatch.setattr(Manifest, "read", spy)
    zone.price(g1=10)
    for month in range(1, 7):
        zone.page(f"2024-0{month}-20", 1, 1, [review(f"m{month}", f"2024-0{month}-19"), review("old", "2023-11-11")])
        zone.page(f"2024-0{month}-20", 1, 2, [review(f"n{month}", f"2024-0{month}-18")])
    run_full(spark, settings, "2024-06-20")
    assert opened == []
    backfill(spark, settings, "2024-03-17", "2024-03-18")
    assert opened == [[*["2024-03-20"] * 2, "2024-04-20", "2024-05-20", "2024-06-20"]]
    del opened[:]
    # A file that no run has recorded is read for the manifest, then with the others.
    zone.page("2024-03-21", 1, 1, [review("new", "2024-03-18")])
    backfill(spark, settings, "2024-03-17", "2024-03-18")
    assert opened[0] == ["2024-03-21"] and "2024-03-21" in opened[1]
    assert "new" in ids(spark, settings, "ods_review")
    assert "n3" not in ids(spark, settings, "ods_review")


def test_daily_intake_opens_touched_crawls_only(spark, zone, settings, monkeypatch):
    files = []
    open_ = Manifest.open

    def spy(self, wanted):
        pages = open_(self, wanted)
        files.extend(sorted(f.split("crawl_dt=")[1][:12] for f in pages.inputFiles() if "crawl_dt=" in f))
        return pages

    monkeypatch.setattr(Manifest, "open", spy)
    zone.price(g1=10, g2=10)
    for crawl in ("2023-01-10", "2023-06-10", "2024-01-10"):
        for game in (1, 2):
            zone.page(crawl, game, 1, [review(f"{crawl}-{game}", crawl)])
    run_full(spark, settings, "2024-01-10")
    zone.page("2023-01-10", 1, 2, [review("x", "2023-01-09")])
    zone.page("2024-01-10", 1, 2, [review("y", "2024-01-09")])
    run_daily(spark, settings, "2024-01-10")
    assert files == ["2023-01-10/1", "2023-01-10/1", "2024-01-10/1", "2024-01-10/1"]
    assert {"x", "y"} <= set(ids(spark, settings, "ods_review"))


def test_manifest_tells_pages(spark, zone, settings):
    zone.page("2024-01-10", 1, 1, [review("a", "2024-01-03"), review("b", None), review("c", "2024-01-12")])
    zone.page("2024-01-10", 1, 2, [])
    (zone.reviews / "crawl_dt=2024-01-10" / "cut [1]{x}.json").write_text('{"appid": 2, "reviews": [')
    known = layers.manifest(settings)
    rows = {(r.appid, r.page): r for r in known.pages(spark).collect()}
    first, empty = rows[1, 1], rows[1, 2]
    day = lambda n: dt.date(2024, 1, n)
    assert (first.first_dt, first.last_dt, first.refetched_dt, first.n_reviews) == (day(3), day(12), day(3), 3)
    assert (empty.first_dt, empty.n_reviews, empty.cursor, empty.readable) == (None, 0, "c2", True)
    cut = next(r for key, r in rows.items() if key[1] is None)
    assert cut.readable is False and cut.n_reviews is None
    assert known.pages(spark).count() == 3
    assert known.open(known.pages(spark).where("NOT readable")).count() == 1


def test_steps_that_need_no_texts_read_none(spark, zone, settings, monkeypatch):
    zone.page("2026-07-10", 1, 1, [review("a", "2026-07-03")])
    with open(next(zone.reviews.glob("crawl_dt=*/*.json")), "a") as file:
        file.write('\n{"appid": 2, "page": 1, "reviews": [{"rev')
    staged = {}

    def keep(df, label):
        staged[label] = stage(df, label)
        return staged[label]

    monkeypatch.setattr(layers, "stage", keep)
    rows = layers.crawled_rows(located(read_review_pages(spark, str(zone.reviews))), settings)
    assert [r.recommendationid for r in rows.collect()] == ["a"] and staged["unreadable"].count() == 1
    pages = staged["pages"]
    assert sorted(r.n_reviews is None for r in pages.select("n_reviews").collect()) == [False, True]
    for narrow in (newest_summaries(intact_pages(pages)), unreadable_pages(pages), page_entries(pages)):
        read = narrow._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1].split("\n")[0]
        assert "review:" not in read and "recommendationid" not in read
