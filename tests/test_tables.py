"""Table maintenance, exports and intake on real tables."""

from __future__ import annotations

import datetime as dt
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from shelfpulse.functions.dates import DayWindow
from shelfpulse.scratch import scratch_path, shared_root, stage, staging
from shelfpulse.sinks import tables
from shelfpulse.sinks.export import Batch
from shelfpulse.sinks import (
    ExportMismatch,
    append_table,
    delete_window,
    ensure_table,
    export_jdbc,
    merge_jdbc,
    overwrite_from_sql,
    refresh_window,
    replace_or_backup,
    replace_table,
    table_days,
    verify_count,
    write_csv_backup,
)
from shelfpulse.schemas import GMV, GMV_COMMENTS
from shelfpulse.sources import read_table, read_window

SCHEMA = "appid LONG, recommendationid STRING, dt DATE"
AS_OF = "2024-01-30"
WEEK = DayWindow.trailing(AS_OF, 7)


def day(text):
    return dt.date.fromisoformat(text) if text else None


def frame(spark, rows):
    return spark.createDataFrame([(a, r, day(d)) for a, r, d in rows], SCHEMA)


def content(spark, name):
    rows = spark.table(name).select("appid", "recommendationid", "dt").collect()
    return sorted(((r.appid, r.recommendationid, str(r.dt)) for r in rows), key=str)


OLD = [
    (1, "a", "2024-01-22"),
    (1, "b", "2024-01-23"),
    (1, "c", "2024-01-30"),
    (2, "d", "2024-01-25"),
    (2, "e", None),
    (1, "f", "2024-01-31"),
]


@pytest.fixture
def stored(spark, database):
    name = f"{database}.stored"
    replace_table(frame(spark, OLD), name, partition_by="dt")
    return name


def test_days_are_partitions(spark, stored):
    assert table_days(spark, stored) == [
        day(d) for d in ("2024-01-22", "2024-01-23", "2024-01-25", "2024-01-30", "2024-01-31")
    ]
    plan = spark.table(stored).where(WEEK.holds("dt"))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_window_scan(spark, stored):
    ids = {r.recommendationid for r in read_window(spark, stored, AS_OF).collect()}
    assert ids == {"b", "c", "d"}
    ids = {r.recommendationid for r in read_window(spark, stored, AS_OF, include_future=True).collect()}
    assert ids == {"b", "c", "d", "f"}


def test_window_delete_keeps_undated_and_older(spark, stored):
    delete_window(spark, stored, DayWindow.trailing(AS_OF, 7, include_future=True))
    assert content(spark, stored) == [(1, "a", "2024-01-22"), (2, "e", "None")]
    append_table(frame(spark, [(9, "z", "2024-01-30")]), stored)
    assert (9, "z", "2024-01-30") in content(spark, stored)
    assert verify_count(spark, stored) == 3


def test_refresh_replaces_the_window_of_refreshed_games_only(spark, stored):
    new = [(1, "n", "2024-01-24"), (1, "u", None), (1, "late", "2024-01-22"), (1, "x", "2024-01-31")]
    staged = stage(frame(spark, new), "new")
    refresh_window(staged, stored, WEEK, keys=["appid"])
    expected = sorted(
        [
            (1, "a", "2024-01-22"),
            (1, "n", "2024-01-24"),
            (1, "u", "None"),
            (2, "d", "2024-01-25"),
            (2, "e", "None"),
            (1, "f", "2024-01-31"),
        ],
        key=str,
    )
    assert content(spark, stored) == expected
    # Days whose rows all went are gone as partitions too.
    assert day("2024-01-23") not in table_days(spark, stored)
    refresh_window(staged, stored, WEEK, keys=["appid"])
    assert content(spark, stored) == expected


def test_refresh_of_rows_without_a_game(spark, stored):
    staged = stage(frame(spark, [(None, "n", "2024-01-30")]), "new")
    for _ in range(2):
        refresh_window(staged, stored, WEEK, keys=["appid"])
    expected = [(a, r, str(d)) for a, r, d in OLD] + [(None, "n", "2024-01-30")]
    assert content(spark, stored) == sorted(expected, key=str)


def test_refresh_without_keys_replaces_the_whole_window(spark, stored):
    refresh_window(stage(frame(spark, [(3, "n", "2024-01-30")]), "new"), stored, WEEK)
    assert content(spark, stored) == sorted(
        [(1, "a", "2024-01-22"), (2, "e", "None"), (1, "f", "2024-01-31"), (3, "n", "2024-01-30")],
        key=str,
    )


def test_refresh_with_nothing_empties_the_window_only(spark, stored):
    refresh_window(stage(frame(spark, []), "new"), stored, WEEK, keys=["appid"])
    assert content(spark, stored) == sorted([(a, r, str(d)) for a, r, d in OLD], key=str)
    refresh_window(stage(frame(spark, []), "new"), stored, WEEK)
    assert content(spark, stored) == sorted(
        [(1, "a", "2024-01-22"), (2, "e", "None"), (1, "f", "2024-01-31")], key=str
    )


def test_refresh_may_read_the_table_it_writes(spark, stored):
    edited = spark.table(stored).withColumn("recommendationid", F.upper("recommendationid"))
    refresh_window(edited.where("appid = 1"), stored, WEEK, keys=["appid"], keep_undated=False)
    assert content(spark, stored) == sorted(
        [
            (1, "a", "2024-01-22"),
            (1, "B", "2024-01-23"),
            (1, "C", "2024-01-30"),
            (2, "d", "2024-01-25"),
            (2, "e", "None"),
            (1, "f", "2024-01-31"),
        ],
        key=str,
    )


def test_refresh_leaves_the_session_setting(spark, stored):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    refresh_window(frame(spark, []), stored, WEEK)
    assert spark.conf.get(key) == before


def test_replace_drops_old_days_and_undated_rows(spark, stored):
    written = replace_table(frame(spark, [(5, "q", "2024-02-01")]), stored, partition_by="dt")
    assert written == 1
    assert content(spark, stored) == [(5, "q", "2024-02-01")]
    assert table_days(spark, stored) == [day("2024-02-01")]


def test_replace_by_nothing(spark, stored):
    empty = frame(spark, [])
    assert replace_table(empty, stored, partition_by="dt", skip_empty=True) == 0
    assert verify_count(spark, stored) == len(OLD)
    assert replace_table(empty, stored, partition_by="dt") == 0
    assert verify_count(spark, stored) == 0


def test_replace_with_other_columns(spark, stored):
    wider = spark.table(stored).withColumn("extra", F.lit(1))
    assert replace_table(wider, stored, partition_by="dt") == len(OLD)
    assert spark.table(stored).columns == ["appid", "recommendationid", "extra", "dt"]
    assert content(spark, stored) == sorted([(a, r, str(d)) for a, r, d in OLD], key=str)


def test_replace_unpartitioned(spark, database):
    name = f"{database}.plain"
    replace_table(spark.range(3), name)
    replace_table(spark.table(name).withColumn("id", F.col("id") + 10), name)
    assert sorted(r.id for r in read_table(spark, name).collect()) == [10, 11, 12]
    assert replace_table(spark.range(0), name, skip_empty=True) == 0
    assert verify_count(spark, name) == 3


def test_failed_replace_leaves_the_table(spark, database, stored):
    name = f"{database}.kept"
    replace_table(spark.range(3), name)
    broken = spark.range(3).select(F.raise_error(F.lit("broken")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="broken"):
        replace_table(broken, name)
    assert verify_count(spark, name) == 3
    bad_day = frame(spark, [(1, "z", "2024-01-22")]).withColumn(
        "recommendationid", F.raise_error(F.lit("broken")).cast("string")
    )
    with pytest.raises(Exception, match="broken"):
        replace_table(bad_day, stored, partition_by="dt")
    with pytest.raises(Exception, match="broken"):
        refresh_window(bad_day, stored, DayWindow.between("2024-01-22", "2024-01-30"))
    assert content(spark, stored) == sorted([(a, r, str(d)) for a, r, d in OLD], key=str)


def test_append_matches_by_name(spark, database):
    name = f"{database}.appended"
    replace_table(spark.createDataFrame([(1, "x")], "a INT, b STRING"), name)
    append_table(spark.createDataFrame([("y", 2)], "b STRING, a INT"), name)
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, "x"), (2, "y")]


def test_table_definition(spark, database):
    name = f"{database}.gmv"
    for _ in range(2):
        ensure_table(spark, name, GMV, comments=GMV_COMMENTS)
    described = {r.name: (r.dataType, r.description) for r in spark.catalog.listColumns(name)}
    assert described["gmv"] == ("decimal(18,4)", GMV_COMMENTS["gmv"])
    for price in (1, 2):
        overwrite_from_sql(
            spark,
            f"INSERT OVERWRITE TABLE {name} WITH t AS (SELECT date'2024-01-01' AS d) "
            f"SELECT '1', CAST(d AS STRING), CAST({price} AS DECIMAL(18,4)), 1L FROM t",
        )
    row = spark.table(name).collect()
    assert [(r.dt, float(r.gmv)) for r in row] == [("2024-01-01", 2.0)]


def test_static_overwrite_replaces_other_days(spark, stored):
    overwrite_from_sql(
        spark, f"INSERT OVERWRITE TABLE {stored} SELECT 8L, 'q', DATE'2024-03-01'"
    )
    assert content(spark, stored) == [(8, "q", "2024-03-01")]


def test_csv_backup(spark, database, tmp_path):
    games = spark.createDataFrame([(1, 'quo"ted, name'), (2, None)], "appid INT, name STRING")
    path = str(tmp_path / "backup")
    assert replace_or_backup(games, f"{database}.games", path) == "table"
    assert not (tmp_path / "backup").exists()
    assert replace_or_backup(games, "no_such_database.games", path) == "csv"
    write_csv_backup(games, path)
    back = spark.read.option("header", True).csv(path).collect()
    assert sorted((r.appid, r.name is None) for r in back) == [("1", False), ("2", True)]


@pytest.fixture
def derby(spark):
    spark.sparkContext._jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")
    return f"jdbc:derby:memory:t{uuid.uuid4().hex[:10]};create=true"


def test_export(spark, derby):
    rows = spark.range(12_345).withColumn("gmv", F.col("id").cast("decimal(18,4)"))
    assert export_jdbc(rows, derby, "board") == 12_345
    assert export_jdbc(rows.limit(10), derby, "board") == 10

    def back():
        return spark.read.format("jdbc").options(url=derby, dbtable="board").load()

    assert back().count() == 10
    assert export_jdbc(rows.where("id >= 10 AND id < 20"), derby, "board", mode="append") == 10
    assert back().agg(F.sum("id")).first()[0] == sum(range(20))


KINDS = "appid VARCHAR(32), dt VARCHAR(10)"


def sold(spark, rows):
    return spark.createDataFrame(rows, "appid string, dt string, n long")


def held(spark, url, name="gmv"):
    rows = spark.read.format("jdbc").options(url=url, dbtable=name).load().collect()
    return sorted(tuple(r) for r in rows)


def test_merge_replaces_by_any_column(spark, derby):
    first = sold(spark, [("1", "a", 1), ("2", "a", 1), ("1", "b", 1), ("2", "b", 1), ("3", "c", 1)])
    assert merge_jdbc(first, derby, "gmv", column_types=KINDS)
    assert not merge_jdbc(first, derby, "gmv", column_types=KINDS)
    new = sold(spark, [("2", "b", 2), ("1", "c", 2), ("1", "b", 2)])
    replaced = {"dt": new.where("dt = 'b'").select("dt"), "appid": new.where("appid = '1'").select("appid")}
    assert merge_jdbc(new, derby, "gmv", replaced, column_types=KINDS)
    expected = [("1", "b", 2), ("1", "c", 2), ("2", "a", 1), ("2", "b", 2), ("3", "c", 1)]
    assert held(spark, derby) == expected
    # Once more is nothing new; the batch before is, since another came after it.
    assert not merge_jdbc(new, derby, "gmv", replaced, column_types=KINDS)
    assert held(spark, derby) == expected
    assert merge_jdbc(first, derby, "gmv", column_types=KINDS)
    assert len(held(spark, derby)) == 5
    # No rows, but days that are empty now.
    assert merge_jdbc(first.limit(0), derby, "gmv", {"dt": new.select("dt")}, column_types=KINDS)
    assert held(spark, derby) == [("1", "a", 1), ("2", "a", 1)]


@pytest.mark.parametrize("fails", ["INSERT INTO gmv ", "DELETE FROM gmv__applied", "INSERT INTO gmv__applied"])
def test_merge_breaks_off_and_is_repeated(spark, derby, monkeypatch, fails):
    merge_jdbc(sold(spark, [("1", "a", 1), ("1", "b", 1)]), derby, "gmv", column_types=KINDS)
    new = sold(spark, [("1", "b", 2), ("2", "b", 2)])
    given = (new, derby, "gmv", {"dt": new.select("dt")})
    run = Batch._run

    def breaks(self, statements):
        return run(self, [sql if not sql.startswith(fails) else "SELECT no_such FROM nowhere" for sql in statements])

    with monkeypatch.context() as patch:
        patch.setattr(Batch, "_run", breaks)
        with pytest.raises(Exception, match="(?i)nowhere"):
            merge_jdbc(*given, column_types=KINDS)
    assert held(spark, derby) == [("1", "a", 1), ("1", "b", 1)]
    assert merge_jdbc(*given, column_types=KINDS)
    assert held(spark, derby) == [("1", "a", 1), ("1", "b", 2), ("2", "b", 2)]


def test_export_notices_other_rows(spark, derby, monkeypatch):
    rows = spark.range(5)
    export_jdbc(rows, derby, "board")
    counts = iter([7, 5])
    monkeypatch.setattr(type(rows), "count", lambda self: next(counts))
    with pytest.raises(ExportMismatch):
        export_jdbc(rows, derby, "board")


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root
    assert scratch_path(spark, "x").startswith(root)


def test_stage_keeps_rows_and_schema(spark):
    df = spark.createDataFrame([(1, None)], "a INT, b DECIMAL(18,4)")
    staged = stage(df, "kept")
    assert staged.schema == df.schema and staged.collect() == df.collect()


def test_staging_folder_goes_with_the_run(spark):
    with staging(spark) as folder:
        staged = stage(spark.range(3), "gone")
        assert staged.inputFiles()[0].startswith(f"file://{folder}/gone-")
        assert staged.count() == 3
    assert not Path(folder).exists()
    assert not scratch_path(spark, "later").startswith(folder)


def test_missing_table(spark, database):
    with pytest.raises(AnalysisException):
        read_table(spark, f"{database}.absent").collect()


def folders(spark, name):
    return sorted(p.name for p in Path(tables._location(spark, name).removeprefix("file:")).parent.iterdir())


def test_replacement_leaves_no_gap(spark, database, monkeypatch):
    name = f"{database}.board"
    values = lambda: sorted(r[0] for r in spark.table(name).collect())
    assert replace_table(spark.range(3), name) == 3
    reader = spark.table(name)
    assert replace_table(spark.range(5), name) == 5
    # Who is still reading the table as it was can finish.
    assert reader.count() in (3, 5) and values() == [0, 1, 2, 3, 4]
    for step in ("point_to", "delete_folder"):
        with monkeypatch.context() as patch:
            patch.setattr(tables, step, lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
            with pytest.raises(RuntimeError, match="killed"):
                replace_table(spark.range(9 if step == "point_to" else 0), name, skip_empty=True)
        assert values() == [0, 1, 2, 3, 4]
    assert replace_table(spark.table(name).where("id > 1"), name) == 3
    assert values() == [2, 3, 4]
    # The files in use, and those before them; what broken runs left is gone.
    assert len([f for f in folders(spark, name) if f.startswith("board")]) == 2
    assert replace_table(spark.range(0), name, skip_empty=True) == 0 and values() == [2, 3, 4]
    assert replace_table(spark.range(2).withColumn("more", F.lit(1)), name) == 2
    assert spark.table(name).columns == ["id", "more"]
    assert replace_table(spark.range(1).withColumn("more", F.lit(1)), name) == 1
    spark.sql(f"DROP TABLE {name}")
    assert not spark.catalog.tableExists(name)


def test_queries_leave_nothing_but_their_rows(spark, sf_dir):
    from shelfpulse.queries import QUERIES

    root = Path(shared_root(spark)) / spark.sparkContext.applicationId

    def state():
        held = {p.name.rsplit("-", 1)[0] for p in root.iterdir()} if root.exists() else set()
        return held, {r[0] for r in spark.sql("SHOW DATABASES").collect()}

    _, databases = state()
    counts = {name: QUERIES[name](spark, sf_dir).count() for name in ("table_append", "trend_1d", "daily_gmv")}
    assert all(counts.values())
    held, after = state()
    assert after == databases
    assert "daily_gmv" not in held and not any(p.startswith("run") for p in held)
    assert {"table_append", "trend_1d"} <= held
