"""One function per layer; each reads the layer below and writes its own tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfpulse.functions.dates import Days, DayWindow, created_day
from shelfpulse.functions.labels import label_by_rules
from shelfpulse.operators.boards import (
    gmv_growth,
    gmv_rank,
    positive_rate_rank,
    rank_history,
    recent_totals,
    sales_rank,
)
from shelfpulse.operators.cleaning import clean_reviews
from shelfpulse.operators.joins import join_same
from shelfpulse.operators.metrics import buyer_sketches, overview, trend_1d
from shelfpulse.operators.quality import check, check_references
from shelfpulse.operators.reviews import (
    day_owners,
    flatten_reviews,
    newest_by_crawl,
    newest_games,
    newest_summaries,
    page_entries,
    settle_crawls,
    valid_pages,
)
from shelfpulse.operators.rows import dedup_latest, distinct_rows, distinct_wide, purchased
from shelfpulse.schemas import (
    DWD_REVIEW,
    GMV,
    GMV_COMMENTS,
    ODS_REVIEW,
    OVERVIEW,
    TREND,
    with_day,
)
from shelfpulse.scratch import stage
from shelfpulse.settings import Settings
from shelfpulse.sinks.tables import (
    append_table,
    ensure_table,
    overwrite_from_sql,
    overwriting,
    refresh_window,
    replace_or_backup,
    replace_table,
    table_bytes,
    table_days,
)
from shelfpulse.sources.landing import intact_pages, read_game_details, unreadable_pages
from shelfpulse.streaming.manifest import Manifest

CRAWL = ("crawl_dt", "appid")
#: Bytes of reviews from which reading them three times is cheaper than shuffling them once.
LARGE_HISTORY = 1 << 30


def manifest(settings: Settings) -> Manifest:
    """What is known of the landing zone."""
    return Manifest(
        settings.review_landing,
        settings.table("manifest"),
        settings.table_format,
        settings.payload_keys,
    )


def crawled_rows(pages: DataFrame, settings: Settings) -> DataFrame:
    """All reviews of landed pages as ODS rows, with their crawl and day.

    Pages that cannot be read go to a table of their own, with a count per crawl. Pages that
    carry their file are recorded in the manifest.
    """
    # Parsed once: the paging rule, the choice of the crawl and the manifest read it again.
    pages = stage(pages.withColumn("n_reviews", F.array_size("reviews")), "pages")
    store_unreadable(pages, settings)
    store_summaries(pages, settings)
    if "file" in pages.columns:
        manifest(settings).record(page_entries(pages))
    return _ods_rows(valid_pages(intact_pages(pages), CRAWL), settings)


def _ods_rows(pages: DataFrame, settings: Settings) -> DataFrame:
    rows = flatten_reviews(pages, carry=["crawl_dt"], keys=settings.payload_keys)
    return rows.select(*ODS_REVIEW.names, "crawl_dt", "dt")


def window_again(
    spark: SparkSession, settings: Settings, window: DayWindow
) -> tuple[DataFrame, DataFrame]:
    """The rows of a window as a first load would have them, and its owned (appid, dt).

    Which pages count and which crawl a day belongs to is settled over the manifest of all
    crawls; opened are the files that hold pages with reviews of the window.
    """
    known = manifest(settings)
    entries = stage(known.pages(spark).where("readable"), "entries")
    pages = stage(valid_pages(entries, CRAWL), "valid")
    fresh = F.col("refetched_dt") >= F.date_sub("crawl_dt", settings.refresh_days)
    seen = pages.where(fresh).select("appid", "crawl_dt").distinct()
    owners = stage(
        day_owners(seen, settings.refresh_days).where(window.holds("dt")), "owners"
    )
    meets = F.col("last_dt") >= F.lit(window.first)
    if window.last:
        meets &= F.col("first_dt") <= F.lit(window.last)
    rows = _ods_rows(intact_pages(known.open(pages.where(meets))), settings)
    rows = stage(rows.where(window.holds("dt")), "crawled")
    return settle_crawls(rows, settings.refresh_days, owners), owners.select("appid", "dt")


def store_summaries(pages: DataFrame, settings: Settings) -> None:
    """Keep the newest rating summary of each game."""
    spark, name = pages.sparkSession, settings.table("summary")
    found = newest_summaries(intact_pages(pages))
    if spark.catalog.tableExists(name):
        found = newest_by_crawl(found.unionByName(spark.table(name)))
    replace_table(stage(found, "summaries"), name, fmt=settings.table_format)


def store_unreadable(pages: DataFrame, settings: Settings) -> None:
    """Keep the lines that cannot be read, and tell how many there are of each crawl.

    A crawl that is taken in again is looked at again, so lines that are there already are
    not repeated, and the counts are those of the table.
    """
    lines = stage(unreadable_pages(pages), "unreadable")
    if lines.isEmpty():
        return
    name, fmt = settings.table("unreadable"), settings.table_format
    ensure_table(lines.sparkSession, name, lines.schema, fmt=fmt)
    stored = lines.sparkSession.table(name)
    new = join_same(lines.distinct(), stored, lines.columns, "left_anti")
    append_table(stage(new, "unreadable-new"), name, fmt=fmt)
    counts = lines.sparkSession.table(name).groupBy("crawl_dt").agg(F.count("*").alias("pages"))
    replace_table(counts, settings.table("intake"), fmt=fmt)


def load_games(spark: SparkSession, settings: Settings) -> DataFrame | None:
    """Replace the game dimension; gives the appid of games whose price is another now."""
    games = stage(newest_games(read_game_details(spark, settings.game_landing)), "games")
    name = settings.table("game")
    if games.isEmpty():
        return None
    repriced = games.select("appid")
    if spark.catalog.tableExists(name):
        price = ["appid", "price_final_cny"]
        stored = spark.table(name).select(*price)
        repriced = join_same(games.select(*price), stored, price, "left_anti").select("appid")
    repriced = stage(repriced, "repriced")
    if settings.csv_backup:
        written = replace_or_backup(games, name, settings.csv_backup, fmt=settings.table_format)
        if written != "table":
            raise RuntimeError(f"{name} could not be written; its rows are in {settings.csv_backup}")
    else:
        replace_table(games, name, fmt=settings.table_format)
    return repriced


def load_ods(rows: DataFrame, settings: Settings) -> bool:
    """Replace the review table, unless there is nothing to write."""
    written = replace_table(
        rows,
        settings.table("ods_review"),
        partition_by="dt",
        skip_empty=True,
        fmt=settings.table_format,
    )
    return written > 0


def take_crawls(rows: DataFrame, settings: Settings) -> Days:
    """Bring the staged rows of crawls into the review table, one crawl after the other.

    Each crawl refreshes its own day and the ``refresh_days`` before it, for the games that
    it has rows of. Its other rows are added unless their review is stored. Gives the days
    that changed. There are no more crawls and days than the calendar has.
    """
    spark, name = rows.sparkSession, settings.table("ods_review")
    changed: set[dt.date] = set()
    crawls = sorted(
        (row[0] for row in rows.select("crawl_dt").distinct().collect()),
        key=lambda day: day or dt.date.min,
    )
    for crawl in crawls:
        own = rows.where(F.col("crawl_dt").eqNullSafe(F.lit(crawl)))
        own = own.select(*ODS_REVIEW.names, "dt")
        loose = own
        if crawl:
            window = DayWindow.trailing(crawl, settings.refresh_days)
            inside = own.where(window.holds("dt"))
            if refresh_ods(inside, settings, window):
                stored = table_days(spark, name) if settings.table_format == "parquet" else []
                changed |= {day for day in stored if window.includes(day)}
                changed |= set(window.listed())
            loose = own.where(F.coalesce(~window.holds("dt"), F.lit(True)))
        changed |= _add_new(loose, settings)
    return Days(frozenset(changed))


def _add_new(rows: DataFrame, settings: Settings) -> set[dt.date]:
    """Add reviews that are not stored; a review keeps its day, so only its days are read."""
    days = {row[0] for row in rows.select("dt").distinct().collect()}
    if not days:
        return set()
    spark, name = rows.sparkSession, settings.table("ods_review")
    ensure_table(
        spark, name, with_day(ODS_REVIEW), partition_by="dt", fmt=settings.table_format
    )
    dated = Days(frozenset(days - {None}))
    known = spark.table(name).where(dated.holds("dt") | F.col("dt").isNull())
    key = ["appid", "recommendationid"]
    new = join_same(rows, known.select(*key).distinct(), key, "left_anti")
    with overwriting(spark, "dynamic"):
        append_table(stage(new, "loose"), name, fmt=settings.table_format)
    return set(dated.days)


def refresh_ods(
    rows: DataFrame,
    settings: Settings,
    window: DayWindow,
    keys: Sequence[str] = ("appid",),
    settled: DataFrame | None = None,
) -> bool:
    """Replace the window of the games that have new rows, or of other ``keys``.

    ``settled`` has keys that are replaced whether they have rows or not.
    """
    if rows.isEmpty() and (settled is None or settled.isEmpty()):
        return False
    name = settings.table("ods_review")
    ensure_table(
        rows.sparkSession,
        name,
        with_day(ODS_REVIEW),
        partition_by="dt",
        fmt=settings.table_format,
    )
    refresh_window(rows, name, window, keys=keys, settled=settled, fmt=settings.table_format)
    return True


def build_dwd(spark: SparkSession, settings: Settings, window: DayWindow | Days | None) -> None:
    """Clean and label reviews: all of them, or the days of a window.

    A review without a day stays in ODS: the layers above are kept by day.
    """
    ods = spark.table(settings.table("ods_review"))
    if window:
        ods = ods.where(window.holds("dt"))
    label = settings.label or partial(label_by_rules, rules=settings.label_rules)
    ods = ods.where(F.col("dt").isNotNull())
    # A large history is not shuffled for the few duplicates in it; some days are. Both ways
    # give the same rows.
    large = not window and table_bytes(spark, settings.table("ods_review")) > LARGE_HISTORY
    distinct = distinct_wide if large else distinct_rows
    dwd = clean_reviews(ods.select(*ODS_REVIEW.names), settings.required, label, distinct)
    if settings.dedup_keys:
        newest = [F.desc_nulls_last("timestamp_updated"), F.asc("recommendationid")]
        dwd = dedup_latest(dwd, settings.dedup_keys, newest)
    # The day follows from the creation time and is not part of the duplicate test.
    dwd = dwd.select(*DWD_REVIEW.names, created_day("timestamp_created").alias("dt"))
    if settings.quality_rules or settings.known_games_only:
        dwd = _checked(stage(dwd, "dwd"), settings, window)
    _store_days(dwd, settings, "dwd_review", window)


def _checked(dwd: DataFrame, settings: Settings, window: DayWindow | Days | None) -> DataFrame:
    """Rows that break no rule; the others go to quarantine, the counts to the report."""
    parts = []
    if settings.quality_rules:
        rules = {name: F.expr(sql) for name, sql in settings.quality_rules.items()}
        parts.append(check(dwd, rules, by=["dt"]))
        dwd = parts[-1].good
    if settings.known_games_only:
        games = dwd.sparkSession.table(settings.table("game"))
        parts.append(check_references(dwd, games, ["appid"], "known_game", by=["dt"]))
        dwd = parts[-1].good
    quarantine = reduce(DataFrame.unionByName, [part.quarantine for part in parts])
    report = reduce(DataFrame.unionByName, [part.report for part in parts])
    _store_days(quarantine, settings, "quarantine", window)
    # By day, so that a run replaces the counts of its days only.
    report = report.select("rule", "checked_rows", "failed_rows", "dt")
    _store_days(report, settings, "quality", window)
    return dwd


def build_overview(
    spark: SparkSession,
    settings: Settings,
    window: DayWindow | Days | None,
    repriced: DataFrame | None = None,
) -> None:
    """The wide table: all of it, or the days of a window.

    ``repriced`` names games whose price is another now: their rows on other days are
    replaced too, on the days on which they sold and on no others.
    """
    reviews = spark.table(settings.table("dwd_review"))
    game = spark.table(settings.table("game"))
    columns = [*OVERVIEW.names, "dt"]
    inside = reviews.where(window.holds("dt")) if window else reviews
    _store_days(overview(inside, game).select(*columns), settings, "overview", window)
    if window is None or repriced is None or repriced.isEmpty():
        return
    again = purchased(reviews).where(~window.holds("dt"))
    again = join_same(again, repriced, ["appid"], "left_semi")
    rows = stage(overview(again, game).select(*columns), "repriced-rows")
    days = Days(frozenset(row[0] for row in rows.select("dt").distinct().collect()))
    if days.days:
        refresh_window(
            rows,
            settings.table("overview"),
            days,
            keys=["appid"],
            keep_undated=False,
            fmt=settings.table_format,
        )


def build_trend(spark: SparkSession, settings: Settings, window: DayWindow | Days | None) -> None:
    reviews = spark.table(settings.table("dwd_review"))
    if window:
        reviews = reviews.where(window.holds("dt"))
    _store_days(trend_1d(reviews).select(*TREND.names, "dt"), settings, "trend", window)
    if settings.buyer_sketches:
        sketches = buyer_sketches(reviews).select("appid", "buyers", "sketch", "dt")
        _store_days(sketches, settings, "buyers", window)


def build_gmv(spark: SparkSession, settings: Settings) -> None:
    """Daily GMV of the whole history at the current prices.

    It is computed from the daily sales counts of the trend table, so that a price change
    does not make every review be read again.
    """
    name = settings.table("gmv")
    ensure_table(spark, name, GMV, comments=GMV_COMMENTS, fmt=settings.table_format)
    overwrite_from_sql(
        spark,
        f"""
        INSERT OVERWRITE TABLE {name}
        WITH sold AS (
            SELECT t.appid, t.dt, t.sales,
                   t.sales * CAST(g.price_final_cny AS DECIMAL(18, 4))
                           * CAST({settings.price_scale} AS DECIMAL(16, 10)) AS amount
            FROM {settings.table("trend")} t
            JOIN {settings.table("game")} g ON t.appid = g.appid
            WHERE t.sales > 0
        )
        SELECT CAST(appid AS STRING), CAST(dt AS STRING),
               CAST(SUM(amount) AS DECIMAL(18, 4)), SUM(sales)
        FROM sold
        GROUP BY appid, dt
        """,
        partitioned=False,
    )


def build_boards(spark: SparkSession, settings: Settings, as_of: dt.date | None) -> None:
    """Rankings and growth for the dashboard, as of a day or else of the newest one."""
    gmv = spark.table(settings.table("gmv"))
    trend = spark.table(settings.table("trend"))
    if as_of is None:
        as_of = trend.agg(F.max("dt")).first()[0]
        if as_of is None:
            return
    totals = recent_totals(gmv, as_of, settings.rank_days)
    boards: dict[str, Callable[[], DataFrame]] = {
        "sales_rank": lambda: sales_rank(totals),
        "gmv_rank": lambda: gmv_rank(totals),
        "rate_rank": lambda: positive_rate_rank(trend, settings.min_reviews),
        "growth": lambda: gmv_growth(gmv),
    }

    def build(role: str) -> None:
        replace_table(boards[role](), settings.table(role), fmt=settings.table_format)

    in_turn(*[partial(build, role) for role in boards])


def build_history(
    spark: SparkSession, settings: Settings, window: DayWindow | Days | None
) -> None:
    """The rankings of every day: of all days, or of those that days of a window count for."""
    if not settings.rank_history:
        return
    gmv = spark.table(settings.table("gmv"))
    days = None
    if window is not None:
        after = range(settings.rank_days)
        days = Days(frozenset(day + dt.timedelta(n) for day in window.listed() for n in after))
    history = rank_history(gmv, settings.rank_days, only=days)
    columns = [c for c in history.columns if c != "dt"]
    _store_days(history.select(*columns, "dt"), settings, "history", days)


def in_turn(*steps: Callable[[], object]) -> None:
    """Run steps that do not depend on each other, one after the other.

    The tasks of one step fill the cluster; steps side by side would only make the driver hold
    the plans, the generated code and the threads of all of them at once. A step that fails does
    not keep the others from running; the first error is raised when all are over.
    """
    errors = []
    for step in steps:
        try:
            step()
        except Exception as error:  # raised below
            errors.append(error)
    if errors:
        raise errors[0]


def _store_days(
    rows: DataFrame, settings: Settings, role: str, window: DayWindow | Days | None
) -> None:
    name = settings.table(role)
    if window is None:
        replace_table(rows, name, partition_by="dt", fmt=settings.table_format)
        return
    ensure_table(
        rows.sparkSession, name, rows.schema, partition_by="dt", fmt=settings.table_format
    )
    refresh_window(rows, name, window, keep_undated=False, fmt=settings.table_format)
