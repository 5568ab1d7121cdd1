"""Review pages and game details to ODS rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfpulse.functions.dates import created_day, epoch_to_text
from shelfpulse.functions.text import enabled_keys, join_field, join_list
from shelfpulse.operators.joins import join_same
from shelfpulse.operators.rows import conform, successful, with_defaults
from shelfpulse.schemas import AUTHOR, GAME, ODS_REVIEW, PAGE_ENTRY, REVIEW
from shelfpulse.sources.landing import readable_page

# What a missing review field means; other fields stay null.
REVIEW_DEFAULTS = {
    "review": "",
    "voted_up": False,
    "votes_up": 0,
    "votes_funny": 0,
    "comment_count": 0,
    "bought": False,
    "received_for_free": False,
    "written_during_early_access": False,
    "on_handheld": False,
}

# The cursor of the first request and the summary of an unrated game.
FIRST_CURSOR = "*"
SUMMARY_DEFAULTS = {
    "review_score_desc": "N/A",
    "total_positive": 0,
    "total_negative": 0,
    "total_reviews": 0,
}


def page_entries(pages: DataFrame) -> DataFrame:
    """What the manifest keeps of landed pages: an entry for each page of a file.

    ``pages`` carry the file they come from. A line that cannot be read gives an entry that
    is not ``readable``. A page that is there twice in a file is one entry.
    """
    readable = readable_page(pages)
    # Only the times of the reviews are read, not their texts.
    times = F.col("reviews.timestamp_created")
    days = F.when(readable, F.transform(times, created_day))
    lines = pages.select(
        "file",
        "modified",
        "crawl_dt",
        "appid",
        "page",
        readable.alias("readable"),
        F.when(readable, F.coalesce("cursor", F.lit(FIRST_CURSOR))).alias("cursor"),
        F.when(readable, F.coalesce(F.size(times), F.lit(0))).alias("n_reviews"),
        days.alias("days"),
    )
    refetched = F.filter("days", lambda day: day <= F.col("crawl_dt"))
    return conform(
        lines.groupBy("file", "modified", "crawl_dt", "appid", "page").agg(
            F.bool_or("readable").alias("readable"),
            F.max("cursor").alias("cursor"),
            F.max("n_reviews").alias("n_reviews"),
            F.min(F.array_min("days")).alias("first_dt"),
            F.max(F.array_max("days")).alias("last_dt"),
            F.max(F.array_max(refetched)).alias("refetched_dt"),
        ),
        PAGE_ENTRY,
    )


def valid_pages(
    pages: DataFrame, keys: Sequence[str] = ("appid",), *, block: int = 1024
) -> DataFrame:
    """Pages up to the end of the listing of each game.

    A listing ends before its first empty page, and with its first page whose cursor is
    the one it was requested with. The end is found on narrow rows in two steps, within
    blocks of consecutive pages and then across blocks, so that no task has to order all
    pages of a large game. The wide pages are only filtered. A column ``n_reviews``, if
    there is one, spares the reading of the review lists. A page without a number has no
    place in the listing and is kept if it has reviews.
    """
    keys = list(keys)
    slot = [*keys, "_slot"]
    count = F.col("n_reviews") if "n_reviews" in pages.columns else F.size("reviews")
    empty = F.coalesce(count, F.lit(0)) <= 0
    steps = (
        pages.where(F.col("page").isNotNull())
        .select(
            *keys,
            "page",
            F.floor(F.col("page") / block).alias("_slot"),
            F.coalesce("cursor", F.lit(FIRST_CURSOR)).alias("_next"),
            empty.alias("_empty"),
        )
        # A page that was landed twice is one step of the listing.
        .groupBy(*slot, "page")
        .agg(F.max("_next").alias("_next"), F.bool_and("_empty").alias("_empty"))
        .withColumn("_asked", F.lag("_next").over(Window.partitionBy(*slot).orderBy("page")))
    )
    ends = F.when(F.col("_empty") | (F.col("_next") == F.col("_asked")), F.col("page"))
    blocks = steps.groupBy(*slot).agg(
        F.min("page").alias("_first"),
        F.min_by("_next", "page").alias("_first_next"),
        F.max_by("_next", "page").alias("_last_next"),
        F.min(ends).alias("_inner_end"),
    )
    across = Window.partitionBy(*keys).orderBy("_slot")
    asked = F.lag("_last_next", 1, FIRST_CURSOR).over(across)
    listing_ends = (
        blocks.withColumn("_asked", asked)
        .withColumn(
            "_end",
            F.when(F.col("_first_next") == F.col("_asked"), F.col("_first")).otherwise(
                F.col("_inner_end")
            ),
        )
        .groupBy(*keys)
        .agg(F.min("_end").alias("_end"))
    )
    beyond = F.coalesce(F.col("page") > F.col("_end"), F.lit(False))
    return join_same(pages, listing_ends, keys, "left").where(~empty & ~beyond).drop("_end")


def flatten_reviews(
    pages: DataFrame, carry: Sequence[str] = (), keys: Mapping[str, str] | None = None
) -> DataFrame:
    """One ODS row per review, plus its day ``dt`` and its place (``page``, ``pos``).

    Author fields move up with a prefix, missing fields take their defaults, times get a
    readable form. Columns in ``carry`` come along from the page. ``keys`` names keys of
    the payload that are not our column names.
    """
    keys = keys or {}
    items = pages.select(*carry, "appid", "page", F.posexplode("reviews").alias("pos", "item"))
    flat = items.select(
        *carry,
        "appid",
        "page",
        "pos",
        *[
            F.col(f"item.{keys.get(name, name)}").alias(name)
            for name in REVIEW.names
            if name != "author"
        ],
        *[
            F.col(f"item.author.{keys.get(name, name)}").alias(f"author_{name}")
            for name in AUTHOR.names
        ],
    )
    filled = with_defaults(flat, REVIEW_DEFAULTS).withColumns(
        {
            "created_date": epoch_to_text("timestamp_created"),
            "updated_date": epoch_to_text("timestamp_updated"),
            "appid": F.col("appid").try_cast("bigint"),
        }
    )
    ods = ODS_REVIEW.names
    place = [*carry, "page", "pos", created_day("timestamp_created").alias("dt")]
    typed = filled.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in ODS_REVIEW.fields], *place
    )
    return typed.select(*ods, *carry, "page", "pos", "dt")


def flatten_games(details: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Game dimension rows from successful detail responses; ``carry`` comes along."""
    carried = [details.schema[name] for name in carry]
    flat = successful(details).select(
        *carry,
        F.col("appid"),
        F.col("data.name").alias("name"),
        join_list("data.developers").alias("developers"),
        join_list("data.publishers").alias("publishers"),
        F.col("data.release_date.date").alias("release_date"),
        F.col("data.release_date.coming_soon").alias("coming_soon"),
        F.col("data.price_overview.initial").alias("price_initial_cny"),
        F.col("data.price_overview.final").alias("price_final_cny"),
        F.col("data.price_overview.discount_percent").alias("discount_percent"),
        join_field("data.genres", "description").alias("genres"),
        enabled_keys("data.platforms").alias("platforms"),
        F.coalesce("data.short_description", F.lit("")).alias("short_description"),
    )
    return conform(flat, T.StructType([*GAME.fields, *carried]))


def newest_games(details: DataFrame) -> DataFrame:
    """One row per game: its newest successful listing over all crawls.

    Without crawls, or within one, a listing with a price is newer than one without. Price
    columns come from the newest listing that has a price, so that none never replaces one.
    A total order of the columns decides between the rest. Rows meet in partial aggregates,
    so a game that is listed very often is no large group.
    """
    listed = details.where(F.col("appid").isNotNull())
    if "crawl_dt" not in details.columns:
        listed = listed.withColumn("crawl_dt", F.lit(None).cast("date"))
    listed = listed.withColumn("_crawl", F.col("crawl_dt").try_cast("date"))
    flat = flatten_games(listed, carry=["_crawl"])
    price = ["price_initial_cny", "price_final_cny", "discount_percent"]
    order = F.struct("_crawl", F.col("price_final_cny").isNotNull(), *GAME.names)
    priced = F.when(F.col("price_final_cny").isNotNull(), order)
    newest = flat.groupBy("appid").agg(
        F.max_by(F.struct(*GAME.names), order).alias("g"),
        F.max_by(F.struct(*price), priced).alias("p"),
    )
    return newest.select(
        *[F.col(f"p.{c}").alias(c) if c in price else F.col(f"g.{c}").alias(c) for c in GAME.names]
    )


def day_owners(seen: DataFrame, refresh_days: int) -> DataFrame:
    """The crawl that a day of a game belongs to: appid, dt, _owner.

    ``seen`` has a row for each crawl that holds reviews of a game of the days that it
    refetches, its own and the ``refresh_days`` before it. Of these crawls the last one owns
    each of these days, with or without reviews.
    """
    days = F.explode(F.sequence(F.date_sub("crawl_dt", refresh_days), "crawl_dt")).alias("dt")
    return (
        seen.select("appid", "crawl_dt", days)
        .groupBy("appid", "dt")
        .agg(F.max("crawl_dt").alias("_owner"))
    )


def settle_crawls(
    rows: DataFrame, refresh_days: int, owners: DataFrame | None = None
) -> DataFrame:
    """Rows of several crawls as if each had been taken in on its day.

    A day of a game has the rows of the crawl that owns it (``day_owners``). Any other row
    counts if its review is not there yet: of several crawls the first one's, unless an owner
    came after it. Owners and repeats are found on narrow rows; the wide ones are only
    filtered. Where ``rows`` are some of the crawled rows only, ``owners`` come from all.
    """
    own = F.coalesce(
        F.col("dt").between(F.date_sub("crawl_dt", refresh_days), F.col("crawl_dt")), F.lit(False)
    )
    rows = rows.withColumn("_own", own)
    if owners is None:
        seen = rows.where("_own").select("appid", "crawl_dt").distinct()
        owners = day_owners(seen, refresh_days)
    met = join_same(rows, owners, ["appid", "dt"], "left")
    owned = met.where("_own AND crawl_dt = _owner")
    after_owner = F.coalesce(F.col("crawl_dt") > F.col("_owner"), F.col("_owner").isNull())
    loose = met.where(~F.col("_own") & after_owner)
    key = ["appid", "recommendationid"]
    crawl = F.coalesce("crawl_dt", F.lit("0001-01-01").cast("date"))
    loose = loose.withColumn("_crawl", crawl)
    first = loose.groupBy(*key).agg(F.min("_crawl").alias("_first"))
    loose = join_same(loose, first, key).where("_crawl = _first")
    loose = join_same(loose, owned.select(*key).distinct(), key, "left_anti")
    columns = [c for c in rows.columns if c != "_own"]
    return owned.select(*columns).unionByName(loose.select(*columns))


def newest_summaries(pages: DataFrame) -> DataFrame:
    """appid, the rating summary of its newest crawl, and that crawl's day."""
    carried = pages.where(F.col("query_summary").isNotNull())
    return newest_by_crawl(query_summary(carried, ["crawl_dt"]))


def newest_by_crawl(summaries: DataFrame) -> DataFrame:
    """One row per game; a summary without a crawl day is the oldest."""
    names = [c for c in summaries.columns if c != "appid"]
    order = F.struct(F.coalesce("crawl_dt", F.lit("0001-01-01").cast("date")), *names)
    newest = summaries.groupBy("appid").agg(F.max_by(F.struct(*names), order).alias("s"))
    return newest.select("appid", *[F.col(f"s.{c}").alias(c) for c in names])


def query_summary(pages: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The rating summary on the first page of each game; ``carry`` comes along."""
    firsts = pages.where((F.col("page") == 1) & (F.col("success") == 1))
    summary = [f"query_summary.{name}" for name in SUMMARY_DEFAULTS]
    flat = firsts.select("appid", *summary, *carry)
    return with_defaults(flat, SUMMARY_DEFAULTS)
