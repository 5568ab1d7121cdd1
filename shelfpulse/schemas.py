"""Declared schemas of landing payloads and tables.

Column names, their order and their types are fixed values.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import types as T

STRING, LONG, INT = T.StringType(), T.LongType(), T.IntegerType()
DOUBLE, BOOLEAN, DATE = T.DoubleType(), T.BooleanType(), T.DateType()
MONEY = T.DecimalType(18, 4)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def as_landed(schema: T.StructType, keys: Mapping[str, str]) -> T.StructType:
    """The same fields under the keys of the payload, where these differ."""
    return T.StructType(
        [
            T.StructField(
                keys.get(f.name, f.name),
                as_landed(f.dataType, keys) if isinstance(f.dataType, T.StructType) else f.dataType,
            )
            for f in schema.fields
        ]
    )


# Counts arrive as 64-bit so that one oversized value cannot void its whole page; the
# table schema narrows them.
AUTHOR = struct(
    id=STRING,
    num_games_owned=LONG,
    num_reviews=LONG,
    playtime_forever=LONG,
    playtime_last_two_weeks=LONG,
    playtime_at_review=LONG,
    deck_playtime_at_review=DOUBLE,
    last_played=LONG,
)

REVIEW = struct(
    recommendationid=STRING,
    review=STRING,
    language=STRING,
    timestamp_created=LONG,
    timestamp_updated=LONG,
    voted_up=BOOLEAN,
    votes_up=LONG,
    votes_funny=LONG,
    weighted_vote_score=STRING,
    comment_count=LONG,
    author=AUTHOR,
    bought=BOOLEAN,
    received_for_free=BOOLEAN,
    written_during_early_access=BOOLEAN,
    on_handheld=BOOLEAN,
    developer_response=STRING,
    timestamp_dev_responded=LONG,
)

QUERY_SUMMARY = struct(
    review_score_desc=STRING,
    total_positive=LONG,
    total_negative=LONG,
    total_reviews=LONG,
)

CORRUPT = "_corrupt"


def review_page(keys: Mapping[str, str] | None = None) -> T.StructType:
    """One landed response. ``crawl_dt``, ``appid`` and ``page`` come from fields of the line
    or from key=value folders of the landing zone.

    ``keys`` names the keys of the payload that are not the names of our columns.
    """
    return struct(
        crawl_dt=DATE,
        appid=LONG,
        page=INT,
        success=INT,
        cursor=STRING,
        query_summary=QUERY_SUMMARY,
        reviews=T.ArrayType(as_landed(REVIEW, keys or {})),
        **{CORRUPT: STRING},
    )


# What is known of the pages in a landed file without opening it: the cursor that a page
# gives, its number of reviews, and their first and last day. ``refetched_dt`` is the last
# day that is not after the crawl.
PAGE_ENTRY = struct(
    file=STRING,
    modified=T.TimestampType(),
    appid=LONG,
    page=INT,
    readable=BOOLEAN,
    cursor=STRING,
    n_reviews=INT,
    first_dt=DATE,
    last_dt=DATE,
    refetched_dt=DATE,
    crawl_dt=DATE,
)

GAME_DATA = struct(
    name=STRING,
    developers=T.ArrayType(STRING),
    publishers=T.ArrayType(STRING),
    release_date=struct(date=STRING, coming_soon=BOOLEAN),
    price_overview=struct(initial=LONG, final=LONG, discount_percent=LONG),
    genres=T.ArrayType(struct(description=STRING)),
    platforms=T.MapType(STRING, BOOLEAN),
    short_description=STRING,
)

GAME_DETAIL = T.MapType(STRING, struct(success=BOOLEAN, data=GAME_DATA))

ODS_REVIEW = struct(
    appid=LONG,
    recommendationid=STRING,
    review=STRING,
    language=STRING,
    timestamp_created=LONG,
    timestamp_updated=LONG,
    voted_up=BOOLEAN,
    votes_up=INT,
    votes_funny=INT,
    weighted_vote_score=DOUBLE,
    comment_count=INT,
    author_id=STRING,
    author_num_games_owned=INT,
    author_num_reviews=INT,
    author_playtime_forever=INT,
    author_playtime_last_two_weeks=INT,
    author_playtime_at_review=INT,
    author_deck_playtime_at_review=DOUBLE,
    author_last_played=LONG,
    bought=BOOLEAN,
    received_for_free=BOOLEAN,
    written_during_early_access=BOOLEAN,
    on_handheld=BOOLEAN,
    developer_response=STRING,
    timestamp_dev_responded=LONG,
    created_date=STRING,
    updated_date=STRING,
)

GAME = struct(
    appid=LONG,
    name=STRING,
    developers=STRING,
    publishers=STRING,
    release_date=STRING,
    coming_soon=BOOLEAN,
    price_initial_cny=LONG,
    price_final_cny=LONG,
    discount_percent=LONG,
    genres=STRING,
    platforms=STRING,
    short_description=STRING,
)

DWD_REVIEW = T.StructType(ODS_REVIEW.fields + struct(clean_content=STRING, category=STRING).fields)

OVERVIEW = T.StructType(DWD_REVIEW.fields + struct(price_final_cny=LONG).fields)

GMV = struct(appid=STRING, dt=STRING, gmv=MONEY, add_review_num=LONG)

GMV_COMMENTS = {
    "appid": "game, as text",
    "dt": "day of the reviews, as text",
    "gmv": "purchased reviews of the day times the current price",
    "add_review_num": "purchased reviews of the day",
}

TREND = struct(
    appid=LONG,
    sales=LONG,
    buyers=LONG,
    review_count=LONG,
    positive_count=LONG,
    positive_rate=DOUBLE,
    sales_rank=LONG,
)


def with_day(schema: T.StructType) -> T.StructType:
    """The stored form of a day-partitioned table: the partition column comes last."""
    return T.StructType([f for f in schema.fields if f.name != "dt"] + [T.StructField("dt", DATE)])
