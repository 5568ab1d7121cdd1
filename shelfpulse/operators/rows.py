"""Filters, defaults, schema conformity, previews and duplicates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfpulse.operators.bloom import MOST_WORDS, bloom_filter, may_hold, words_for
from shelfpulse.scratch import stage

SECONDS_PER_DAY = 86_400


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill missing values; an absent field and an explicit null both count as missing."""
    return df.withColumns(
        {name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()}
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns, bound by name.

    Missing columns become null, extra ones go, values that do not fit become null.
    """
    have = dict(zip(df.columns, df.schema.fields, strict=True))

    def fit(field: T.StructField) -> Column:
        if field.name not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if have[field.name].dataType == field.dataType:
            return F.col(field.name)
        return F.col(field.name).try_cast(field.dataType).alias(field.name)

    return df.select(*[fit(field) for field in schema.fields])


def successful(df: DataFrame, flag: str = "success") -> DataFrame:
    """Rows whose flag is true; a missing flag counts as false."""
    return df.where(F.coalesce(F.col(flag).cast("boolean"), F.lit(False)))


def within(
    df: DataFrame, as_of: dt.datetime | dt.date | str, days: int, seconds: str = "timestamp_created"
) -> DataFrame:
    """Drop rows created more than ``days`` days before ``as_of``.

    Rows without a time (null or 0) pass; ``days <= 0`` switches the filter off. ``as_of``
    is read in the session time zone.
    """
    if days <= 0:
        return df
    cutoff = F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.lit(days * SECONDS_PER_DAY)
    stamp = F.col(seconds)
    return df.where(stamp.isNull() | (stamp == 0) | (stamp >= cutoff))


def purchased(df: DataFrame, flag: str = "bought") -> DataFrame:
    return df.where(F.col(flag))


def discounted(df: DataFrame, percent: str = "discount_percent") -> DataFrame:
    return df.where(F.col(percent) > 0)


def split_votes(df: DataFrame, vote: str = "voted_up") -> tuple[DataFrame, DataFrame]:
    """Positive and negative reviews; rows without a vote are in neither."""
    return df.where(F.col(vote)), df.where(~F.col(vote))


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows with a value in every named column (all columns if none are named).

    NaN counts as missing in floating point columns.
    """
    return df.dropna(how="any", subset=list(subset) if subset is not None else None)


def remaining(df: DataFrame, deleted: Column) -> DataFrame:
    """What a DELETE with this condition leaves; an unknown condition deletes nothing."""
    return df.where(~F.coalesce(deleted, F.lit(False)))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Exact duplicates over all columns collapse; nulls compare equal."""
    return df.distinct()


def distinct_wide(df: DataFrame, most_words: int = MOST_WORDS) -> DataFrame:
    """``distinct_rows`` for tables of wide rows with few duplicates.

    A 128-bit digest of each row is counted on narrow rows. The digests that repeat make a
    Bloom filter of at most ``most_words`` words, which every row is tested against where it
    is. Rows that it does not know are unique and go straight through; the others are shuffled
    whole and compared. More repeats than the filter is made for let unique rows be shuffled
    too, and change nothing else.

    ``df`` is read three times, for the digests and for the rows on either side, so that no
    wide row is shuffled without need. Maps have no digest; such tables are shuffled whole.
    """
    if any(_has_map(field.dataType) for field in df.schema.fields):
        return distinct_rows(df)
    columns = [F.col(f"`{name}`") for name in df.columns]
    hashed = F.xxhash64(*columns)
    digests = df.select(hashed.alias("h"), F.xxhash64(F.lit(1), *columns).alias("g"))
    repeated = digests.groupBy("h", "g").agg(F.count("*").alias("copies")).where("copies > 1")
    repeated = stage(repeated.select("h"), "repeated")
    words = words_for(repeated.count(), most_words)
    suspect = may_hold(bloom_filter(repeated, words), hashed, words)
    return df.where(~suspect).unionByName(distinct_rows(df.where(suspect)))


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(field.dataType) for field in kind.fields)
    return isinstance(kind, T.MapType | T.VariantType)


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key under a total ``order``.

    The group limit runs before the shuffle, so a key with very many copies sends at
    most one row per input partition.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(ranked)).where("_row = 1").drop("_row")


def cap_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    limit: int,
    *,
    spread_by: Sequence[str],
    spread: int = 64,
) -> DataFrame:
    """The first ``limit`` rows per key.

    A hot key is cut in ``spread`` slices first; the first rows of the key are among the
    first rows of its slices, so the last step sees at most ``spread * limit`` rows of it.
    """
    slices = Window.partitionBy(*keys, "_slice").orderBy(*order)
    whole = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_slice", F.pmod(F.xxhash64(*spread_by), F.lit(spread)))
        .withColumn("_row", F.row_number().over(slices))
        .where(F.col("_row") <= limit)
        .withColumn("_row", F.row_number().over(whole))
        .where(F.col("_row") <= limit)
        .drop("_slice", "_row")
    )


def preview(
    df: DataFrame, n: int, columns: Sequence[str] | None = None, order: Sequence[Column | str] = ()
) -> DataFrame:
    """A few rows to look at; arbitrary ones unless ``order`` is given."""
    chosen = df.orderBy(*order) if order else df
    return (chosen.select(*columns) if columns else chosen).limit(n)


def accumulate(first: DataFrame, *more: DataFrame) -> DataFrame:
    """Batches put together, columns matched by name."""
    for batch in more:
        first = first.unionByName(batch)
    return first
