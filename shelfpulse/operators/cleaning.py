"""ODS reviews to DWD reviews."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame

from shelfpulse.functions.labels import label_by_rules
from shelfpulse.functions.text import clean_text
from shelfpulse.operators.rows import distinct_rows, drop_nulls
from shelfpulse.settings import REQUIRED_REVIEW_COLUMNS


def add_clean_content(df: DataFrame, source: str = "review") -> DataFrame:
    return df.withColumn("clean_content", clean_text(source))


def classify(
    df: DataFrame,
    label: Callable[[Column | str], Column] = label_by_rules,
    text: str = "clean_content",
) -> DataFrame:
    """Add ``category``; ``label`` is the rule expression or a wrapped batch model."""
    return df.withColumn("category", label(text))


def clean_reviews(
    ods: DataFrame,
    required: Sequence[str] | None = REQUIRED_REVIEW_COLUMNS,
    label: Callable[[Column | str], Column] = label_by_rules,
    distinct: Callable[[DataFrame], DataFrame] = distinct_rows,
) -> DataFrame:
    """Collapse duplicates, clean, drop incomplete rows, label.

    The clean text follows from the raw one, so it is added after the shuffle of the
    duplicate test and not carried through it. ``required=None`` asks for a value in
    every column. ``distinct`` is the way to collapse duplicates.
    """
    whole = drop_nulls(add_clean_content(distinct(ods)), required)
    return classify(whole, label)
