"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the separator of list columns in the game dimension.
LIST_SEPARATOR = "、"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def clean_text(column: Column | str) -> Column:
    """Runs of anything but letters and digits become one blank; ends are trimmed.

    Letters and digits are meant in the Unicode sense, so Chinese text survives. Java's
    ``\\W`` is ASCII-only and would delete it. Null stays null.
    """
    return F.trim(F.regexp_replace(_col(column), r"[^\p{L}\p{N}]+", " "))


def join_list(column: Column | str, sep: str = LIST_SEPARATOR) -> Column:
    """Array of strings to one string; a missing list gives the empty string."""
    return F.coalesce(F.array_join(_col(column), sep), F.lit(""))


def join_field(column: Column | str, field: str, sep: str = LIST_SEPARATOR) -> Column:
    """One field of an array of structs, joined. A missing field keeps its separator."""
    values = F.transform(_col(column), lambda item: F.coalesce(item[field], F.lit("")))
    return F.coalesce(F.array_join(values, sep), F.lit(""))


def enabled_keys(column: Column | str, sep: str = LIST_SEPARATOR) -> Column:
    """Keys of a map of flags whose flag is true, in the order of the input."""
    enabled = F.map_filter(_col(column), lambda _, flag: F.coalesce(flag, F.lit(False)))
    return F.coalesce(F.array_join(F.map_keys(enabled), sep), F.lit(""))
