"""Epoch seconds, day text and day windows."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed value: layout of created_date and updated_date.
TEXT_TIME = "yyyy-MM-dd HH:mm:ss"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


# Seconds of the years 1 to 9999; what lies beyond is no date of a review.
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def _instant(seconds: Column | str) -> Column:
    given = _col(seconds)
    return F.timestamp_seconds(
        F.when((given != 0) & given.between(FIRST_SECOND, LAST_SECOND), given)
    )


def epoch_to_text(seconds: Column | str) -> Column:
    """Epoch seconds as text in the session time zone; null, 0 and what is no date give null."""
    return F.date_format(_instant(seconds), TEXT_TIME)


def created_day(seconds: Column | str) -> Column:
    """Day of an epoch in the session time zone; null, 0 and what is no date give null."""
    return F.to_date(_instant(seconds))


def day_of(text: Column | str) -> Column:
    """Day of a date-time text, from its first ten characters; malformed text gives null."""
    return F.try_to_date(F.left(_col(text), F.lit(10)), "yyyy-MM-dd")


def age_days(day: Column | str, as_of: dt.date | str) -> Column:
    """Whole days from ``day`` to ``as_of``; negative for the future."""
    return F.datediff(F.lit(as_of).cast("date"), _col(day))


def to_day(day: dt.date | str) -> dt.date:
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(day)


def today(spark: SparkSession) -> dt.date:
    """The current day in the session time zone."""
    return spark.sql("SELECT current_date()").first()[0]


@dataclass(frozen=True)
class DayWindow:
    """Closed range of days; an open end includes the future."""

    first: dt.date
    last: dt.date | None

    @classmethod
    def trailing(
        cls, as_of: dt.date | str, days: int, *, include_future: bool = False
    ) -> DayWindow:
        """``as_of`` and the ``days`` days before it, ``days + 1`` in all."""
        end = to_day(as_of)
        return cls(end - dt.timedelta(days=days), None if include_future else end)

    @classmethod
    def between(cls, first: dt.date | str, last: dt.date | str) -> DayWindow:
        return cls(to_day(first), to_day(last))

    def holds(self, day: Column | str) -> Column:
        """Range predicate on a plain column, so that it prunes partitions."""
        column = _col(day)
        lower = column >= F.lit(self.first)
        return lower if self.last is None else lower & (column <= F.lit(self.last))

    def listed(self) -> list[dt.date]:
        """All days of a window with an end."""
        if self.last is None:
            raise ValueError("the window has no end")
        return [self.first + dt.timedelta(n) for n in range((self.last - self.first).days + 1)]

    def includes(self, day: dt.date) -> bool:
        return self.first <= day and (self.last is None or day <= self.last)


@dataclass(frozen=True)
class Days:
    """Single days, which need not follow each other; no more than the calendar has."""

    days: frozenset[dt.date]

    def holds(self, day: Column | str) -> Column:
        """A list of values, so that it prunes partitions."""
        return _col(day).isin(sorted(self.days)) if self.days else F.lit(False)

    def listed(self) -> list[dt.date]:
        return sorted(self.days)

    def includes(self, day: dt.date) -> bool:
        return day in self.days
