"""Everything that brings data in."""

from shelfpulse.sources.landing import (
    intact_pages,
    read_game_details,
    read_review_pages,
    read_seed,
    unreadable_pages,
)
from shelfpulse.sources.tables import from_rows, read_table, read_window

__all__ = [
    "from_rows",
    "intact_pages",
    "read_game_details",
    "read_review_pages",
    "read_seed",
    "read_table",
    "read_window",
    "unreadable_pages",
]
