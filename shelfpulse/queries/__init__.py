"""Queries over the test tables, each with the SQL that must give the same rows."""

from shelfpulse.queries import boards, landing, metrics, rows, runs, tables  # noqa: F401
from shelfpulse.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
