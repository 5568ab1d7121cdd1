"""Review and sales analytics for digital shelves, written as Spark DataFrame jobs."""

from shelfpulse.session import build_session
from shelfpulse.settings import Settings

__all__ = ["Settings", "build_session"]
