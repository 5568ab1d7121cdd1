"""Incremental intake."""

from shelfpulse.streaming.ingest import ingest_new, mark_landed
from shelfpulse.streaming.manifest import Manifest

__all__ = ["Manifest", "ingest_new", "mark_landed"]
