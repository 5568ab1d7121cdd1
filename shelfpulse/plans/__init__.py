"""Layers put together: first load, daily run, backfill."""

from shelfpulse.plans.runs import backfill, run_daily, run_full

__all__ = ["backfill", "run_daily", "run_full"]
