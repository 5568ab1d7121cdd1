"""Operators for preparing training corpora, and their registered queries.

Nothing outside this package imports it; ``__spark_entry__`` adds ``LLM_QUERIES`` when it
is there.
"""

from shelfpulse.llm.registry import LLM_ORACLES, LLM_QUERIES

__all__ = ["LLM_ORACLES", "LLM_QUERIES"]
