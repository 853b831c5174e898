"""Every operator of this package as a query over the given tables."""

from __future__ import annotations

from millrace.llm import model_queries, native_queries, search_queries, text_queries  # noqa: F401
from millrace.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
