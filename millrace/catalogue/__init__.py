"""Every operator and model as a named query over the given tables, with its oracle SQL."""

from millrace.catalogue import incremental, models, rows, scans, semantics, tables  # noqa: F401
from millrace.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
