"""Every operator as a query over the given tables."""

from acreline.queries import boosting, invariants, learned, reports, rows, splits  # noqa: F401
from acreline.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
