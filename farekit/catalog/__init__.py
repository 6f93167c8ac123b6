"""Every operator as a named query over the test tables."""

from farekit.catalog import aggregates, joins, models, projections, requests, scalars, scans  # noqa: F401
from farekit.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
