"""Every operator as a query over the test tables, next to its SQL."""

from tallywell.catalog import alerts, checks, monitoring, quality, rankings, revenue, sinks, sources
from tallywell.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "alerts", "checks", "monitoring", "quality", "rankings", "revenue", "sinks", "sources"]
