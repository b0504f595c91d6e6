"""The registered queries: each a Spark query and, where SQL can say it, its DuckDB twin."""

from tripflow.catalog import analytics, ingest, staging, streams
from tripflow.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "analytics", "ingest", "staging", "streams"]
