"""Named queries over the driver tables and their DuckDB oracles."""

from keyflow.plans.catalog import QUERIES, STREAMING_QUERIES
from keyflow.plans.oracle import ORACLE_SQL

__all__ = ["QUERIES", "STREAMING_QUERIES", "ORACLE_SQL"]
