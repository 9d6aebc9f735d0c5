"""Queries over the driver's tables: each domain view is derived from them inside the query."""

from avmatch.plans import page_queries, scalar_queries, table_queries  # noqa: F401
from avmatch.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
