"""All queries of the library itself."""

from __future__ import annotations

from . import aggregate_queries, audit_queries, geometry_queries, join_queries, name_queries, page_queries, record_queries, sequence_queries, source_queries, workflow_queries  # noqa: F401  each registers its queries
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
