"""The nearest-neighbour query."""

from __future__ import annotations

from .ann import op2_nearest

QUERIES = {"op2_nearest": op2_nearest}
ORACLE_SQL: dict[str, str] = {}
