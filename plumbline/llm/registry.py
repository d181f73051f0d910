"""All queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from . import queries_benchmark, queries_dedup, queries_models, queries_secrets, queries_tokens, queries_vectors, queries_web

_MODULES = [queries_web, queries_vectors, queries_models, queries_dedup, queries_benchmark, queries_secrets, queries_tokens]

QUERIES = {name: q for m in _MODULES for name, q in m.QUERIES.items()}
ORACLE_SQL = {name: q for m in _MODULES for name, q in m.ORACLE_SQL.items()}
