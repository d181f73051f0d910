"""Queries of the trained classifiers."""

from __future__ import annotations

from .langid import op4_language_id
from .quality import op9_quality
from .toxicity import op3_toxicity

QUERIES = {"op3_toxicity": op3_toxicity, "op4_language_id": op4_language_id, "op9_quality": op9_quality}
ORACLE_SQL: dict[str, str] = {}
