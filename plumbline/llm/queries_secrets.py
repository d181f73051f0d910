"""The secret scan query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .secrets import digests, found_spans


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(found_spans(table(spark, sf_dir, "documents")))


QUERIES = {"op8_secret_scan": op8_secret_scan}
ORACLE_SQL: dict[str, str] = {}
