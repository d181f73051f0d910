"""Bounded samples of labelled documents, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored

#: Labelled rows that a classifier is fitted on at most: those with the least hashes of their ids.
SAMPLE_ROWS = 20_000


def sample(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str, learn: Column, key: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """(key, text, y, part) of at most `rows` labelled documents that `learn` (over key) admits.

    An id's label is the larger of repeated ones; null ids and labels are left out. The ids are broadcast: at most
    `rows` of them. Of rows that repeat an id one is taken, that whose text has the least hash; a null text is empty;
    other columns are ignored, whatever their names; empty tables give an empty sample.
    """
    y = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & learn).groupBy(key).agg(F.max(label).cast("int").alias("y"))
    least = y.orderBy(F.xxhash64(key), key).limit(rows)
    found = docs.select(key, F.coalesce(text, F.lit("")).alias(text)).join(F.broadcast(least), key)
    one = found.groupBy(key, "y").agg(F.min_by(text, F.struct(F.xxhash64(text), F.length(text))).alias(text))
    out = one.select(key, text, "y", F.pmod(F.xxhash64(F.lit("part"), key), F.lit(12)).cast("int").alias("part"))
    return stored(spark, out, "labelled")
