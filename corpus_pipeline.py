"""The corpus pipeline: its stages in order, each over all that the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents.

Defined results: a null text counts as empty; empty texts and texts without words are neither toxic nor copies, hold no
item and no secret, and have no tokens, so they stay; rows that repeat a whole row, or an id, or have none, are judged by
their own text, and of copies one row stays, ties as `one_of_each` says; without labels nothing is toxic; empty tables
give empty tables; other columns of documents go through the first four stages whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm.bpe import encoded
from plumbline.llm.common import fold, forget, passing, stored, table
from plumbline.llm.decontaminate import decontaminated
from plumbline.llm.ngram_join import one_of_each
from plumbline.llm.queries_tokens import tokenizer_path
from plumbline.llm.secrets import redactions
from plumbline.llm.toxicity import fit_toxicity, kept


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labelled documents outside the held-out fold."""
    model = fit_toxicity(spark, docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    return kept(spark, docs, model)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by marks."""
    return redactions(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each text as token ids."""
    return encoded(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("bpe", bpe),
]

#: SQL cannot express the toxicity classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    *first, (_, last) = STAGES
    for name, stage in first:
        with passing(spark) as kept:  # what a stage has stored for itself goes once its rows are written
            before, docs = docs, stored(spark, stage(spark, docs, sf_dir), name)
            kept.append(docs)
        forget(before)
    return last(spark, docs, sf_dir)
