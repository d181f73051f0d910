"""The BPE query: every whole text encoded and decoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .bpe import round_trip
from .common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


QUERIES = {"op10_bpe_codec": op10_bpe_codec}
ORACLE_SQL: dict[str, str] = {}
