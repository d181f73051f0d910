"""Similarities that built-in functions don't have, over Arrow batches."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .pages import clean_street


@F.pandas_udf("double")
def matching_share(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of characters in matching blocks; null with a null."""
    pairs = zip(a, b, strict=True)
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in pairs], dtype="float64")


def name_similarity(a: Column, b: Column) -> Column:
    """matching_share of two printed headers, cleaned."""
    return matching_share(clean_street(a), clean_street(b))
