"""Small helpers for Column expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once, however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(*values: str) -> Column:
    return F.array(*[F.lit(v) for v in values])


def within(x: Column, values: Iterable[str]) -> Column:
    return F.array_contains(words(*sorted(values)), x)


def lookup(table: dict[str, str], x: Column) -> Column:
    """The table's entry for x, else x."""
    pairs = [F.lit(v) for kv in table.items() for v in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), x), x) if pairs else x


def run_at_end(tokens: Column, test: Callable[[Column], Column]) -> Column:
    """How many of the last tokens pass, without a break."""
    return run_at_start(F.reverse(tokens), test)


def run_at_start(tokens: Column, test: Callable[[Column], Column]) -> Column:
    first = F.array_position(F.transform(tokens, test), False)
    return F.when(first == 0, F.size(tokens)).otherwise(first - 1).cast("int")


def tokens_of(text: Column) -> Column:
    """Split at single blanks; an empty text is one empty token."""
    return F.split(text, " ", -1)


def spelt(tokens: Column) -> Column:
    return F.array_join(tokens, " ")
