"""Printed rows of a renumbering list: what a row of recognised tokens is, as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .let import let

# The largest numbers, the letters behind them, ditto marks, and words of headings and labels.
MOST_NEW, MOST_OLD = 13999, 9999
LETTERS = ("S", "W")
DITTO = r"[\s\"'`“”‘’«»,.′″~-]+"
TO = r"^(?:to|t0)(?:[\s,.]+(?:to|t0))?$"
COLUMN_HEADS = ("new", "old", "0ld", "o1d", "numbers")


def _tokens(texts: Column) -> Column:
    """All words of a row without signs about them."""
    words = F.flatten(F.transform(texts, lambda t: F.split(t, r"\s+")))
    return F.filter(F.transform(words, lambda w: F.regexp_replace(w, r"^[.,;:|()!]+|[.,;:|()!]+$", "")), lambda w: w != "")


def _sorted_out(tokens: Column) -> Column:
    """struct(nums array<struct(n, suffix)>, words): a letter behind a bare number is its suffix, once."""
    number = "struct<n: int, suffix: string>"
    start = F.struct(F.array().cast(f"array<{number}>").alias("nums"), F.array().cast("array<string>").alias("words"), F.lit(False).alias("bare"))

    def step(s: Column, t: Column) -> Column:
        n, letter = F.regexp_extract(t, r"^(\d{1,5})[SWsw]?$", 1), F.upper(F.regexp_extract(t, r"^\d{1,5}([SWsw])$", 1))
        head, last = F.slice(s["nums"], 1, F.size(s["nums"]) - 1), F.try_element_at(s["nums"], F.lit(-1))
        suffixed = F.concat(head, F.array(F.struct(last["n"].alias("n"), F.upper(t).alias("suffix"))))
        more = F.concat(s["nums"], F.array(F.struct(n.try_cast("int").alias("n"), letter.alias("suffix"))))
        is_number, is_suffix = n != "", s["bare"] & F.upper(t).isin(*LETTERS)
        nums = F.when(is_suffix, suffixed).when(is_number, more).otherwise(s["nums"])
        words = F.when(is_suffix | is_number, s["words"]).otherwise(F.concat(s["words"], F.array(t)))
        return F.struct(nums.alias("nums"), words.alias("words"), (~is_suffix & is_number & (letter == "")).alias("bare"))

    return F.aggregate(tokens, start, step)


def row_class(texts: Column) -> Column:
    """struct(kind, new, old, new_suffix, old_suffix, parity, cont, text) of a row's token texts, from left to right.

    Digits are taken as they are read: to mend them would make two readers err alike.
    """
    raw = F.array_join(F.filter(F.transform(texts, F.trim), lambda t: t != ""), " ")

    def classed(text: Column) -> Column:
        lower = F.lower(text)
        bare = F.regexp_replace(lower, "[^a-z0-9]", "")
        odd, even, cont = F.contains(bare, F.lit("odd")), F.contains(bare, F.lit("even")), F.contains(bare, F.lit("cont"))

        def by(s: Column) -> Column:
            nums, count = s["nums"], F.size(s["nums"])
            alpha = F.filter(s["words"], lambda w: w.rlike("[A-Za-z]{2,}"))
            heads = "|".join(COLUMN_HEADS)
            a, b = F.try_element_at(nums, F.lit(1)), F.try_element_at(nums, F.lit(2))
            fit = a["n"].between(1, MOST_NEW) & b["n"].between(1, MOST_OLD)
            sided = (count == 0) & (odd | even) & (F.contains(bare, F.lit("no")) | cont)
            headed = (F.size(alpha) > 0) & F.lower(F.array_join(alpha, " ")).rlike(rf"^(?:{heads})(?:[\s.]+(?:{heads}))*$")
            goes_on = (count == 0) & F.contains(lower, F.lit("cont"))
            kind = (
                F.when((text != "") & (F.regexp_replace(text, DITTO, "") == ""), "ditto").when(lower.rlike(TO), "to").when(sided | headed | goes_on, "label")
                .when(F.size(alpha) > 0, "header").when((count == 2) & fit, "pair").when(count == 2, "junk").when(count == 1, "lone").when(count > 2, "multi").otherwise("junk")
            )
            def shaped(k: Column) -> Column:
                pair, one = k == "pair", k.isin("pair", "lone")
                return F.struct(
                    k.alias("kind"), F.when(one, a["n"]).alias("new"), F.when(pair, b["n"]).alias("old"), F.when(one, a["suffix"]).alias("new_suffix"), F.when(pair, b["suffix"]).alias("old_suffix"),
                    F.when((k == "label") & sided, F.when(odd, "odd").otherwise("even")).alias("parity"), ((k == "label") & ((sided & cont) | (~sided & ~headed & goes_on))).alias("cont"), text.alias("text"),
                )

            return let(kind, shaped)

        return let(_sorted_out(_tokens(texts)), by)

    return let(raw, classed)
