"""Array expressions. Missing arrays never fail: each function states what null gives."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.constants import CARD_ITEMS, NO_ITEMS
from larder.functions.text import _col, no_strings, strip


def length(c: Column | str) -> Column:
    """Number of elements; 0 for a null array."""
    return F.coalesce(F.size(_col(c)), F.lit(0))


def first(c: Column | str) -> Column:
    """First element, or null when there is none."""
    return F.get(_col(c), F.lit(0))


def non_empty(c: Column | str) -> Column:
    return length(c) > 0


def masked_texts(records: Column | str, mask: Column | str, field: str = "text") -> Column:
    """Lower-cased, stripped texts of the records whose flag at the same position is true.

    The longer array is cut to the shorter one, empty and missing texts are left out, and order and
    repeats are kept. A text of white space alone stays, as ''.
    """
    pairs = F.arrays_zip(_col(records).alias("record"), _col(mask).alias("flag"))
    kept = F.filter(
        pairs, lambda p: F.coalesce(p["flag"], F.lit(False)) & (F.coalesce(p["record"][field], F.lit("")) != "")
    )
    texts = F.transform(kept, lambda p: strip(F.lower(p["record"][field])))
    return F.coalesce(texts, no_strings())


def or_empty(c: Column | str) -> Column:
    return F.coalesce(_col(c), no_strings())


def head(c: Column | str, n: int = CARD_ITEMS, empty: str = NO_ITEMS) -> Column:
    """The first n items for display, or a single placeholder."""
    return F.when(length(c) > 0, F.slice(_col(c), 1, n)).otherwise(F.array(F.lit(empty)))


def candidates(first_choice: Column | str, others: Column | str) -> Column:
    """Non-empty values in order of preference, each once."""
    everything = F.concat(F.array(_col(first_choice)), or_empty(others))
    return F.array_distinct(F.filter(everything, lambda u: u != ""))
