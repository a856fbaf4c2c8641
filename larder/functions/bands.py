"""Bands: a numeric value to a label, from a list of upper bounds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.constants import SCORE_BANDS, SCORE_TOP, TIME_BANDS, TIME_MISSING, TIME_TOP, UNKNOWN
from larder.functions.text import _col

Bounds = Sequence[tuple[float, str]]


def banded(c: Column | str, bounds: Bounds, top: str, *, closed: bool, missing: str | None = None) -> Column:
    """Label of the first bound above the value (``closed``: or equal to it), ``top`` past the last bound.

    Null gives ``missing``. NaN sorts above every number in Spark, so it gives ``top``.
    """
    c = _col(c)
    chain = reduce(
        lambda acc, b: acc.when((c <= b[0]) if closed else (c < b[0]), F.lit(b[1])),
        bounds,
        F.when(c.isNull(), F.lit(missing).cast("string")),
    )
    return chain.otherwise(F.lit(top))


def score_band(c: Column | str, bounds: Bounds = SCORE_BANDS, top: str = SCORE_TOP) -> Column:
    return banded(c, bounds, top, closed=False)


def time_band(
    c: Column | str, bounds: Bounds = TIME_BANDS, top: str = TIME_TOP, missing: str = TIME_MISSING
) -> Column:
    return banded(c, bounds, top, closed=True, missing=missing)


def fallback_score(first: Column | str, second: Column | str, **bands) -> Column:
    """Band of the first known value. It mixes units (per 100 g and per portion), hence not the default."""
    return score_band(F.coalesce(_col(first), _col(second)), **bands)


def flag(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(False))


def labelled(c: Column | str, placeholder: str = UNKNOWN) -> Column:
    return F.coalesce(_col(c), F.lit(placeholder))
