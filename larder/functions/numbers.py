"""Numeric expressions over untrusted text. Nothing here raises under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.functions.text import _col, strip

# What counts as a decimal number, and as a run of digits.
NUMBER = r"(?i)\A[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\z"
DIGITS = r"\A[0-9]+\z"


def leading_number(c: Column | str) -> Column:
    """First number of a vector printed as text, such as ``"[312.4, 12.0]"``; null when it is none."""
    bare = F.translate(_col(c), "[]", "")
    text = strip(F.get(F.split(bare, ","), F.lit(0)))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def digits(c: Column | str, to: str = "bigint") -> Column:
    """A string of ASCII digits as an integer; signs, blanks, points and overflow give null."""
    return F.when(_col(c).rlike(DIGITS), _col(c).try_cast(to))


def narrow_int(c: Column | str) -> Column:
    """To 32 bits; a value out of range becomes null."""
    return _col(c).try_cast("int")


def bucket(c: Column | str, width: int) -> Column:
    """Lower edge of the fixed-width bucket that holds the value."""
    return (F.floor(_col(c) / F.lit(width)) * F.lit(width)).cast("bigint")


def share(part: Column, whole: Column, digits_after: int = 0) -> Column:
    """Rounded percentage of two counts; null when the whole is 0."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits_after)
