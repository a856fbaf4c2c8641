"""Layout on several columns at once: files follow a Z-order curve, so a filter on any of the columns skips most of them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType

from larder.sources.tables import clustered

BITS = 6
# Bytes of a string that tell its place; a double holds six of them exactly.
PREFIX = 6


def _place(df: DataFrame, column: str) -> Column:
    """A number in the order of the column: its value, or the first bytes of a string; nulls come first."""
    value = F.col(column)
    if isinstance(df.schema[column].dataType, StringType):
        begin = F.rpad(F.hex(F.substring(value.cast("binary"), 1, PREFIX)), 2 * PREFIX, "0")
        value = F.conv(begin, 16, 10)
    elif isinstance(df.schema[column].dataType, DateType):
        value = value.cast("timestamp")
    return value.cast("double")


def _rank(place: Column, borders: Sequence[float]) -> Column:
    """How many of the borders a number reaches, by halving them."""
    if not borders:
        return F.lit(0)
    mid = len(borders) // 2
    return F.when(place < borders[mid], _rank(place, borders[:mid])).otherwise(F.lit(mid + 1) + _rank(place, borders[mid + 1 :]))


def curve_key(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """The place of a row on the curve: the bits of each column's quantile rank, interleaved, the first column's first.

    One pass over the columns finds the quantiles; 2 ** ``bits`` - 1 numbers a column go to the driver. Equal values and
    nulls have one rank, so a value of very many rows is one cell of the curve; what is written is split by a further column.
    """
    parts = [i / 2**bits for i in range(1, 2**bits)]
    found = df.select(*(F.percentile_approx(_place(df, c), parts, 10_000).alias(f"q{i}") for i, c in enumerate(columns))).first()
    out = []
    for i, c in enumerate(columns):
        rank = F.coalesce(_rank(_place(df, c), sorted(set(found[i] or []))), F.lit(0)).cast("long")
        for bit in range(bits):
            out.append(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)), bit * len(columns) + len(columns) - 1 - i))
    return reduce(add, out)


def write_by_curve(df: DataFrame, path: str, columns: Sequence[str], unique: str, rows_per_file: int = 0) -> None:
    """Write ``df`` in the order of the curve over ``columns``, then of the ``unique`` column, which splits frequent values."""
    placed = clustered(df.withColumn("_curve", curve_key(df, columns)), ["_curve", unique]).drop("_curve")
    options = {"maxRecordsPerFile": str(rows_per_file)} if rows_per_file else {}
    placed.write.mode("overwrite").options(**options).parquet(path)
