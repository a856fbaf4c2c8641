"""Deduplication with a reproducible choice of the row to keep."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.operators.joins import BROADCAST_BYTES
from larder.session import materialise
from larder.sources.tables import planned_bytes


def keep_one(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = (), prefer: str = "min"
) -> DataFrame:
    """One row per key: the least (or ``prefer='max'`` the greatest) by ``order_by``, then by all columns.

    It is an aggregate, not a window: every map task keeps one row per key before the shuffle, so a key
    with a third of all rows costs its reducer one row per task. The order is total, so a retried or
    repeated run keeps the same row. Nulls of ``order_by`` come last for both choices.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    pick = {"min": F.min, "max": F.max}[prefer]
    order = []
    for c in order_by:
        c = F.col(c) if isinstance(c, str) else c
        order += [c.isNull() if prefer == "min" else c.isNotNull(), c]
    best = pick(F.struct(*(c.alias(f"_o{i}") for i, c in enumerate(order)), *rest))
    picked = df.groupBy(*keys).agg(best.alias("_best"))
    return picked.select(*(F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns))


def _digest(columns: Sequence[str]) -> Column:
    """Equal for equal rows only: JSON shows where nulls are, the hash also sees bytes that are no text."""
    return F.sha2(F.concat_ws("|", F.to_json(F.struct(*columns)), F.xxhash64(*columns)), 256)


def keep_one_stored(df: DataFrame, key: str) -> DataFrame:
    """``keep_one(df, [key])`` of a stored table of wide rows, which are compared only where rows of a key differ.

    Passes over narrow columns come first, as jobs of their own: keys alone show whether any is repeated, then digests
    whether repeats differ. Rows of unique keys stay where they are. Any row stands for equal ones, so columns that the
    caller does not read are not moved, unlike those of a row that is compared as a whole.
    """
    if df.groupBy(key).count().filter("count > 1").isEmpty():
        return df
    rest = [c for c in df.columns if c != key]
    if not rest:
        return df.distinct()
    digests = df.select(key, _digest(rest).alias("_digest")).groupBy(F.col(key).alias("_key"))
    bounds = digests.agg(F.min("_digest").alias("_low"), F.max("_digest").alias("_high"))
    differing = materialise(bounds.filter("_low <> _high").select("_key"), name="differing")
    any_row = lambda rows: rows.groupBy(key).agg(*(F.first(c).alias(c) for c in rest)).select(*df.columns)
    if differing.isEmpty():
        return any_row(df)
    if planned_bytes(differing) > BROADCAST_BYTES:
        return keep_one(df, [key])
    differs, differing = df[key].eqNullSafe(differing["_key"]), F.broadcast(differing)
    return any_row(df.join(differing, differs, "left_anti")).union(keep_one(df.join(differing, differs, "left_semi"), [key]))


def first_seen(df: DataFrame, key: str, order_by: str | Column) -> DataFrame:
    """The first row of every non-empty key, in the order of a column (file order does not survive splits)."""
    return keep_one(df.filter(F.col(key) != ""), [key], [order_by])


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Row count, distinct key count, and whether the key is unique."""
    return df.agg(F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_keys")).withColumn(
        "is_unique", F.col("n_rows") == F.col("n_keys")
    )
