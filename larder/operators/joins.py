"""Enrichment joins. Dimensions carry one row per key (see ``keep_one``), so no join multiplies rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.sources.tables import planned_bytes

# A side is sent to every task up to this size, files as they are stored.
BROADCAST_BYTES = 64 << 20


def left_join(base: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return base.join(dim, key, "left")


def left_join_on(base: DataFrame, dim: DataFrame, base_key: str, dim_key: str) -> DataFrame:
    """Left join on differently named keys; the dimension's key is dropped."""
    return base.join(dim, base[base_key] == dim[dim_key], "left").drop(dim[dim_key])


def frequent_values(df: DataFrame, column: str, width: int | None = None) -> DataFrame:
    """(value, ways) of every value that holds more than 1/width of the known rows, so at most ``width`` values.

    ``ways`` is the value's share of ``width`` tasks (default: the shuffle width), so the ways add up to at
    most twice the width however the values are distributed.
    """
    width = width or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    top = counts.filter(F.col("_n") * F.lit(width) > total)
    return top.select(column, F.ceil(F.lit(width) * F.col("_n") / total).cast("int").alias("ways"))


def spread_left_join(
    base: DataFrame, dim: DataFrame, base_key: str, dim_key: str, hot: DataFrame, spread_by: Sequence[str]
) -> DataFrame:
    """Left join that stays balanced when some base keys hold a large part of all rows.

    ``hot`` lists those keys and their ways (from ``frequent_values``: at most one row for each task, hence
    broadcast). Base rows of a hot key spread over its ways by hash of ``spread_by``; the dimension's row
    for it is repeated once per way. All other keys join as usual. Null base keys match nothing and are
    spread too. The result equals ``left_join_on`` whatever ``hot`` holds.
    """
    value, ways = hot.columns
    hot = F.broadcast(hot.select(F.col(value).alias("_hot"), F.col(ways).alias("_ways")))
    draw = F.xxhash64(*spread_by)
    left = (
        base.join(hot, base[base_key] == F.col("_hot"), "left")
        .withColumn("_way", F.when(F.col(base_key).isNull(), draw).otherwise(F.pmod(draw, F.coalesce("_ways", F.lit(1)))))
        .drop("_hot", "_ways")
    )
    right = (
        dim.join(hot, dim[dim_key] == F.col("_hot"), "left")
        .withColumn("_dim_way", F.explode(F.sequence(F.lit(0), F.coalesce("_ways", F.lit(1)) - 1)))
        .withColumn("_dim_way", F.col("_dim_way").cast("bigint"))
        .withColumnRenamed(dim_key, "_dim_key")
        .drop("_hot", "_ways")
    )
    on = (left[base_key] == right["_dim_key"]) & (left["_way"] == right["_dim_way"])
    return left.join(right, on, "left").drop("_way", "_dim_key", "_dim_way")


def small_side(df: DataFrame, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if its planned size, known before anything runs, is ``most_bytes`` at most; else as it is.

    A size that the optimizer does not know is not small. Beyond the bound the join is planned as any other.
    """
    return F.broadcast(df) if planned_bytes(df) <= most_bytes else df


def restrict_to(base: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of base whose key is in ids. The ids are made distinct before the shuffle that the join needs anyway."""
    return base.join(ids.select(key).distinct(), key, "left_semi")


def restrict_to_small(base: DataFrame, ids: DataFrame, key: str, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """As ``restrict_to``; ids of a checked size go to every task, so that base is not shuffled."""
    return base.join(small_side(ids.select(key), most_bytes), key, "left_semi")


def with_details(main: DataFrame, details: DataFrame, key: str = "recipe_id") -> DataFrame:
    """Master view: every main row with its detail columns, null where it has none."""
    return main.join(details, key, "left")


def reassembled(children: DataFrame, parent: str, position: str, value: str, into: str, tie: Sequence[str] = ()) -> DataFrame:
    """Child rows back to one array per parent, in order of position (then of ``tie`` and value).

    The array is the output cell, so a parent must be a record: its children fit in one row.
    """
    items = F.sort_array(F.collect_list(F.struct(position, *tie, F.col(value).alias("_value"))))
    return children.groupBy(parent).agg(F.transform(items, lambda s: s["_value"]).alias(into))


def attach_lists(parents: DataFrame, lists: Sequence[DataFrame], key: str) -> DataFrame:
    """Left-join any number of per-parent lists; all sides share one partitioning on the key."""
    for side in lists:
        parents = parents.join(side, key, "left")
    return parents


