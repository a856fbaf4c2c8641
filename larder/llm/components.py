"""Connected components of a link table, by alternating large and small stars. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import materialise, remove, scratch


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: for each linked node the least node that it reaches.

    A node that is its own component's least, or has no link, has no row. Nulls link nothing; loops, repeated and
    mirrored links do no harm; an empty table gives an empty one. Each round halves the remaining depth of every tree.
    Its links are written to the shared folder and those of the round before are removed, so a lost executor costs one
    round; the driver only sees a count and a checksum. Minima are combined before each shuffle, and a node with very many links is one row on the other
    side of its join, which adaptive execution splits.
    """
    edges = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    spark, seen = links.sparkSession, None
    path = scratch(spark, "links")
    edges = materialise(edges, path)
    while True:
        count, mark = edges.select(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if not count or (count, mark) == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen, old, path = (count, mark), path, scratch(spark, "links")
        edges = materialise(_small_star(_large_star(edges)), path)
        remove(spark, old)


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("w"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("w").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, are linked to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("w"))
    moved = edges.join(least, "u").where("v > w").select(F.col("v").alias("u"), F.col("w").alias("v"))
    return moved.unionByName(least.select("u", F.col("w").alias("v"))).distinct()
