"""Fixed-size samples, taken after the filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Leading hexadecimal digits of a draw by which rows are counted: 4,096 groups, whatever the input.
GROUP_DIGITS = 3


def fixed_sample(df: DataFrame, n: int, key: str = "recipe_id", seed: int = 0) -> DataFrame:
    """n rows, uniformly at random; the same rows for the same seed, whatever the partitioning.

    Each row draws a hash of seed and key, and the n least draws win. Rows are counted by the draw's leading digits
    first; the running sum of these counts tells up to which group the n least draws go, so only rows of these groups,
    about n of them, are sorted. One plan for any input, exact, without a job before it is run.
    """
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    group = F.substring("_draw", 1, GROUP_DIGITS)
    counts = df.select(draw.alias("_draw")).groupBy(group.alias("g")).agg(F.count("*").alias("c"))
    before = F.coalesce(F.sum("c").over(Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = counts.withColumn("before", before).where(F.col("before") < n).agg(F.max("g")).scalar()
    return df.withColumn("_draw", draw).where(group <= last).orderBy("_draw", key).limit(n).drop("_draw")
