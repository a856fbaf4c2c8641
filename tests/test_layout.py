"""Layout on several columns, and joins with a side of a checked size."""

from __future__ import annotations

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from larder.operators import joins
from larder.session import scratch
from larder.sources import curve
from larder.sources.tables import write_clustered


@pytest.fixture(scope="module")
def rows(spark):
    h = lambda i: F.pmod(F.xxhash64(F.lit(i), "id"), F.lit(1000))
    df = spark.range(20_000).select("id", h(1).alias("a"), F.concat(F.lit("k"), F.lpad(h(2).cast("string"), 4, "0")).alias("b"), h(3).alias("c"))
    return df.withColumn("a", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("a")))


def files_with(path, column, value):
    """The share of files whose statistics do not rule the value out."""
    reached, total = 0, 0
    for file in path.glob("*.parquet"):
        meta = pq.read_metadata(file)
        at = meta.schema.names.index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        total += 1
        reached += any(s is not None and s.has_min_max and s.min <= value <= s.max for s in stats)
    return reached / total


def test_filters_on_either_column_skip_files(spark, rows, tmp_path):
    curve.write_by_curve(rows, str(tmp_path / "curve"), ["a", "b"], "id", rows_per_file=150)
    write_clustered(rows, str(tmp_path / "single"), ["a", "id"], rows_per_file=150)
    assert files_with(tmp_path / "curve", "a", 500) < 0.25 and files_with(tmp_path / "curve", "b", "k0500") < 0.35
    assert files_with(tmp_path / "single", "b", "k0500") > 0.9
    again = spark.read.parquet(str(tmp_path / "curve"))
    assert again.exceptAll(rows).isEmpty() and rows.exceptAll(again).isEmpty()
    assert again.filter("b = 'k0500'").count() == rows.filter("b = 'k0500'").count()


def test_a_frequent_value_is_many_files(spark, rows, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    curve.write_by_curve(rows.filter("a = 7"), str(tmp_path / "one"), ["a"], "id")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "one").glob("*.parquet"))) > 2


def test_ranks_are_quantiles_and_bits_interleave(spark):
    df = spark.range(1000).select(F.col("id").alias("a"), (F.lit(999) - F.col("id")).alias("b"))
    keys = [r["k"] for r in df.orderBy("a").select(curve.curve_key(df, ["a", "b"], bits=2).alias("k")).collect()]
    # Ranks 0 to 3 of a against 3 to 0 of b, a's bits before b's.
    assert [keys[i] for i in (0, 300, 600, 999)] == [0b0101, 0b0110, 0b1001, 0b1010]


def test_empty_tables_are_written(spark, rows, tmp_path):
    curve.write_by_curve(rows.limit(0), str(tmp_path / "none"), ["a", "b"], "id")
    assert spark.read.schema(rows.schema).parquet(str(tmp_path / "none")).count() == 0


def test_a_side_is_broadcast_up_to_a_checked_size(spark, rows):
    path = scratch(spark, "side")
    rows.select("id").write.parquet(path)
    side = spark.read.parquet(path)
    base = spark.range(100_000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lambda n: joins.restrict_to_small(base, side, "id", n)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan(1 << 20) and "BroadcastHashJoin" not in plan(1000)
        assert joins.restrict_to_small(base, side, "id", 1000).count() == joins.restrict_to_small(base, side, "id").count() == 20_000
        # Rows from nowhere known have no size.
        unknown = spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "id long")
        assert joins.small_side(unknown) is unknown
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
