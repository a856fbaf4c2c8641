"""Staging tables to one wide row per recipe."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from larder.functions.text import json_strings
from larder.operators.dedupe import keep_one, keep_one_stored
from larder.operators.joins import BROADCAST_BYTES, frequent_values, left_join, left_join_on, spread_left_join
from larder.session import materialise
from larder.sources.tables import planned_bytes, read_table

# The array columns, which may also arrive as JSON text.
LISTS = ("ingredients_raw", "image_urls", "ingredients_validated", "tags")
# Rows of short columns are so many times larger in memory than stored, at most about.
UNPACKED = 8


def decoded(df: DataFrame) -> DataFrame:
    """JSON-text list columns as arrays; native arrays stay."""
    as_text = [c for c in LISTS if c in df.columns and isinstance(df.schema[c].dataType, StringType)]
    return df.withColumns({c: json_strings(c) for c in as_text}) if as_text else df


@dataclass(frozen=True)
class Parts:
    """The sides of the assembly, each with one row per key; ``by_title`` is the two tables on the title key, merged."""

    layer1: DataFrame
    layer2: DataFrame
    det_ingrs: DataFrame
    by_title: DataFrame

    def joined(self) -> DataFrame:
        """One wide row per recipe. Rows that hold their wide columns packed are joined as any others."""
        recipes = left_join(left_join(self.layer1, self.layer2, "id"), self.det_ingrs, "id")
        # Rows are larger in a task than stored.
        if UNPACKED * planned_bytes(self.by_title) <= BROADCAST_BYTES:
            return left_join_on(recipes, F.broadcast(self.by_title), "title_norm", "dim_title")
        hot = frequent_values(self.layer1, "title_norm")
        return spread_left_join(recipes, self.by_title, "title_norm", "dim_title", hot, ["id"])


def prepared(staging: Mapping[str, DataFrame], drop_empty_keys: bool = False) -> Parts:
    """Each table reduced to one row per key, so no join multiplies rows and appended repeats are harmless."""
    tables = {name: decoded(df) for name, df in staging.items()}
    layer1, layer2, det_ingrs = (keep_one_stored(tables[name], "id") for name in ("layer1", "layer2", "det_ingrs"))
    nutrition = keep_one(tables["nutrition"].drop("title").withColumnRenamed("energy_kcal", "mit_energy_kcal"), ["title_norm"])
    kaggle = keep_one(tables["kaggle"].drop("n_steps"), ["title_norm"], [F.col("kaggle_id").try_cast("bigint")])
    by_title = nutrition.join(kaggle, "title_norm", "full").withColumnRenamed("title_norm", "dim_title")
    if drop_empty_keys:
        by_title = by_title.filter(F.col("dim_title") != "")
    titles = tables["layer1"].select(F.col("title_norm").alias("dim_title")).distinct()
    by_title = materialise(by_title.join(titles, "dim_title", "left_semi"), name="by-title")
    return Parts(layer1, layer2, det_ingrs, by_title)


def assemble(staging: Mapping[str, DataFrame], drop_empty_keys: bool = False) -> DataFrame:
    """Left-join the four dimensions to ``layer1``; every recipe stays, once.

    The three tables on ``id`` move once, for their reduction to one row per key or, where no id is repeated, for the
    join. The two tables on the title key are merged into one before the recipes
    move: one shuffle of the wide rows, spread for titles that many recipes share ("" above all).
    ``drop_empty_keys`` keeps untitled recipes from matching an untitled nutrition row.
    """
    return prepared(staging, drop_empty_keys).joined()


def read_staging(spark: SparkSession, staging_dir: str) -> dict[str, DataFrame]:
    names = ("layer1", "layer2", "det_ingrs", "nutrition", "kaggle")
    return {name: read_table(spark, f"{staging_dir}/{name}") for name in names}
