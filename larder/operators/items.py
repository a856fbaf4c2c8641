"""Items of array columns: the inverted index and the queries on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.constants import TOP_INDEX_ITEMS
from larder.functions.text import clean_item
from larder.operators.filters import all_of

CARRIED = ("recipe_id", "title", "nutri_score", "image_url", "cook_time_category")


def inverted_index(
    df: DataFrame, items: str = "ingredients_validated", into: str = "ingredient", carry: Sequence[str] = CARRIED
) -> DataFrame:
    """One row per record and non-blank item occurrence, cleaned, with the carried columns. No shuffle."""
    rows = df.select(*carry, F.explode(items).alias(into))
    return rows.withColumn(into, clean_item(into)).filter(F.col(into) != "")


def unnested(df: DataFrame, items: str, into: str = "item", keep: Sequence[str] | None = None) -> DataFrame:
    """Lateral unnest: one row per element; null and empty arrays give none."""
    return df.select(*(keep if keep is not None else [c for c in df.columns if c != items]), F.explode(items).alias(into))


def top_values(df: DataFrame, column: str, n: int, into: str = "freq") -> DataFrame:
    """The n most frequent values, ties by value. Counts are combined per task, so a frequent value is cheap."""
    counts = df.groupBy(column).agg(F.count("*").alias(into))
    return counts.orderBy(F.desc(into), column).limit(n)


def top_index_items(index: DataFrame, item: str = "ingredient", n: int = TOP_INDEX_ITEMS) -> DataFrame:
    return top_values(index, item, n, "count")


def item_catalog(
    index: DataFrame, item: str = "ingredient", owner: str = "recipe_id", into: str = "recipe_count",
    approximate: float | None = None,
) -> DataFrame:
    """Every item with its number of distinct owners, most owned first.

    The exact count is split by (item, owner) before it is merged per item. ``approximate`` takes a
    relative error instead and needs a single shuffle of sketches.
    """
    owners = F.count_distinct(owner) if approximate is None else F.approx_count_distinct(owner, approximate)
    return index.groupBy(item).agg(owners.alias(into)).orderBy(F.desc(into), item)


def owners_of_all(
    index: DataFrame, wanted: Sequence[str], item: str = "ingredient", owner: str = "recipe_id"
) -> DataFrame:
    """Owners that have every wanted item; repeats of one item count once. One shuffle, on the owner."""
    wanted = list(dict.fromkeys(wanted))
    has: list[Column] = [F.bool_or(F.col(item) == w).alias(f"_has{i}") for i, w in enumerate(wanted)]
    grouped = index.filter(F.col(item).isin(wanted)).groupBy(owner).agg(*has)
    return grouped.filter(all_of([F.col(f"_has{i}") for i in range(len(wanted))])).select(owner)


def owners_of_any(
    index: DataFrame, wanted: Sequence[str], item: str = "ingredient", owner: str = "recipe_id"
) -> DataFrame:
    return index.filter(F.col(item).isin(list(wanted))).select(owner).distinct()
