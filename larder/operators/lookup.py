"""Substring search and single-record lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.constants import MACROS, SEARCH_ROWS
from larder.functions.arrays import candidates, head
from larder.functions.text import numbered_steps
from larder.operators.filters import all_of, holds_text
from larder.operators.grams import GramIndex, holding, items_holding
from larder.operators.joins import restrict_to
from larder.operators.sampling import fixed_sample
from larder.schemas import with_optional

# The columns of the record card and of a short search result.
CARD = (
    "recipe_id", "title", "instructions_text", "ingredients_validated", "cook_minutes",
    "image_url", "image_urls", "mit_energy_kcal", "nutri_score",
)
BRIEF = ("recipe_id", "title", "cook_minutes", "nutri_score", "image_url")


def _limited(df: DataFrame, n: int, order_by: str | None) -> DataFrame:
    return (df.orderBy(order_by) if order_by else df).limit(n)


def by_name(
    main: DataFrame, query: str, n: int = SEARCH_ROWS, order_by: str | None = None, titles: GramIndex | None = None
) -> DataFrame:
    """With an index of the titles' grams only rows that may hold the text are read for it."""
    found = holding(main, titles, query) if titles else main.filter(holds_text("title", query))
    return _limited(found.select(*BRIEF), n, order_by)


def _with_item(index: DataFrame, query: str, grams: GramIndex | None) -> DataFrame:
    return items_holding(index, grams, query) if grams else index.filter(holds_text("ingredient", query))


def by_ingredient(
    master: DataFrame, index: DataFrame, query: str, n: int = SEARCH_ROWS, order_by: str | None = None,
    items: str = "ingredients_raw", grams: GramIndex | None = None,
) -> DataFrame:
    """``grams`` is the index of the distinct ingredients' grams."""
    ids = _with_item(index, query, grams)
    return _limited(restrict_to(master.select(*BRIEF, items), ids, "recipe_id"), n, order_by)


def advanced_predicate(
    name: str | None = None, max_time: int | None = None, nutri_score: str | None = None
) -> Column:
    """Conjunction of the arguments that are given; an empty or zero argument counts as not given."""
    parts = []
    if name:
        parts.append(holds_text("title", name))
    if max_time:
        parts.append(F.col("cook_minutes") <= max_time)
    if nutri_score:
        parts.append(F.col("nutri_score") == nutri_score)
    return all_of(parts)


def advanced(
    master: DataFrame,
    index: DataFrame,
    name: str | None = None,
    ingredient: str | None = None,
    max_time: int | None = None,
    nutri_score: str | None = None,
    n: int = SEARCH_ROWS,
    order_by: str | None = None,
    items: str = "ingredients_raw",
    titles: GramIndex | None = None,
    grams: GramIndex | None = None,
) -> DataFrame:
    found = holding(master, titles, name) if titles and name else master
    found = found.filter(advanced_predicate(name, max_time, nutri_score))
    if ingredient:
        found = restrict_to(found, _with_item(index, ingredient, grams), "recipe_id")
    columns = (
        "recipe_id", "title", "cook_minutes", "cook_time_category", "nutri_score", "mit_energy_kcal", "image_url", items
    )
    return _limited(found.select(*columns), n, order_by)


def record(df: DataFrame, key: str, value: str) -> DataFrame:
    """The row with this key, or none; the filter reaches the scan."""
    return df.filter(F.col(key) == value).limit(1)


def _card_columns(main: DataFrame, card: Sequence[str]) -> DataFrame:
    return with_optional(main, {"image_urls": "array<string>"}).select(*card)


def recipe_card(
    main: DataFrame, details: DataFrame, recipe_id: str, card: Sequence[str] = CARD, key: str = "recipe_id"
) -> DataFrame:
    """The display columns of one recipe with its macros. Both scans filter on the key."""
    macros = details.filter(F.col(key) == recipe_id).select(key, *MACROS)
    return record(_card_columns(main, card), key, recipe_id).join(macros, key, "left").limit(1)


def random_card(
    main: DataFrame, details: DataFrame, seed: int = 0, card: Sequence[str] = CARD, key: str = "recipe_id"
) -> DataFrame:
    """The card of a random recipe with an image. Only the drawn key is broadcast, one row."""
    drawn = fixed_sample(main.filter("has_image"), 1, key, seed)
    macros = details.join(F.broadcast(drawn.select(key)), key, "left_semi").select(key, *MACROS)
    return _card_columns(drawn, card).join(macros, key, "left")


def card_texts(main: DataFrame, key: str = "recipe_id") -> DataFrame:
    """Display texts of every recipe: numbered steps, the first ingredients, and image addresses by preference."""
    return main.select(
        key,
        numbered_steps("instructions_text").alias("steps"),
        head("ingredients_validated").alias("items"),
        candidates("image_url", "image_urls").alias("images"),
    )
