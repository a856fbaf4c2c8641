"""The serving layer: views over the published tables and the dashboard under one filter state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.constants import COOK_CURVE_RANGE, COOK_CURVE_WIDTH, TIME_CLASSES
from larder.functions.numbers import bucket
from larder.operators import charts
from larder.operators.filters import Facets
from larder.operators.items import item_catalog
from larder.operators.joins import with_details
from larder.plans.publish import Catalog
from larder.sources.tables import export, pin, register_views

# Column order of the joined view's macros.
VIEW_MACROS = ("fat_g", "protein_g", "salt_g", "sugars_g", "saturates_g")


def full_view(main: DataFrame, details: DataFrame, key: str = "recipe_id") -> DataFrame:
    return with_details(main, details.select(key, *VIEW_MACROS), key)


def register_catalog(spark: SparkSession, out_dir: str) -> None:
    """Temporary views over the published tables, under every name the catalog's queries use."""
    main, index, details = Catalog(out_dir).read(spark)
    full = full_view(main, details)
    register_views(
        {
            "recipes_main": main,
            "v_main": main,
            "ingredients_index": index,
            "v_index": index,
            "recipes_nutrition": details,
            "recipes_nutrition_detail": details,
            "v_nutrition": details,
            "recipes": full,
            "v_full": full,
            "v_ingredient_catalog": item_catalog(index),
        }
    )


def master_table(main: DataFrame, details: DataFrame, path: str, key: str = "recipe_id") -> DataFrame:
    """The joined view as a written table; write it again when its inputs change."""
    return export(with_details(main, details, key), path)


# Columns of the narrow table for search.
SEARCH_COLUMNS = (
    "recipe_id", "title", "cook_minutes", "cook_time_category", "nutri_score", "mit_energy_kcal",
    "image_url", "ingredients_raw", "instructions_text",
)


def search_table(main: DataFrame, details: DataFrame, path: str, key: str = "recipe_id") -> DataFrame:
    return export(with_details(main.select(*SEARCH_COLUMNS), details, key), path)


def facet_cube(main: DataFrame, facets: Facets = charts.NO_FACETS) -> DataFrame:
    """Counts per (score, time class, 5-minute bucket): one scan, a few hundred groups at any data size."""
    in_curve = F.col("cook_minutes").between(*COOK_CURVE_RANGE)
    slot = F.when(in_curve, bucket("cook_minutes", COOK_CURVE_WIDTH))
    return (
        facets.apply(main)
        .groupBy("nutri_score", "cook_time_category", slot.alias("bucket"))
        .agg(F.count("*").alias("count"))
    )


def category_charts(main: DataFrame, facets: Facets = charts.NO_FACETS) -> DataFrame:
    """The score, class and curve charts as rows (chart, label, count), from one scan of the main table."""
    cube = facet_cube(main, facets)

    def label(chart: str, value: Column, keep: Column) -> Column:
        return F.when(keep, F.struct(F.lit(chart).alias("chart"), value.cast("string").alias("label")))

    labels = F.array(
        label("score", F.col("nutri_score"), F.col("nutri_score").isNotNull()),
        label("time", F.col("cook_time_category"), F.col("cook_time_category").isin(*TIME_CLASSES)),
        label("curve", F.col("bucket"), F.col("bucket").isNotNull()),
    )
    rows = cube.select(F.explode(F.array_compact(labels)).alias("l"), "count")
    return rows.groupBy("l.chart", "l.label").agg(F.sum("count").alias("count"))


CHART_COLUMNS = (
    "recipe_id", "title", "nutri_score", "cook_time_category", "cook_minutes", "mit_energy_kcal",
    "ingredients_validated", "tags",
)


def released(page: dict[str, DataFrame]) -> None:
    """Unpin the rows of a page made with ``keep``; its charts still work, as scans."""
    page["rows"].unpersist()


def dashboard(
    main: DataFrame, details: DataFrame, state: dict | None = None, seed: int = 0, keep: bool = False
) -> dict[str, DataFrame]:
    """Every chart of the dashboard under one filter state.

    The facets filter the chart columns once. ``keep`` pins the filtered rows on the executors, which pays
    if all charts are drawn and the rows fit; without it each chart is a pruned scan of its own. ``released`` gives the
    pinned rows back.
    """
    facets = Facets.from_state(state)
    rows = facets.apply(main).select(*CHART_COLUMNS)
    rows = pin(rows) if keep else rows
    return {
        "rows": rows,
        "kcal_histogram": charts.histogram(rows),
        "macro_totals": charts.macro_totals(details, rows, facets),
        "score_counts": charts.score_counts(rows),
        "class_counts": charts.class_counts(rows),
        "cook_curve": charts.cook_curve(rows),
        "scatter": charts.scatter(details, rows, seed=seed),
        "top_ingredients": charts.top_items(rows, "ingredients_validated"),
        "top_tags": charts.top_items(rows, "tags"),
    }
