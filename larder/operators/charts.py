"""The aggregates behind the dashboard charts, each under one facet state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.constants import (
    COOK_CURVE_RANGE,
    COOK_CURVE_WIDTH,
    KCAL_BINS,
    KCAL_CAP,
    MACROS,
    SATURATES_RANGE,
    SCATTER_ROWS,
    SUGARS_RANGE,
    TIME_CLASSES,
    TOP_ITEMS,
)
from larder.functions.bands import labelled
from larder.functions.numbers import bucket
from larder.operators.filters import Facets, long_enough
from larder.operators.items import top_values, unnested
from larder.operators.sampling import fixed_sample

NO_FACETS = Facets()


def score_counts(main: DataFrame, facets: Facets = NO_FACETS, score: str = "nutri_score") -> DataFrame:
    rows = facets.apply(main).filter(F.col(score).isNotNull())
    return rows.groupBy(F.col(score).alias("score")).agg(F.count("*").alias("count")).orderBy("score")


def class_counts(
    main: DataFrame,
    facets: Facets = NO_FACETS,
    column: str = "cook_time_category",
    domain: Sequence[str] = TIME_CLASSES,
) -> DataFrame:
    """Rows per class of a fixed domain, 0 where there are none: one global aggregate, turned to rows."""
    counts = facets.apply(main).agg(*(F.count_if(F.col(column) == d).alias(d) for d in domain))
    return counts.unpivot([], list(domain), column, "count")


def cook_curve(
    main: DataFrame,
    facets: Facets = NO_FACETS,
    column: str = "cook_minutes",
    span: tuple[int, int] = COOK_CURVE_RANGE,
    width: int = COOK_CURVE_WIDTH,
) -> DataFrame:
    rows = facets.apply(main).filter(F.col(column).between(*span))
    return rows.groupBy(bucket(column, width).alias("bucket")).agg(F.count("*").alias("count")).orderBy("bucket")


def histogram(
    main: DataFrame,
    facets: Facets = NO_FACETS,
    column: str = "mit_energy_kcal",
    cap: float = KCAL_CAP,
    bins: int = KCAL_BINS,
) -> DataFrame:
    """Counts in ``bins`` equal-width bins from the least to the greatest value below the cap.

    Bin i covers [low + i*w, low + (i+1)*w) and the last one is closed. Empty bins are left out. The
    range is a scalar subquery over the same pruned column; the rows go through one count per bin.
    """
    values = facets.apply(main).filter(F.col(column) < cap).select(F.col(column).cast("double").alias("x"))
    span = values.agg(F.struct(F.min("x").alias("low"), F.max("x").alias("high")).alias("span")).scalar()
    placed = values.select("x", span.alias("span")).select(
        "x", "span.low", ((F.col("span.high") - F.col("span.low")) / F.lit(float(bins))).alias("width")
    )
    slot = F.least(F.floor((F.col("x") - F.col("low")) / F.col("width")), F.lit(bins - 1))
    slot = F.when(F.col("width") > 0, slot).otherwise(F.lit(0)).cast("int")
    counts = placed.groupBy(slot.alias("bin"), "low", "width").agg(F.count("*").alias("count"))

    def edge(n: Column) -> Column:
        return F.col("low") + n * F.col("width")

    return counts.select(
        "bin", edge(F.col("bin")).alias("bin_start"), edge(F.col("bin") + 1).alias("bin_end"), "count"
    ).orderBy("bin")


def macro_totals(
    details: DataFrame,
    main: DataFrame,
    facets: Facets = NO_FACETS,
    key: str = "recipe_id",
    columns: Sequence[str] = MACROS,
) -> DataFrame:
    """Total of each macro over the recipes the facets keep; the join is left out when nothing filters."""
    rows = details
    if facets:
        rows = details.join(facets.apply(main).select(key), key, "inner")
    return rows.agg(*(F.sum(c).alias(c) for c in columns))


def macro_slices(totals: DataFrame) -> DataFrame:
    """The totals row as (macro, total) rows; no rows when every total is unknown."""
    return totals.unpivot([], totals.columns, "macro", "total").filter(F.col("total").isNotNull())


def top_items(
    main: DataFrame, column: str, facets: Facets = NO_FACETS, n: int = TOP_ITEMS, floor: int = 1
) -> DataFrame:
    """Most frequent items of an array column, by occurrence; items of one character or less are left out."""
    items = unnested(facets.apply(main), column, "item", keep=[])
    return top_values(items.filter(long_enough("item", floor)), "item", n)


def scatter_candidates(
    details: DataFrame,
    main: DataFrame,
    facets: Facets = NO_FACETS,
    key: str = "recipe_id",
    saturates: tuple[float, float] = SATURATES_RANGE,
    sugars: tuple[float, float] = SUGARS_RANGE,
) -> DataFrame:
    """All scored recipes with both macros inside their ranges."""
    left = details.filter(F.col("saturates_g").between(*saturates) & F.col("sugars_g").between(*sugars))
    right = facets.apply(main).filter(F.col("nutri_score").isNotNull())
    return left.select(key, "saturates_g", "sugars_g").join(
        right.select(key, labelled("nutri_score").alias("nutri_score"), "title"), key, "inner"
    )


def scatter(
    details: DataFrame, main: DataFrame, facets: Facets = NO_FACETS, n: int = SCATTER_ROWS, seed: int = 0,
    key: str = "recipe_id",
) -> DataFrame:
    """A sample of exactly n candidates, or all of them if there are fewer."""
    sample = fixed_sample(scatter_candidates(details, main, facets, key), n, key, seed)
    return sample.select("saturates_g", "sugars_g", "nutri_score", "title")
