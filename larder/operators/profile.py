"""KPIs, table statistics and data-quality profiles. One pass per table and report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.constants import COMPLETE, COOK_MEAN_RANGE, INCOMPLETE, OUTLIER_ROWS, TIME_CLASSES, TIME_MISSING, UNKNOWN, USABLE
from larder.functions.numbers import share
from larder.operators.filters import all_present, outlying, usable
from larder.operators.items import top_values
from larder.operators.joins import with_details


def _or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def kpis(main: DataFrame, cook_range: tuple[int, int] = COOK_MEAN_RANGE, quick: str = TIME_CLASSES[0]) -> DataFrame:
    """The KPI row: totals, means and the share of quick recipes. An empty table gives zeros."""
    n = F.count("*")
    with_image = F.count_if("has_image")
    return main.agg(
        n.alias("total"),
        with_image.alias("with_image"),
        (n - with_image).alias("without_image"),
        F.count("mit_energy_kcal").alias("with_nutrition"),
        _or_zero(F.round(F.avg("mit_energy_kcal"))).alias("avg_kcal"),
        _or_zero(F.round(F.avg(F.when(F.col("cook_minutes").between(*cook_range), F.col("cook_minutes"))))).alias(
            "avg_cook"
        ),
        _or_zero(share(F.count_if(F.col("cook_time_category") == quick), n)).alias("pct_quick"),
    )


def most_frequent(main: DataFrame, column: str = "nutri_score", none: str = UNKNOWN) -> DataFrame:
    """The most frequent known value, ties by value; a placeholder row when none is known."""
    best = top_values(main.filter(F.col(column).isNotNull()), column, 1, "_n")
    return best.agg(F.coalesce(F.max(column), F.lit(none)).alias(f"top_{column}"))


def share_within(main: DataFrame, column: str = "nutri_score", among: Sequence[str] = ("A", "B")) -> DataFrame:
    """Percentage of the known values that are in the list; 0 when none is known."""
    hits = F.count_if(F.col(column).isin(list(among)))
    return main.agg(_or_zero(share(hits, F.count(column))).alias("pct"))


def rounded_mean(main: DataFrame, column: str = "n_steps") -> DataFrame:
    """Rounded mean; 0 for a missing column or no known value."""
    value = F.col(column) if column in main.columns else F.lit(None).cast("double")
    return main.agg(_or_zero(F.round(F.avg(value))).alias(f"avg_{column}"))


def catalog_stats(main: DataFrame, index: DataFrame, details: DataFrame) -> DataFrame:
    """Eight counts over the three tables as one row: one aggregate per table."""
    index_stats = index.agg(F.count("*").alias("rows"), F.count_distinct("ingredient").alias("items"))
    of_main = main.agg(
        F.count("*").alias("recipes_total"),
        F.count("nutri_score").alias("with_nutri_score"),
        F.count("mit_energy_kcal").alias("with_mit_energy"),
        F.count("kaggle_energy_kcal").alias("with_kaggle_energy"),
        F.count_if("has_image").alias("with_image"),
    )
    return of_main.select(
        "recipes_total",
        index_stats.select("rows").scalar().alias("index_rows"),
        details.agg(F.count("*").alias("rows")).scalar().alias("nutrition_rows"),
        index_stats.select("items").scalar().alias("unique_ingredients"),
        "with_nutri_score",
        "with_mit_energy",
        "with_kaggle_energy",
        "with_image",
    )


def table_stats(main: DataFrame, index: DataFrame, details: DataFrame) -> DataFrame:
    """One row per published table; counts that do not apply to a table are null. An image here is a known URL."""

    def row(df: DataFrame, name: str, **counts: Column) -> DataFrame:
        wanted = {c: counts.get(c, F.lit(None).cast("bigint")) for c in ("with_image", "with_score", "with_mit_energy")}
        return df.agg(F.count("*").alias("n_rows"), *(v.alias(c) for c, v in wanted.items())).select(
            F.lit(name).alias("table_name"), "n_rows", *wanted
        )

    return (
        row(
            main,
            "recipes_main",
            with_image=F.count("image_url"),
            with_score=F.count("nutri_score"),
            with_mit_energy=F.count("mit_energy_kcal"),
        )
        .union(row(index, "ingredients_index"))
        .union(row(details, "recipes_nutrition_detail"))
    )


def coverage_pct(df: DataFrame, columns: dict[str, str], digits: int = 1, total: str = "total_recipes") -> DataFrame:
    """Row count and the percentage of known values per column ({column: output name})."""
    n = F.count("*")
    return df.agg(n.alias(total), *(share(F.count(c), n, digits).alias(out) for c, out in columns.items()))


def known_by_column(df: DataFrame, digits: int = 2) -> DataFrame:
    """(column, percentage of known values) for every column, from one aggregate."""
    n = F.count("*")
    row = df.agg(*(share(F.count(F.col(f"`{c}`")), n, digits).alias(c) for c in df.columns))
    return row.unpivot([], row.columns, "column_name", "pct_known")


def completeness(main: DataFrame, details: DataFrame, key: str = "recipe_id") -> DataFrame:
    """Count and share of complete, usable and incomplete recipes; the first class that fits wins.

    Both sides are reduced to flags before the join, so only a key and two flags per recipe are shuffled.
    """
    of_main = main.select(key, all_present(main.columns).alias("_all"), usable().alias("_usable"))
    of_details = details.select(key, all_present(details.columns).alias("_macros"))
    status = (
        F.when(F.col("_all") & F.coalesce("_macros", F.lit(False)), F.lit(COMPLETE))
        .when(F.col("_usable"), F.lit(USABLE))
        .otherwise(F.lit(INCOMPLETE))
    )
    joined = with_details(of_main, of_details, key)
    classes = (COMPLETE, USABLE, INCOMPLETE)
    n = F.count("*")
    row = joined.select(status.alias("status")).agg(
        n.alias("_n"), *(F.count_if(F.col("status") == c).alias(f"_c{i}") for i, c in enumerate(classes))
    )
    pairs = [x for i, c in enumerate(classes) for x in (F.lit(c), F.col(f"_c{i}"))]
    long = row.select("_n", F.stack(F.lit(len(classes)), *pairs).alias("status", "count"))
    return long.filter(F.col("count") > 0).select(
        "status", "count", share(F.col("count"), F.col("_n"), 2).alias("percentage")
    )


def category_share(main: DataFrame, column: str = "nutri_score", digits: int = 2) -> DataFrame:
    """Rows per known category with their share of all rows, rows without a category included."""
    total = main.agg(F.count("*").alias("n")).scalar()
    counts = main.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))
    return counts.withColumn("percentage", share(F.col("count"), total, digits)).orderBy(column)


def class_profile(
    main: DataFrame,
    column: str = "cook_time_category",
    measure: str = "mit_energy_kcal",
    order: Sequence[str] = TIME_CLASSES,
    skip: str = TIME_MISSING,
    digits: int = 1,
) -> DataFrame:
    """Count and rounded mean per class, in a given order of classes; classes not listed come last."""
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), F.col(column)), F.lit(0)), F.lit(len(order) + 1))
    return (
        main.filter(F.col(column) != skip)
        .groupBy(column)
        .agg(F.count("*").alias("n_recipes"), F.round(F.avg(measure), digits).alias("mean_value"))
        .orderBy(rank, column)
    )


def numeric_summary(df: DataFrame) -> DataFrame:
    """count, mean, min and max of every column, as strings."""
    return df.summary("count", "mean", "min", "max")


def outliers(
    main: DataFrame,
    limits: dict[str, float] | None = None,
    order: str = "mit_energy_kcal",
    tie: str = "recipe_id",
    n: int = OUTLIER_ROWS,
    columns: Sequence[str] = ("title", "n_ingredients_validated", "mit_energy_kcal", "cook_minutes", "source_url"),
) -> DataFrame:
    """Implausible recipes, greatest energy first and unknown energy last."""
    return main.filter(outlying(limits)).orderBy(F.col(order).desc_nulls_last(), tie).limit(n).select(*columns)
