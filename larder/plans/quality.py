"""The data-quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame

from larder.constants import MACROS
from larder.operators import profile
from larder.operators.items import top_index_items


def quality_report(main: DataFrame, index: DataFrame, details: DataFrame) -> dict[str, DataFrame]:
    return {
        "completeness": profile.completeness(main, details),
        "known_by_column": profile.known_by_column(main),
        "score_share": profile.category_share(main),
        "top_ingredients": top_index_items(index),
        "time_profile": profile.class_profile(main),
        "macro_summary": profile.numeric_summary(details.select("recipe_id", *MACROS)),
        "outliers": profile.outliers(main),
    }
