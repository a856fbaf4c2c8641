"""KPIs, charts and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.constants import COMPLETE, INCOMPLETE, MACROS, USABLE
from larder.operators import charts, items, profile
from larder.operators.dedupe import distinct_keys
from larder.operators.filters import Facets
from larder.plans.serving import category_charts
from larder.workload import bindings as b
from larder.workload.registry import query, table

FACETS = Facets(scores=["A", "B"], classes=["rapide", "moyen"], kcal_min=10, kcal_max=140)
WHERE = "nutri_score IN ('A', 'B') AND cook_time_category IN ('rapide', 'moyen') AND mit_energy_kcal BETWEEN 10 AND 140"


def _pct(part: str, whole: str, digits: int) -> str:
    return f"CAST(round(CAST(100.0 * ({part}) / ({whole}) AS DECIMAL(18, 9)), {digits}) AS DOUBLE)"


@query(
    "a1_kpis",
    f"""SELECT count(*) AS total, count(*) FILTER (WHERE has_image) AS with_image,
      count(*) FILTER (WHERE NOT has_image) AS without_image, count(mit_energy_kcal) AS with_nutrition,
      round(avg(mit_energy_kcal)) AS avg_kcal, round(avg(cook_minutes) FILTER (WHERE cook_minutes BETWEEN 1 AND 600)) AS avg_cook,
      {_pct("count(*) FILTER (WHERE cook_time_category = 'rapide')", "count(*)", 0)} AS pct_quick FROM main""",
    b.MAIN,
)
def a1(spark, sf):
    return profile.kpis(b.main(spark, sf))


@query(
    "a2_most_frequent_score",
    """SELECT nutri_score AS top_nutri_score FROM main WHERE nutri_score IS NOT NULL
      GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1""",
    b.MAIN,
)
def a2(spark, sf):
    return profile.most_frequent(b.main(spark, sf))


@query(
    "a3_share_within",
    f"SELECT {_pct('''count(*) FILTER (WHERE nutri_score IN ('A', 'B'))''', 'count(nutri_score)', 0)} AS pct FROM main",
    b.MAIN,
)
def a3(spark, sf):
    return profile.share_within(b.main(spark, sf))


@query("a4_mean_steps", "SELECT round(avg(n_steps)) AS avg_n_steps FROM main", b.MAIN)
def a4(spark, sf):
    return profile.rounded_mean(b.main(spark, sf))


@query(
    "a4_mean_of_missing_column",
    "SELECT CAST(0 AS DOUBLE) AS avg_n_absent, count(*) AS n FROM events",
)
def a4_missing(spark, sf):
    events = table(spark, sf, "events")
    mean = profile.rounded_mean(events, "n_absent")
    return mean.withColumn("n", events.agg(F.count("*")).scalar())


@query(
    "a5_score_counts",
    "SELECT nutri_score AS score, count(*) AS count FROM main WHERE nutri_score IS NOT NULL GROUP BY 1",
    b.MAIN,
)
def a5(spark, sf):
    return charts.score_counts(b.main(spark, sf))


@query(
    "a5_score_counts_faceted",
    f"SELECT nutri_score AS score, count(*) AS count FROM main WHERE {WHERE} GROUP BY 1",
    b.MAIN,
)
def a5_faceted(spark, sf):
    return charts.score_counts(b.main(spark, sf), FACETS)


_DOMAIN = "(VALUES ('rapide'), ('moyen'), ('long')) d(cook_time_category)"


@query(
    "a6_fixed_domain_counts",
    f"""SELECT d.cook_time_category, count(m.recipe_id) AS count FROM {_DOMAIN}
      LEFT JOIN (SELECT * FROM main WHERE {WHERE}) m ON m.cook_time_category = d.cook_time_category GROUP BY 1""",
    b.MAIN,
)
def a6(spark, sf):
    return charts.class_counts(b.main(spark, sf), FACETS)


_BUCKET = "CAST(floor(cook_minutes / 5) * 5 AS BIGINT)"


@query(
    "a7_bucketed_distribution",
    f"SELECT {_BUCKET} AS bucket, count(*) AS count FROM main WHERE cook_minutes BETWEEN 1 AND 300 GROUP BY 1",
    b.MAIN,
)
def a7(spark, sf):
    return charts.cook_curve(b.main(spark, sf))


_HISTOGRAM = """vals AS (SELECT mit_energy_kcal AS x FROM main WHERE mit_energy_kcal < 3500 AND {where}),
  bounds AS (SELECT min(x) AS low, (max(x) - min(x)) / 60.0::DOUBLE AS width FROM vals)"""
_HISTOGRAM_BODY = """SELECT CAST(least(floor((x - low) / width), 59) AS INTEGER) AS bin,
  low + bin * width AS bin_start, low + (bin + 1) * width AS bin_end, count(*) AS count
  FROM vals, bounds GROUP BY bin, low, width"""


@query("a8_histogram", _HISTOGRAM_BODY, b.MAIN, _HISTOGRAM.format(where="true"))
def a8(spark, sf):
    return charts.histogram(b.main(spark, sf))


@query("a8_histogram_faceted", _HISTOGRAM_BODY, b.MAIN, _HISTOGRAM.format(where=WHERE))
def a8_faceted(spark, sf):
    return charts.histogram(b.main(spark, sf), FACETS)


_TOTALS = ", ".join(f"round(sum({m}), 4) AS {m}" for m in MACROS)


@query("a9_macro_totals", f"SELECT {_TOTALS} FROM details", b.WIDE, b.DETAILS)
def a9(spark, sf):
    totals = charts.macro_totals(b.details(spark, sf), b.main(spark, sf))
    return totals.select(*(F.round(c, 4).alias(c) for c in totals.columns))


@query("a9_macro_totals_faceted", f"SELECT {_TOTALS} FROM details JOIN main USING (recipe_id) WHERE {WHERE}", b.MAIN, b.DETAILS)
def a9_faceted(spark, sf):
    totals = charts.macro_totals(b.details(spark, sf), b.main(spark, sf), FACETS)
    return totals.select(*(F.round(c, 4).alias(c) for c in totals.columns))


_SLICES = " UNION ALL ".join(f"SELECT '{m}' AS macro, round(sum({m}), 4) AS total FROM details" for m in MACROS)


@query("a9_macro_slices", _SLICES, b.WIDE, b.DETAILS)
def a9_slices(spark, sf):
    slices = charts.macro_slices(charts.macro_totals(b.details(spark, sf), b.main(spark, sf)))
    return slices.select("macro", F.round("total", 4).alias("total"))


def _top(column: str, where: str) -> str:
    return f"""SELECT item, count(*) AS freq FROM (SELECT unnest({column}) AS item FROM main WHERE {where}) u
      WHERE length(trim(item)) > 1 GROUP BY item ORDER BY freq DESC, item LIMIT 15"""


@query("a10_top_ingredients", _top("ingredients_validated", "true"), b.MAIN)
def a10(spark, sf):
    return charts.top_items(b.main(spark, sf), "ingredients_validated")


@query("a10_top_tags_faceted", _top("tags", WHERE), b.MAIN)
def a10_tags(spark, sf):
    return charts.top_items(b.main(spark, sf), "tags", FACETS)


@query(
    "a10_top_words",
    """SELECT item, count(*) AS freq FROM (SELECT unnest(string_split(text, ' ')) AS item FROM documents) u
      WHERE length(trim(item)) > 1 GROUP BY item ORDER BY freq DESC, item LIMIT 15""",
)
def a10_words(spark, sf):
    return charts.top_items(table(spark, sf, "documents").select(F.split("text", " ").alias("words")), "words")


@query(
    "a11_top_index_items",
    "SELECT ingredient, count(*) AS count FROM item_index GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30",
    b.MAIN,
    b.INDEX,
)
def a11(spark, sf):
    return items.top_index_items(b.index(spark, sf))


@query(
    "a12_item_catalog",
    "SELECT ingredient, count(DISTINCT recipe_id) AS recipe_count FROM item_index GROUP BY 1",
    b.MAIN,
    b.INDEX,
)
def a12(spark, sf):
    return items.item_catalog(b.index(spark, sf))


@query(
    "a13_catalog_stats",
    """SELECT count(*) AS recipes_total, (SELECT count(*) FROM item_index) AS index_rows,
      (SELECT count(*) FROM details) AS nutrition_rows, (SELECT count(DISTINCT ingredient) FROM item_index) AS unique_ingredients,
      count(nutri_score) AS with_nutri_score, count(mit_energy_kcal) AS with_mit_energy,
      count(kaggle_energy_kcal) AS with_kaggle_energy, count(*) FILTER (WHERE has_image) AS with_image FROM main""",
    b.MAIN,
    b.INDEX,
    b.DETAILS,
)
def a13(spark, sf):
    return profile.catalog_stats(b.main(spark, sf), b.index(spark, sf), b.details(spark, sf))


_TABLE_STATS = """SELECT 'recipes_main' AS table_name, count(*) AS n_rows, count(image_url) AS with_image,
    count(nutri_score) AS with_score, count(mit_energy_kcal) AS with_mit_energy FROM main
  UNION ALL SELECT 'ingredients_index', count(*), -1, -1, -1 FROM item_index
  UNION ALL SELECT 'recipes_nutrition_detail', count(*), -1, -1, -1 FROM details"""


@query("a14_table_stats", _TABLE_STATS, b.MAIN, b.INDEX, b.DETAILS)
def a14(spark, sf):
    stats = profile.table_stats(b.main(spark, sf), b.index(spark, sf), b.details(spark, sf))
    return stats.na.fill(-1)


@query(
    "a15_coverage",
    f"""SELECT count(*) AS total_recipes, {_pct('count(image_url)', 'count(*)', 1)} AS pct_image,
      {_pct('count(mit_energy_kcal)', 'count(*)', 1)} AS pct_mit_energy FROM main""",
    b.MAIN,
)
def a15(spark, sf):
    return profile.coverage_pct(b.main(spark, sf), {"image_url": "pct_image", "mit_energy_kcal": "pct_mit_energy"})


_MAIN_COLUMNS = (
    "recipe_id title description instructions_text ingredients_raw ingredients_validated n_ingredients_validated n_steps "
    "cook_minutes cook_time_category image_url image_urls has_image source_url mit_energy_kcal kaggle_energy_kcal "
    "nutri_score tags"
).split()


@query(
    "a16_known_by_column",
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, {_pct(f'count({c})', 'count(*)', 2)} AS pct_known FROM main" for c in _MAIN_COLUMNS),
    b.MAIN,
)
def a16(spark, sf):
    return profile.known_by_column(b.main(spark, sf))


_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in [*_MAIN_COLUMNS, *MACROS])


@query(
    "a17_completeness",
    f"""SELECT status, count(*) AS count, {_pct('count(*)', '(SELECT count(*) FROM main)', 2)} AS percentage FROM (
      SELECT CASE WHEN {_COMPLETE} THEN '{COMPLETE}'
        WHEN has_image AND mit_energy_kcal IS NOT NULL AND n_ingredients_validated > 0 THEN '{USABLE}'
        ELSE '{INCOMPLETE}' END AS status FROM main LEFT JOIN details USING (recipe_id)) s GROUP BY status""",
    b.MAIN,
    b.DETAILS,
)
def a17(spark, sf):
    return profile.completeness(b.main(spark, sf), b.details(spark, sf))


@query(
    "a18_category_share",
    f"""SELECT nutri_score, count(*) AS count, {_pct('count(*)', '(SELECT count(*) FROM main)', 2)} AS percentage
      FROM main WHERE nutri_score IS NOT NULL GROUP BY nutri_score""",
    b.MAIN,
)
def a18(spark, sf):
    return profile.category_share(b.main(spark, sf))


@query(
    "a19_class_profile",
    """SELECT cook_time_category, count(*) AS n_recipes, round(avg(mit_energy_kcal), 1) AS mean_value
      FROM main WHERE cook_time_category <> 'inconnu' GROUP BY 1""",
    b.MAIN,
)
def a19(spark, sf):
    return profile.class_profile(b.main(spark, sf))


_SUMMARY = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean, min({c}) AS low, max({c}) AS high FROM details"
    for c in MACROS
)


@query("a20_numeric_summary", _SUMMARY, b.WIDE, b.DETAILS)
def a20(spark, sf):
    summary = profile.numeric_summary(b.details(spark, sf).select(*MACROS))
    long = summary.unpivot("summary", list(MACROS), "column_name", "v").withColumn("v", F.col("v").cast("double"))

    def of(what: str) -> F.Column:
        return F.max(F.when(F.col("summary") == what, F.col("v")))

    return long.groupBy("column_name").agg(
        of("count").cast("bigint").alias("n"), F.round(of("mean"), 4).alias("mean"), of("min").alias("low"), of("max").alias("high")
    )


@query(
    "a21_owners_of_all",
    """SELECT recipe_id FROM item_index WHERE ingredient IN ('click', 'user 7') GROUP BY recipe_id
      HAVING count(DISTINCT ingredient) = 2""",
    b.MAIN,
    b.INDEX,
)
def a21(spark, sf):
    return items.owners_of_all(b.index(spark, sf), ["click", "user 7"])


_WORDS_OF_DOCS = "words AS (SELECT doc_id, lower(trim(unnest(string_split(text, ' ')))) AS ingredient FROM documents)"


@query(
    "a21_documents_with_all_words",
    """SELECT doc_id FROM words WHERE ingredient IN ('the', 'and', 'of') GROUP BY doc_id HAVING count(DISTINCT ingredient) = 3""",
    _WORDS_OF_DOCS,
)
def a21_words(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.split("text", " ").alias("words"))
    index = items.inverted_index(docs, "words", carry=["doc_id"])
    return items.owners_of_all(index, ["the", "and", "of", "the"], owner="doc_id")


@query(
    "a21_owners_of_any",
    "SELECT DISTINCT recipe_id FROM item_index WHERE ingredient IN ('item 3', 'user 7')",
    b.MAIN,
    b.INDEX,
)
def a21_any(spark, sf):
    return items.owners_of_any(b.index(spark, sf), ["item 3", "user 7"])


@query(
    "a22_distinct_keys",
    "SELECT count(*) AS n_rows, count(DISTINCT p_name) AS n_keys, count(*) = count(DISTINCT p_name) AS is_unique FROM part",
)
def a22(spark, sf):
    return distinct_keys(table(spark, sf, "part"), "p_name")


@query(
    "e5_category_charts",
    f"""SELECT 'score' AS chart, nutri_score AS label, CAST(count(*) AS BIGINT) AS count FROM main WHERE {WHERE} GROUP BY 2
      UNION ALL SELECT 'time', cook_time_category, count(*) FROM main
        WHERE {WHERE} AND cook_time_category IN ('rapide', 'moyen', 'long') GROUP BY 2
      UNION ALL SELECT 'curve', CAST({_BUCKET} AS VARCHAR), count(*) FROM main WHERE {WHERE} AND cook_minutes BETWEEN 1 AND 300 GROUP BY 2""",
    b.MAIN,
)
def e5(spark, sf):
    return category_charts(b.main(spark, sf), FACETS)
