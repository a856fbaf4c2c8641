"""Predicates, orders, limits and samples."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from larder import schemas
from larder.constants import MACROS
from larder.operators import filters, lookup, profile
from larder.operators.charts import scatter_candidates
from larder.operators.dedupe import keep_one
from larder.operators.items import top_values, unnested
from larder.operators.joins import with_details
from larder.operators.sampling import fixed_sample
from larder.plans.ingest import stage_kaggle
from larder.session import scratch
from larder.sources.tables import export
from larder.workload import bindings as b
from larder.workload.registry import query, table

FULL_STATE = {"nutri_scores": ["A", "B"], "cook_cats": ["rapide", "long"], "kcal_min": 20, "kcal_max": 150}


@query("f1_any_macro_known", "SELECT * FROM details", b.WIDE, b.DETAILS)
def f1(spark, sf):
    return b.wide(spark, sf).select("recipe_id", *MACROS).filter(filters.any_present(MACROS))


@query("f2_no_blank_items", "SELECT ingredient, count(*) AS n FROM item_index GROUP BY 1", b.MAIN, b.INDEX)
def f2(spark, sf):
    return b.index(spark, sf).groupBy("ingredient").agg(F.count("*").alias("n"))


def _facet_query(name: str, facets: filters.Facets, where: str) -> None:
    sql = f"SELECT recipe_id, title FROM main WHERE {where}"

    @query(name, sql, b.MAIN)
    def run(spark, sf):
        return facets.apply(b.main(spark, sf)).select("recipe_id", "title")


_facet_query("f3_facet_score", filters.Facets(scores=["A", "C"]), "nutri_score IN ('A', 'C')")
_facet_query("f3_facet_class", filters.Facets(classes=["moyen"]), "cook_time_category = 'moyen'")
_facet_query("f3_facet_kcal_min", filters.Facets(kcal_min=100), "mit_energy_kcal >= 100")
_facet_query("f3_facet_kcal_max", filters.Facets(kcal_max=50.5), "mit_energy_kcal <= 50.5")
_ALL_FACETS = (
    "nutri_score IN ('A', 'B') AND cook_time_category IN ('rapide', 'long') AND mit_energy_kcal BETWEEN 20 AND 150"
)
_facet_query("f3_facet_all", filters.Facets.from_state(FULL_STATE), _ALL_FACETS)
_facet_query(
    "f4_untouched_state",
    filters.Facets.from_state({"nutri_scores": [], "cook_cats": None, "kcal_min": 0, "kcal_max": 3500}),
    "true",
)


@query("f5_substring", "SELECT recipe_id, title FROM main WHERE title ILIKE '%K 1%'", b.MAIN)
def f5(spark, sf):
    return b.main(spark, sf).filter(filters.holds_text("title", "K 1")).select("recipe_id", "title")


@query(
    "f5_substring_wildcards",
    "SELECT doc_id FROM documents WHERE text ILIKE '%the_and%of%'",
)
def f5_wildcards(spark, sf):
    return table(spark, sf, "documents").filter(filters.holds_text("text", "the_and%of")).select("doc_id")


@query(
    "f6_optional_arguments",
    "SELECT recipe_id FROM main WHERE title ILIKE '%view%' AND cook_minutes <= 40 AND nutri_score = 'A'",
    b.MAIN,
)
def f6(spark, sf):
    wanted = lookup.advanced_predicate(name="view", max_time=40, nutri_score="A")
    return b.main(spark, sf).filter(wanted).select("recipe_id")


@query("f6_zero_time_is_absent", "SELECT recipe_id FROM main WHERE nutri_score = 'B'", b.MAIN)
def f6_zero(spark, sf):
    return b.main(spark, sf).filter(lookup.advanced_predicate(max_time=0, nutri_score="B")).select("recipe_id")


_MASTER = (*schemas.RECIPES_MAIN.names, *MACROS)


@query(
    "f7_all_columns_known",
    f"""SELECT recipe_id FROM main LEFT JOIN details USING (recipe_id)
      WHERE {" AND ".join(f"{c} IS NOT NULL" for c in _MASTER)}""",
    b.MAIN,
    b.DETAILS,
)
def f7(spark, sf):
    master = with_details(b.main(spark, sf), b.details(spark, sf))
    return master.filter(filters.all_present(master.columns)).select("recipe_id")


@query(
    "f8_usable",
    "SELECT recipe_id FROM main WHERE has_image AND mit_energy_kcal IS NOT NULL AND n_ingredients_validated > 0",
    b.MAIN,
)
def f8(spark, sf):
    return b.main(spark, sf).filter(filters.usable()).select("recipe_id")


LIMITS = {"n_ingredients_validated": 40, "mit_energy_kcal": 250, "cook_minutes": 97}


@query(
    "f9_outliers",
    "SELECT recipe_id FROM main WHERE n_ingredients_validated > 40 OR mit_energy_kcal > 250 OR cook_minutes > 97",
    b.MAIN,
)
def f9(spark, sf):
    return b.main(spark, sf).filter(filters.outlying(LIMITS)).select("recipe_id")


@query(
    "f10_point_lookup",
    "SELECT recipe_id, title, source_url FROM main WHERE recipe_id = '123'",
    b.MAIN,
)
def f10(spark, sf):
    return lookup.record(b.main(spark, sf), "recipe_id", "123").select("recipe_id", "title", "source_url")


@query(
    "f11_ranges",
    """SELECT count(*) FILTER (WHERE cook_minutes BETWEEN 1 AND 300) AS in_curve,
      count(*) FILTER (WHERE mit_energy_kcal < 3500) AS below_cap,
      count(*) FILTER (WHERE cook_minutes BETWEEN 30 AND 60) AS both_ends FROM main""",
    b.MAIN,
)
def f11(spark, sf):
    return b.main(spark, sf).agg(
        F.count_if(F.col("cook_minutes").between(1, 300)).alias("in_curve"),
        F.count_if(F.col("mit_energy_kcal") < 3500).alias("below_cap"),
        F.count_if(F.col("cook_minutes").between(30, 60)).alias("both_ends"),
    )


@query(
    "f12_membership",
    "SELECT recipe_id, cook_time_category FROM main WHERE cook_time_category IN ('rapide', 'moyen', 'long')",
    b.MAIN,
)
def f12(spark, sf):
    known = F.col("cook_time_category").isin("rapide", "moyen", "long")
    return b.main(spark, sf).filter(known).select("recipe_id", "cook_time_category")


@query(
    "f13_no_empty_keys",
    f"""SELECT {b.KEY_SQL.format("CASE WHEN c_acctbal < 0 THEN '!?' ELSE c_mktsegment || ' ' || c_nationkey END")} AS title_norm,
      min(c_custkey) AS first_id FROM customer WHERE c_acctbal >= 0 GROUP BY 1""",
)
def f13(spark, sf):
    named = F.when(F.col("c_acctbal") < 0, "!?").otherwise(F.concat_ws(" ", "c_mktsegment", "c_nationkey"))
    raw = b.raw_kaggle(spark, sf).drop("name")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"), named.alias("name"))
    staged = stage_kaggle(raw.join(customers, "id"))
    return staged.select("title_norm", F.col("kaggle_id").cast("bigint").alias("first_id"))


@query(
    "f14_item_length_floor",
    """SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) w
      WHERE length(trim(word)) > 1 GROUP BY word""",
)
def f14(spark, sf):
    words = unnested(table(spark, sf, "documents").select(F.split("text", " ").alias("w")), "w", "word", keep=[])
    return words.filter(filters.long_enough("word")).groupBy("word").agg(F.count("*").alias("n"))


@query(
    "l1_top_by_count",
    "SELECT p_name, count(*) AS freq FROM part GROUP BY p_name ORDER BY freq DESC, p_name LIMIT 15",
)
def l1(spark, sf):
    return top_values(table(spark, sf, "part"), "p_name", 15)


def _numbered(ordered, *columns):
    """The rows with their place in the delivered order, one for each group."""
    place = F.row_number().over(Window.orderBy("_at"))
    return ordered.withColumn("_at", F.monotonically_increasing_id()).select(*columns, place.alias("place"))


@query(
    "l2_order_by_key",
    """SELECT nutri_score, count(*) AS n, CAST(row_number() OVER (ORDER BY nutri_score) AS INTEGER) AS place
      FROM main WHERE nutri_score IS NOT NULL GROUP BY 1""",
    b.MAIN,
)
def l2(spark, sf):
    known = b.main(spark, sf).filter(F.col("nutri_score").isNotNull())
    return _numbered(known.groupBy("nutri_score").agg(F.count("*").alias("n")).orderBy("nutri_score"), "nutri_score", "n")


@query(
    "l3_custom_order",
    """SELECT cook_time_category, count(*) AS n_recipes, CAST(row_number() OVER (ORDER BY CASE cook_time_category
        WHEN 'rapide' THEN 1 WHEN 'moyen' THEN 2 ELSE 3 END) AS INTEGER) AS place
      FROM main WHERE cook_time_category <> 'inconnu' GROUP BY 1""",
    b.MAIN,
)
def l3(spark, sf):
    return _numbered(profile.class_profile(b.main(spark, sf)), "cook_time_category", "n_recipes")


@query(
    "l4_desc_nulls_last_limit",
    """SELECT recipe_id, coalesce(mit_energy_kcal, -1) AS kcal FROM main
      WHERE n_ingredients_validated > 40 OR mit_energy_kcal > 250 OR cook_minutes > 97
      ORDER BY mit_energy_kcal DESC NULLS LAST, recipe_id LIMIT 50""",
    b.MAIN,
)
def l4(spark, sf):
    top = profile.outliers(b.main(spark, sf), LIMITS, columns=["recipe_id", "mit_energy_kcal"])
    return top.select("recipe_id", F.coalesce("mit_energy_kcal", F.lit(-1.0)).alias("kcal"))


@query("l5_limit", "SELECT recipe_id, title FROM main ORDER BY recipe_id LIMIT 20", b.MAIN)
def l5(spark, sf):
    return lookup.by_name(b.main(spark, sf), "", 20, order_by="recipe_id").select("recipe_id", "title")


@query(
    "l6_fixed_sample",
    "SELECT recipe_id, title FROM main WHERE has_image ORDER BY md5('7:' || recipe_id), recipe_id LIMIT 500",
    b.MAIN,
)
def l6(spark, sf):
    return fixed_sample(b.main(spark, sf).filter("has_image").select("recipe_id", "title"), 500, seed=7)


@query(
    "l6_sample_of_join",
    """SELECT recipe_id, saturates_g, sugars_g FROM details JOIN main USING (recipe_id)
      WHERE saturates_g BETWEEN 0 AND 60 AND sugars_g BETWEEN 0 AND 100 AND nutri_score IS NOT NULL
      ORDER BY md5('0:' || recipe_id), recipe_id LIMIT 2000""",
    b.MAIN,
    b.DETAILS,
)
def l6_join(spark, sf):
    rows = scatter_candidates(b.details(spark, sf), b.main(spark, sf))
    return fixed_sample(rows.select("recipe_id", "saturates_g", "sugars_g"), 2000)


@query("l7_first_row", "SELECT recipe_id, title FROM main ORDER BY recipe_id LIMIT 1", b.MAIN)
def l7(spark, sf):
    return b.main(spark, sf).select("recipe_id", "title").orderBy("recipe_id").limit(1)


@query("l8_sorted_within_files", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_unsorted FROM events")
def l8(spark, sf):
    """Rows of each written file in the order of its row numbers: none may come before its predecessor."""
    events = table(spark, sf, "events").select("event_id", "event_type").sortWithinPartitions("event_type", "event_id")
    written = export(events, scratch(spark, "l8"))
    row = F.struct("event_type", "event_id")
    rows = written.select("event_type", "event_id", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
    before = F.lag(row).over(Window.partitionBy("file").orderBy("at"))
    return rows.select((before > row).alias("late")).agg(
        F.count("*").alias("n"), F.count_if(F.coalesce("late", F.lit(False))).alias("n_unsorted")
    )


@query(
    "d1_keep_one",
    """SELECT p_name, p_partkey, p_retailprice FROM part
      QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_retailprice, p_partkey) = 1""",
)
def d1(spark, sf):
    parts = table(spark, sf, "part").select("p_name", "p_partkey", "p_retailprice")
    return keep_one(parts, ["p_name"], ["p_retailprice"])


@query(
    "d1_keep_one_text",
    """SELECT min(doc_id) AS doc_id, md5(text) AS digest FROM documents GROUP BY text""",
)
def d1_text(spark, sf):
    docs = table(spark, sf, "documents").select("text", "doc_id")
    return keep_one(docs, ["text"]).select("doc_id", F.md5("text").alias("digest"))


@query(
    "d2_first_seen",
    f"""SELECT {b.KEY_SQL.format("'Src' || c_nationkey || ' fr?'")} AS title_norm, CAST(min(c_custkey) AS VARCHAR) AS kaggle_id
      FROM customer GROUP BY 1""",
)
def d2(spark, sf):
    return stage_kaggle(b.raw_kaggle(spark, sf)).select("title_norm", "kaggle_id")


@query(
    "w1_latest_per_user",
    """SELECT user_id, event_id, event_type FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def w1(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    return keep_one(events, ["user_id"], ["ts", "event_id"], prefer="max").select("user_id", "event_id", "event_type")
