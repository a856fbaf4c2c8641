"""The compositions, run from raw files that are written from the given tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from larder import schemas
from larder.constants import KCAL_BINS, MACROS, OUTLIER_ITEMS, OUTLIER_KCAL, OUTLIER_MINUTES, OUTLIER_ROWS
from larder.operators.charts import macro_slices
from larder.operators.profile import COMPLETE, INCOMPLETE, USABLE
from larder.plans import ingest, publish
from larder.plans.assemble import assemble, read_staging
from larder.plans.quality import quality_report
from larder.plans.serving import dashboard
from larder.session import concurrently, scratch
from larder.sources.tables import write_staging
from larder.workload import bindings as b
from larder.workload.registry import query


def _write_raw(spark, sf: str) -> str:
    root = scratch(spark, "raw")
    for name, resource in ingest.RESOURCES.items():
        raw, path = b.RAW[name](spark, sf), f"{root}/{resource.file}"
        if resource.is_csv:
            raw.write.option("header", True).option("escape", '"').option("compression", "gzip").csv(path)
        else:
            raw.write.option("compression", "gzip").json(path)
    return root


def _write_staging(spark, sf: str) -> str:
    root = scratch(spark, "staging")
    staged = {name: resource.stage(b.RAW[name](spark, sf)) for name, resource in ingest.RESOURCES.items()}
    concurrently(spark, [partial(write_staging, df, f"{root}/{name}") for name, df in staged.items()])
    return root


_STAGED = """SELECT 'layer1' AS resource, count(*) AS n_rows, count(DISTINCT id) AS n_keys FROM layer1
  UNION ALL SELECT 'layer2', count(*), count(DISTINCT id) FROM layer2
  UNION ALL SELECT 'det_ingrs', count(*), count(DISTINCT id) FROM det_ingrs
  UNION ALL SELECT 'nutrition', (SELECT count(*) FROM events), count(*) FROM nutrition
  UNION ALL SELECT 'kaggle', count(*), count(DISTINCT title_norm) FROM kaggle"""


@query("e1_ingest", _STAGED, b.STAGING)
def e1(spark, sf):
    staging = scratch(spark, "staging")
    ingest.ingest(spark, _write_raw(spark, sf), staging, layout="lines")
    counts = None
    for name, df in read_staging(spark, staging).items():
        key = "id" if "id" in df.columns else "title_norm"
        row = df.agg(F.lit(name).alias("resource"), F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_keys"))
        counts = row if counts is None else counts.union(row)
    return counts


_PUBLISHED = f"""SELECT id AS recipe_id, title, coalesce(description, '') AS description, md5(instructions_text) AS steps,
  CAST(len(ingredients_raw) AS INTEGER) AS n_raw, md5(coalesce(array_to_string(ingredients_validated, '|'), '')) AS items,
  CAST(coalesce(len(ingredients_validated), 0) AS INTEGER) AS n_ingredients_validated, n_steps,
  CAST(coalesce(cook_minutes, -1) AS INTEGER) AS cook_minutes, {b.TIME_SQL.format('cook_minutes')} AS cook_time_category,
  coalesce(image_url, '') AS image_url, coalesce(has_image, false) AS has_image, url AS source_url,
  coalesce(mit_energy_kcal, -1) AS mit_energy_kcal, coalesce(kaggle_energy_kcal, -1) AS kaggle_energy_kcal,
  coalesce({b.SCORE_SQL.format('mit_energy_kcal')}, 'none') AS nutri_score, coalesce(array_to_string(tags, '|'), '') AS tag_list
  FROM assembled"""


def _main_digest(main):
    none = F.lit(-1.0)
    return main.select(
        "recipe_id",
        "title",
        F.coalesce("description", F.lit("")).alias("description"),
        F.md5("instructions_text").alias("steps"),
        F.size("ingredients_raw").alias("n_raw"),
        F.md5(F.coalesce(F.array_join("ingredients_validated", "|"), F.lit(""))).alias("items"),
        "n_ingredients_validated",
        "n_steps",
        F.coalesce("cook_minutes", F.lit(-1)).alias("cook_minutes"),
        "cook_time_category",
        F.coalesce("image_url", F.lit("")).alias("image_url"),
        "has_image",
        "source_url",
        F.coalesce("mit_energy_kcal", none).alias("mit_energy_kcal"),
        F.coalesce("kaggle_energy_kcal", none).alias("kaggle_energy_kcal"),
        F.coalesce("nutri_score", F.lit("none")).alias("nutri_score"),
        F.array_join("tags", "|").alias("tag_list"),
    )


@query("e2_transform_main", _PUBLISHED, b.STAGING)
def e2_main(spark, sf):
    catalog = publish.transform(spark, _write_staging(spark, sf), scratch(spark, "out"))
    return _main_digest(catalog.read(spark)[0])


@query(
    "e2_transform_index",
    """SELECT ingredient, count(*) AS n, count(DISTINCT id) AS n_recipes FROM (
      SELECT id, lower(trim(unnest(ingredients_validated))) AS ingredient FROM assembled) u WHERE ingredient <> '' GROUP BY 1""",
    b.STAGING,
)
def e2_index(spark, sf):
    catalog = publish.transform(spark, _write_staging(spark, sf), scratch(spark, "out"))
    index = catalog.read(spark)[1]
    return index.groupBy("ingredient").agg(F.count("*").alias("n"), F.count_distinct("recipe_id").alias("n_recipes"))


@query("e3_run_main", _PUBLISHED, b.STAGING)
def e3(spark, sf):
    catalog = publish.run(spark, _write_raw(spark, sf), scratch(spark, "staging"), scratch(spark, "out"), layout="lines")
    return _main_digest(catalog.read(spark)[0])


@query(
    "e3_run_nutrition_detail",
    "SELECT id AS recipe_id, fat_g, protein_g, salt_g, saturates_g, sugars_g FROM assembled WHERE mit_energy_kcal IS NOT NULL",
    b.STAGING,
)
def e3_details(spark, sf):
    catalog = publish.run(spark, _write_raw(spark, sf), scratch(spark, "staging"), scratch(spark, "out"), layout="lines")
    return catalog.read(spark)[2].select("recipe_id", *MACROS)


@query(
    "e3_append_is_idempotent",
    "SELECT count(*) AS n_recipes, count(image_url) AS n_images, count(mit_energy_kcal) AS n_kcal, count(kaggle_energy_kcal) AS n_kaggle FROM assembled",
    b.STAGING,
)
def e3_append(spark, sf):
    staging, raw = scratch(spark, "staging"), _write_raw(spark, sf)
    for _ in range(2):
        ingest.ingest(spark, raw, staging, "append", "lines")
    wide = assemble(read_staging(spark, staging))
    return wide.agg(
        F.count("*").alias("n_recipes"),
        F.count("image_url").alias("n_images"),
        F.count("mit_energy_kcal").alias("n_kcal"),
        F.count("kaggle_energy_kcal").alias("n_kaggle"),
    )


@query(
    "e4_info",
    """SELECT 'recipes_main' AS table_name, count(*) AS n_rows, count(image_url) AS with_image,
        count(mit_energy_kcal) AS with_score, count(mit_energy_kcal) AS with_mit_energy FROM assembled
      UNION ALL SELECT 'ingredients_index', count(*), -1, -1, -1 FROM (
        SELECT lower(trim(unnest(ingredients_validated))) AS i FROM assembled) u WHERE i <> ''
      UNION ALL SELECT 'recipes_nutrition_detail', count(*), -1, -1, -1 FROM assembled WHERE mit_energy_kcal IS NOT NULL""",
    b.STAGING,
)
def e4(spark, sf):
    catalog = publish.transform(spark, _write_staging(spark, sf), scratch(spark, "out"))
    return publish.info(spark, catalog.root).na.fill(-1)


STATE = {"nutri_scores": ["A", "B", "C"], "cook_cats": ["rapide", "moyen"], "kcal_min": 0, "kcal_max": 200}
_STATE_SQL = "nutri_score IN ('A', 'B', 'C') AND cook_time_category IN ('rapide', 'moyen') AND mit_energy_kcal <= 200"


def _scatter_label():
    """The first digit of a digest of the drawn point, so that a count of points depends on their values."""
    hundredths = [F.round(F.col(c) * 100).cast("bigint").cast("string") for c in ("saturates_g", "sugars_g")]
    return F.substring(F.md5(F.concat_ws("|", "title", "nutri_score", *hundredths)), 1, 1)


@query(
    "e5_dashboard",
    f"""SELECT 'class' AS chart, d.c AS label, count(m.recipe_id) AS count FROM (VALUES ('rapide'), ('moyen'), ('long')) d(c)
        LEFT JOIN (SELECT * FROM main WHERE {_STATE_SQL}) m ON m.cook_time_category = d.c GROUP BY 2
      UNION ALL SELECT 'score', nutri_score, count(*) FROM main WHERE {_STATE_SQL} GROUP BY 2
      UNION ALL SELECT 'curve', CAST(CAST(floor(cook_minutes / 5) * 5 AS BIGINT) AS VARCHAR), count(*) FROM main
        WHERE {_STATE_SQL} AND cook_minutes BETWEEN 1 AND 300 GROUP BY 2
      UNION ALL (SELECT 'ingredient', item, count(*) AS n FROM (
        SELECT unnest(ingredients_validated) AS item FROM main WHERE {_STATE_SQL}) u
        WHERE length(trim(item)) > 1 GROUP BY 2 ORDER BY n DESC, item LIMIT 15)
      UNION ALL (SELECT 'tag', item, count(*) AS n FROM (SELECT unnest(tags) AS item FROM main WHERE {_STATE_SQL}) u
        WHERE length(trim(item)) > 1 GROUP BY 2 ORDER BY n DESC, item LIMIT 15)
      UNION ALL SELECT 'kcal', CAST(CAST(CASE WHEN high > low THEN least(floor((mit_energy_kcal - low) / ((high - low) / {KCAL_BINS}.0)), {KCAL_BINS - 1})
          ELSE 0 END AS INTEGER) AS VARCHAR), count(*)
        FROM (SELECT mit_energy_kcal, min(mit_energy_kcal) OVER () AS low, max(mit_energy_kcal) OVER () AS high
          FROM main WHERE {_STATE_SQL} AND mit_energy_kcal < 3500) h GROUP BY 2
      UNION ALL SELECT 'macro', macro, CAST(round(total) AS BIGINT) FROM (
        SELECT unnest(['fat_g', 'protein_g', 'salt_g', 'saturates_g', 'sugars_g']) AS macro,
          unnest([sum(fat_g), sum(protein_g), sum(salt_g), sum(saturates_g), sum(sugars_g)]) AS total
        FROM details JOIN (SELECT recipe_id FROM main WHERE {_STATE_SQL}) k USING (recipe_id)) t
      UNION ALL SELECT 'scatter', label, count(*) FROM (
        SELECT substr(md5(concat_ws('|', title, nutri_score, CAST(round(saturates_g * 100) AS BIGINT), CAST(round(sugars_g * 100) AS BIGINT))), 1, 1) AS label
        FROM details JOIN main USING (recipe_id) WHERE {_STATE_SQL} AND saturates_g BETWEEN 0 AND 60 AND sugars_g BETWEEN 0 AND 100
        ORDER BY md5('0:' || recipe_id), recipe_id LIMIT 2000) s GROUP BY 2""",
    b.MAIN,
    b.DETAILS,
)
def e5(spark, sf):
    page = dashboard(b.main(spark, sf), b.details(spark, sf), STATE)

    def rows(chart: str, name: str, label: str, count: str = "count"):
        return page[name].select(
            F.lit(chart).alias("chart"), F.col(label).cast("string").alias("label"), F.col(count).alias("count")
        )

    return (
        rows("class", "class_counts", "cook_time_category")
        .union(rows("score", "score_counts", "score"))
        .union(rows("curve", "cook_curve", "bucket"))
        .union(rows("ingredient", "top_ingredients", "item", "freq"))
        .union(rows("tag", "top_tags", "item", "freq"))
        .union(rows("kcal", "kcal_histogram", "bin"))
        .union(macro_slices(page["macro_totals"]).select(F.lit("macro"), "macro", F.round("total").cast("bigint")))
        .union(page["scatter"].groupBy(_scatter_label().alias("label")).count().select(F.lit("scatter"), "label", "count"))
    )


_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in (*schemas.RECIPES_MAIN.names, *MACROS))
_KNOWN = " UNION ALL ".join(
    f"SELECT 'known', '{c}', CAST(round(10000.0 * count({c}) / count(*)) AS BIGINT) FROM main" for c in schemas.RECIPES_MAIN.names
)
_MACRO_COUNTS = " UNION ALL ".join(f"SELECT 'macro', '{c}', count({c}) FROM details" for c in MACROS)


@query(
    "e6_quality_report",
    f"""SELECT 'score' AS part, nutri_score AS label, count(*) AS count FROM main WHERE nutri_score IS NOT NULL GROUP BY 2
      UNION ALL SELECT 'time', cook_time_category, count(*) FROM main WHERE cook_time_category <> 'inconnu' GROUP BY 2
      UNION ALL (SELECT 'item', ingredient, count(*) AS n FROM item_index GROUP BY 2 ORDER BY n DESC, 2 LIMIT 30)
      UNION ALL SELECT 'complete', CASE WHEN {_COMPLETE} THEN '{COMPLETE}'
        WHEN has_image AND mit_energy_kcal IS NOT NULL AND n_ingredients_validated > 0 THEN '{USABLE}'
        ELSE '{INCOMPLETE}' END, count(*) FROM main LEFT JOIN details USING (recipe_id) GROUP BY 2
      UNION ALL {_KNOWN}
      UNION ALL {_MACRO_COUNTS}
      UNION ALL (SELECT 'outlier', title, count(*) FROM (
        SELECT title FROM main WHERE n_ingredients_validated > {OUTLIER_ITEMS} OR mit_energy_kcal > {OUTLIER_KCAL}
          OR cook_minutes > {OUTLIER_MINUTES}
        ORDER BY mit_energy_kcal DESC NULLS LAST, recipe_id LIMIT {OUTLIER_ROWS}) o GROUP BY 2)""",
    b.MAIN,
    b.DETAILS,
    b.INDEX,
)
def e6(spark, sf):
    report = quality_report(b.main(spark, sf), b.index(spark, sf), b.details(spark, sf))

    def rows(part: str, name: str, label: str, count: str):
        return report[name].select(F.lit(part).alias("part"), F.col(label).alias("label"), F.col(count).alias("count"))

    known = report["known_by_column"]
    counts = report["macro_summary"].filter("summary = 'count'").select(*MACROS)
    macros = counts.unpivot([], list(MACROS), "macro", "n")
    return (
        rows("score", "score_share", "nutri_score", "count")
        .union(rows("time", "time_profile", "cook_time_category", "n_recipes"))
        .union(rows("item", "top_ingredients", "ingredient", "count"))
        .union(rows("complete", "completeness", "status", "count"))
        .union(known.select(F.lit("known"), "column_name", F.round(F.col("pct_known") * 100).cast("bigint")))
        .union(macros.select(F.lit("macro"), "macro", F.col("n").cast("bigint")))
        .union(report["outliers"].groupBy("title").count().select(F.lit("outlier"), "title", "count"))
    )
