"""Catalog-shaped views of the given tables, as DataFrames and as the same CTEs for the oracle.

``events`` play the recipes (one per event, whole table): the type and user make the title, ``value`` the
energy, ``$.k`` of ``props`` the minutes. Nulls follow from the event id. ``main``, ``index`` and ``details``
are the tables published from them, in the published layout. ``documents``, ``labels``,
``pages``, ``events`` and ``customer`` play the five raw files of the pipeline.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import schemas
from larder.constants import MACROS
from larder.functions.arrays import length
from larder.functions.bands import score_band, time_band
from larder.plans.publish import Catalog, store
from larder.session import materialise, scratch
from larder.workload.registry import table


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 18 columns of the main contract and the macros, from ``events``."""
    kind, user, value = F.col("event_type"), F.col("user_id").cast("string"), F.col("value")
    event = F.col("event_id").cast("string")
    # Nulls follow from the id, so some rows have none and others several.
    turn = F.col("event_id") % 7
    k = F.col("_k")
    image = F.when(turn != 1, F.concat(F.lit("https://img.example.org/"), event, F.lit(".jpg")))
    items = F.array(kind, F.concat(F.lit(" Item "), k.cast("string"), F.lit(" ")), F.concat(F.lit("user "), user), F.lit("  "))
    # Parsed once: the optimizer leaves a costly column that is used more than once below the others.
    parsed = table(spark, sf_dir, "events").withColumn("_k", F.get_json_object("props", "$.k").cast("int"))
    base = parsed.select(
        event.alias("recipe_id"),
        F.concat_ws(" ", kind, user).alias("title"),
        F.when(turn != 0, F.col("props")).alias("description"),
        F.concat_ws(" | ", kind, F.concat(F.lit("user "), user), F.col("props")).alias("instructions_text"),
        F.array(kind, F.concat(F.lit("user "), user), F.concat(F.lit("item "), k.cast("string"))).alias("ingredients_raw"),
        F.when(turn != 3, items).alias("ingredients_validated"),
        F.when(turn != 2, F.floor(k / 10)).cast("int").alias("n_steps"),
        F.when(turn != 4, k).alias("cook_minutes"),
        image.alias("image_url"),
        F.when(turn != 1, F.array(image, F.lit("https://img.example.org/none.jpg"))).alias("image_urls"),
        (turn != 1).alias("has_image"),
        F.concat(F.lit("https://r.example.org/"), event).alias("source_url"),
        F.when(turn != 3, value).alias("mit_energy_kcal"),
        F.when(turn > 2, value * 2).alias("kaggle_energy_kcal"),
        F.when(turn != 0, F.array(kind, F.concat(F.lit("k"), F.floor(k / 10).cast("string")))).alias("tags"),
        F.when(turn != 3, value * 0.1).alias("fat_g"),
        F.when(~turn.isin(2, 3), value * 0.05).alias("protein_g"),
        F.when(turn != 3, value * 0.01).alias("salt_g"),
        F.when(~turn.isin(3, 4), value * 0.2).alias("saturates_g"),
        F.when(~turn.isin(2, 3), value * 0.5).alias("sugars_g"),
    )
    derived = base.withColumns(
        {
            "n_ingredients_validated": length("ingredients_validated"),
            "cook_time_category": time_band("cook_minutes"),
            "nutri_score": score_band("mit_energy_kcal"),
        }
    )
    return derived.select(*schemas.RECIPES_MAIN.names, *MACROS)


def fresh_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide(spark, sf_dir).select(*schemas.RECIPES_MAIN.names)


def version(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    """Names, lengths and times of a table's files: what is kept of it is made anew when they change."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    return tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files))


@lru_cache(maxsize=8)
def _published(app: str, spark: SparkSession, sf_dir: str, version: tuple) -> Catalog:
    return store(materialise(wide(spark, sf_dir), name="wide"), scratch(spark, "catalog"))


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """The published tables of this session: written once from all events, then queried many times."""
    return _published(spark.sparkContext.applicationId, spark, sf_dir, version(spark, sf_dir, "events"))


def main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog(spark, sf_dir).read_main(spark)


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog(spark, sf_dir).read_index(spark)


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog(spark, sf_dir).read_details(spark)


SCORE_SQL = (
    "CASE WHEN {0} IS NULL THEN NULL WHEN {0} < 80 THEN 'A' WHEN {0} < 160 THEN 'B' "
    "WHEN {0} < 270 THEN 'C' WHEN {0} < 400 THEN 'D' ELSE 'E' END"
)
TIME_SQL = "CASE WHEN {0} IS NULL THEN 'inconnu' WHEN {0} <= 30 THEN 'rapide' WHEN {0} <= 60 THEN 'moyen' ELSE 'long' END"

_EVENT_ROWS = """event_rows AS (
  SELECT *, CAST(event_id AS VARCHAR) AS eid, CAST(user_id AS VARCHAR) AS uid,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events)"""

WIDE = f"""{_EVENT_ROWS}, wide_base AS (
  SELECT eid AS recipe_id, event_type || ' ' || uid AS title,
    CASE WHEN event_id % 7 <> 0 THEN props END AS description,
    event_type || ' | user ' || uid || ' | ' || props AS instructions_text,
    [event_type, 'user ' || uid, 'item ' || k] AS ingredients_raw,
    CASE WHEN event_id % 7 <> 3 THEN [event_type, ' Item ' || k || ' ', 'user ' || uid, '  '] END AS ingredients_validated,
    CASE WHEN event_id % 7 <> 3 THEN 4 ELSE 0 END AS n_ingredients_validated,
    CASE WHEN event_id % 7 <> 2 THEN CAST(floor(k / 10) AS INTEGER) END AS n_steps,
    CASE WHEN event_id % 7 <> 4 THEN k END AS cook_minutes,
    CASE WHEN event_id % 7 <> 1 THEN 'https://img.example.org/' || eid || '.jpg' END AS image_url,
    CASE WHEN event_id % 7 <> 1
         THEN ['https://img.example.org/' || eid || '.jpg', 'https://img.example.org/none.jpg'] END AS image_urls,
    event_id % 7 <> 1 AS has_image,
    'https://r.example.org/' || eid AS source_url,
    CASE WHEN event_id % 7 <> 3 THEN value END AS mit_energy_kcal,
    CASE WHEN event_id % 7 > 2 THEN value * 2 END AS kaggle_energy_kcal,
    CASE WHEN event_id % 7 <> 0 THEN [event_type, 'k' || CAST(floor(k / 10) AS INTEGER)] END AS tags,
    CASE WHEN event_id % 7 <> 3 THEN value * 0.1 END AS fat_g,
    CASE WHEN event_id % 7 NOT IN (2, 3) THEN value * 0.05 END AS protein_g,
    CASE WHEN event_id % 7 <> 3 THEN value * 0.01 END AS salt_g,
    CASE WHEN event_id % 7 NOT IN (3, 4) THEN value * 0.2 END AS saturates_g,
    CASE WHEN event_id % 7 NOT IN (2, 3) THEN value * 0.5 END AS sugars_g
  FROM event_rows), wide AS (
  SELECT *, {TIME_SQL.format("cook_minutes")} AS cook_time_category,
    {SCORE_SQL.format("mit_energy_kcal")} AS nutri_score FROM wide_base)"""
MAIN = f"{WIDE}, main AS (SELECT * EXCLUDE (fat_g, protein_g, salt_g, saturates_g, sugars_g) FROM wide)"
DETAILS = """details AS (
  SELECT recipe_id, fat_g, protein_g, salt_g, saturates_g, sugars_g FROM wide
  WHERE fat_g IS NOT NULL OR protein_g IS NOT NULL OR salt_g IS NOT NULL OR saturates_g IS NOT NULL OR sugars_g IS NOT NULL)"""
INDEX = """item_index AS (
  SELECT recipe_id, title, nutri_score, image_url, cook_time_category, lower(trim(raw_item)) AS ingredient
  FROM (SELECT *, unnest(ingredients_validated) AS raw_item FROM main) u
  WHERE trim(raw_item) <> '')"""


# The raw files of the pipeline.

def _texts(words: Column) -> Column:
    return F.transform(words, lambda w: F.struct(w.alias("text")))


def doc_title() -> Column:
    return F.concat(F.upper("source"), F.lit(" "), F.col("lang"), F.lit("!"))


def raw_layer1(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.split("text", "\n")
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        doc_title().alias("title"),
        F.concat(F.lit("https://d.example.org/"), "doc_id").alias("url"),
        F.col("lang").alias("partition"),
        _texts(F.split("text", " ")).alias("ingredients"),
        _texts(lines).alias("instructions"),
    )


def raw_layer2(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.col("page_id").cast("string")
    return table(spark, sf_dir, "pages").select(
        page.alias("id"), F.array(F.struct(page.alias("id"), F.col("url"))).alias("images")
    )


def raw_det_ingrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, valid when longer than four characters; every third has an id that no recipe has."""
    words = F.split("text", " ")
    own = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("x"), "doc_id")).otherwise(F.col("doc_id").cast("string"))
    return table(spark, sf_dir, "documents").select(
        own.alias("id"),
        _texts(words).alias("ingredients"),
        F.transform(words, lambda w: F.length(w) > 4).alias("valid"),
    )


def raw_nutrition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event, so that many rows repeat a title."""
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("src"), "user_id", F.lit(" en")).alias("title"),
        F.struct(
            value.alias("energy"),
            (value * 0.1).alias("fat"),
            (value * 0.05).alias("protein"),
            (value * 0.01).alias("salt"),
            (value * 0.2).alias("saturates"),
            (value * 0.5).alias("sugars"),
        ).alias("nutr_values_per100g"),
    )


def raw_kaggle(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("c_nationkey").cast("string")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("Src"), nation, F.lit(" fr?")).alias("name"),
        F.col("c_custkey").cast("string").alias("id"),
        nation.alias("minutes"),
        F.concat(F.lit("['"), "c_mktsegment", F.lit("', 'nation "), nation, F.lit("']")).alias("tags"),
        F.concat(F.lit("["), F.col("c_acctbal").cast("string"), F.lit(", 1.0]")).alias("nutrition"),
        F.when(F.col("c_acctbal") < 0, "-1").otherwise(nation).alias("n_steps"),
        F.col("c_name").alias("description"),
    )


RAW = {
    "layer1": raw_layer1,
    "layer2": raw_layer2,
    "det_ingrs": raw_det_ingrs,
    "nutrition": raw_nutrition,
    "kaggle": raw_kaggle,
}

SPACES = "E' \\n\\t\\r'"
KEY_SQL = "trim(lower(regexp_replace({0}, '[^a-zA-Z0-9\\s]', '', 'g')), " + SPACES + ")"

STAGING = f"""layer1 AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, upper(source) || ' ' || lang || '!' AS title,
    'https://d.example.org/' || doc_id AS url, lang AS part, replace(text, E'\\n', ' | ') AS instructions_text,
    string_split(text, ' ') AS ingredients_raw, CAST(len(string_split(text, E'\\n')) AS INTEGER) AS n_steps,
    {KEY_SQL.format("upper(source) || ' ' || lang || '!'")} AS title_norm FROM documents),
layer2 AS (SELECT CAST(page_id AS VARCHAR) AS id, url AS image_url, [url] AS image_urls, true AS has_image FROM pages),
det_ingrs AS (
  SELECT CASE WHEN doc_id % 3 = 0 THEN 'x' || doc_id ELSE CAST(doc_id AS VARCHAR) END AS id,
    [trim(lower(w), {SPACES}) for w in string_split(text, ' ') if length(w) > 4] AS ingredients_validated
  FROM documents),
nutrition AS (
  SELECT {KEY_SQL.format("'src' || user_id || ' en'")} AS title_norm, min(value) AS energy_kcal FROM events GROUP BY 1),
kaggle AS (
  SELECT {KEY_SQL.format("'Src' || c_nationkey || ' fr?'")} AS title_norm, CAST(c_nationkey AS BIGINT) AS cook_minutes,
    c_name AS description, [c_mktsegment, 'nation ' || c_nationkey] AS tags, c_acctbal AS kaggle_energy_kcal
  FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) = 1),
assembled AS (
  SELECT l1.*, l2.image_url, l2.image_urls, l2.has_image, d.ingredients_validated,
    n.energy_kcal AS mit_energy_kcal, n.energy_kcal * 0.1 AS fat_g, n.energy_kcal * 0.05 AS protein_g,
    n.energy_kcal * 0.01 AS salt_g, n.energy_kcal * 0.2 AS saturates_g, n.energy_kcal * 0.5 AS sugars_g,
    k.cook_minutes, k.description, k.tags, k.kaggle_energy_kcal
  FROM layer1 l1 LEFT JOIN layer2 l2 USING (id) LEFT JOIN det_ingrs d USING (id)
  LEFT JOIN nutrition n USING (title_norm) LEFT JOIN kaggle k USING (title_norm))"""
