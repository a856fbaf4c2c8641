"""Raw files to staging tables: five independent jobs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import schemas
from larder.functions.arrays import first, length, masked_texts, non_empty
from larder.functions.numbers import digits, leading_number
from larder.functions.text import blank_to_null, field_texts, joined_texts, listed_items, title_key
from larder.operators.dedupe import first_seen
from larder.session import concurrently
from larder.sources.raw import read_csv_records, read_json_records
from larder.sources.tables import write_staging


def stage_layer1(raw: DataFrame) -> DataFrame:
    return raw.select(
        "id",
        "title",
        "url",
        "partition",
        joined_texts("instructions").alias("instructions_text"),
        field_texts("ingredients").alias("ingredients_raw"),
        length("instructions").alias("n_steps"),
        title_key("title").alias("title_norm"),
    )


def stage_layer2(raw: DataFrame) -> DataFrame:
    """Image addresses; a record without images is kept with the flag off."""
    urls = raw.select("id", field_texts("images", "url").alias("image_urls"))
    return urls.select(
        "id", first("image_urls").alias("image_url"), "image_urls", non_empty("image_urls").alias("has_image")
    )


def stage_det_ingrs(raw: DataFrame) -> DataFrame:
    kept = raw.select("id", masked_texts("ingredients", "valid").alias("ingredients_validated"))
    return kept.withColumn("n_ingredients_validated", length("ingredients_validated"))


def stage_nutrition(raw: DataFrame) -> DataFrame:
    """The nutrient struct as columns; a missing struct gives nulls."""
    values = {"energy_kcal": "energy"} | {f"{m}_g": m for m in ("fat", "protein", "salt", "saturates", "sugars")}
    per_100g = "nutr_values_per100g"
    return raw.select(
        "title",
        title_key("title").alias("title_norm"),
        *(F.col(f"{per_100g}.{source}").alias(name) for name, source in values.items()),
    )


def stage_kaggle(raw: DataFrame) -> DataFrame:
    """Typed columns from an all-string CSV, one row per non-empty title key: the one with the least id.

    (A distributed scan has no first row in file order, so the id decides.)
    """
    typed = raw.select(
        F.col("id").alias("kaggle_id"),
        digits("minutes").alias("cook_minutes"),
        digits("n_steps").alias("n_steps"),
        blank_to_null("description").alias("description"),
        listed_items("tags").alias("tags"),
        title_key("name").alias("title_norm"),
        leading_number("nutrition").alias("kaggle_energy_kcal"),
    )
    return first_seen(typed, "title_norm", F.col("kaggle_id").try_cast("bigint"))


@dataclass(frozen=True)
class Resource:
    """A raw file, its schema, and the job that turns it into a staging table."""

    file: str
    schema: object
    stage: Callable[[DataFrame], DataFrame]
    is_csv: bool = False


# File names of the raw data set.
RESOURCES = {
    "layer1": Resource("layer1.json", schemas.RAW_LAYER1, stage_layer1),
    "layer2": Resource("layer2+.json", schemas.RAW_LAYER2, stage_layer2),
    "det_ingrs": Resource("det_ingrs.json", schemas.RAW_DET_INGRS, stage_det_ingrs),
    "nutrition": Resource("recipes_with_nutritional_info.json", schemas.RAW_NUTRITION, stage_nutrition),
    "kaggle": Resource("RAW_recipes.csv", schemas.RAW_KAGGLE, stage_kaggle, is_csv=True),
}


def scan(spark: SparkSession, raw_dir: str, name: str, layout: str = "array", multi_line: bool = True) -> DataFrame:
    resource = RESOURCES[name]
    path = f"{raw_dir}/{resource.file}"
    if resource.is_csv:
        return read_csv_records(spark, path, resource.schema, multi_line)
    return read_json_records(spark, path, resource.schema, layout)


def ingest(
    spark: SparkSession,
    raw_dir: str,
    staging_dir: str,
    disposition: str = "replace",
    layout: str = "array",
    only: tuple[str, ...] = tuple(RESOURCES),
    multi_line: bool = True,
) -> dict[str, str]:
    """Write the staging tables, side by side, and return their paths. A failing resource fails the run.

    ``layout`` is that of the JSON files; ``multi_line=False`` says that no CSV field holds a line break.
    """
    paths = {name: f"{staging_dir}/{name}" for name in only}

    def load(name: str) -> None:
        write_staging(RESOURCES[name].stage(scan(spark, raw_dir, name, layout, multi_line)), paths[name], disposition)

    concurrently(spark, [partial(load, name) for name in only])
    return paths
