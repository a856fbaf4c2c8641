"""Wide recipe rows to the three published tables, and the pipeline entry points."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larder import schemas
from larder.constants import MACROS
from larder.functions.arrays import length, or_empty
from larder.functions.bands import flag, score_band, time_band
from larder.functions.numbers import narrow_int
from larder.operators.filters import any_present
from larder.operators.items import inverted_index
from larder.operators.packing import packed, unpacked
from larder.operators.profile import table_stats
from larder.plans.assemble import prepared, read_staging
from larder.plans.ingest import ingest
from larder.session import concurrently, materialise, remove, scratch
from larder.sources.tables import CODEC, planned_bytes, read_table, write_clustered, write_partitioned

# Wide rows are larger in a task than stored, and bytes of an index row in a task, about.
UNPACKED = 4
INDEX_ROW = 128
# Columns of texts that move packed, by the names of the packed ones.
WIDE = {"packed_texts": ("instructions_text", "ingredients_raw"), "packed_items": ("ingredients_validated",)}


def enriched(df: DataFrame) -> DataFrame:
    """Derived columns and published names; the columns of the main contract plus the macros."""
    # Numbers are narrowed before they are classed, so a class always describes the published value.
    narrowed = df.withColumns({"n_steps": narrow_int("n_steps"), "cook_minutes": narrow_int("cook_minutes")})
    is_packed = "ingredients_validated" not in df.columns
    derived = narrowed.withColumns(
        {
            "recipe_id": F.col("id"),
            "source_url": F.col("url"),
            "n_ingredients_validated": F.coalesce("n_ingredients_validated", F.lit(0)) if is_packed else length("ingredients_validated"),
            "cook_time_category": time_band("cook_minutes"),
            "has_image": flag("has_image"),
            "nutri_score": score_band("mit_energy_kcal"),
            "tags": or_empty("tags"),
        }
    )
    held = [c for c in schemas.RECIPES_MAIN.names if c in derived.columns]
    return derived.select(*held, *(c for c in WIDE if c in derived.columns), *MACROS)


def packed_wide(df: DataFrame) -> DataFrame:
    """The frame with the wide columns that it holds packed; their number of items is counted before."""
    for into, columns in WIDE.items():
        if columns[0] in df.columns:
            df = packed(df, columns, into)
    return df


def unpacked_main(rows: DataFrame) -> DataFrame:
    """The main table's columns from rows of packed ones."""
    for column, columns in WIDE.items():
        rows = unpacked(rows, column, StructType([schemas.RECIPES_MAIN[c] for c in columns]))
    return recipes_main(rows)


def recipes_main(wide: DataFrame) -> DataFrame:
    return wide.select(*schemas.RECIPES_MAIN.names)


def ingredients_index(main: DataFrame) -> DataFrame:
    return inverted_index(main)


def nutrition_detail(wide: DataFrame) -> DataFrame:
    """Macros of the recipes that have at least one."""
    return wide.select("recipe_id", *MACROS).filter(any_present(MACROS))


@dataclass(frozen=True)
class Catalog:
    """Paths of the published tables."""

    root: str

    @property
    def main(self) -> str:
        return f"{self.root}/recipes_main"

    @property
    def index(self) -> str:
        return f"{self.root}/ingredients_index"

    @property
    def details(self) -> str:
        return f"{self.root}/recipes_nutrition_detail"

    def read_main(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.main, schemas.RECIPES_MAIN)

    def read_index(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.index, schemas.INGREDIENTS_INDEX)

    def read_details(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.details, schemas.RECIPES_NUTRITION_DETAIL)

    def read(self, spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(main, index, details)"""
        return self.read_main(spark), self.read_index(spark), self.read_details(spark)


def store(wide: DataFrame, out_dir: str, rows_per_file: int = 0) -> Catalog:
    """Write the three tables from rows that hold the main contract's columns and the macros."""
    catalog = Catalog(out_dir)
    main, index, details = recipes_main(wide), ingredients_index(wide), nutrition_detail(wide)
    # The optimizer knows no number of items, of which each is a row of the index.
    items = wide.agg(F.sum(F.greatest("n_ingredients_validated", F.lit(0)))).first()[0] or 0
    concurrently(
        wide.sparkSession,
        [
            lambda: write_partitioned(
                main, catalog.main, "nutri_score", ["title", "recipe_id"], rows_per_file, ["recipe_id"], UNPACKED * planned_bytes(main)
            ),
            lambda: write_clustered(index, catalog.index, ["ingredient", "recipe_id"], rows_per_file, n_bytes=INDEX_ROW * items),
            lambda: write_clustered(details, catalog.details, ["recipe_id"], rows_per_file),
        ],
    )
    return catalog


def store_packed(rows: DataFrame, details: DataFrame, n_bytes: int, out_dir: str, rows_per_file: int = 0) -> Catalog:
    """Write the three tables from main rows with packed wide columns, and the rows of the nutrition table.

    Wide columns stay packed until the main table's rows are in their places. The index comes from the main table as
    written, so it describes exactly its rows. ``n_bytes``: the stored size of the rows.
    """
    catalog, spark = Catalog(out_dir), rows.sparkSession
    main = rows.drop(*MACROS)
    write_partitioned(
        main, catalog.main, "nutri_score", ["title", "recipe_id"], rows_per_file, ["recipe_id"], UNPACKED * n_bytes, unpacked_main
    )
    written = catalog.read_main(spark)
    items = written.agg(F.sum(F.greatest("n_ingredients_validated", F.lit(0)))).first()[0] or 0
    index = ingredients_index(written)
    concurrently(
        spark,
        [
            lambda: write_clustered(index, catalog.index, ["ingredient", "recipe_id"], rows_per_file, n_bytes=INDEX_ROW * items),
            lambda: write_clustered(details, catalog.details, ["recipe_id"], rows_per_file),
        ],
    )
    return catalog


def publish(assembled: DataFrame, out_dir: str, rows_per_file: int = 0) -> Catalog:
    """Write the three tables from joined rows, whatever they come from.

    The rows are written once to the shared scratch folder, wide columns packed: the joins run once although range
    partitioning reads its input twice. The copy is removed when all three are written.
    """
    spark = assembled.sparkSession
    copy = scratch(spark, "assembled")
    rows = materialise(packed_wide(enriched(assembled)), copy, compression=CODEC)
    catalog = store_packed(rows, nutrition_detail(rows), planned_bytes(rows), out_dir, rows_per_file)
    remove(spark, copy)
    return catalog


def transform(spark: SparkSession, staging_dir: str, out_dir: str) -> Catalog:
    """Staging tables to published tables, without a copy of the joined rows.

    Wide columns are packed before the join; the shuffles on ``id`` are read twice, once for the ranges of the main table.
    The nutrition table's rows are joined by themselves, from their few columns of the stored tables.
    """
    staging = read_staging(spark, staging_dir)
    parts = prepared(staging)
    counted = parts.det_ingrs.withColumn("n_ingredients_validated", length("ingredients_validated"))
    moved = replace(parts, layer1=packed_wide(parts.layer1), det_ingrs=packed_wide(counted))
    n_bytes = sum(planned_bytes(staging[name]) for name in ("layer1", "layer2", "det_ingrs"))
    return store_packed(enriched(moved.joined()), nutrition_detail(enriched(parts.joined())), n_bytes, out_dir)


def run(
    spark: SparkSession,
    raw_dir: str,
    staging_dir: str,
    out_dir: str,
    disposition: str = "replace",
    layout: str = "array",
    multi_line: bool = True,
) -> Catalog:
    """Raw files to published tables."""
    ingest(spark, raw_dir, staging_dir, disposition, layout, multi_line=multi_line)
    return transform(spark, staging_dir, out_dir)


def info(spark: SparkSession, out_dir: str) -> DataFrame:
    """Counts per published table; a missing table raises FileNotFoundError."""
    return table_stats(*Catalog(out_dir).read(spark))
