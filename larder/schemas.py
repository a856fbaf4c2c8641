"""Declared schemas of the raw files, staging tables and published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


STRING, INT, BIGINT, DOUBLE, BOOLEAN = StringType(), IntegerType(), LongType(), DoubleType(), BooleanType()
STRINGS = ArrayType(STRING)


def _struct(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


def _records(*fields: str) -> ArrayType:
    return ArrayType(_struct(**dict.fromkeys(fields, STRING)))


# Raw files. Types are explicit so that no pass over the data is spent on inference.
RAW_LAYER1 = _struct(
    id=STRING, title=STRING, url=STRING, partition=STRING,
    ingredients=_records("text"), instructions=_records("text"),
)
RAW_LAYER2 = _struct(id=STRING, images=_records("id", "url"))
RAW_DET_INGRS = _struct(id=STRING, ingredients=_records("text"), valid=ArrayType(BOOLEAN))
RAW_NUTRITION = _struct(
    title=STRING,
    nutr_values_per100g=_struct(
        energy=DOUBLE, fat=DOUBLE, protein=DOUBLE, salt=DOUBLE, saturates=DOUBLE, sugars=DOUBLE
    ),
)
RAW_KAGGLE = _struct(
    name=STRING, id=STRING, minutes=STRING, tags=STRING, nutrition=STRING, n_steps=STRING, description=STRING
)

# Staging tables.
LAYER1 = _struct(
    id=STRING, title=STRING, url=STRING, partition=STRING, instructions_text=STRING,
    ingredients_raw=STRINGS, n_steps=INT, title_norm=STRING,
)
LAYER2 = _struct(id=STRING, image_url=STRING, image_urls=STRINGS, has_image=BOOLEAN)
DET_INGRS = _struct(id=STRING, ingredients_validated=STRINGS, n_ingredients_validated=INT)
NUTRITION = _struct(
    title=STRING, title_norm=STRING, energy_kcal=DOUBLE, fat_g=DOUBLE, protein_g=DOUBLE,
    salt_g=DOUBLE, saturates_g=DOUBLE, sugars_g=DOUBLE,
)
KAGGLE = _struct(
    kaggle_id=STRING, cook_minutes=BIGINT, n_steps=BIGINT, description=STRING, tags=STRINGS,
    title_norm=STRING, kaggle_energy_kcal=DOUBLE,
)

# Columns of the published tables; their order is part of the contract.
RECIPES_MAIN = _struct(
    recipe_id=STRING,
    title=STRING,
    description=STRING,
    instructions_text=STRING,
    ingredients_raw=STRINGS,
    ingredients_validated=STRINGS,
    n_ingredients_validated=INT,
    n_steps=INT,
    cook_minutes=INT,
    cook_time_category=STRING,
    image_url=STRING,
    image_urls=STRINGS,
    has_image=BOOLEAN,
    source_url=STRING,
    mit_energy_kcal=DOUBLE,
    kaggle_energy_kcal=DOUBLE,
    nutri_score=STRING,
    tags=STRINGS,
)
INGREDIENTS_INDEX = _struct(
    recipe_id=STRING, title=STRING, nutri_score=STRING, image_url=STRING, cook_time_category=STRING, ingredient=STRING
)
RECIPES_NUTRITION_DETAIL = _struct(
    recipe_id=STRING, fat_g=DOUBLE, protein_g=DOUBLE, salt_g=DOUBLE, saturates_g=DOUBLE, sugars_g=DOUBLE
)


def contract_gaps(df: DataFrame, contract: StructType) -> list[str]:
    """Differences between a frame and a contract, empty when it conforms (names, order and types)."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    gaps = [
        f"{f.name}: expected {f.dataType.simpleString()}, found {have.get(f.name, 'nothing')}"
        for f in contract
        if have.get(f.name) != f.dataType.simpleString()
    ]
    gaps += [f"{name}: not in the contract" for name in have if name not in contract.names]
    if not gaps and df.columns != contract.names:
        gaps.append(f"column order: {df.columns}")
    return gaps


def with_optional(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add a typed null for every named column that the frame lacks (optional-column fallback)."""
    missing = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df
