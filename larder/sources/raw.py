"""Scans of the raw files."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larder.schemas import with_optional
from larder.sources.split import csv_records, json_objects


def read_json_records(spark: SparkSession, path: str | list[str], schema: StructType, layout: str = "array") -> DataFrame:
    """One row per record of a JSON file or directory, with a declared schema.

    ``array``: a file is one JSON array of objects in any formatting. It is read by as many tasks as it has blocks.
    ``array_whole``: the same, and arrays of anything; a file is parsed in one task, and rebalanced after the scan.
    ``array_lines``: a JSON array with one element per line. The file is split like any text file; a
    line that holds no whole element fails the job instead of being lost.
    ``lines``: JSON lines, the layout for large data; files split as well.
    """
    if layout == "array":
        return json_objects(spark, path, schema)
    if layout == "array_whole":
        return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path).hint("rebalance")
    if layout == "lines":
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if layout == "array_lines":
        element = F.regexp_replace("value", r"^[\s\[,]+|[\s\],]+$", "")
        parsed = F.from_json(element, schema, {"mode": "FAILFAST"})
        return spark.read.text(path).filter(element != "").select(parsed.alias("r")).select("r.*")
    raise ValueError(f"unknown layout {layout!r}")


def _by_header(spark: SparkSession, path: str | list[str]) -> list[list[str]]:
    """The files of a path in groups that share their first line, found by one job."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    first = lines.where("block = 0").withColumn("at", F.monotonically_increasing_id()).groupBy("file").agg(F.min_by("value", "at").alias("header"))
    files = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect()
    return [[unquote(f) for f in r["files"]] for r in files]


def read_csv_records(
    spark: SparkSession, path: str | list[str], schema: StructType, multi_line: bool = True
) -> DataFrame:
    """Records of CSV files with a header: quoted fields, doubled quotes, and line breaks inside quotes.

    All columns are strings, matched to the schema by each file's own header, and null where the file or the
    row lacks one. A file whose fields may hold line breaks is read by as many tasks as it has blocks (see
    ``split.csv_records`` for the quotes it takes). ``multi_line=False`` reads files without them, in groups whose headers
    are equal.
    """
    if multi_line:
        return csv_records(spark, path, schema)
    names = {f.name: f.dataType.simpleString() for f in schema}

    def one(files: list[str]) -> DataFrame:
        rows = spark.read.option("header", True).option("inferSchema", False).option("escape", '"').csv(files)
        return with_optional(rows, names).select(*schema.names)

    groups = _by_header(spark, path)
    return reduce(DataFrame.unionByName, map(one, groups)) if groups else spark.createDataFrame([], schema)
