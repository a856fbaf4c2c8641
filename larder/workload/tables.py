"""Scans, sinks, views and materialisation. Every file is written from a given table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from larder import schemas
from larder.constants import MACROS
from larder.functions.numbers import leading_number
from larder.functions.text import title_key
from larder.operators.dedupe import keep_one
from larder.operators.items import inverted_index, top_values
from larder.plans import ingest, serving
from larder.plans.publish import nutrition_detail, recipes_main
from larder.session import scratch
from larder.sources import tables as store
from larder.sources.curve import write_by_curve
from larder.sources.raw import read_csv_records, read_json_records
from larder.streaming.incremental import append_new_files
from larder.workload import bindings as b
from larder.workload.registry import query, table

_LAYER1 = "SELECT id, title_norm, n_steps, md5(instructions_text) AS steps, CAST(len(ingredients_raw) AS INTEGER) AS n_items FROM layer1"


def _layer1_digest(staged):
    return staged.select(
        "id", "title_norm", "n_steps", F.md5("instructions_text").alias("steps"), F.size("ingredients_raw").alias("n_items")
    )


@query("s1_json_lines_scan", _LAYER1, b.STAGING)
def s1_lines(spark, sf):
    path = scratch(spark, "s1")
    b.raw_layer1(spark, sf).write.json(path)
    return _layer1_digest(ingest.stage_layer1(read_json_records(spark, path, schemas.RAW_LAYER1, "lines")))


@query("s1_json_array_lines_scan", _LAYER1, b.STAGING)
def s1_array_lines(spark, sf):
    """Files of array elements, one per line, each line ending in the array's comma."""
    path = scratch(spark, "s1")
    raw = b.raw_layer1(spark, sf)
    raw.select(F.concat(F.to_json(F.struct(*raw.columns)), F.lit(","))).write.text(path)
    return _layer1_digest(ingest.stage_layer1(read_json_records(spark, path, schemas.RAW_LAYER1, "array_lines")))


def _as_array(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of a task, a line feed between them, as one array."""
    mark = "["
    for part in parts:
        for i in range(0, part.num_rows, 100):
            marks = pa.array([mark, *[","] * (min(100, part.num_rows - i) - 1)])
            yield pa.RecordBatch.from_pydict({"value": pc.binary_join_element_wise(marks, part.column(0).slice(i, 100).cast(pa.string()), "\n")})
            mark = ","
    yield pa.RecordBatch.from_pydict({"value": ["[]" if mark == "[" else "]"]})


@query("s1_json_array_scan", _LAYER1, b.STAGING)
def s1_array(spark, sf):
    """Each file one JSON array over many lines, as the raw data set has it."""
    path = scratch(spark, "s1")
    raw = b.raw_layer1(spark, sf)
    records = raw.select("id", F.to_json(F.struct(*raw.columns), {"pretty": "true"}).alias("value")).repartition(64, "id")
    records.select("value").mapInArrow(_as_array, "value string").write.text(path)
    rows = read_json_records(spark, path, schemas.RAW_LAYER1, "array")
    return _layer1_digest(ingest.stage_layer1(rows))


@query("s2_csv_mixed_headers", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(c_nationkey AS VARCHAR) AS minutes FROM customer")
def s2_mixed(spark, sf):
    """Files whose headers list the columns in different orders, in one folder."""
    path = scratch(spark, "s2")
    raw = b.raw_kaggle(spark, sf).select("id", F.col("description").alias("name"), "minutes")
    for i, columns in enumerate((["id", "name", "minutes"], ["minutes", "id", "name"], ["name", "minutes", "id"])):
        some = raw.filter(F.pmod(F.col("id").cast("long"), F.lit(3)) == i).select(*columns)
        some.write.mode("append").option("header", True).csv(path)
    return read_csv_records(spark, path, schemas.RAW_KAGGLE, multi_line=False).select("id", "name", "minutes")


@query("s2_csv_scan", "SELECT CAST(doc_id AS VARCHAR) AS id, md5(text) AS digest, '\"q\", ' || lang AS name FROM documents")
def s2(spark, sf):
    """Whole texts as quoted CSV fields: they hold line breaks, and the names hold quotes and commas."""
    path = scratch(spark, "s2")
    docs = table(spark, sf, "documents").select(
        F.concat(F.lit('"q", '), "lang").alias("name"), F.col("doc_id").alias("id"), F.col("text").alias("description")
    )
    (
        docs.write.option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    rows = read_csv_records(spark, path, schemas.RAW_KAGGLE)
    return rows.select("id", F.md5("description").alias("digest"), "name")


@query(
    "s3_staging_write",
    "SELECT id, image_url, CAST(len(image_urls) AS INTEGER) AS n_urls, has_image FROM layer2",
    b.STAGING,
)
def s3(spark, sf):
    path = scratch(spark, "s3")
    store.write_staging(ingest.stage_layer2(b.raw_layer2(spark, sf)), path)
    staged = store.read_table(spark, path)
    return staged.select("id", "image_url", F.size("image_urls").alias("n_urls"), "has_image")


@query(
    "s4_append_then_dedupe",
    "SELECT count(*) AS n_rows, count(DISTINCT event_type) AS n_types, 2 * count(*) AS n_stored FROM events",
)
def s4(spark, sf):
    path = scratch(spark, "s4")
    for _ in range(2):
        store.write_staging(table(spark, sf, "events"), path, "append")
    stored = store.read_table(spark, path)
    once = keep_one(stored, ["event_id"]).agg(
        F.count("*").alias("n_rows"), F.count_distinct("event_type").alias("n_types")
    )
    return once.withColumn("n_stored", stored.agg(F.count("*")).scalar())


@query("s4_incremental_append", _LAYER1, b.STAGING)
def s4_incremental(spark, sf):
    """Two deliveries of files; the second run reads only the new ones."""
    source, staged, check = (scratch(spark, n) for n in ("s4-in", "s4-out", "s4-check"))
    raw = b.raw_layer1(spark, sf)
    for english in (True, False):
        raw.filter((F.col("partition") == "en") == english).write.mode("append").json(source)
        append_new_files(spark, "layer1", source, staged, check)
    return _layer1_digest(store.read_table(spark, staged))


@query(
    "s5_pruned_scan",
    "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_quantity > 25 GROUP BY l_returnflag",
)
def s5(spark, sf):
    lines = store.read_table(spark, f"{sf}/lineitem.parquet").filter("l_quantity > 25")
    return lines.groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query("s4_batch_then_stream", _LAYER1, b.STAGING)
def s4_batch_then_stream(spark, sf):
    """A batch load, a stream load and a batch load into one staging folder add up."""
    source, staged, check = (scratch(spark, n) for n in ("s4-in", "s4-out", "s4-check"))
    raw = b.raw_layer1(spark, sf)
    stage = ingest.RESOURCES["layer1"].stage
    store.write_staging(stage(raw.filter("partition = 'en'")), staged, "append")
    raw.filter("partition = 'fr'").write.json(source)
    append_new_files(spark, "layer1", source, staged, check)
    store.write_staging(stage(raw.filter("partition NOT IN ('en', 'fr') OR partition IS NULL")), staged, "append")
    return _layer1_digest(store.read_table(spark, staged))


_BY_SCORE = "SELECT coalesce(nutri_score, 'none') AS score, count(*) AS n, min(title) AS first_title FROM main GROUP BY 1"


def _by_score(main):
    return main.groupBy(F.coalesce("nutri_score", F.lit("none")).alias("score")).agg(
        F.count("*").alias("n"), F.min("title").alias("first_title")
    )


@query("s7_partitioned_sink", _BY_SCORE, b.MAIN)
def s7(spark, sf):
    path = scratch(spark, "s7")
    store.write_partitioned(b.fresh_main(spark, sf), path, "nutri_score", ["title", "recipe_id"])
    return _by_score(store.read_table(spark, path))


@query("s7_partition_pruning", "SELECT recipe_id, title FROM main WHERE nutri_score IN ('D', 'E')", b.MAIN)
def s7_pruning(spark, sf):
    path = scratch(spark, "s7")
    store.write_partitioned(b.fresh_main(spark, sf), path, "nutri_score", ["title", "recipe_id"])
    return store.read_table(spark, path).filter(F.col("nutri_score").isin("D", "E")).select("recipe_id", "title")


@query("s8_unpartitioned_sinks", "SELECT count(*) AS n_index, count(DISTINCT ingredient) AS n_items FROM item_index", b.MAIN, b.INDEX)
def s8(spark, sf):
    path = scratch(spark, "s8")
    store.write_clustered(inverted_index(b.fresh_main(spark, sf)), path, ["ingredient", "recipe_id"])
    written = store.read_table(spark, path)
    return written.agg(F.count("*").alias("n_index"), F.count_distinct("ingredient").alias("n_items"))


@query("s9_clustered_layout", "SELECT recipe_id, title FROM item_index WHERE ingredient = 'item 42'", b.MAIN, b.INDEX)
def s9(spark, sf):
    path = scratch(spark, "s9")
    store.write_clustered(inverted_index(b.fresh_main(spark, sf)), path, ["ingredient", "recipe_id"])
    return store.read_table(spark, path).filter("ingredient = 'item 42'").select("recipe_id", "title")


@query(
    "s9_curve_layout",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_shipmode FROM (SELECT *, l_returnflag || l_linestatus AS l_shipmode FROM lineitem)
      WHERE l_partkey BETWEEN 100 AND 120 OR l_orderkey BETWEEN 500 AND 520""",
)
def s9_curve(spark, sf):
    """Lines laid out by part and order at once; ranges of either skip files."""
    path = scratch(spark, "s9-curve")
    lines = table(spark, sf, "lineitem").withColumn("l_shipmode", F.concat("l_returnflag", "l_linestatus"))
    write_by_curve(lines, path, ["l_partkey", "l_orderkey"], "l_linenumber")
    found = store.read_table(spark, path).filter("l_partkey BETWEEN 100 AND 120 OR l_orderkey BETWEEN 500 AND 520")
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipmode")


@query(
    "s10_export",
    f"SELECT doc_id, {b.KEY_SQL.format('source')} AS title_norm, md5(text) AS digest FROM documents",
)
def s10(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", title_key("source").alias("title_norm"), F.md5("text").alias("digest"))
    return store.export(docs, scratch(spark, "s10"))


@query(
    "s11_serving_views",
    """SELECT (SELECT count(*) FROM main) AS n_recipes, (SELECT count(*) FROM details) AS n_details,
      ingredient, count(DISTINCT recipe_id) AS recipe_count FROM item_index GROUP BY ingredient""",
    b.MAIN,
    b.DETAILS,
    b.INDEX,
)
def s11(spark, sf):
    """The views that serve the published catalog."""
    serving.register_catalog(spark, b.catalog(spark, sf).root)
    return spark.sql(
        """SELECT (SELECT count(*) FROM recipes) AS n_recipes, (SELECT count(fat_g) + count_if(fat_g IS NULL AND
          coalesce(protein_g, salt_g, saturates_g, sugars_g) IS NOT NULL) FROM recipes) AS n_details,
          ingredient, recipe_count FROM v_ingredient_catalog"""
    )


@query(
    "s12_joined_view",
    """SELECT recipe_id, title, coalesce(fat_g, -1) AS fat_g, coalesce(sugars_g, -1) AS sugars_g
      FROM main LEFT JOIN details USING (recipe_id)""",
    b.MAIN,
    b.DETAILS,
)
def s12(spark, sf):
    store.register_views({"s12_full": serving.full_view(b.fresh_main(spark, sf), nutrition_detail(b.wide(spark, sf)))})
    return spark.sql(
        """SELECT recipe_id, title, coalesce(fat_g, -1.0D) AS fat_g, coalesce(sugars_g, -1.0D) AS sugars_g FROM s12_full"""
    )


@query(
    "s13_optional_column",
    "SELECT recipe_id, 'absent' AS urls, title FROM main",
    b.MAIN,
)
def s13(spark, sf):
    old = b.fresh_main(spark, sf).drop("image_urls")
    new = schemas.with_optional(old, {"image_urls": "array<string>", "title": "string"})
    return new.select("recipe_id", F.coalesce(F.array_join("image_urls", "|"), F.lit("absent")).alias("urls"), "title")


@query(
    "s13_schema_contract",
    "SELECT count(*) AS n_rows, CAST(0 AS INTEGER) AS n_gaps, CAST(2 AS INTEGER) AS n_gaps_when_broken FROM main",
    b.MAIN,
)
def s13_contract(spark, sf):
    """The published columns against the contract, and again with one column gone and one of another type."""
    main = recipes_main(b.wide(spark, sf))
    broken = main.drop("title").withColumn("cook_minutes", F.col("cook_minutes").cast("string"))
    gaps, found = (schemas.contract_gaps(df, schemas.RECIPES_MAIN) for df in (main, broken))
    return main.agg(
        F.count("*").alias("n_rows"), F.lit(len(gaps)).alias("n_gaps"), F.lit(len(found)).alias("n_gaps_when_broken")
    )


@query(
    "s14_master_table",
    """SELECT nutri_score IS NULL AS unscored, count(*) AS n, count(fat_g) AS n_fat, count(protein_g) AS n_protein
      FROM main LEFT JOIN details USING (recipe_id) GROUP BY 1""",
    b.MAIN,
    b.DETAILS,
)
def s14(spark, sf):
    master = serving.master_table(b.fresh_main(spark, sf), nutrition_detail(b.wide(spark, sf)), scratch(spark, "s14"))
    return master.groupBy(F.col("nutri_score").isNull().alias("unscored")).agg(
        F.count("*").alias("n"), F.count("fat_g").alias("n_fat"), F.count("protein_g").alias("n_protein")
    )


@query(
    "s14_narrow_search_table",
    "SELECT recipe_id, instructions_text FROM main LEFT JOIN details USING (recipe_id) WHERE cook_minutes <= 10",
    b.MAIN,
    b.DETAILS,
)
def s14_narrow(spark, sf):
    narrow = serving.search_table(b.fresh_main(spark, sf), nutrition_detail(b.wide(spark, sf)), scratch(spark, "s14"))
    return narrow.filter("cook_minutes <= 10").select("recipe_id", "instructions_text")


@query("s15_pinned_table", "SELECT ingredient, count(*) AS n FROM item_index GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10", b.MAIN, b.INDEX)
def s15(spark, sf):
    pinned = store.pin(inverted_index(b.fresh_main(spark, sf)))
    try:
        return store.export(top_values(pinned, "ingredient", 10, "n"), scratch(spark, "s15"))
    finally:
        pinned.unpersist()


@query(
    "s6_final_scan",
    "SELECT recipe_id, fat_g FROM details WHERE fat_g > 20",
    b.WIDE,
    b.DETAILS,
)
def s6(spark, sf):
    path = scratch(spark, "s6")
    store.write_clustered(nutrition_detail(b.wide(spark, sf)).select("recipe_id", *MACROS), path, ["recipe_id"])
    return store.read_table(spark, path).filter("fat_g > 20").select("recipe_id", "fat_g")


@query(
    "s2_csv_numbers",
    "SELECT CAST(c_custkey AS VARCHAR) AS id, c_acctbal AS kcal FROM customer",
)
def s2_numbers(spark, sf):
    path = scratch(spark, "s2")
    raw = b.raw_kaggle(spark, sf)
    raw.write.option("header", True).option("escape", '"').csv(path)
    rows = read_csv_records(spark, path, schemas.RAW_KAGGLE, multi_line=False)
    return rows.select("id", leading_number("nutrition").alias("kcal"))
