"""Scalar expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.constants import NO_ITEMS, NO_STEPS
from larder.functions import arrays, bands, macros, numbers, text
from larder.plans import ingest, publish
from larder.workload import bindings as b
from larder.workload.registry import query, table


def _digest(items) -> F.Column:
    return F.md5(F.array_join(items, "|"))


_NOISY_SQL = "'  ' || upper(p_name) || ' & ' || p_brand || E'!\\t'"


@query("p1_title_key", f"SELECT p_partkey, {b.KEY_SQL.format(_NOISY_SQL)} AS title_norm FROM part")
def p1(spark, sf):
    noisy = F.concat(F.lit("  "), F.upper("p_name"), F.lit(" & "), F.col("p_brand"), F.lit("!\t"))
    return table(spark, sf, "part").select("p_partkey", text.title_key(noisy).alias("title_norm"))


@query(
    "p1_title_key_of_texts",
    f"SELECT doc_id, length(k) AS n, md5(k) AS digest FROM (SELECT doc_id, {b.KEY_SQL.format('text')} AS k FROM documents) d",
)
def p1_texts(spark, sf):
    key = table(spark, sf, "documents").select("doc_id", text.title_key("text").alias("k"))
    return key.select("doc_id", F.length("k").cast("bigint").alias("n"), F.md5("k").alias("digest"))


@query(
    "p2_joined_steps",
    "SELECT doc_id, md5(replace(text, E'\\n', ' | ')) AS digest FROM documents",
)
def p2(spark, sf):
    steps = F.transform(F.split("text", "\n"), lambda s: F.struct(s.alias("text")))
    docs = table(spark, sf, "documents").select("doc_id", steps.alias("steps"))
    return docs.select("doc_id", F.md5(text.joined_texts("steps")).alias("digest"))


@query(
    "p3_struct_field_texts",
    "SELECT doc_id, CAST(len(string_split(text, ' ')) AS INTEGER) AS n, md5(replace(text, ' ', '|')) AS digest FROM documents",
)
def p3(spark, sf):
    words = F.transform(F.split("text", " "), lambda s: F.struct(s.alias("text")))
    docs = table(spark, sf, "documents").select("doc_id", text.field_texts(words).alias("texts"))
    return docs.select("doc_id", F.size("texts").alias("n"), _digest("texts").alias("digest"))


@query(
    "p4_array_length",
    "SELECT recipe_id, CAST(coalesce(len(tags), 0) AS INTEGER) AS n_tags FROM main",
    b.MAIN,
)
def p4(spark, sf):
    return b.fresh_main(spark, sf).select("recipe_id", arrays.length("tags").alias("n_tags"))


@query(
    "p5_first_and_flag",
    "SELECT recipe_id, coalesce(image_urls[1], 'none') AS first_url, coalesce(len(image_urls), 0) > 0 AS has_any FROM main",
    b.MAIN,
)
def p5(spark, sf):
    first = F.coalesce(arrays.first("image_urls"), F.lit("none"))
    return b.fresh_main(spark, sf).select("recipe_id", first.alias("first_url"), arrays.non_empty("image_urls").alias("has_any"))


@query(
    "p6_masked_texts",
    f"""SELECT doc_id, CAST(len(kept) AS INTEGER) AS n, md5(coalesce(array_to_string(kept, '|'), '')) AS digest FROM (
      SELECT doc_id, [trim(lower(w), {b.SPACES}) for w in string_split(text, ' ') if length(w) > 4] AS kept FROM documents) d""",
)
def p6(spark, sf):
    words = F.split("text", " ")
    docs = table(spark, sf, "documents").select(
        "doc_id",
        F.transform(words, lambda w: F.struct(w.alias("text"))).alias("records"),
        F.transform(words, lambda w: F.length(w) > 4).alias("mask"),
    )
    kept = docs.select("doc_id", arrays.masked_texts("records", "mask").alias("kept"))
    return kept.select("doc_id", F.size("kept").alias("n"), _digest("kept").alias("digest"))


@query(
    "p7_flattened_struct",
    f"""SELECT 'src' || user_id || ' en' AS title, {b.KEY_SQL.format("'src' || user_id || ' en'")} AS title_norm,
      value AS energy_kcal, value * 0.1 AS fat_g, value * 0.05 AS protein_g, value * 0.01 AS salt_g,
      value * 0.2 AS saturates_g, value * 0.5 AS sugars_g FROM events""",
)
def p7(spark, sf):
    return ingest.stage_nutrition(b.raw_nutrition(spark, sf))


@query(
    "p8_listed_items",
    "SELECT p_partkey, p_name || '|' || p_brand || '|' || p_type AS items FROM part",
)
def p8(spark, sf):
    printed = F.concat(
        F.lit("['"), "p_name", F.lit("', '"), "p_brand", F.lit("',  '"), "p_type", F.lit("', '']")
    )
    items = text.listed_items(printed)
    return table(spark, sf, "part").select("p_partkey", F.array_join(items, "|").alias("items"))


@query("p9_leading_number", "SELECT p_partkey, p_retailprice AS kcal FROM part")
def p9(spark, sf):
    printed = F.concat(F.lit("[ "), F.col("p_retailprice").cast("string"), F.lit(", 12.0, bad]"))
    return table(spark, sf, "part").select("p_partkey", numbers.leading_number(printed).alias("kcal"))


@query(
    "p10_digits_or_null",
    """SELECT p_partkey, CASE WHEN p_type IN ('SMALL', 'PROMO') THEN 'null' ELSE substr(p_brand, 7) END AS number_text,
      CASE WHEN p_type IN ('SMALL', 'PROMO') THEN CAST(-1 AS BIGINT) ELSE CAST(substr(p_brand, 7) AS BIGINT) END AS number
      FROM part""",
)
def p10(spark, sf):
    digits = F.expr("substring(p_brand, 7)")
    printed = (
        F.when(F.col("p_type") == "SMALL", F.concat(F.lit("-"), digits))
        .when(F.col("p_type") == "PROMO", F.concat(digits, F.lit(".0")))
        .otherwise(digits)
    )
    parts = table(spark, sf, "part").select("p_partkey", numbers.digits(printed).alias("number"))
    return parts.select(
        "p_partkey",
        F.coalesce(F.col("number").cast("string"), F.lit("null")).alias("number_text"),
        F.coalesce("number", F.lit(-1)).cast("bigint").alias("number"),
    )


@query(
    "p11_blank_to_null",
    """SELECT c_nationkey, count(*) AS n, count(*) FILTER (WHERE c_acctbal >= 0) AS n_known
      FROM customer GROUP BY c_nationkey""",
)
def p11(spark, sf):
    segment = F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_mktsegment"))
    known = table(spark, sf, "customer").select("c_nationkey", text.blank_to_null(segment).alias("segment"))
    return known.groupBy("c_nationkey").agg(F.count("*").alias("n"), F.count("segment").alias("n_known"))


@query(
    "p12_json_strings",
    """SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'null' WHEN 'SMALL' THEN 'null'
      ELSE p_name || '|' || p_size END AS items FROM part""",
)
def p12(spark, sf):
    encoded = F.to_json(F.array("p_name", F.col("p_size").cast("string")))
    printed = F.when(F.col("p_type") == "PROMO", "[bad").when(F.col("p_type") == "SMALL", "").otherwise(encoded)
    decoded = F.coalesce(F.array_join(text.json_strings(printed), "|"), F.lit("null"))
    return table(spark, sf, "part").select("p_partkey", decoded.alias("items"))


@query(
    "p14_null_safe_count",
    """SELECT nutri_score IS NULL AS unscored, n_ingredients_validated AS n, count(*) AS n_recipes
      FROM main GROUP BY 1, 2""",
    b.MAIN,
)
def p14(spark, sf):
    rows = b.fresh_main(spark, sf).select(
        F.col("nutri_score").isNull().alias("unscored"), arrays.length("ingredients_validated").alias("n")
    )
    return rows.groupBy("unscored", "n").agg(F.count("*").alias("n_recipes"))


@query(
    "p15_score_band",
    f"SELECT recipe_id, coalesce({b.SCORE_SQL.format('mit_energy_kcal')}, 'none') AS score FROM main",
    b.MAIN,
)
def p15(spark, sf):
    score = F.coalesce(bands.score_band("mit_energy_kcal"), F.lit("none"))
    return b.fresh_main(spark, sf).select("recipe_id", score.alias("score"))


@query(
    "p16_time_band",
    f"SELECT recipe_id, {b.TIME_SQL.format('cook_minutes')} AS time_class FROM main",
    b.MAIN,
)
def p16(spark, sf):
    return b.fresh_main(spark, sf).select("recipe_id", bands.time_band("cook_minutes").alias("time_class"))


@query(
    "p17_fallback_score",
    f"SELECT recipe_id, {b.SCORE_SQL.format('coalesce(mit_energy_kcal, kaggle_energy_kcal)')} AS score FROM main",
    b.MAIN,
)
def p17(spark, sf):
    score = bands.fallback_score("mit_energy_kcal", "kaggle_energy_kcal")
    return b.fresh_main(spark, sf).select("recipe_id", score.alias("score"))


@query(
    "p18_flag_default",
    "SELECT doc_id, coalesce(quality = 1, false) AS is_good FROM documents LEFT JOIN labels USING (doc_id)",
)
def p18(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return docs.select("doc_id", bands.flag(F.col("quality") == 1).alias("is_good"))


@query(
    "p19_array_default",
    "SELECT recipe_id, CAST(len(coalesce(tags, [])) AS INTEGER) AS n, coalesce(array_to_string(tags, '|'), '') AS tag_list FROM main",
    b.MAIN,
)
def p19(spark, sf):
    tags = b.fresh_main(spark, sf).select("recipe_id", arrays.or_empty("tags").alias("tags"))
    return tags.select("recipe_id", F.size("tags").alias("n"), F.array_join("tags", "|").alias("tag_list"))


@query(
    "p20_clean_item",
    "SELECT p_partkey, lower(p_name) AS item FROM part",
)
def p20(spark, sf):
    noisy = F.concat(F.lit("  "), F.upper("p_name"), F.lit(" "))
    return table(spark, sf, "part").select("p_partkey", text.clean_item(noisy).alias("item"))


@query(
    "p21_published_projection",
    f"""SELECT recipe_id, source_url, n_ingredients_validated, coalesce(cook_minutes, -1) AS cook_minutes, cook_time_category,
      has_image, coalesce(nutri_score, 'none') AS nutri_score, coalesce(array_to_string(tags, '|'), '') AS tag_list,
      coalesce(fat_g, -1) AS fat_g FROM wide""",
    b.WIDE,
)
def p21(spark, sf):
    """The contract's columns from joined rows under their staging names and types."""
    joined = b.wide(spark, sf).drop("n_ingredients_validated", "cook_time_category", "nutri_score")
    joined = joined.withColumnsRenamed({"recipe_id": "id", "source_url": "url"}).withColumns(
        {"cook_minutes": F.col("cook_minutes").cast("bigint"), "has_image": F.when(F.col("has_image"), True)}
    )
    return publish.enriched(joined).select(
        "recipe_id",
        "source_url",
        "n_ingredients_validated",
        F.coalesce("cook_minutes", F.lit(-1)).alias("cook_minutes"),
        "cook_time_category",
        "has_image",
        F.coalesce("nutri_score", F.lit("none")).alias("nutri_score"),
        F.array_join("tags", "|").alias("tag_list"),
        F.coalesce("fat_g", F.lit(-1.0)).alias("fat_g"),
    )


@query(
    "p22_bucket",
    """SELECT CAST(floor(cook_minutes / 5) * 5 AS BIGINT) AS bucket, count(*) AS n
      FROM main WHERE cook_minutes IS NOT NULL GROUP BY 1""",
    b.MAIN,
)
def p22(spark, sf):
    known = b.fresh_main(spark, sf).filter(F.col("cook_minutes").isNotNull())
    return known.groupBy(numbers.bucket("cook_minutes", 5).alias("bucket")).agg(F.count("*").alias("n"))


@query(
    "p23_placeholder",
    "SELECT coalesce(nutri_score, '?') AS score, count(*) AS n FROM main GROUP BY 1",
    b.MAIN,
)
def p23(spark, sf):
    return b.fresh_main(spark, sf).groupBy(bands.labelled("nutri_score").alias("score")).agg(F.count("*").alias("n"))


@query(
    "p24_numbered_steps",
    f"""SELECT doc_id, CAST(greatest(len(steps), 1) AS INTEGER) AS n,
      md5(CASE WHEN len(steps) = 0 THEN '{NO_STEPS}'
          ELSE array_to_string([(i || '. ' || steps[i]) for i in range(1, len(steps) + 1)], '|') END) AS digest
      FROM (SELECT doc_id, [trim(s, {b.SPACES}) for s in
              CASE WHEN contains(text, '|') THEN string_split(text, '|') ELSE string_split(text, E'\\n') END
              if trim(s, {b.SPACES}) <> ''] AS steps FROM documents) d""",
)
def p24(spark, sf):
    steps = table(spark, sf, "documents").select("doc_id", text.numbered_steps("text").alias("steps"))
    return steps.select("doc_id", F.size("steps").alias("n"), _digest("steps").alias("digest"))


@query(
    "p25_first_items",
    f"""SELECT o_orderkey, CAST(greatest(least(len(items), 3), 1) AS INTEGER) AS n,
      CASE WHEN len(items) > 0 THEN array_to_string(items[1:3], '|') ELSE '{NO_ITEMS}' END AS items
      FROM (SELECT o_orderkey, [w for w in string_split(o_orderpriority || ' ' || o_orderstatus || ' a b', ' ')
              if o_orderstatus <> 'F'] AS items FROM orders) o""",
)
def p25(spark, sf):
    line = F.concat("o_orderpriority", F.lit(" "), "o_orderstatus", F.lit(" a b"))
    items = F.when(F.col("o_orderstatus") != "F", F.split(line, " "))
    top = table(spark, sf, "orders").select("o_orderkey", arrays.head(items, 3).alias("items"))
    return top.select("o_orderkey", F.size("items").alias("n"), F.array_join("items", "|").alias("items"))


@query(
    "p26_image_candidates",
    """SELECT recipe_id, CASE WHEN image_url IS NULL THEN '' ELSE array_to_string(image_urls, '|') END AS images FROM main""",
    b.MAIN,
)
def p26(spark, sf):
    images = arrays.candidates("image_url", "image_urls")
    return b.fresh_main(spark, sf).select("recipe_id", F.array_join(images, "|").alias("images"))


@query(
    "p27_list_in_text",
    "SELECT o_orderkey, o_orderstatus || '|' || o_orderpriority || '|x' AS items FROM orders",
)
def p27(spark, sf):
    plain = F.concat_ws(", ", "o_orderstatus", "o_orderpriority", F.lit(" x"), F.lit(""))
    bracketed = F.concat(F.lit("['"), "o_orderstatus", F.lit("', '"), "o_orderpriority", F.lit("', 'x']"))
    printed = F.when(F.col("o_orderstatus") == "F", bracketed).otherwise(plain)
    return table(spark, sf, "orders").select("o_orderkey", F.array_join(text.listed_items(printed), "|").alias("items"))


@query(
    "p28_rounded_shares",
    """SELECT event_type, CAST(round(CAST(100.0 * count(*) FILTER (WHERE value < 80) / count(*) AS DECIMAL(18, 9)), 1) AS DOUBLE) AS pct,
      round(avg(value)) AS mean_value FROM events GROUP BY event_type""",
)
def p28(spark, sf):
    n = F.count("*")
    return (
        table(spark, sf, "events")
        .groupBy("event_type")
        .agg(
            numbers.share(F.count_if(F.col("value") < 80), n, 1).alias("pct"),
            F.round(F.avg("value")).alias("mean_value"),
        )
    )


@query(
    "p29_sql_functions",
    f"""SELECT e.event_id, {b.KEY_SQL.format("'  ' || event_type || '-' || e.user_id || '! '")} AS title_norm,
      coalesce({b.SCORE_SQL.format('value')}, '') AS score, {b.TIME_SQL.format('e.user_id')} AS time_class FROM events e""",
)
def p29(spark, sf):
    macros.register_sql_functions(spark)
    table(spark, sf, "events").createOrReplaceTempView("p29_events")
    return spark.sql(
        """SELECT event_id, normalize_title('  ' || event_type || '-' || user_id || '! ') AS title_norm,
             coalesce(nutri_score(value), '') AS score, cook_time_cat(user_id) AS time_class FROM p29_events"""
    )
