"""Joins, re-assembly and unnesting."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.functions.text import title_key
from larder.operators import joins
from larder.operators.charts import macro_totals
from larder.operators.dedupe import keep_one
from larder.operators.filters import Facets
from larder.operators.items import inverted_index, unnested
from larder.plans.assemble import assemble
from larder.plans.ingest import RESOURCES
from larder.workload import bindings as b
from larder.workload.registry import query, table


@query(
    "j1_left_join",
    "SELECT doc_id, lang, coalesce(quality, -1) AS quality, coalesce(toxic, -1) AS toxic FROM documents LEFT JOIN labels USING (doc_id)",
)
def j1(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    joined = joins.left_join(docs, table(spark, sf, "labels"), "doc_id")
    return joined.select(
        "doc_id", "lang", *(F.coalesce(c, F.lit(-1)).alias(c) for c in ("quality", "toxic"))
    )


_TITLES = f"""titles AS (
  SELECT {b.KEY_SQL.format("upper(p_name) || CASE WHEN p_size > 25 THEN '!' ELSE ' small' END")} AS dim_key,
    min(p_retailprice) AS kcal FROM part GROUP BY 1)"""


def _title_dim(spark, sf):
    """All parts; the small ones have titles that no row asks for, so some rows stay unmatched."""
    ending = F.when(F.col("p_size") > 25, "!").otherwise(" small")
    named = table(spark, sf, "part").select(
        title_key(F.concat(F.upper("p_name"), ending)).alias("dim_key"), F.col("p_retailprice").alias("kcal")
    )
    return keep_one(named, ["dim_key"])


_J2 = f"""SELECT p_partkey, coalesce(kcal, -1) AS kcal FROM part
  LEFT JOIN titles ON dim_key = CASE WHEN p_type = 'PROMO' THEN '' ELSE {b.KEY_SQL.format('p_name')} END"""


def _parts(spark, sf):
    key = F.when(F.col("p_type") == "PROMO", "").otherwise(title_key("p_name"))
    return table(spark, sf, "part").select("p_partkey", key.alias("title_norm"))


@query("j2_left_join_on_title_key", _J2, _TITLES)
def j2(spark, sf):
    joined = joins.left_join_on(_parts(spark, sf), _title_dim(spark, sf), "title_norm", "dim_key")
    return joined.select("p_partkey", F.coalesce("kcal", F.lit(-1.0)).alias("kcal"))


@query("j2_spread_left_join", _J2, _TITLES)
def j2_spread(spark, sf):
    parts = _parts(spark, sf)
    hot = joins.frequent_values(parts, "title_norm", width=64)
    joined = joins.spread_left_join(parts, _title_dim(spark, sf), "title_norm", "dim_key", hot, ["p_partkey"])
    return joined.select("p_partkey", F.coalesce("kcal", F.lit(-1.0)).alias("kcal"))


_WIDE_DIGEST = """SELECT id, title_norm, coalesce(image_url, '') AS image_url, coalesce(has_image, false) AS has_image,
  coalesce(len(ingredients_validated), 0) AS n_valid, coalesce(mit_energy_kcal, -1) AS mit_energy_kcal,
  coalesce(kaggle_energy_kcal, -1) AS kaggle_energy_kcal, coalesce(cook_minutes, -1) AS cook_minutes,
  coalesce(description, '') AS description, coalesce(array_to_string(tags, '|'), '') AS tag_list,
  coalesce(sugars_g, -1) AS sugars_g, n_steps FROM assembled"""


@query("j3_cascade", _WIDE_DIGEST, b.STAGING)
def j3(spark, sf):
    wide = assemble({name: RESOURCES[name].stage(raw(spark, sf)) for name, raw in b.RAW.items()})
    none = F.lit(-1.0)
    return wide.select(
        "id",
        "title_norm",
        F.coalesce("image_url", F.lit("")).alias("image_url"),
        F.coalesce("has_image", F.lit(False)).alias("has_image"),
        F.coalesce(F.size("ingredients_validated"), F.lit(0)).cast("bigint").alias("n_valid"),
        F.coalesce("mit_energy_kcal", none).alias("mit_energy_kcal"),
        F.coalesce("kaggle_energy_kcal", none).alias("kaggle_energy_kcal"),
        F.coalesce("cook_minutes", F.lit(-1)).cast("bigint").alias("cook_minutes"),
        F.coalesce("description", F.lit("")).alias("description"),
        F.coalesce(F.array_join("tags", "|"), F.lit("")).alias("tag_list"),
        F.coalesce("sugars_g", none).alias("sugars_g"),
        "n_steps",
    )


@query(
    "j4_inner_join_under_facets",
    """SELECT round(sum(fat_g), 4) AS fat_g, round(sum(salt_g), 4) AS salt_g FROM details JOIN main USING (recipe_id)
      WHERE nutri_score IN ('A', 'B') AND cook_time_category IN ('rapide') AND mit_energy_kcal >= 10""",
    b.MAIN,
    b.DETAILS,
)
def j4(spark, sf):
    facets = Facets(scores=["A", "B"], classes=["rapide"], kcal_min=10)
    totals = macro_totals(b.details(spark, sf), b.main(spark, sf), facets, columns=["fat_g", "salt_g"])
    return totals.select(*(F.round(c, 4).alias(c) for c in totals.columns))


@query(
    "j5_master_left_join",
    "SELECT recipe_id, title, coalesce(protein_g, -1) AS protein_g FROM main LEFT JOIN details USING (recipe_id)",
    b.MAIN,
    b.DETAILS,
)
def j5(spark, sf):
    master = joins.with_details(b.main(spark, sf), b.details(spark, sf))
    return master.select("recipe_id", "title", F.coalesce("protein_g", F.lit(-1.0)).alias("protein_g"))


@query(
    "j6_restrict_to_ids",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')",
)
def j6(spark, sf):
    returned = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").withColumnRenamed("l_orderkey", "o_orderkey")
    return joins.restrict_to(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), returned, "o_orderkey")


@query(
    "j7_lateral_unnest",
    "SELECT doc_id, unnest(string_split(text, E'\\n')) AS line FROM documents",
)
def j7(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    return unnested(docs, "lines", "line")


_LINES = """lists AS (
  SELECT l_orderkey AS o_orderkey, string_agg(CAST(l_partkey AS VARCHAR), '|' ORDER BY l_linenumber, l_partkey) AS parts
  FROM lineitem GROUP BY 1)"""


@query(
    "j8_reassembled_lists",
    """SELECT o_orderkey, o_orderstatus, coalesce(parts, '') AS parts FROM orders LEFT JOIN lists USING (o_orderkey)""",
    _LINES,
)
def j8(spark, sf):
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    parts = joins.reassembled(lines, "o_orderkey", "l_linenumber", "l_partkey", "parts")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    joined = joins.attach_lists(orders, [parts], "o_orderkey")
    return joined.select("o_orderkey", "o_orderstatus", F.coalesce(F.array_join("parts", "|"), F.lit("")).alias("parts"))


@query(
    "a23_ordered_list_aggregate",
    "SELECT conv_id, count(*) AS n, md5(string_agg(text, '|' ORDER BY turn)) AS digest FROM conversations GROUP BY conv_id",
)
def a23(spark, sf):
    texts = joins.reassembled(table(spark, sf, "conversations"), "conv_id", "turn", "text", "texts")
    return texts.select(
        "conv_id", F.size("texts").cast("bigint").alias("n"), F.md5(F.array_join("texts", "|")).alias("digest")
    )


@query(
    "j9_checked_broadcast",
    """SELECT r_name, n_name, count(*) AS n_customers FROM customer JOIN nation ON c_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
)
def j9(spark, sf):
    nations = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, sf, "customer").select("c_nationkey")
    joined = customers.join(joins.small_side(nations), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("r_name", "n_name").agg(F.count("*").alias("n_customers"))


@query(
    "j3_star_cascade",
    """SELECT r_name, count(*) AS n_lines, count(DISTINCT o_orderkey) AS n_orders,
      round(sum(l_quantity), 1) AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""",
)
def j3_star(spark, sf):
    """The base-and-dimensions shape of the catalog at volume: a fact table through four dimensions."""
    nations = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, sf, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    orders = table(spark, sf, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    lines = table(spark, sf, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.groupBy("r_name").agg(
        F.count("*").alias("n_lines"),
        F.count_distinct("o_orderkey").alias("n_orders"),
        F.round(F.sum("l_quantity"), 1).alias("quantity"),
    )


@query(
    "p13_rename_and_drop",
    f"""SELECT {b.KEY_SQL.format("'Src' || c_nationkey || ' fr?'")} AS kaggle_title_norm, min(c_nationkey) AS minutes
      FROM customer GROUP BY 1""",
)
def p13(spark, sf):
    staged = RESOURCES["kaggle"].stage(b.raw_kaggle(spark, sf))
    clear = staged.drop("n_steps").withColumnRenamed("title_norm", "kaggle_title_norm")
    return clear.select("kaggle_title_norm", F.col("cook_minutes").cast("int").alias("minutes"))


@query("u1_inverted_index", "SELECT recipe_id, title, cook_time_category, ingredient FROM item_index", b.MAIN, b.INDEX)
def u1(spark, sf):
    rows = inverted_index(b.fresh_main(spark, sf))
    return rows.select("recipe_id", "title", "cook_time_category", "ingredient")


_WORD_INDEX = f"""SELECT w AS ingredient, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM (
  SELECT doc_id, lower(trim(unnest(string_split(text, ' ')))) AS w FROM documents) x WHERE w <> '' GROUP BY w"""


@query("u1_inverted_index_of_texts", _WORD_INDEX)
def u1_texts(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.split("text", " ").alias("words"))
    words = inverted_index(docs, "words", carry=["doc_id"])
    return words.groupBy("ingredient").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("n_docs"))


@query(
    "u2_inline_unnest",
    "SELECT tag, count(*) AS n FROM (SELECT unnest(tags) AS tag FROM main) t GROUP BY tag",
    b.MAIN,
)
def u2(spark, sf):
    return unnested(b.main(spark, sf), "tags", "tag", keep=[]).groupBy("tag").agg(F.count("*").alias("n"))
