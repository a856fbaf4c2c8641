"""Full-text search, substring search, record cards and the sampled scatter set."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from larder.constants import NO_ITEMS
from larder.operators import charts, grams, lookup, search
from larder.operators.filters import Facets
from larder.session import scratch
from larder.workload import bindings as b
from larder.workload.registry import query, table


def _stem(term: str) -> str:
    return f"""CASE WHEN NOT {term}.ends_with('s') OR regexp_matches({term}, '[us]s$') OR length({term}) < 3 THEN {term}
      WHEN {term}.ends_with('ies') AND NOT regexp_matches({term}, '[ae]ies$') AND length({term}) > 3
        THEN substr({term}, 1, length({term}) - 3) || 'y' ELSE substr({term}, 1, length({term}) - 1) END"""


def _postings(source: str, key: str, fields: dict[str, str]) -> str:
    """The index as CTEs: occurrences, postings, document lengths, document frequencies, corpus."""
    words = " UNION ALL ".join(
        f"SELECT {key} AS id, '{name}' AS field, unnest(regexp_extract_all(lower(strip_accents({expr})), '[a-z0-9]+')) AS w FROM {source}"
        for name, expr in fields.items()
    )
    tfs = ", ".join(f"count(*) FILTER (WHERE field = '{name}') AS tf_{name}" for name in fields)
    return f"""occurrences AS (SELECT id, field, {_stem('w')} AS term FROM ({words}) x),
      lengths AS (SELECT s.{key} AS id, count(o.term) AS dl FROM {source} s LEFT JOIN occurrences o ON o.id = s.{key} GROUP BY 1),
      corpus AS (SELECT count(*) AS n_docs, avg(dl) AS avgdl FROM lengths),
      postings AS (SELECT id, term, {tfs} FROM occurrences GROUP BY 1, 2),
      terms AS (SELECT term, count(*) AS df FROM postings GROUP BY 1)"""


def _scores(words: list[str], fields: list[str]) -> str:
    terms = ", ".join(f"({_stem(repr(w))})" for w in words)
    tf = " + ".join(f"tf_{f}" for f in fields)
    return f"""scores AS (SELECT id, sum(ln((n_docs - df + 0.5) / (df + 0.5) + 1.0) * (tf * 2.2)
        / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))) AS score
      FROM (SELECT id, term, {tf} AS tf FROM postings WHERE term IN ({terms})) p
      JOIN terms USING (term) JOIN lengths USING (id), corpus WHERE tf > 0 GROUP BY id)"""


DOC_INDEX = _postings("documents", "doc_id", {"text": "text", "source": "source"})
MAIN_INDEX = _postings(
    "main", "recipe_id", {"title": "title", "ingredients_raw": "array_to_string(ingredients_raw, ' ')"}
)


@lru_cache(maxsize=8)
def _stored(app: str, spark, sf: str, kind: str, version: tuple) -> search.TextIndex:
    return _create(spark, sf, kind)


def _create(spark, sf: str, kind: str) -> search.TextIndex:
    path = scratch(spark, f"text-index-{kind}")
    if kind == "documents":
        return search.create_index(table(spark, sf, "documents"), path, "doc_id", ("text", "source"))
    return search.create_index(b.main(spark, sf), path, "recipe_id", ("title", "ingredients_raw"))


def _index(spark, sf: str, kind: str) -> search.TextIndex:
    """The stored index of this session; like a catalog's, it is built once and queried many times."""
    source = "documents" if kind == "documents" else "events"
    return _stored(spark.sparkContext.applicationId, spark, sf, kind, b.version(spark, sf, source))


@query(
    "r1_text_index",
    """SELECT term, df, CAST(sum(tf_text) AS BIGINT) AS tf_text, CAST(sum(tf_source) AS BIGINT) AS tf_source,
      CAST(sum(dl) AS BIGINT) AS dl, min(n_docs) AS n_docs, round(min(avgdl), 6) AS avgdl
      FROM postings JOIN terms USING (term) JOIN lengths USING (id), corpus GROUP BY term, df""",
    DOC_INDEX,
)
def r1(spark, sf):
    index = _create(spark, sf, "documents")
    sums = index.postings.groupBy("term").agg(
        F.sum("tf_text").alias("tf_text"), F.sum("tf_source").alias("tf_source"), F.sum("dl").alias("dl")
    )
    corpus = index.corpus
    return sums.join(index.terms.drop("idf"), "term").select(
        "*",
        corpus.select("n_docs").scalar().alias("n_docs"),
        F.round(corpus.select("avgdl").scalar(), 6).alias("avgdl"),
    )


@query(
    "r2_bm25_all_matches",
    "SELECT id AS doc_id, round(score, 6) AS score FROM scores",
    DOC_INDEX,
    _scores(["the", "ention", "src3"], ["text", "source"]),
)
def r2(spark, sf):
    scores = search.bm25(_index(spark, sf, "documents"), " The ention, SRC3! ")
    return scores.select("doc_id", F.round("score", 6).alias("score"))


@query(
    "r2_bm25_top",
    "SELECT doc_id, lang, source, round(score, 6) AS score FROM scores JOIN documents ON doc_id = id ORDER BY 4 DESC, 1 LIMIT 8",
    DOC_INDEX,
    _scores(["creme", "eaux", "thes"], ["text", "source"]),
)
def r2_top(spark, sf):
    docs = table(spark, sf, "documents")
    index = _index(spark, sf, "documents")
    return search.full_text(docs, index, "Crème eaux thes", columns=("doc_id", "lang", "source"))


@query(
    "r2_ranked_by_bounds",
    "SELECT id AS doc_id, round(score, 6) AS score FROM scores ORDER BY 2 DESC, 1 LIMIT 100",
    DOC_INDEX,
    _scores(["ention", "the", "la", "und"], ["text"]),
)
def r2_ranked(spark, sf):
    """The best of many matches of frequent words: cells below the hundredth score are not read."""
    return search.top_scores(_index(spark, sf, "documents"), "ention the la und", 100, ["text"])[0]


@query(
    "r2_cell_bounds",
    """SELECT CAST(count(*) AS BIGINT) AS n_postings, bool_and(score > 0) AS all_score, true AS all_bound FROM scores JOIN
      (SELECT id, term FROM postings WHERE term IN ('the', 'ention')) p USING (id)""",
    DOC_INDEX,
    _scores(["the", "ention"], ["text", "source"]),
)
def r2_bounds(spark, sf):
    """Every score is below its cell's bound, and the cells of the bounds hold all postings of the words."""
    index, wanted = _index(spark, sf, "documents"), ["the", "ention"]
    cells = search.bounds(index, wanted)
    scores = search.bm25(index, "the ention")
    placed = index.blocks.filter(F.col("term").isin(wanted)).select("cell", F.explode("docs.doc_id").alias("doc_id"))
    met = placed.join(scores, "doc_id").join(cells, "cell")
    return met.agg(
        F.count("*").alias("n_postings"), F.bool_and(F.col("score") > 0).alias("all_score"), F.bool_and(F.col("score") <= F.col("bound") + 1e-9).alias("all_bound")
    )


@query(
    "r2_bm25_catalog",
    """SELECT recipe_id, title, coalesce(nutri_score, 'none') AS nutri_score, cook_time_category, round(score, 6) AS score
      FROM scores JOIN main ON recipe_id = id ORDER BY 5 DESC, 1 LIMIT 8""",
    b.MAIN,
    MAIN_INDEX,
    _scores(["view", "42"], ["title", "ingredients_raw"]),
)
def r2_catalog(spark, sf):
    found = search.full_text(b.main(spark, sf), _index(spark, sf, "main"), "view 42")
    return found.withColumn("nutri_score", F.coalesce("nutri_score", F.lit("none")))


@query(
    "r2_blank_query",
    "SELECT count(*) AS n_found FROM documents WHERE false",
)
def r2_blank(spark, sf):
    scores = search.bm25(_index(spark, sf, "documents"), "  ?! ")
    return scores.agg(F.count("*").alias("n_found"))


@query(
    "r3_bm25_by_name",
    """SELECT recipe_id, title, coalesce(cook_minutes, -1) AS cook_minutes, round(score, 6) AS score
      FROM scores JOIN main ON recipe_id = id ORDER BY 4 DESC, 1 LIMIT 20""",
    b.MAIN,
    MAIN_INDEX,
    _scores(["clicks", "7"], ["title"]),
)
def r3(spark, sf):
    found = search.full_text_by_name(b.main(spark, sf), _index(spark, sf, "main"), "clicks 7")
    return found.select("recipe_id", "title", F.coalesce("cook_minutes", F.lit(-1)).alias("cook_minutes"), "score")


@query(
    "r4_bm25_by_ingredient",
    """SELECT recipe_id, title, array_to_string(ingredients_raw, '|') AS items, round(score, 6) AS score
      FROM scores JOIN main ON recipe_id = id ORDER BY 4 DESC, 1 LIMIT 20""",
    b.MAIN,
    MAIN_INDEX,
    _scores(["items", "99"], ["ingredients_raw"]),
)
def r4(spark, sf):
    found = search.full_text_by_item(b.main(spark, sf), _index(spark, sf, "main"), "items 99")
    return found.select("recipe_id", "title", F.array_join("ingredients_raw", "|").alias("items"), "score")


@query(
    "r5_bm25_composite",
    """SELECT recipe_id, title FROM main WHERE cook_minutes <= 30 AND nutri_score = 'A' AND recipe_id IN (SELECT id FROM scores)
      ORDER BY recipe_id LIMIT 20""",
    b.MAIN,
    MAIN_INDEX,
    _scores(["purchase", "item"], ["title", "ingredients_raw"]),
)
def r5(spark, sf):
    found = search.full_text_advanced(
        b.main(spark, sf), _index(spark, sf, "main"), "purchase", "item", 30, "a", order_by="recipe_id"
    )
    return found.select("recipe_id", "title")


@query(
    "r6_substring_by_name",
    "SELECT recipe_id, title, coalesce(cook_minutes, -1) AS cook_minutes FROM main WHERE title ILIKE '%SIGN%1%' ORDER BY recipe_id LIMIT 20",
    b.MAIN,
)
def r6(spark, sf):
    found = lookup.by_name(b.main(spark, sf), "SIGN%1", order_by="recipe_id")
    return found.select("recipe_id", "title", F.coalesce("cook_minutes", F.lit(-1)).alias("cook_minutes"))


@query(
    "r7_substring_by_ingredient",
    """SELECT recipe_id, title, array_to_string(ingredients_raw, '|') AS items FROM main WHERE recipe_id IN
      (SELECT recipe_id FROM item_index WHERE ingredient ILIKE '%item 1%') ORDER BY recipe_id LIMIT 20""",
    b.MAIN,
    b.INDEX,
)
def r7(spark, sf):
    main = b.main(spark, sf)
    found = lookup.by_ingredient(main, b.index(spark, sf), "item 1", order_by="recipe_id")
    return found.select("recipe_id", "title", F.array_join("ingredients_raw", "|").alias("items"))


@query(
    "r8_substring_composite",
    """SELECT recipe_id, title, cook_time_category, mit_energy_kcal FROM main WHERE title ILIKE '%click%' AND cook_minutes <= 50
      AND nutri_score = 'B' AND recipe_id IN (SELECT recipe_id FROM item_index WHERE ingredient ILIKE '%user%')
      ORDER BY recipe_id LIMIT 20""",
    b.MAIN,
    b.INDEX,
)
def r8(spark, sf):
    found = lookup.advanced(b.main(spark, sf), b.index(spark, sf), "click", "user", 50, "B", order_by="recipe_id")
    return found.select("recipe_id", "title", "cook_time_category", "mit_energy_kcal")


@lru_cache(maxsize=8)
def _grams(app: str, spark, sf: str, kind: str, version: tuple) -> grams.GramIndex:
    if kind == "documents":
        return grams.create_gram_index(table(spark, sf, "documents"), scratch(spark, "text-grams"), "doc_id", "text")
    if kind == "titles":
        return grams.create_gram_index(b.main(spark, sf), scratch(spark, "title-grams"), "recipe_id", "title")
    return grams.item_index(b.index(spark, sf))


def _gram_index(spark, sf: str, kind: str) -> grams.GramIndex:
    """The stored grams of this session, as ``_index``."""
    source = "documents" if kind == "documents" else "events"
    return _grams(spark.sparkContext.applicationId, spark, sf, kind, b.version(spark, sf, source))


@query(
    "r6_text_by_grams",
    "SELECT doc_id, source, md5(text) AS digest FROM documents WHERE text ILIKE '%IN%onat_%and th%'",
)
def r6_text(spark, sf):
    found = grams.holding(table(spark, sf, "documents"), _gram_index(spark, sf, "documents"), "IN%onat_%and th")
    return found.select("doc_id", "source", F.md5("text").alias("digest"))


@query(
    "r6_rare_text_by_grams",
    "SELECT doc_id, source FROM documents WHERE text ILIKE '%ement qu%'",
)
def r6_rare(spark, sf):
    return grams.holding(table(spark, sf, "documents"), _gram_index(spark, sf, "documents"), "ement qu").select("doc_id", "source")


@query(
    "r8_composite_by_grams",
    """SELECT recipe_id, title, cook_time_category FROM main WHERE title ILIKE '%click%' AND cook_minutes <= 50
      AND recipe_id IN (SELECT recipe_id FROM item_index WHERE ingredient ILIKE '%user 1_%') ORDER BY recipe_id LIMIT 20""",
    b.MAIN,
    b.INDEX,
)
def r8_grams(spark, sf):
    titles, items = _gram_index(spark, sf, "titles"), _gram_index(spark, sf, "items")
    found = lookup.advanced(
        b.main(spark, sf), b.index(spark, sf), "click", "user 1_", 50, order_by="recipe_id", titles=titles, grams=items
    )
    return found.select("recipe_id", "title", "cook_time_category")


def _card(where: str) -> str:
    return f"""SELECT recipe_id, title, instructions_text, coalesce(array_to_string(ingredients_validated, '|'), '') AS items,
      coalesce(image_url, '') AS image_url, coalesce(nutri_score, '?') AS nutri_score, coalesce(fat_g, -1) AS fat_g
      FROM main LEFT JOIN details USING (recipe_id) WHERE {where}"""


def _card_digest(card):
    return card.select(
        "recipe_id",
        "title",
        "instructions_text",
        F.coalesce(F.array_join("ingredients_validated", "|"), F.lit("")).alias("items"),
        F.coalesce("image_url", F.lit("")).alias("image_url"),
        F.coalesce("nutri_score", F.lit("?")).alias("nutri_score"),
        F.coalesce("fat_g", F.lit(-1.0)).alias("fat_g"),
    )


@query("r9_recipe_card", _card("recipe_id = '77'"), b.MAIN, b.DETAILS)
def r9(spark, sf):
    return _card_digest(lookup.recipe_card(b.main(spark, sf), b.details(spark, sf), "77"))


@query(
    "r9_card_texts",
    f"""SELECT recipe_id, '1. ' || replace(instructions_text, ' | user', '|2. user') AS steps_so_far,
      CASE WHEN ingredients_validated IS NULL THEN '{NO_ITEMS}' ELSE array_to_string(ingredients_validated, '|') END AS items,
      coalesce(array_to_string(image_urls, '|'), '') AS images FROM main""",
    b.MAIN,
)
def r9_texts(spark, sf):
    texts = lookup.card_texts(b.main(spark, sf))
    steps = F.replace(F.array_join("steps", "|"), F.lit("|3. {"), F.lit(" | {"))
    return texts.select(
        "recipe_id", steps.alias("steps_so_far"), F.array_join("items", "|").alias("items"), F.array_join("images", "|").alias("images")
    )


@query(
    "r10_random_card",
    _card("recipe_id = (SELECT recipe_id FROM main WHERE has_image ORDER BY md5('5:' || recipe_id), recipe_id LIMIT 1)"),
    b.MAIN,
    b.DETAILS,
)
def r10(spark, sf):
    return _card_digest(lookup.random_card(b.main(spark, sf), b.details(spark, sf), seed=5))


@query(
    "r11_scatter_sample",
    """SELECT saturates_g, sugars_g, nutri_score, title FROM details JOIN main USING (recipe_id)
      WHERE saturates_g BETWEEN 0 AND 60 AND sugars_g BETWEEN 0 AND 100 AND nutri_score IN ('A', 'B')
      ORDER BY md5('0:' || recipe_id), recipe_id LIMIT 2000""",
    b.MAIN,
    b.DETAILS,
)
def r11(spark, sf):
    return charts.scatter(b.details(spark, sf), b.main(spark, sf), Facets(scores=["A", "B"]))


@query(
    "r11_scatter_candidates",
    """SELECT recipe_id, saturates_g, sugars_g, nutri_score, title FROM details JOIN main USING (recipe_id)
      WHERE saturates_g BETWEEN 0 AND 60 AND sugars_g BETWEEN 0 AND 100 AND nutri_score IS NOT NULL""",
    b.MAIN,
    b.DETAILS,
)
def r11_candidates(spark, sf):
    return charts.scatter_candidates(b.details(spark, sf), b.main(spark, sf))
