"""Full-text and substring search against brute force."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from larder.operators import lookup, search
from larder.session import scratch

RECIPES = [
    ("1", "Tomato Soup", ["tomatoes", "salt", "water"], 20, "A"),
    ("2", "Tomato Tomatoes Pie", ["pie crust", "tomato"], 50, "C"),
    ("3", "Crème brûlée", ["cream", "eggs", "sugar"], 90, "E"),
    ("4", "Apple pies", ["apples", "pie crust", "sugar"], None, None),
    ("5", None, None, 10, "A"),
    ("6", "Salt", ["salt"], 5, "A"),
]


@pytest.fixture(scope="module")
def main(spark):
    df = spark.createDataFrame(
        RECIPES, "recipe_id string, title string, ingredients_raw array<string>, cook_minutes int, nutri_score string"
    )
    return df.withColumns(
        {"image_url": F.lit("u"), "cook_time_category": F.lit("c"), "mit_energy_kcal": F.lit(1.0)}
    )


@pytest.fixture(scope="module")
def index(spark, main):
    return search.create_index(main, scratch(spark, "idx"), fields=("title", "ingredients_raw"))


def tokens(text):
    plain = (text or "").lower().translate(str.maketrans("éèêûî", "eeeui"))

    def stem(w):
        if not w.endswith("s") or w.endswith(("us", "ss")) or len(w) < 3:
            return w
        return w[:-3] + "y" if w.endswith("ies") and len(w) > 3 and not w.endswith(("aies", "eies")) else w[:-1]

    return [stem(w) for w in re.findall("[a-z0-9]+", plain)]


def brute_force(query, fields):
    docs = {r[0]: {"title": tokens(r[1]), "ingredients_raw": tokens(" ".join(r[2] or []))} for r in RECIPES}
    length = {d: sum(map(len, f.values())) for d, f in docs.items()}
    mean = sum(length.values()) / len(docs)
    scores = Counter()
    for term in set(tokens(query)):
        df = sum(any(term in f for f in fs.values()) for fs in docs.values())
        idf = math.log((len(docs) - df + 0.5) / (df + 0.5) + 1)
        for d, fs in docs.items():
            tf = sum(fs[f].count(term) for f in fields)
            if tf:
                scores[d] += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length[d] / mean))
    return {d: round(s, 6) for d, s in scores.items()}


@pytest.mark.parametrize("query", ["tomato", " Tomatoes, PIE! ", "creme SUGAR", "salt salt water", "none", "", "  ?! "])
@pytest.mark.parametrize("fields", [["title"], ["ingredients_raw"], ["title", "ingredients_raw"]])
def test_bm25_equals_brute_force(index, query, fields):
    got = {r.recipe_id: round(r.score, 6) for r in search.bm25(index, query, fields).collect()}
    assert got == pytest.approx(brute_force(query, fields), abs=1e-6)
    assert {r.recipe_id for r in search.matches(index, query, fields).collect()} == set(got)


def test_ranked_search(main, index):
    found = [r.recipe_id for r in search.full_text(main, index, "tomato").collect()]
    want = brute_force("tomato", ["title", "ingredients_raw"])
    assert found == sorted(want, key=lambda d: (-want[d], d))
    assert search.full_text(main, index, "tomato", n=1).count() == 1
    assert search.full_text(main, index, " ").count() == 0 and search.full_text(main, index, "none").count() == 0
    assert [r.recipe_id for r in search.full_text_by_name(main, index, "brulee").collect()] == ["3"]
    assert [r.recipe_id for r in search.full_text_by_item(main, index, "cream").collect()] == ["3"]


def test_composite_search(main, index):
    def ids(**kw):
        return [r.recipe_id for r in search.full_text_advanced(main, index, order_by="recipe_id", **kw).collect()]

    assert ids(name="tomato") == ["1", "2"]
    assert ids(ingredient="crust") == ["2", "4"]
    assert ids(name="soup", ingredient="sugar") == ["1", "3", "4"]
    assert ids(name="tomato", max_time=30, nutri_score="a") == ["1"]
    assert ids(max_time=0) == ["1", "2", "3", "4", "5", "6"]
    assert len(search.full_text_advanced(main, index, n=2).collect()) == 2


def test_index_tables(index):
    made = index.corpus.first()
    assert (made.n_docs, made.avgdl, made.key, made.fields) == (6, 4.0, "recipe_id", ["title", "ingredients_raw"])
    assert index.terms.filter("term = 'tomato'").first().df == 2
    row = index.postings.filter("term = 'tomato' and recipe_id = '2'").first()
    assert (row.tf_title, row.tf_ingredients_raw, row.dl) == (1, 1, 6)


def test_digits_can_be_left_out(spark):
    df = spark.createDataFrame([("1", "7up 42")], "recipe_id string, title string")
    index = search.create_index(df, scratch(spark, "idx"), fields=("title",), pattern="[a-z]+", stemmer="none")
    assert [r.term for r in index.postings.collect()] == ["up"]


def test_a_reopened_index_keeps_its_settings(spark):
    df = spark.createDataFrame([(1, "Routes 66"), (2, "Route x"), (3, None)], "id long, t string")
    path = scratch(spark, "idx")
    search.create_index(df, path, "id", ("t",), "[a-z]+", "none")
    again = search.open_index(spark, path)
    assert (again.key, again.fields, again.pattern, again.stemmer) == ("id", ("t",), "[a-z]+", "none")
    assert search.query_terms(spark, "routes 66", again.pattern, again.stemmer) == ["routes"]
    assert [r["id"] for r in search.bm25(again, "routes 66").collect()] == [1]
    assert again.terms.count() == 3 and again.corpus.first()["n_docs"] == 3


def test_an_index_of_nothing_finds_nothing(spark):
    df = spark.createDataFrame([], "id long, t string")
    index = search.create_index(df, scratch(spark, "idx"), "id", ("t",))
    assert search.bm25(index, "any word").count() == 0


def test_substring_search(spark, main):
    items = main.select("recipe_id", F.explode("ingredients_raw").alias("ingredient"))

    def ids(df):
        return sorted(r.recipe_id for r in df.collect())

    assert ids(lookup.by_name(main, "PIE")) == ["2", "4"]
    assert ids(lookup.by_name(main, "tom%pie")) == ["2"]
    assert ids(lookup.by_ingredient(main, items, "s")) == ["1", "2", "3", "4", "6"]
    assert ids(lookup.advanced(main, items, "a", "sugar", nutri_score=None)) == ["4"]
    assert ids(lookup.advanced(main, items, max_time=20, nutri_score="A")) == ["1", "5", "6"]
    assert len(lookup.by_name(main, "", n=2).collect()) == 2
    assert lookup.record(main, "recipe_id", "9").collect() == []
