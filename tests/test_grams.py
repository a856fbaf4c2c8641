"""Substring search by grams against ILIKE on every row."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from larder.operators import grams, lookup
from larder.operators.filters import holds_text
from larder.session import scratch


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(12)
    words = ["tomato", "Tomatoes", "Crème", "brûlée", "ΟΔΟΣ", "İstanbul", "a_b", "100%", "back\\slash", "日本語", "pie", "x"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 6))) + rng.choice(["", "\n", "!"])) for i in range(400)]
    return spark.createDataFrame([*rows, (900, None), (901, ""), (902, "ab")], "id long, t string")


@pytest.fixture(scope="module")
def index(spark, texts):
    before, grams.CELL = grams.CELL, 32
    made = grams.create_gram_index(texts, scratch(spark, "grams"), "id", "t")
    grams.CELL = before
    return made


QUERIES = [
    "tomato", "TOMATOES", "crème BRÛLÉE", "to%pie", "t_m_to", "mat%crè%pie", "οδος", "ΟΔΟΣ", "istanbul", "İST", "a_b", "100%", "\\slash", "k\\sla",
    "日本語", "日本", "x", "", "%", "_", "zzz", "tomatozzz", "ato tom", "o\nx", "100% t",
]


@pytest.mark.parametrize("query", QUERIES)
def test_rows_are_those_of_a_scan(texts, index, query):
    scan = {r["id"] for r in texts.filter(holds_text("t", query)).collect()}
    assert {r["id"] for r in grams.holding(texts, index, query).collect()} == scan


def test_only_a_part_of_the_rows_is_read(spark, texts, index):
    few = grams.candidates(index, "brûlée tomatoes pie").count()
    assert few < texts.count() / 4
    assert grams.candidates(index, "ab") is None and grams.candidates(index, "nowhere").count() == 0
    assert grams.pattern_grams(spark, "Abcd%ef_ghi") == ["abc", "bcd", "ghi"]


def test_a_frequent_gram_is_many_rows(index):
    rows = index.grams.filter("gram = 'tom'").select("n", F.size("keys").alias("m")).collect()
    assert len(rows) > 8 and all(r["n"] == r["m"] for r in rows) and max(r["n"] for r in rows) < 100


def test_catalog_searches(spark):
    main = spark.createDataFrame(
        [("1", "Tomato Soup", ["tomatoes", "salt"], 20, "A"), ("2", "Tomato Pie", ["pie crust", "tomato"], 50, "C"), ("3", None, None, 10, "A")],
        "recipe_id string, title string, ingredients_raw array<string>, cook_minutes int, nutri_score string",
    ).withColumns({"image_url": F.lit("u"), "cook_time_category": F.lit("c"), "mit_energy_kcal": F.lit(1.0)})
    items = main.select("recipe_id", F.explode("ingredients_raw").alias("ingredient"))
    titles = grams.create_gram_index(main, scratch(spark, "grams"), "recipe_id", "title")
    of_items = grams.item_index(items)
    ids = lambda df: sorted(r["recipe_id"] for r in df.collect())
    assert ids(lookup.by_name(main, "TOMATO", titles=titles)) == ["1", "2"] and ids(lookup.by_name(main, "pie", titles=titles)) == ["2"]
    for query in ("tomato", "CRUST", "salt", "to", "none at all"):
        assert ids(lookup.by_ingredient(main, items, query, grams=of_items)) == ids(lookup.by_ingredient(main, items, query))
    assert ids(lookup.advanced(main, items, "tomato", "tomato", 30, titles=titles, grams=of_items)) == ["1"]
    assert ids(lookup.advanced(main, items, max_time=20, titles=titles, grams=of_items)) == ["1", "3"]


def test_time_grows_with_the_length_of_a_text(spark):
    start = time.monotonic()
    df = spark.createDataFrame([(1, "in on " * 60_000), (2, "in conaton, hand than"), (3, "and than in onats in")], "id long, t string")
    made = grams.create_gram_index(df, scratch(spark, "grams"), "id", "t")
    assert made.grams.where("gram = 'in '").first()["keys"] == [1, 2, 3]
    # A search that tries each "in" with each "on" behind it takes the length's square.
    assert [r["id"] for r in df.filter(holds_text("t", "IN%ON%on_ %and th")).collect()] == [2]
    assert [r["id"] for r in grams.holding(df, made, "in%nat_n%and th").collect()] == [2]
    assert time.monotonic() - start < 60
