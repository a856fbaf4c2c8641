"""Expressions on literals: the reference outcomes, then the edge cases."""

from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larder.constants import NO_ITEMS, NO_STEPS
from larder.functions import arrays, bands, macros, numbers, text


def value(spark, expr, ddl, *args):
    return spark.createDataFrame([args], ddl).select(expr.alias("v")).first()["v"]


def values(spark, expr, ddl, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, c {ddl}")
    return [r["v"] for r in df.select("i", expr.alias("v")).orderBy("i").collect()]


def test_title_key(spark):
    got = values(
        spark,
        text.title_key("c"),
        "string",
        ["Chicken & Rice!", "  Pasta  ", "3 Cheese Pizza", "", None, "Café", "\t Tea \n", "a\x1cb\x1d"],
    )
    assert got == ["chicken  rice", "pasta", "3 cheese pizza", "", "", "caf", "tea", "a\x1cb"]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(max_size=12), min_size=20, max_size=40))
def test_title_key_equals_python(spark, titles):
    titles = [t.encode("utf-8", "ignore").decode() for t in titles]
    expected = [re.sub(r"[^a-zA-Z0-9\s]", "", t).lower().strip() for t in titles]
    assert values(spark, text.title_key("c"), "string", titles) == expected


def test_strip_equals_python(spark):
    padded = [f"{ch}x{ch}" for ch in map(chr, range(0x3001)) if not 0xD800 <= ord(ch) < 0xE000]
    assert values(spark, text.strip("c"), "string", padded) == [p.strip() for p in padded]


def test_listed_items(spark):
    got = values(
        spark,
        text.listed_items("c"),
        "string",
        ["['italian', 'pasta', 'quick']", "[]", "", "['vegan']", None, "['a, b']", "[\"it's\", 'x']"],
    )
    assert got == [["italian", "pasta", "quick"], [], [], ["vegan"], [], ["a", "b"], ["its", "x"]]


def test_leading_number(spark):
    got = values(
        spark,
        numbers.leading_number("c"),
        "string",
        ["[312.4, 12.0, 5.2]", "", "[bad]", None, "[12f]", "[ -1e2 ]", "[.5]", "[]", "[1d, 2]", "[inf]"],
    )
    assert got == [312.4, None, None, None, None, -100.0, 0.5, None, None, float("inf")]


def test_digits(spark):
    got = values(
        spark, numbers.digits("c"), "string", ["45", "-5", " 5", "5.0", "", None, "5\n", "2147483648", "9" * 30]
    )
    assert got == [45, None, None, None, None, None, None, 2147483648, None]
    assert value(spark, numbers.narrow_int("c"), "c bigint", 2147483648) is None


def test_texts_of_structs(spark):
    ddl = "array<struct<text:string>>"
    rows = [[("mix",), (None,), ("bake",)], [], None]
    assert values(spark, text.joined_texts("c"), ddl, rows) == ["mix |  | bake", "", ""]
    assert values(spark, text.field_texts("c"), ddl, rows) == [["mix", "", "bake"], [], []]


def test_first_length_flag(spark):
    rows = [["a", "b"], [], None]
    assert values(spark, arrays.first("c"), "array<string>", rows) == ["a", None, None]
    assert values(spark, arrays.length("c"), "array<string>", rows) == [2, 0, 0]
    assert values(spark, arrays.non_empty("c"), "array<string>", rows) == [True, False, False]


@pytest.mark.parametrize(
    "texts, flags, expected",
    [
        (["Pasta ", "beef", "Tomatoes"], [True, True, False], ["pasta", "beef"]),
        (["a", "b", "c"], [True], ["a"]),
        (["a"], [True, True], ["a"]),
        (["", None, " ", "b", "b"], [True] * 5, ["", "b", "b"]),
        (["a"], [None], []),
        (None, [True], []),
        (["a"], None, []),
    ],
)
def test_masked_texts(spark, texts, flags, expected):
    records = None if texts is None else [(t,) for t in texts]
    ddl = "r array<struct<text:string>>, m array<boolean>"
    assert value(spark, arrays.masked_texts("r", "m"), ddl, records, flags) == expected


def test_json_strings(spark):
    got = values(spark, text.json_strings("c"), "string", ['["a","b"]', "[1,2]", "", "null", "[bad", None])
    assert got == [["a", "b"], ["1", "2"], None, None, None, None]


def test_bands(spark):
    kcal = [50.0, 80.0, 160.0, 270.0, 400.0, None, -1.0, 79.99, float("nan")]
    assert values(spark, bands.score_band("c"), "double", kcal) == ["A", "B", "C", "D", "E", None, "A", "A", "E"]
    minutes = [20, 45, 90, None, 30, 60, 0, -3]
    expected = ["rapide", "moyen", "long", "inconnu", "rapide", "moyen", "rapide", "rapide"]
    assert values(spark, bands.time_band("c"), "int", minutes) == expected
    assert value(spark, bands.fallback_score("a", "b"), "a double, b double", None, 90.0) == "B"
    assert values(spark, bands.flag("c"), "boolean", [True, False, None]) == [True, False, False]
    assert values(spark, bands.labelled("c"), "string", ["A", None]) == ["A", "?"]


def test_numbered_steps(spark):
    got = values(
        spark, text.numbered_steps("c"), "string", ["mix | | bake\nwell", "mix\n\n bake ", "", None, " | ", "one"]
    )
    assert got == [["1. mix", "2. bake\nwell"], ["1. mix", "2. bake"], [NO_STEPS], [NO_STEPS], [NO_STEPS], ["1. one"]]


def test_head_and_candidates(spark):
    many = [f"i{i}" for i in range(20)]
    assert values(spark, arrays.head("c"), "array<string>", [many, ["a"], [], None]) == [
        many[:14], ["a"], [NO_ITEMS], [NO_ITEMS]
    ]
    ddl = "a string, b array<string>"
    assert value(spark, arrays.candidates("a", "b"), ddl, "u", ["v", "u", "", None, "v"]) == ["u", "v"]
    assert value(spark, arrays.candidates("a", "b"), ddl, None, None) == []


def test_item_cleanup(spark):
    assert values(spark, text.clean_item("c"), "string", ["  FLOUR  ", None]) == ["flour", None]
    assert values(spark, text.blank_to_null("c"), "string", ["", "x", None]) == [None, "x", None]


def test_words_and_stems(spark):
    assert value(spark, text.words("c"), "c string", "Crème Brûlée, 7up & PÂTÉ!") == ["creme", "brulee", "7up", "pate"]
    assert value(spark, text.words("c"), "c string", None) == []
    stems = {
        "berries": "berry", "cookies": "cooky", "apples": "apple", "dishes": "dishe", "trees": "tree", "glass": "glass",
        "asparagus": "asparagus", "is": "is", "tomatoes": "tomatoe", "rice": "rice", "eggs": "egg", "ies": "ie",
    }
    assert values(spark, text.plural_stem("c"), "string", list(stems)) == list(stems.values())


def test_buckets_and_shares(spark):
    assert values(spark, numbers.bucket("c", 5), "int", [0, 4, 5, 99, -1, None]) == [0, 0, 5, 95, -5, None]
    ddl = "a bigint, b bigint"
    assert value(spark, numbers.share(F.col("a"), F.col("b"), 1), ddl, 1, 3) == 33.3
    assert value(spark, numbers.share(F.col("a"), F.col("b")), ddl, 1, 0) is None


def test_sql_functions_equal_columns(spark):
    macros.register_sql_functions(spark)
    df = spark.createDataFrame(
        [("Chicken & Rice! ", 80.0, 30), (None, None, None), ("\tCafé", 400.0, 61)], "t string, k double, m int"
    )
    left = df.selectExpr("normalize_title(t)", "nutri_score(k)", "cook_time_cat(m)")
    right = df.select(text.title_key("t"), bands.score_band("k"), bands.time_band("m"))
    assert [tuple(r) for r in left.collect()] == [tuple(r) for r in right.collect()]
