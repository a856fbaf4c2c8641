"""Search for the best documents by bounds of cells, against scoring every document."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from larder.operators import search
from larder.session import scratch


@pytest.fixture(scope="module")
def index(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    rows = []
    for i in range(3000):
        n = rng.choice([3, 5, 8, 30, 120])
        title = " ".join(rng.choices(words, weights, k=n))
        rows.append((i, title, rng.choices(words, weights, k=rng.randint(0, 6))))
    rows += [(3000 + i, "w0 w0 w0 rare", ["w1"]) for i in range(3)] + [(4000, None, None), (4001, "w0", [])]
    rows += [(5000 + i, "same same", ["w0"]) for i in range(40)]
    before = search.CELL
    search.CELL = 32
    df = spark.createDataFrame(rows, "id long, title string, items array<string>")
    made = search.create_index(df, scratch(spark, "ranked"), "id", ("title", "items"))
    search.CELL = before
    return made


QUERIES = ["w0 w1 w2", "w0 rare", "same w0", "nothing", "", "w0 nothing", " ".join(f"w{i}" for i in range(30))]


@pytest.mark.parametrize("query", QUERIES)
@pytest.mark.parametrize("fields", [None, ["title"]])
def test_rows_are_those_of_full_scoring(index, query, fields):
    every = search.best(search.bm25(index, query, fields), "id", 10_000).collect()
    for n, probed in ((1, 1), (8, 16), (50, 4), (10_000, 16)):
        got, keys = search.top_scores(index, query, n, fields, probed=probed)
        rows = got.collect()
        assert [r["id"] for r in rows] == [r["id"] for r in every[:n]]
        assert [r["score"] for r in rows] == pytest.approx([r["score"] for r in every[:n]], abs=2e-6)
        assert keys is None or keys == [r["id"] for r in rows]


def test_most_cells_are_left_out(index):
    cells = search.bounds(index, ["w0", "w1"]).count()
    eighth = search.best(search.bm25(index, "w0 w1"), "id", 8).collect()[-1]["score"]
    reached = search.reaching(index, ["w0", "w1"], None, eighth, 6)
    assert cells > 60 and reached.count() * 2 < cells
    assert search.reaching(index, ["w0", "w1"], None, None, 6).count() == cells


def test_bounds_hold_and_read_no_posting(index):
    bounds = search.bounds(index, ["w0", "w5"], ["title"])
    plan = bounds._jdf.queryExecution().executedPlan().toString()
    assert "docs" not in plan and "In(term, [w0,w5])" in plan
    scored = search._scores(index, search._asked(index, ["w0", "w5"]), ["title"], 1.2, 0.75)
    cells = index.blocks.select("cell", F.explode("docs.id").alias("id")).distinct()
    worst = scored.join(cells, "id").groupBy("cell").agg(F.max("score").alias("score")).join(bounds, "cell")
    assert worst.where("score > bound + 1e-9").count() == 0 and worst.count() == bounds.count()


def test_a_word_of_all_documents_is_many_rows(index):
    rows = index.blocks.where("term = 'w0'").select("n", F.size("docs").alias("m")).collect()
    assert len(rows) > 60 and all(r["n"] == r["m"] for r in rows) and max(r["n"] for r in rows) < 100
    assert sum(r["n"] for r in rows) == index.terms.where("term = 'w0'").first()["df"]


def test_the_build_moves_texts_and_no_postings(spark, index, monkeypatch):
    """Rows are stored without a join with their term, and each is made where the texts of its cell are."""
    plans = []
    made = search.materialise
    monkeypatch.setattr(search, "materialise", lambda df, *a: plans.append(df._jdf.queryExecution().executedPlan().toString()) or made(df, *a))
    df = spark.createDataFrame([(i, f"a b{i}") for i in range(20)], "id long, t string")
    search.create_index(df, scratch(spark, "moved"), "id", ("t",))
    assert "idf" not in index.blocks.columns and len(plans) == 1
    assert plans[0].count("Exchange") == 1


def test_long_rows_are_laid_out_apart_and_by_their_postings(spark, monkeypatch):
    """Ranges hold like numbers of rows: beside short ones, the long rows of one term would fill a range."""
    parts = []
    made = search.write_clustered
    monkeypatch.setattr(search, "write_clustered", lambda df, path, by, **k: parts.append((df, by, k)) or made(df, path, by, **k))
    df = spark.createDataFrame([(i, f"a b{i}") for i in range(900)], "id long, t string")
    index = search.create_index(df, scratch(spark, "long"), "id", ("t",))
    terms = index.blocks.groupBy("term").agg(F.sum("n").alias("n")).collect()
    assert {r["term"]: r["n"] for r in terms} == {"a": 900} | {f"b{i}": 1 for i in range(900)}
    kept = [spark.read.parquet(p).agg(F.min("n"), F.max("n"), F.sum("n")).first() for p in search._parts(_root(index))]
    assert kept[0][0] >= search.FREQUENT > kept[1][1]
    widths = [k["n_bytes"] for _, by, k in parts if by == ["term", "cell"]]
    assert len(widths) == 2 and all(w >= search.POSTING * r[2] for w, r in zip(sorted(widths), sorted(kept, key=lambda r: r[2]), strict=True))


def _root(index):
    return index.terms.inputFiles()[0].rsplit("/terms/", 1)[0]
