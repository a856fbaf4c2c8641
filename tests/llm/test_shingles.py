"""The pipeline's near duplicates against the Jaccard similarity of all pairs."""

from __future__ import annotations

import random
import time

import corpus_pipeline
import numpy as np
import pytest
from larder.llm import shingles


def brute_shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similar(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def brute_kept(rows):
    sets, classes, todo = [brute_shingles(t) for _, t in rows], [], set(range(len(rows)))
    while todo:
        front, own = [todo.pop()], []
        while front:
            a = front.pop()
            own.append(rows[a][0])
            near = {b for b in todo if similar(sets[a], sets[b])}
            todo -= near
            front += near
        classes.append(min(own))
    return sorted(classes)


@pytest.fixture(scope="module")
def edited(words):
    """Texts with copies from far below to far above the bound, a family of near copies, a passage of many texts."""
    rng = random.Random(21)
    text = lambda n: [rng.choice(words) for _ in range(n)]
    rows, passage = [], text(60)
    for _ in range(40):
        base = text(rng.randint(5, 150))
        rows.append(base)
        for _ in range(2):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 30))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(copy)
    # 104 words have 100 shingles; a changed word in the middle breaks five, at the end one: 0.8 is 100 of 125 or 88 of 110.
    family = text(104)
    for i in range(60):
        copy = list(family)
        copy[rng.randrange(104)] = f"changed{i}"
        rows.append(copy)
    edge = text(13)  # nine shingles; with one word more and one changed at the ends: 8 of 10
    rows += [edge, ["x", *edge[1:]], [*edge, "more"], ["x", *edge[1:], "more"]]
    rows += [[*text(20), *passage, *text(20)] for _ in range(30)]
    rows += [[], [], ["one"], ["one"], ["two", "words"]]
    return [(i, " ".join(r)) for i, r in enumerate(rows)]


@pytest.mark.parametrize("several", [shingles.SEVERAL, 1])
def test_stage_keeps_one_of_each_class_of_similar_texts(spark, edited, several, monkeypatch):
    monkeypatch.setattr(shingles, "SEVERAL", several)
    monkeypatch.setattr(shingles, "SAMPLED", 16 if several > 1 else 1)
    docs = spark.createDataFrame(edited, "doc_id long, text string").repartition(4)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    expected = brute_kept(edited)
    assert sorted(r["doc_id"] for r in kept.collect()) == expected
    assert len(expected) < 130


def test_looked_up_is_exact():
    for n in range(1, 400):
        assert shingles.looked_up(n) == n - (4 * n + 4) // 5 + 1


def test_bits_never_show_more_than_differs():
    rng = np.random.default_rng(3)
    for n, m, common in ((0, 0, 0), (1, 1, 1), (40, 50, 30), (100, 130, 99), (3000, 3100, 2900), (16, 17, 16)):
        every = rng.integers(-(1 << 63), (1 << 63) - 1, n + m - common)
        a, b = np.unique(every[:n]), np.unique(every[n - common :])
        apart = shingles.bits_apart(shingles.parities(a), shingles.parities(b))
        real = len(np.setxor1d(a, b))
        assert apart <= real and apart % 2 == real % 2 and apart >= real * 0.6


def test_templated_pages_do_not_meet(spark, words):
    """Pages of one template with a seventh of own shingles: all alike to 0.75, and none is judged against another."""
    rng = random.Random(8)
    template = [rng.choice(words) for _ in range(204)]
    rows = [(i, " ".join([*template[:100], *(f"own{i}x{j}" for j in range(24)), *template[100:]])) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    begin = time.monotonic()
    assert shingles.keep_one(docs).count() == 3000
    assert time.monotonic() - begin < 120


def test_copies_of_rows_and_keys(spark, words):
    text = " ".join(words[:80])
    near = " ".join([*words[:79], "other"])
    rows = [(7, text)] * 50 + [(7, near)] * 40 + [(8, text), (9, near), (None, text), (7, "else"), (None, "no key"), (None, "no key")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted(map(tuple, shingles.keep_one(docs).collect()), key=repr)
    assert [k for k in kept if k[1] not in (text, near)] == sorted([(7, "else"), (None, "no key")], key=repr)
    assert [k[0] for k in kept if k[1] in (text, near)] == [7]
