"""Fingerprints, edited texts and followers against plain Python."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import pytest
from larder.llm import spotsigs
from pyspark.sql import functions as F

ANCHORS = set(spotsigs.ANCHORS.split())


def brute_signatures(text):
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    content, found, before = [w for w in words if w not in ANCHORS], set(), 0
    for w in words:
        if w in ANCHORS:
            found.add((w, *content[before : before + 3]))
        else:
            before += 1
    return found or {(w, *words[i + 1 : i + 4]) for i, w in enumerate(words)}


def brute_likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_distinct_rows(spark, rows):
    chosen = sorted({(k, t or "") for k, t, _ in rows if k is not None and k not in (121, 140, 141)}, reverse=True)
    frame = spark.createDataFrame([(k, t or None) for k, t in chosen], "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: r for r in spotsigs.edits(frame).collect()}
    assert len(found) == len(chosen)
    for i, (key, text) in enumerate(chosen):
        following, third, row = chosen[(i + 1) % len(chosen)][1], len(text) // 3, found[key]
        edited = text[: len(text) - third] + following[:third]
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        own = brute_signatures(text)
        assert row["near_edited"] == pytest.approx(brute_likeness(own, brute_signatures(edited)), abs=0.01)
        assert row["near_next"] == pytest.approx(brute_likeness(own, brute_signatures(following)), abs=0.01)
        assert len(row["fingerprint"]) == 8 * len(own)


def test_all_rows_stay_and_equal_texts_have_equal_fingerprints(docs, rows):
    found = spotsigs.edits(docs).collect()
    assert sorted((r["doc_id"] for r in found), key=repr) == sorted((k for k, _, _ in rows), key=repr)
    assert len({r["fingerprint"] for r in found if r["doc_id"] in (100, 101)}) == 1
    copies = [r["near_next"] for r in found if r["doc_id"] == 140]
    assert max(copies) == 1.0 and min(copies) < 0.5


def test_one_row_follows_itself_and_an_empty_table_is_empty(spark, no_docs):
    one = spotsigs.edits(spark.createDataFrame([(5, "the cat sat")], "doc_id long, text string")).first()
    assert (one["n_chars"], one["near_next"]) == (11, 1.0)
    assert spotsigs.edits(no_docs).count() == 0


def test_lengths_alone_prune_pairs(spark):
    frame = spark.createDataFrame([([1, 2, 3, 4], [1]), ([], []), ([1], []), ([1, 2], [2, 3])], "a array<int>, b array<int>")
    exact = frame.select(spotsigs.likeness(F.col("a"), F.col("b")).alias("x")).collect()
    pruned = frame.select(spotsigs.likeness(F.col("a"), F.col("b"), 0.8).alias("x")).collect()
    assert [r["x"] for r in exact] == [0.25, 1.0, 0.0, pytest.approx(1 / 3)]
    assert [r["x"] for r in pruned] == [0.0, 1.0, 0.0, pytest.approx(1 / 3)]


@pytest.mark.parametrize("least", [0.8, 0.5])
def test_all_similar_pairs(spark, least):
    rng = random.Random(17)
    common = list(range(1000, 1006))  # signatures of nearly all sets
    sets = []
    for _ in range(40):
        base = rng.sample(range(400), rng.choice([1, 2, 5, 9, 30]))
        for _ in range(3):
            own = set(base) | set(rng.sample(common, 4))
            for _ in range(rng.randint(0, 4)):
                own.symmetric_difference_update({rng.randrange(400)})
            sets.append(sorted(own))
    sets += [sets[0], sets[0], [], None, sorted(common)]
    frame = spark.createDataFrame([(i, s) for i, s in enumerate(sets)], "doc_id long, sigs array<int>")
    pairs, members = spotsigs.similar_pairs(frame, least)
    of = {r["doc_id"]: r["class"] for r in members.collect()}
    assert len(of) == len(sets) and of[0] == of[len(sets) - 5]
    distinct = {of[i]: set(s) for i, s in enumerate(sets) if s}
    expected = {
        (min(a, b), max(a, b)): brute_likeness(distinct[a], distinct[b])
        for a, b in itertools.combinations(distinct, 2)
        if brute_likeness(distinct[a], distinct[b]) >= least
    }
    found = {(r["a"], r["b"]): r["likeness"] for r in pairs.collect()}
    assert found == pytest.approx(expected) and len(expected) > 10


def test_similar_pairs_of_texts(docs, no_docs):
    marked = docs.select("doc_id", spotsigs.signatures(F.col("text")).alias("sigs"))
    pairs, members = spotsigs.similar_pairs(marked)
    of = {r["doc_id"]: r["class"] for r in members.collect()}
    found = {(r["a"], r["b"]) for r in pairs.collect()}
    assert of[100] == of[101] and tuple(sorted((of[100], of[102]))) in found
    assert spotsigs.similar_pairs(no_docs.select("doc_id", F.array().cast("array<int>").alias("sigs")))[0].count() == 0
