"""Benchmark copies against alignments of every item with every text."""

from __future__ import annotations

import random

import numpy as np
import pytest
from larder.llm import decontaminate


def brute_alignment(item, text):
    """Smith-Waterman cell by cell: (score, matches, -columns) of the best alignment."""
    best, above = (0, 0, 0), [(0, 0, 0)] * (len(text) + 1)
    add = lambda cell, s, m: (cell[0] + s, cell[1] + m, cell[2] - 1)
    for a in item:
        row = [(0, 0, 0)]
        for j, b in enumerate(text):
            row.append(max((0, 0, 0), add(above[j], 2, 1) if a == b else add(above[j], -1, 0), add(above[j + 1], -1, 0), add(row[j], -1, 0)))
        best, above = max(best, *row), row
    return best[1] / max(len(item), -best[2], 1)


def edited(rng, item, words, edits):
    out = list(item)
    for _ in range(edits):
        i = rng.randrange(len(out))
        kind = rng.randrange(3)
        out[i : i + (kind != 1)] = [rng.choice(words)] if kind < 2 else []
    return out


def test_alignment_equals_the_plain_one():
    rng = random.Random(3)
    pairs = [(np.array([rng.randrange(1, 5) for _ in range(rng.randint(1, 9))]), np.array([rng.randrange(0, 5) for _ in range(rng.randint(1, 30))])) for _ in range(200)]
    pairs.append((np.array([1, 2]), np.empty(0, np.int64)))
    for (a, b), (similarity, end) in zip(pairs, decontaminate.align(pairs), strict=True):
        assert similarity == pytest.approx(brute_alignment(a.tolist(), b.tolist()))
        assert end <= len(b)


@pytest.fixture(scope="module")
def corpus(spark, words):
    rng = random.Random(9)
    items = [[rng.choice(words[:400]) for _ in range(rng.choice([12, 30, 45]))] for _ in range(12)]
    texts = []
    for i in range(150):
        body = [rng.choice(words) for _ in range(rng.randint(0, 120))]
        if i % 3 == 0:
            item = rng.choice(items)
            at = rng.randint(0, len(body))
            body[at:at] = edited(rng, item, words, rng.randint(0, len(item) // 4))
        texts.append((i, " ".join(body), "f", "i"))
    texts += [(900, None, "f", "i"), (901, "", "f", "i"), (None, " ".join(items[0]), "f", "i")] + [(902, ", ".join(items[1]).upper(), "f", "i")] * 2
    # One passage in a third of all documents: its seeds are the most frequent ones.
    texts += [(1000 + i, " ".join([rng.choice(words), *items[2], rng.choice(words)]), "f", "i") for i in range(80)]
    benchmark = [(i, " ".join(t)) for i, t in enumerate(items)] + [(50, None), (51, " .. "), (52, "uniqueword")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, found string, item_id string").repartition(3)
    return docs, spark.createDataFrame(benchmark, "item_id long, text string"), texts, benchmark


def brute_matches(texts, benchmark):
    split = {k: decontaminate.words_of(t or "") for k, t in benchmark}
    for key, text, *_ in texts:
        own = decontaminate.words_of(text or "")
        for item, words in split.items():
            similarity = brute_alignment(words, own) if words and set(words) & set(own) else 0.0
            if similarity >= decontaminate.SIMILARITY:
                yield key, item, round(similarity, 9)


def test_all_pairs(corpus):
    docs, items, texts, benchmark = corpus
    found = [(r["doc_id"], r["item_id"], round(r["similarity"], 9)) for r in decontaminate.matches(docs, items).collect()]
    expected = sorted(brute_matches(texts, benchmark), key=repr)
    assert sorted(found, key=repr) == expected
    assert len({s for _, _, s in expected}) > 5 and len(expected) > 110


def test_copies_at_the_very_bound_are_found(spark, words):
    rng = random.Random(17)
    items = [rng.sample(words[:400], n) for n in (5, 10, 15, 50, 9, 40, 4)]
    spaced = [[f"new{i}" if i % 5 == 2 else w for i, w in enumerate(item)] for item in items[:4]]
    # One word lost and one inserted of nine, ten inserted into forty, one into four.
    spaced.append([*items[4][:2], "new", *items[4][3:6], "more", *items[4][6:]])
    spaced.append([x for i, w in enumerate(items[5]) for x in ([w, "more"] if i % 4 == 1 else [w])])
    spaced.append([*items[6][:2], "more", *items[6][2:]])
    texts = [(i, " ".join([*rng.sample(words[500:], 20), *t, *rng.sample(words[500:], 20)])) for i, t in enumerate(spaced)]
    benchmark = [(i, " ".join(t)) for i, t in enumerate(items)]
    docs, wanted = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(benchmark, "item_id long, text string")
    found = [(r["doc_id"], r["item_id"], round(r["similarity"], 9)) for r in decontaminate.matches(docs, wanted).collect()]
    expected = sorted(brute_matches(texts, benchmark))
    assert sorted(found) == expected
    assert {(i, i) for i in (0, 1, 2, 3, 5, 6)} <= {(k, item) for k, item, s in expected if s == 0.8}


def test_least_shared_is_whole():
    assert [decontaminate.least_shared(n) for n in (10, 15, 20, 40, 50)] == [2, 4, 6, 14, 18]


def test_blocks_of_items_do_not_matter(corpus, monkeypatch):
    docs, items, *_ = corpus
    whole = sorted(map(repr, decontaminate.matches(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 500)
    assert len(list(decontaminate.blocks(items, "text", "item_id"))) > 2
    assert sorted(map(repr, decontaminate.matches(docs, items).collect())) == whole


def test_clean_rows_keep_their_columns(corpus):
    docs, items, texts, benchmark = corpus
    dirty = {k for k, *_ in brute_matches(texts, benchmark)}
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted((k for k, *_ in texts if k not in dirty), key=repr)


def test_empty_tables(corpus, no_docs):
    docs, items, *_ = corpus
    assert decontaminate.matches(no_docs, items).count() == 0
    assert decontaminate.matches(docs, items.limit(0)).count() == 0
    assert decontaminate.clean(docs, items.limit(0)).count() == docs.count()
