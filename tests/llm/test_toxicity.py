"""The toxicity grammar: the composed machine, what is learned, and held-out accuracy."""

from __future__ import annotations

import random
import zlib

import pytest
from larder.llm import toxicity

INSULTS = frozenset({"idiot", "grobz"})
THREATS = frozenset({"kill"})


def labels_of(text):
    counts = toxicity.matched_labels(text.encode(), toxicity.lexicon(INSULTS, THREATS))
    return {toxicity.LABELS[i]: int(n) for i, n in enumerate(counts) if n}


def label(kind, negated=False, reported=False, targeted=False):
    return (("kind", kind), ("negated", negated), ("reported", reported), ("targeted", targeted))


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("You IDIOT", {label("insult", targeted=True): 1}),
        ("an idiotic plan. grobzen, too", {label("insult"): 2}),
        ("you are not an idiot", {label("insult", negated=True, targeted=True): 1}),
        ("not now. An idiot", {label("insult"): 1}),
        ("she said idiot", {label("insult", reported=True, targeted=True): 1}),
        ("I will kill him", {label("threat"): 1}),
        ("they never kill", {label("threat", negated=True, targeted=True): 1}),
        ("a fine day", {}),
        ("", {}),
    ],
)
def test_clauses(text, expected):
    assert labels_of(text) == expected


def test_composition_runs_both_machines():
    a, b = toxicity.nearby(toxicity.TARGET, 2, "t"), toxicity.kinds()
    both = a.compose(b)
    rng = random.Random(1)
    for _ in range(50):
        x, y, state = a.start, b.start, both.start
        for _ in range(20):
            symbol = rng.randrange(7)
            (x, out), (y, out2), (state, out3) = a.moves[x, symbol], b.moves[y, symbol], both.moves[state, symbol]
            assert (state, out3) == ((x, y), out + out2)


@pytest.fixture(scope="module")
def labelled(spark, words):
    """Toxic texts hold a word of an invented stem; some stems come with ever new endings."""
    rng = random.Random(6)
    data, labels = [], []
    for i in range(900):
        text, toxic = [rng.choice(words) for _ in range(40)], int(rng.random() < 0.2)
        if toxic:
            text[rng.randrange(40)] = rng.choice(["zzuqra" + rng.choice(words), "xyqqo", "idiot"])
        data.append((i, " ".join(text), "x", "y"))
        labels.append((i, toxic))
    labels += [(None, 1), (3000, 1), (5, None), (7, 9)]
    docs = spark.createDataFrame(data, "doc_id long, text string, score string, t string")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels[:900])


def test_held_out_rows_are_told_apart(labelled):
    docs, labels, truth = labelled
    model = toxicity.fit(docs, labels)
    scored = toxicity.with_scores(docs, model).withColumn("held", toxicity.is_held_out("doc_id"))
    rows = [r for r in scored.select("doc_id", "score", "held").collect()]
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held"]]
    right = sum((r["score"] >= toxicity.THRESHOLD) == bool(truth[r["doc_id"]]) for r in held)
    assert len(held) > 200 and right >= 0.98 * len(held)
    kept = toxicity.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["score"] < toxicity.THRESHOLD for r in rows)


def test_labels_of_held_out_rows_teach_nothing(labelled):
    docs, labels, _ = labelled
    wrong = labels.selectExpr("doc_id", "CASE WHEN pmod(crc32(cast(doc_id AS string)), 3) = 1 THEN 1 - toxic ELSE toxic END AS toxic")
    assert toxicity.fit(docs, wrong.where("doc_id < 900")) == toxicity.fit(docs, labels.where("doc_id < 900"))


def test_any_text_gets_a_score(docs, rows, no_docs, labelled):
    model = toxicity.fit(no_docs, labelled[1])
    found = toxicity.with_scores(docs, model).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    assert toxicity.scores([b"", b"you idiot"], model).round().tolist() == [0.0, 1.0]
    assert toxicity.with_scores(no_docs, model).count() == 0
