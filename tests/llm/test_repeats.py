"""Repeated byte strings against every window of every text."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from larder.llm import passages as passages_module
from larder.llm import repeats
from larder.llm.suffixes import SuffixRanks, longest_previous_factors, previous_smaller


def brute(texts):
    windows = Counter(t[i : i + 400] for t in texts for i in range(len(t) - 399))
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 399):
            if windows[t[i : i + 400]] > 1:
                gone[i : i + 400] = True
        runs = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        yield len(t), int(gone.sum()), runs, np.frombuffer(t, np.uint8)[~gone].tobytes()


def brute_first(rows):
    """Rows in the order of key and hash; a window stays where it has not been before."""
    order = sorted({(k is None, k or 0, hashlib.sha256(t.encode()).digest(), t.encode()) for k, t in rows})
    seen, gone_of = set(), {}
    for no, k, _, t in order:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 399):
            if t[i : i + 400] in seen:
                gone[i : i + 400] = True
            seen.add(t[i : i + 400])
        gone_of[None if no else k, t] = gone
    for k, t in rows:
        gone, raw = gone_of[k, t.encode()], t.encode()
        runs = sum(1 for i in range(len(raw)) if gone[i] and (i == 0 or not gone[i - 1]))
        yield k, (len(raw), int(gone.sum()), runs, np.frombuffer(raw, np.uint8)[~gone].tobytes())


@pytest.mark.parametrize("contexts", [repeats.CONTEXTS, 1])
def test_first_copies_stay(docs, rows, contexts):
    expected = sorted(brute_first([(k, t or "") for k, t, _ in rows]), key=repr)
    found = repeats.without_repeats(docs, contexts=contexts, keep="first")
    ours = [(r["doc_id"], (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))) for r in found.collect()]
    assert sorted(ours, key=repr) == expected


@pytest.mark.parametrize("contexts", [repeats.CONTEXTS, 1])
def test_all_texts(docs, rows, contexts):
    keys = [k for k, _, _ in rows]
    expected = sorted(zip(keys, brute([(t or "").encode() for _, t, _ in rows]), strict=True), key=repr)
    found = repeats.without_repeats(docs, contexts=contexts, keep="none")
    ours = [(r["doc_id"], (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))) for r in found.collect()]
    assert sorted(ours, key=repr) == expected
    assert any(0 < r[1][1] < r[1][0] for r in ours)


def test_pieces_of_a_long_text_do_not_matter(spark, words, monkeypatch):
    rng = random.Random(8)
    text = " ".join(rng.choice(words) for _ in range(3000)).encode()
    whole = repeats.anchors(text)
    monkeypatch.setattr(repeats, "PIECE", 1000)
    for a, b in zip(whole, repeats.anchors(text), strict=True):
        assert np.array_equal(a, b)


def test_empty_table(no_docs):
    assert repeats.report(no_docs).count() == 0


def test_longest_previous_factors():
    rng = random.Random(0)
    for _ in range(60):
        n, limit = rng.randint(1, 90), rng.choice([8, 13, 20, 32, 40])
        text = bytes(rng.choice(b"\0ab"[: rng.choice([1, 2, 3])]) for _ in range(n))
        starts = np.array(sorted(rng.sample(range(n), rng.randint(1, n))))
        time = np.array(rng.sample(range(1000), len(starts)))

        def common(a, b, text=text, limit=limit):
            k = 0
            while k < limit and max(a, b) + k < len(text) and text[a + k] == text[b + k]:
                k += 1
            return k

        expected = [max((common(a, b) for b, u in zip(starts, time, strict=True) if u < t), default=0) for a, t in zip(starts, time, strict=True)]
        found = longest_previous_factors(SuffixRanks(np.frombuffer(text, np.uint8), limit), starts, time)
        assert found.tolist() == expected


def test_previous_smaller():
    values = np.array([3, 1, 4, 1, 5, 9, 2, 6])
    assert previous_smaller(values).tolist() == [-1, -1, 1, -1, 3, 4, 3, 6]


def test_shared_strings_show_passages_of_fifty_words(spark, words):
    rng = random.Random(31)
    text = lambda n: [rng.choice(words) for _ in range(n)]
    passages = [text(n) for n in (50, 51, 60, 90)]
    rows = [(i, " ".join([*text(rng.randint(5, 80)), *p, *text(rng.randint(5, 80))])) for i, p in enumerate(passages * 2)]
    clean = [(100 + i, " ".join(text(rng.randint(1, 300)))) for i in range(40)]
    short = text(31)
    clean += [(200 + i, " ".join([*text(30), *short, *text(30)])) for i in range(5)]
    copies = [(300, " ".join(text(70)))] * 2 + [(301, None), (302, None)]
    docs = spark.createDataFrame(rows + clean + copies, "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r["n_shared"] for r in repeats.report(docs).collect()}
    assert all(found[k] > 0 for k, _ in rows) and not any(found[k] for k, _ in clean)
    assert found[300] == len(passages_module.picked(copies[0][1].encode())) and found[301] == 0


def test_picked_strings_are_the_least_of_each_window(words):
    rng = random.Random(3)
    text = " ".join(rng.choice(words) for _ in range(140)).encode()
    split, seen = text.split(), {}
    for i in range(len(split) - 49):
        window = b" ".join(split[i : i + 50])
        own = set(passages_module.picked(window).tolist())
        assert len(own) == 1 and own <= set(passages_module.picked(text).tolist())
        seen[i] = own.pop()
    assert set(seen.values()) == set(passages_module.picked(text).tolist())
