"""Spelling variants against comparing all words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest
from larder.llm import spellings


def edited_once(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]


def brute_words(rows, characters=6, least=5):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= characters and n >= least}


def brute_variants(counts, times=5):
    near = {w: [] for w in counts}
    for a, b in combinations(counts, 2):
        if edited_once(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {w: min(own, key=lambda v: (-counts[v], v)) for w, own in near.items() if own}
    form = {w: f for w, f in form.items() if counts[f] >= times * counts[w]}
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out.append((w, f, root, n, len(near[w]), counts[f] if f else None))
    return sorted(out, key=repr)


def edits(rng, word, letters):
    i, kind = rng.randrange(len(word)), rng.randrange(3)
    return word[:i] + ("" if kind == 0 else rng.choice(letters)) + word[i + (kind < 2) :]


@pytest.mark.parametrize(("letters", "seed"), [("ab", 1), ("abcdeé", 2), ("abcdefghijklmnopqrstuvwxyzÀßÿ", 3), ("a", 4)])
def test_variants_of_random_words(spark, letters, seed):
    rng = random.Random(seed)
    counts = {}
    for _ in range(60):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(6, 12)))
        n = rng.choice([5, 30, 200, 4000, 100_000])
        for _ in range(rng.randint(1, 6)):
            counts[word] = n
            word, n = edits(rng, word, letters), rng.choice([n, max(5, n // 5), max(5, n // 7)])
            if len(word) < 6:
                break
    counts = {w: n for w, n in counts.items() if len(w) >= 6}
    counted = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert sorted(map(tuple, spellings.variants(counted).collect()), key=repr) == brute_variants(counts)


def test_chains_are_followed_to_their_end(spark):
    chain = ["abcdef" + "x" * i for i in range(20)]
    counts = {w: 5 ** (i + 1) for i, w in enumerate(chain)}
    counted = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r["word"]: r["root"] for r in spellings.variants(counted).collect()}
    assert set(got.values()) == {chain[-1]}


def test_report_of_texts(spark, docs, rows, no_docs):
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdeÉö") for _ in range(rng.randint(5, 9))) for _ in range(80)]
    more = []
    for i in range(250):
        own = [w if rng.random() < 0.9 else edits(rng, w, "abcdeÉö") for w in rng.choices(base, weights=[1 / (j + 1) for j in range(80)], k=60)]
        more.append((i, "×".join(own[:3]) + "-" + " ".join(w.upper() if rng.random() < 0.2 else w for w in own)))
    every = docs.select("doc_id", "text").unionAll(spark.createDataFrame(more, "doc_id long, text string"))
    got = [tuple(r) for r in spellings.report(every).collect()]
    expected = brute_variants(brute_words([(k, t) for k, t, _ in rows] + more))
    assert sorted(got, key=repr) == expected
    assert sum(r[1] is not None for r in got) > 10
    assert spellings.report(no_docs).collect() == []


def test_pivots_are_the_lightest_pair():
    rng = random.Random(2)
    for _ in range(500):
        places = sorted(rng.sample(range(12), rng.randint(3, 8)))
        weights = [rng.randint(1, 5) for _ in places]
        a, b = spellings.pivots(places, weights)
        weight = dict(zip(places, weights, strict=True))
        assert b - a >= 2
        assert weight[a] + weight[b] == min(weight[x] + weight[y] for x, y in combinations(places, 2) if y - x >= 2)
    with pytest.raises(ValueError):
        spellings.pivots([3, 4], [1, 1])
