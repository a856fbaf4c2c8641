"""Periodic runs against looking at every start and period."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import pytest
from larder.llm import runs

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def words_of(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c not in BLANKS:
            word += c
        elif word:
            out, word = [*out, word], ""
    return out


def brute(words, least=24, times=3):
    """For each period the stretches of equal words so far apart; of one stretch the smallest period."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, times * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(key, text):
    words = words_of(text)
    n, h = len(words), zlib.crc32(str(key).encode())
    g = h // 10
    if key is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    gone = {i for a, m, q in found for i in range(a + q, a + m)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        key, len(found), *best, found and 1000 * best[1] // best[2] or None, digest("".join(f"{a},{m},{q}\n" for a, m, q in found)),
        digest(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


@pytest.mark.parametrize("seed", range(60))
def test_runs_of_random_words(seed):
    rng = random.Random(seed)
    words = []
    for _ in range(rng.randint(1, 12)):
        letters = "ab" if rng.random() < 0.3 else "abcdefgh"
        piece = [rng.choice(letters) for _ in range(rng.randint(1, 14))]
        piece = piece * rng.randint(1, 9) if rng.random() < 0.7 else piece
        if rng.random() < 0.3:
            piece = (piece + [rng.choice("abc")]) * rng.randint(1, 4)
        words += piece[: rng.randint(1, len(piece))] if rng.random() < 0.5 else piece
    words = [w.encode() for w in words]
    found = runs.runs(words)
    assert found == brute(words)
    gone = {i for a, m, q in found for i in range(a + q, a + m)}
    assert runs.collapsed(words, found) == [w for i, w in enumerate(words) if i not in gone]
    assert runs.runs(words, 6, 4) == brute(words, 6, 4)


def test_edges():
    one = lambda text: runs.runs(text.encode().split())
    assert one("") == [] and one("a " * 23) == [] and one("a " * 24) == [(0, 24, 1)]
    eight, nine = [" ".join(f"w{i}" for i in range(n)) + " " for n in (8, 9)]
    assert one(eight * 3) == [(0, 24, 8)] and one(nine * 3) == [(0, 27, 9)] and one(nine * 2 + "w0 w1 w2 w3 w4 w5 w6 w7") == []
    # A repeated period of two is one run of period two, not of four; a run of runs has both.
    assert one("a b " * 14) == [(0, 28, 2)]
    line = "a " * 30 + "b "
    assert one(line * 3) == [(0, 30, 1), (0, 93, 31), (31, 30, 1), (62, 30, 1)]


def test_long_texts_with_many_repeats():
    many = ["w"] * 200_000
    assert runs.runs([w.encode() for w in many]) == [(0, 200_000, 1)]
    rng, passage = random.Random(1), [f"p{i}" for i in range(20)]
    mixed = [w for _ in range(3000) for w in (*passage, f"x{rng.random()}")]
    assert runs.runs([w.encode() for w in mixed]) == []
    fib = ["a"], ["a", "b"]
    for _ in range(18):
        fib = fib[1], fib[1] + fib[0]
    words = [w.encode() for w in fib[1][:3000]]
    assert runs.runs(words) == brute(words)


def test_report(spark, docs, rows, no_docs):
    more = [(k, "one two three " * 30 if k % 2 else " ".join(f"a{i % 7}" for i in range(k))) for k in range(200, 340)]
    every = docs.select("doc_id", "text", "d").unionAll(
        spark.createDataFrame([(*r, "!") for r in more], "doc_id long, text string, d string")
    )
    expected = sorted([brute_row(k, t) for k, t in [(k, t) for k, t, _ in rows if k != 150] + more], key=repr)
    got = [tuple(r) for r in runs.report(every.where("doc_id IS NULL OR doc_id <> 150")).collect()]
    assert sorted(got, key=repr) == expected
    assert sum(r[1] for r in got) > 100 and sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in got) > 5
    assert runs.report(no_docs).collect() == []
    made = runs.with_runs(docs, name="score")
    assert sorted(made.columns) == sorted(docs.columns)
    assert made.where("doc_id = 151").first()["score"]["n_words"] == 1
