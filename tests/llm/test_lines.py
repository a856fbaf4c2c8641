"""Lines that many documents hold, against counting them; the minimal perfect hash alone."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from larder.llm import lines
from larder.llm.line_index import PerfectHash
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute(rows, least=3, characters=20):
    """Rows ``key, text`` to ``key, lines, dropped, kept``."""
    holders = defaultdict(set)
    for k, t in rows:
        for line in (t or "").split("\n"):
            holders[key_of(line)].add(k)
    number = lambda k: -1 if k is None else k
    last = {key: max(own, key=number) for key, own in holders.items() if len(key) >= characters and len(own) >= least}
    out = []
    for k, t in rows:
        own = (t or "").split("\n")
        kept = [line for line in own if last.get(key_of(line), k) == k]
        out.append((k, len(own), len(own) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def pages():
    """Lines of all kinds: frequent, at the length's border, blank, with other blanks and case, in repeated rows and keys."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdeéß日") for _ in range(rng.randint(2, 6)))
    common = [" ".join(word() for _ in range(rng.randint(2, 8))) for _ in range(60)] + ["é" * 19, "é" * 20, "a" * 19, "a" * 20, "ﬁ" * 7, ""]
    rows = []
    for i in range(150):
        own = [rng.choice(common) for _ in range(rng.randint(0, 12))] + [" ".join(word() for _ in range(9))]
        own = [rng.choice(["", " ", "\t", "\x0c", "\xa0"]) + (line.upper() if rng.random() < 0.2 else line) + rng.choice(["", "  ", "\r"]) for line in own]
        rng.shuffle(own)
        rows.append((i, "\n".join(own)))
    frequent = "a line that every third of the documents holds"
    rows += [(200 + i, f"x{i}\n{frequent}\n{frequent} \ny") for i in range(70)]
    rows += [(300, None), (301, ""), (302, "\n\n"), (None, frequent), (None, f"{frequent}\n{frequent}"), (None, None)]
    rows += [(400, f"{frequent}\nonly here, but in two rows of it")] * 2 + [(401, f"{frequent}\nA"), (401, f"{frequent}\nB")]
    rows += [(500, "\n".join(["the same long line again and again"] * 3000)), (501, "x" * 300_000)]
    return rows


@pytest.mark.parametrize("resident", [lines.RESIDENT, 200])
def test_equals_counting(spark, pages, resident):
    docs = spark.createDataFrame([(*r, "l", "d") for r in pages], "doc_id long, text string, N_lines string, k string").repartition(3)
    found = lines.without_repeated_lines(docs, resident=resident)
    assert found.columns == ["doc_id", "text", "k", "n_lines", "n_dropped"]
    got = sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in found.collect()), key=repr)
    assert got == brute(pages)
    assert sum(r[2] for r in got) > 300


def test_report_and_odd_rows(docs, rows, no_docs):
    got = sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in lines.report(docs).collect()), key=repr)
    expected = [(k, n, m, hashlib.sha256(t.encode()).hexdigest()) for k, n, m, t in brute([(k, t) for k, t, _ in rows])]
    assert got == sorted(expected, key=repr)
    assert lines.report(no_docs).collect() == []
    assert lines.without_repeated_lines(no_docs).columns == [*no_docs.columns, "n_lines", "n_dropped"]


def test_frequent_line_is_counted_before_it_meets(spark):
    rows = spark.range(1000).select(F.lit("a line of more than twenty characters").alias("t"), F.col("id").alias("k"))
    (one,) = lines.repeated_lines(rows).collect()
    assert (one["n"], one["last"]) == (1000, 999)
    plan = lines.repeated_lines(rows)._jdf.queryExecution().toString()
    assert plan.count("partial_count") >= 1


@pytest.mark.parametrize("n", [0, 1, 2, 50_000])
def test_numbers_are_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 1 << 63, (n, 2), np.uint64)
    keys[: n // 2, 0] = 7  # keys that differ in their low bits only
    made = PerfectHash.of(keys[:, 0], keys[:, 1])
    again = PerfectHash.unpacked(*made.packed())
    for index in (made, again):
        assert np.array_equal(np.sort(index.numbers(keys[:, 0], keys[:, 1])), np.arange(n))
    assert len(made.packed()[1]) <= n * 0.7 + 100
    others = rng.integers(0, 1 << 63, (1000, 2), np.uint64)
    assert again.numbers(others[:, 0], others[:, 1]).max(initial=-1) < n
