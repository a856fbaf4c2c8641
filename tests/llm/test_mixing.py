"""Source mixing: targets, flow and selection against exhaustive or plain versions."""

from __future__ import annotations

import itertools
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from larder.llm import mixing
from pyspark.sql import functions as F


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes):
    weights = dict(zip(sorted(sizes, key=lambda s: (s is None, s or "")), itertools.cycle((5, 2, 1))))  # noqa: B905
    total, low, high = sum(sizes.values()), 0.0, 1e12
    for _ in range(200):  # the common factor of all sources that are not stopped
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(3 * sizes[s], mid * weights[s]) for s in sizes) < total else (low, mid)
    return {s: min(3 * sizes[s], high * weights[s]) for s in sizes}


def test_targets_share_the_whole():
    rng = random.Random(2)
    for _ in range(50):
        sizes = {s: rng.choice([0, 1, 10, 1000, 30000]) for s in [None, *map(str, range(rng.randint(0, 9)))]}
        if sum(sizes.values()):
            found, expected = mixing.targets(sizes, sum(sizes.values())), brute_targets(sizes)
            assert all(found[s] == pytest.approx(expected[s], rel=1e-6, abs=1e-3) for s in sizes)


def test_flow_is_the_cheapest_of_all():
    sizes, members = {"a": 2, "ab": 2, "b": 1}, {"a": ["a"], "ab": ["a", "b"], "b": ["b"]}
    for quotas in ({"a": 4, "b": 3}, {"a": 1, "b": 5}, {"a": 6, "b": 0}, {"a": 12, "b": 9}):
        flow = mixing.min_cost_flow(sizes, members, quotas)

        def cost(used, sizes=sizes):
            return sum(r * max(0, min(sizes[p], used[p] - r * sizes[p])) for p in sizes for r in range(3))

        best = None
        for a, ab_a, ab_b, b in itertools.product(range(7), range(7), range(7), range(4)):
            if ab_a + ab_b <= 6 and a + ab_a <= quotas["a"] and b + ab_b <= quotas["b"]:
                key = (-(a + ab_a + ab_b + b), cost({"a": a, "ab": ab_a + ab_b, "b": b}))
                best = key if best is None else min(best, key)
        used = {p: sum(flow[p, s] for s in members[p]) for p in sizes}
        assert (-sum(used.values()), cost(used)) == best


def test_report_of_all_rows(docs, rows):
    found = mixing.report(docs).collect()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += size_of(text)
    targets, taken = brute_targets(sizes), defaultdict(int)
    source_of = defaultdict(set)
    for key, text, source in rows:
        source_of[key, size_of(text)].add(source)
    assert sorted(((r["doc_id"], r["size"]) for r in found), key=repr) == sorted(((k, size_of(t)) for k, t, _ in rows), key=repr)
    for r in found:
        assert r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        taken[r["source_size"]] += r["taken"]
        (source,) = source_of[r["doc_id"], r["size"]]
        assert r["source_size"] == sizes[source] and r["target"] == pytest.approx(targets[source])
    for source, size in sizes.items():
        # Documents are whole, so one that is nearly all of its source leaves a larger gap.
        largest = max(size_of(t) for _, t, s in rows if s == source)
        assert taken[size] == pytest.approx(targets[source], abs=max(40, largest / 5))


def test_reruns_and_partitions_do_not_matter(docs):
    once = sorted(map(repr, mixing.report(docs).collect()))
    assert sorted(map(repr, mixing.report(docs.repartition(7)).collect())) == once


def test_overlapping_sources_and_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 8)
    rng = random.Random(4)
    sets = [["a"], ["b"], ["a", "b"], ["a", "b", None], []]
    data = [(i, " ".join(["w"] * rng.randint(1, 9)), rng.choice(sets)) for i in range(600)]
    docs = spark.createDataFrame(data, "doc_id long, text string, of array<string>")
    out, mix = mixing.with_uses(docs, F.col("of"))
    taken = Counter()
    for r in out.collect():
        assert set(r["uses"]) <= set(r["of"]) and len(r["uses"]) <= 3
        for s in r["uses"]:
            taken[s] += size_of(r["text"])
    for source, (_, target) in mix.sources.items():
        assert taken[source] == pytest.approx(target, abs=10)


def test_mixed_rows_keep_their_columns(docs, no_docs):
    found = mixing.mixed(docs, F.array("source"))
    assert found.columns == docs.columns
    assert max(Counter(r["doc_id"] for r in found.collect() if r["doc_id"] != 140).values()) <= 6
    assert mixing.mixed(no_docs, F.array("source")).count() == 0
    assert mixing.report(no_docs).count() == 0


def test_plans_go_to_the_jvm_without_python_workers(spark, docs, monkeypatch):
    made, create = [], type(spark).createDataFrame

    def seen(self, data, *a, **b):
        made.append(type(data))
        return create(self, data, *a, **b)

    monkeypatch.setattr(type(spark), "createDataFrame", seen)
    found = mixing.report(docs.repartition(2))
    assert len(made) >= 3 and set(made) == {pa.Table}
    assert found._jdf.queryExecution().executedPlan().toString().count("LocalTableScan") == 2
