"""Near-duplicate classes against all pairs."""

from __future__ import annotations

import random
import re

import xxhash
from larder.llm import simhash
from larder.llm.components import components


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(values):
    classes, todo = {}, set(values)
    while todo:
        front, own = [todo.pop()], set()
        while front:
            a = front.pop()
            own.add(a)
            near = {b for b in todo if (a ^ b).bit_count() <= 3}
            todo -= near
            front += near
        classes |= dict.fromkeys(own, frozenset(own))
    return classes


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_every_row_has_its_class(docs, rows):
    marks = [(k, brute_fingerprint(t)) for k, t, _ in rows]
    classes = brute_classes({f for _, f in marks})
    least = {c: min((k for k, f in marks if f in c and k is not None), default=None) for c in set(classes.values())}
    expected = sorted(((k, f"{f:016x}", least[classes[f]]) for k, f in marks), key=repr)
    found = simhash.clusters(docs).withColumn("hex", simhash.hex_digits("fp"))
    assert sorted(((r["doc_id"], r["hex"], r["component_id"]) for r in found.collect()), key=repr) == expected


def test_one_row_of_each_class_stays_with_its_columns(docs, rows):
    classes = brute_classes({brute_fingerprint(t) for _, t, _ in rows})
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    found = [brute_fingerprint(r["text"]) for r in kept.collect()]
    assert len(found) == len(set(classes.values())) == len({classes[f] for f in found})
    assert {r["fp"] for r in kept.collect()} == {"fp!"}


def test_large_buckets_are_split_without_losing_links(spark):
    rng = random.Random(1)
    values = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(40):
            value = base
            for _ in range(rng.randint(0, 4)):
                value ^= 1 << rng.randrange(64)
            values.add(value)
    classes = brute_classes(values)
    frame = spark.createDataFrame([(signed(v),) for v in values] + [(None,)], "fp long")
    for bucket in (simhash.BUCKET, 8):
        roots = {r["node"]: r["component"] for r in components(simhash.links(frame, bucket=bucket)).collect()}
        assert {signed(v): min(map(signed, c)) for v, c in classes.items()} == {signed(v): roots.get(signed(v), signed(v)) for v in values}


def test_empty_table(no_docs):
    assert simhash.clusters(no_docs).count() == 0
    assert simhash.keep_one(no_docs).count() == 0


def test_components_of_a_path_a_star_and_loops(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    found = components(spark.createDataFrame(links, "a long, b long"))
    expected = {i: 0 for i in range(1, 51)} | {100 + i: 100 for i in range(1, 60)} | {201: 200}
    assert {r["node"]: r["component"] for r in found.collect()} == expected
