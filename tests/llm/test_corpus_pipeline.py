"""The corpus pipeline, stage by stage, against plain versions of its decisions."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from larder.llm import mixing, simhash
from larder.llm.registry import TOKENIZER
from test_shingles import brute_kept
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def folder(spark, words, tmp_path_factory):
    rng = random.Random(12)
    place = str(tmp_path_factory.mktemp("tables"))
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(30)) for i in range(5)]
    docs, labels = [], []
    for i in range(300):
        body, toxic = text(rng.randint(20, 90)), int(i % 10 == 3)
        if toxic:
            body += " you idiot " + text(5)
        elif i % 10 == 5:
            body += " " + items[i % 5][1] + " " + text(9)
        elif i % 10 == 7:
            body = docs[i - 1][1]
        elif i % 20 == 9:
            # One word of the last copied text changed at its end, near the bound of 0.8 for short texts.
            body = " ".join([*docs[i - 3][1].split()[:-1], "other"])
        docs.append((i, body, "en", f"s{i % 4}", len(body)))
        if i % 2:
            labels.append((i, 1, toxic))
    docs.append((400, None, "en", None, 0))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{place}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    return place, docs, items


def test_stages(spark, folder):
    place, rows, items = folder
    docs = spark.read.parquet(f"{place}/documents.parquet")
    texts = {k: t or "" for k, t, *_ in rows}
    left = {k for k in texts if "idiot" not in texts[k]}
    edited = {k for k in range(9, 300, 20)}
    for (name, stage), n in zip(corpus_pipeline.STAGES[:4], range(4), strict=True):
        docs = stage(spark, docs, place).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        found = Counter(r["doc_id"] for r in docs.collect())
        if n == 1:
            left = set(brute_kept([(k, texts[k]) for k in left]))
            assert not left & edited
        if n == 2:
            left = {k for k in left if not any(t in texts[k] for _, t in items)}
        if n < 3:
            assert found == Counter(left), name
        else:
            assert set(found) <= left and max(found.values()) <= 3
            sizes = Counter()
            for k in left:
                sizes[rows[k][3] if k < 300 else None] += len(texts[k].split())
            targets = mixing.targets(sizes, sum(sizes.values()))
            for source, target in targets.items():
                taken = sum(len(texts[k].split()) * c for k, c in found.items() if (rows[k][3] if k < 300 else None) == source)
                assert taken == pytest.approx(target, abs=40)
    library, at = Tokenizer.from_file(TOKENIZER), 0
    for r in corpus_pipeline.STAGES[4][1](spark, docs, place).orderBy("start").collect():
        ids = [*library.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 1]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_run_goes_through_all_stages(spark, folder):
    out = corpus_pipeline.run(spark, folder[0])
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 100


def test_stages_take_odd_rows_and_other_columns(spark, folder, docs, no_docs, rows):
    assert sum(k is None for k, _, _ in rows) == 2
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder[0])
        assert name == "token_files" or out.columns == docs.columns
        assert out.count() >= 0.7 * len(rows), name
        assert stage(spark, no_docs, folder[0]).count() == 0


def test_stages_without_labels_and_items(spark, docs, rows, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, str(tmp_path))
    assert docs.count() > 40


def test_near_duplicates_go_through_fingerprints(spark, folder, monkeypatch):
    """Texts that fingerprints link are judged before any is looked for by its shingles."""
    asked, known = [], simhash.links
    monkeypatch.setattr(simhash, "links", lambda found, *a: asked.append({r["fp"] for r in found.collect()}) or known(found, *a))
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    assert corpus_pipeline.drop_near_duplicates(spark, docs, folder[0]).count() < docs.count()
    assert asked == [{simhash.fingerprint((t or "").encode() if not isinstance(t, bytes) else t) for _, t, *_ in folder[1]}]
