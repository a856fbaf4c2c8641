"""Token counts and token files against the library."""

from __future__ import annotations

import json
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from larder.llm import common, token_counts, token_files
from larder.llm.common import with_arrow
from larder.llm.registry import TOKENIZER
from tokenizers import Tokenizer

LIBRARY = Tokenizer.from_file(TOKENIZER)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_counts_equal_the_library(docs, rows):
    found = token_counts.with_token_counts(docs, TOKENIZER, limit=100)
    assert found.columns == [*docs.columns, "over_limit"]
    expected = sorted(((k, t, len(ids_of(t)), len(ids_of(t)) > 100) for k, t, _ in rows), key=repr)
    assert sorted(((r["doc_id"], r["text"], r["n_tokens"], r["over_limit"]) for r in found.collect()), key=repr) == expected


def test_odd_texts_one_by_one():
    odd = ["x\x1cy\x1d z", "　a x\x85y", "<|endoftext|><|ENDOFTEXT|>a<|startoftext|>", "ﬁ Ⅷ ǅ ẞ é", "'s's 'D 1234", "aaaa" * 300, "😀" * 9]
    assert token_counts.count_texts([t.encode() for t in odd], TOKENIZER) == [len(ids_of(t)) for t in odd]
    encoded = list(token_files.encoder(TOKENIZER)([t.encode() for t in odd]))
    assert [np.frombuffer(e, token_files.IDS).tolist() for e in encoded] == [ids_of(t) for t in odd]


def test_merges_are_those_of_a_plain_loop():
    spec = json.loads(Path(TOKENIZER).read_text())["model"]
    rank = {tuple(m): i for i, m in enumerate(spec["merges"])}
    letters = token_counts.byte_letters()
    words = [b"hello", b"banana", b"x", b"lalalalala", b"mississippi", b"a" * 61]
    left = token_counts.table(TOKENIZER)[0].surviving(words)
    for word, n in zip(words, left.tolist(), strict=True):
        symbols = [letters[b] for b in word]
        symbols[-1] += "</w>"
        while pairs := [(rank[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in rank]:  # noqa: B905
            _, i = min(pairs)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        assert n == len(symbols)


def test_files_hold_all_documents_in_order(spark, docs, rows, tmp_path):
    path = f"file://{tmp_path}/files"
    manifest = token_files.write(docs, path, TOKENIZER, end_id=1, frame_tokens=500)
    found = token_files.read(spark, path).orderBy("start").collect()
    at = 0
    for r, (key, text, _) in zip(found, sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")), strict=True):
        ids = [*ids_of(text), 1]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["tokens"]) == (key, at, len(ids), ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert sum(r["n_tokens"] for r in manifest.collect()) == at
    some = token_files.read(spark, path, wanted=[100, 150], tokens=False)
    assert sorted(r["doc_id"] for r in some.collect()) == [100, 150]


def test_readers_give_up_the_encoder_of_their_worker(spark, docs):
    def held(parts):
        from larder.llm import common, token_files

        for _ in parts:
            yield pa.RecordBatch.from_pydict({"owner": [common._owner[0]], "n": [token_files._encoder.cache_info().currsize]})

    assert token_files.write_and_read(docs, TOKENIZER, 1).count() == docs.count()
    workers = spark.range(0, 64, 1, 64).mapInArrow(held, "owner string, n long").collect()
    assert {r["n"] for r in workers if r["owner"] == "token_readers"} == {0}


def test_a_worker_that_changes_hands_returns_what_it_freed():
    def held():
        return sum(int(line.split()[1]) for line in Path("/proc/self/smaps_rollup").read_text().splitlines() if line.startswith("Private_Dirty"))

    common.takes_worker("one", lambda: None)
    rows = [b"x" * 700 + bytes([i % 256]) for i in range(150_000)]
    # What stays lies between the freed rows, so that the C library keeps their pages by itself.
    some = rows[::50]
    del rows
    before = held()
    common.takes_worker("other", lambda: None)
    assert before - held() > 50_000
    assert len(some) == 3000


def test_only_wanted_frames_are_read_and_damage_is_seen(tmp_path):
    place = tmp_path / "one.zst"
    with place.open("wb") as out:
        writer = token_files.FrameWriter(out, frame_tokens=4)
        for key in range(6):
            writer.add(key, np.arange(key, key + 3, dtype="<u4").tobytes())
        writer.add(None, b"")
        writer.close()
    plain = zstandard.ZstdDecompressor().stream_reader(place.open("rb"), read_across_frames=True).read()
    assert np.frombuffer(plain, "<u4").tolist() == [k + i for k in range(6) for i in range(3)]
    with place.open("rb") as source:
        reader = token_files.FrameReader(source)
        assert np.frombuffer(reader.document(4), "<u4").tolist() == [4, 5, 6]
        assert reader.known.tolist() == [True] * 6 + [False]
        second = int(reader.places[1] + reader.sizes[1] - 3)
    raw = bytearray(place.read_bytes())
    raw[second] ^= 1
    place.write_bytes(raw)
    with place.open("rb") as source:
        reader = token_files.FrameReader(source)
        assert np.frombuffer(reader.document(4), "<u4").tolist() == [4, 5, 6]
        with pytest.raises((ValueError, zstandard.ZstdError)):
            reader.document(1)


def test_empty_table(spark, no_docs):
    assert token_counts.with_token_counts(no_docs, TOKENIZER).count() == 0
    assert token_files.write_and_read(no_docs, TOKENIZER, 1).count() == 0


def test_added_column_replaces_one_of_its_name(docs):
    out = with_arrow(docs, "score", "text", "long", lambda texts: pa.array([len(t) for t in texts], pa.int64()))
    assert out.columns == docs.columns and dict(out.dtypes)["score"] == "bigint"


def test_bytes_that_are_no_text_do_not_crash(spark):
    broken = spark.sql("SELECT 1L AS doc_id, cast(unhex('61FF2062') AS string) AS text")
    assert token_counts.with_token_counts(broken, TOKENIZER).first()["n_tokens"] == len(ids_of("a� b"))
