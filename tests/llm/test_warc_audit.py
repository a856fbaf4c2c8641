"""Merkle audits against a comparison of all leaves."""

from __future__ import annotations

import hashlib

import pytest
from larder.llm import warc_audit


@pytest.fixture(scope="module")
def pages(spark):
    data = [(i, f"http://h/{i}", f"<p>{i}</p>" * (i % 7), "x") for i in range(1, 1500)]
    data += [(None, None, None, "x"), (None, "http://h/n", "n", "x"), (5, "http://h/5", "again", "x")] + [(7, "http://h/7", "same", "x")] * 3
    data += [(2000, "http://h/long", "é" * 100_000, "x")]
    return spark.createDataFrame(data, "page_id long, url string, html string, file string").repartition(4)


def keyed(leaves):
    return {(r["file"], r["ordinal"]): (r["offset"], r["length"], r["digest"]) for r in leaves.collect()}


def test_records_lie_end_to_end(pages):
    rows = warc_audit.leaves(pages).orderBy("file", "ordinal").collect()
    assert len(rows) == pages.count()
    for a, b in zip(rows, rows[1:], strict=False):
        if a["file"] == b["file"]:
            assert (b["ordinal"], b["offset"]) == (a["ordinal"] + 1, a["offset"] + a["length"])
        else:
            assert (b["ordinal"], b["offset"]) == (0, 0)
    one = next(r for r in rows if r["key"] == 2000)
    body = ("é" * 100_000).encode()
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://h/long\r\nContent-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n"
    assert one["digest"] == hashlib.sha256(head.encode() + body + b"\r\n\r\n").hexdigest()


def test_audit_finds_every_difference_and_nothing_else(pages):
    other = warc_audit.damaged_copy(pages).where("page_id IS NULL OR page_id NOT IN (1400, 2000)")
    one, two = warc_audit.leaves(pages), warc_audit.leaves(other)
    a, b = keyed(one), keyed(two)
    expected = {k: "missing" if k not in b else "added" if k not in a else "damaged" for k in a.keys() | b.keys() if a.get(k) != b.get(k)}
    found = {(r["file"], r["ordinal"]): r["status"] for r in warc_audit.audit(one, two).collect()}
    assert found == expected and set(expected.values()) == {"missing", "damaged"}


def test_equal_replicas_differ_nowhere(pages):
    one = warc_audit.leaves(pages)
    assert warc_audit.audit(one, warc_audit.leaves(pages.repartition(7))).count() == 0


def test_root_covers_everything(pages):
    leaves = warc_audit.leaves(pages)
    levels = warc_audit.tree([leaves, warc_audit.leaves(pages.where("page_id <> 3"))])
    top = levels[-1].orderBy("replica").collect()
    assert len(top) == 2 and top[0]["digest"] != top[1]["digest"]


def test_many_equal_rows_fill_several_files(spark, monkeypatch):
    monkeypatch.setattr(warc_audit, "RECORDS_A_FILE", 50)
    same = spark.createDataFrame([(1, "http://u", "x")] * 400, "page_id long, url string, html string")
    rows = warc_audit.leaves(same).groupBy("file").count().collect()
    assert len(rows) == 8 and sum(r["count"] for r in rows) == 400


def test_a_changed_byte_in_a_large_key_is_one_row(spark, monkeypatch):
    monkeypatch.setattr(warc_audit, "RECORDS_A_FILE", 50)
    schema = "page_id long, url string, html string"
    data = [(None, None, f"<p>{i:04d}</p>") for i in range(400)] + [(9, "http://h/9", f"{i:04d}") for i in range(120)]
    data += [(9, "http://h/9", "same")] * 60
    other = list(data)
    other[123], other[450] = (None, None, "<p>#123</p>"), (9, "http://h/9", "#050")
    one, two = spark.createDataFrame(data, schema), spark.createDataFrame([*other, (9, "http://h/9", "one more")], schema)
    rows = warc_audit.report(one, two).collect()
    assert len(rows) == len(data)
    where = {r["sha256"]: r["status"] for r in rows if r["status"] != "intact"}
    wanted = warc_audit.leaves(spark.createDataFrame([data[123], data[450]], schema)).collect()
    assert len([r for r in rows if r["status"] != "intact"]) <= 2 and set(where.values()) == {"damaged"}
    assert wanted[0]["digest"] in where and wanted[1]["digest"] in where


def test_empty_table(pages):
    none = pages.limit(0)
    assert warc_audit.report(none, none).count() == 0
    found = warc_audit.audit(warc_audit.leaves(pages.limit(3)), warc_audit.leaves(none))
    assert {r["status"] for r in found.collect()} == {"missing"} and found.count() == 3
