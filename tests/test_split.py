"""Records of one file read in many blocks, against a parser that reads it from its beginning."""

from __future__ import annotations

import csv
import json
import random

import pytest
from pyspark.sql.types import StructType

from larder.schemas import RAW_KAGGLE
from larder.sources import split
from larder.sources.raw import read_csv_records, read_json_records

ODD = ['{', '}', '"', '\\', '[', ']', ',', '\n', "é", "日本", '{"a": "}', '\\"}', "}}", " ", "\r\n", ""]


def odd_text(rng):
    return "".join(rng.choice([*ODD, "word ", "x"]) for _ in range(rng.randint(0, 12)))


@pytest.fixture(params=[60, 400, 1 << 20])
def block(spark, request):
    """Files are cut into blocks of so many bytes."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(request.param))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield request.param
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("indent", [None, 1, 4])
def test_json_arrays_of_any_format(spark, tmp_path, block, indent):
    rng = random.Random(indent or 0)
    rows = [{"id": i, "t": odd_text(rng), "n": {"m": [{"k": odd_text(rng)} for _ in range(rng.randint(0, 3))]}} for i in range(60)]
    for name, part in (("a", rows[:40]), ("b", rows[40:41]), ("c", []), ("d", rows[41:])):
        text = json.dumps(part, indent=indent, ensure_ascii=False)
        (tmp_path / f"{name}.json").write_text(f"﻿ {text}\n" if name == "a" else text)
    schema = StructType.fromDDL("id long, t string, n struct<m: array<struct<k: string>>>")
    got = read_json_records(spark, str(tmp_path), schema)
    whole = read_json_records(spark, str(tmp_path), schema, "array_whole")
    found = sorted(got.collect(), key=lambda r: r["id"])
    assert found == sorted((r for r in whole.collect()), key=lambda r: r["id"])
    assert [r["t"] for r in found] == [r["t"] for r in rows]
    assert [[x["k"] for x in r["n"]["m"]] for r in found] == [[x["k"] for x in r["n"]["m"]] for r in rows]


def test_one_json_file_is_many_tasks(spark, tmp_path, block):
    (tmp_path / "one.json").write_text(json.dumps([{"id": str(i), "text": "x" * 50} for i in range(100)]))
    pieces = split._pieces(spark, str(tmp_path), split.JSON)
    n = pieces.select("block").distinct().count()
    assert n > 10 or block > 400


@pytest.mark.parametrize("text", ['[{"id": "1"}, {"id": ', '[{"id": "1"}] x', '[{"id": "1}]'])
def test_a_broken_array_fails(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match=r"(?i)malformed|parse"):
        read_json_records(spark, str(tmp_path), StructType.fromDDL("id string")).collect()


def test_csv_with_line_breaks_in_quotes(spark, tmp_path, block):
    rng = random.Random(6)
    names = RAW_KAGGLE.names
    expected = []
    for f in range(3):
        own = rng.sample(names, rng.randint(2, len(names)))
        with (tmp_path / f"{f}.csv").open("w", newline="") as file:
            out = csv.writer(file, lineterminator=rng.choice(["\n", "\r\n"]), quoting=csv.QUOTE_ALL if f == 1 else csv.QUOTE_MINIMAL)
            out.writerow(own)
            for i in range(40):
                row = [f"{f}-{i}" if j == 0 else odd_text(rng).replace("\r\n", "\n").strip() + "." for j in range(len(own))]
                out.writerow(row)
                expected.append(tuple(dict(zip(own, row, strict=True)).get(n) for n in names))
    got = read_csv_records(spark, str(tmp_path), RAW_KAGGLE)
    assert got.columns == names
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)


def test_csv_that_ends_in_quotes_fails(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('id,name\n1,"open\n2,x\n')
    with pytest.raises(Exception, match="ends inside quotes"):
        read_csv_records(spark, str(tmp_path), RAW_KAGGLE).collect()


def test_empty_csv_files(spark, tmp_path):
    (tmp_path / "none.csv").write_text("")
    (tmp_path / "head.csv").write_text("id,name\n")
    for multi_line in (True, False):
        assert read_csv_records(spark, str(tmp_path), RAW_KAGGLE, multi_line).collect() == []


def test_pieces_are_not_shuffled(spark, tmp_path):
    """A piece is as small as a word; what is moved are blocks, a row each, and records at a border."""
    (tmp_path / "one.json").write_text(json.dumps([{"id": str(i), "n": [{"k": "x"}] * 20} for i in range(50)]))
    pieces = split._pieces(spark, str(tmp_path), split.JSON)
    found = split.blocks(pieces, split.JSON)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.index("Exchange") < plan.index("MapInArrow")
    assert [(r["begins"], r["depth"]) for r in found.collect()] == [(0, 0)]
