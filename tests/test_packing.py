"""Wide columns that move as one compressed value of each row."""

from __future__ import annotations

from pathlib import Path

import pytest
from fixtures import staging, write_raw

from larder import schemas
from larder.operators.packing import packed, unpacked
from larder.plans import ingest, publish
from larder.plans.assemble import assemble, read_staging
from larder.sources.tables import read_table, write_staging

DDL = "id int, t string, n int, a array<string>"
ROWS = [
    (0, None, 1, None),
    (1, "", None, []),
    (2, 'a","b\\ "c" \x1f\x00\n é𝄞', 2, [None, "", 'x","y', "\x1f", '"', "\\", "[", None]),
    (3, "z" * 300_000, 3, ["w"] * 5_000),
    (4, "null", 4, ["null", "{}"]),
]


@pytest.mark.parametrize("parts", [1, 3])
def test_what_is_packed_is_unpacked(spark, parts):
    df = spark.createDataFrame(ROWS, DDL).repartition(parts)
    moved = packed(df, ["t", "a"], "p")
    assert moved.columns == ["id", "n", "p"] and dict(moved.dtypes)["p"] == "binary"
    again = unpacked(moved.repartitionByRange(2, "id").sortWithinPartitions("id"), "p", df.select("t", "a").schema)
    assert again.columns == ["id", "n", "t", "a"] and again.select(df.columns).collect() == [tuple(r) for r in ROWS]


def test_a_missing_value_gives_nulls_and_no_rows_give_none(spark):
    df = spark.createDataFrame(ROWS, DDL)
    schema = df.select("t", "a").schema
    none = spark.createDataFrame([(1, None)], "id int, p binary")
    assert unpacked(none, "p", schema).collect() == [(1, None, None)]
    assert unpacked(packed(df.limit(0), ["t", "a"], "p"), "p", schema).count() == 0


def test_repeated_text_takes_few_bytes(spark):
    df = spark.createDataFrame([(i, "soup " * 100, i, ["soup"] * 100) for i in range(50)], DDL)
    assert max(len(r["p"]) for r in packed(df, ["t", "a"], "p").collect()) < 100


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_published_rows_move_packed_and_are_not_copied(spark, tmp_path, monkeypatch):
    for name, df in staging(spark).items():
        write_staging(df, str(tmp_path / "staging" / name))
    seen, write = {}, publish.write_partitioned

    def watched(df, *args):
        seen["main"] = df
        write(df, *args)

    monkeypatch.setattr(publish, "write_partitioned", watched)
    copies = lambda: {*Path(spark.conf.get("spark.checkpoint.dir")).glob("larder/*/assembled-*")}
    monkeypatch.setattr(publish, "remove", lambda *_: None)
    before = copies()
    catalog = publish.transform(spark, str(tmp_path / "staging"), str(tmp_path / "out"))
    assert copies() == before and {*publish.WIDE} <= {*seen["main"].columns}
    moves = [line for line in _plan(seen["main"]).splitlines() if "Exchange" in line]
    assert moves and not any("ingredients" in line or "instructions" in line for line in moves)
    # Rows that come joined, and rows that move by title, are published as the same tables.
    other = publish.publish(assemble(read_staging(spark, str(tmp_path / "staging"))), str(tmp_path / "other"))
    monkeypatch.setattr("larder.plans.assemble.BROADCAST_BYTES", -1)
    spread = publish.transform(spark, str(tmp_path / "staging"), str(tmp_path / "spread"))
    for ours, *same in zip(*(c.read(spark) for c in (catalog, other, spread)), strict=True):
        want = sorted(map(repr, ours.collect()))
        assert want and all(sorted(map(repr, theirs.collect())) == want for theirs in same)
    assert schemas.contract_gaps(read_table(spark, catalog.main).select(*schemas.RECIPES_MAIN.names), schemas.RECIPES_MAIN) == []


def test_repeats_and_recipes_without_items_are_published(spark, tmp_path):
    raw = write_raw(tmp_path / "raw")
    for _ in range(2):
        ingest.ingest(spark, raw, str(tmp_path / "staging"), "append")
    frames = read_staging(spark, str(tmp_path / "staging"))
    for name, df in frames.items():
        write_staging(df.filter("id <> 'w02'") if name == "det_ingrs" else df, str(tmp_path / "less" / name))
    main, index, _ = publish.transform(spark, str(tmp_path / "less"), str(tmp_path / "out")).read(spark)
    stew = main.filter("recipe_id = 'w02'").collect()
    assert [(r.ingredients_validated, r.n_ingredients_validated, r.n_steps) for r in stew] == [(None, 0, 3)]
    assert main.count() == 3 and index.filter("recipe_id = 'w02'").isEmpty() and index.count() == 6
