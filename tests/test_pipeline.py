"""Raw files to published tables, on three recipes and their edge cases."""

from __future__ import annotations

import json

import pytest
from fixtures import DET, LAYER1, LAYER2, NUTRITION, staging, write_raw
from pyspark.sql import functions as F

from larder import schemas
from larder.operators.dedupe import distinct_keys, first_seen, keep_one, keep_one_stored
from larder.operators.filters import holds_text
from larder.operators.items import owners_of_all, owners_of_any
from larder.operators.joins import frequent_values, left_join_on, reassembled, spread_left_join
from larder.plans import ingest, publish, serving
from larder.plans.assemble import assemble, read_staging
from larder.plans.ingest import RESOURCES
from larder.plans.publish import Catalog, info, run
from larder.plans.quality import quality_report
from larder.sources.raw import read_csv_records, read_json_records
from larder.sources.tables import read_table, write_staging
from larder.streaming.incremental import append_new_files


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("catalog")
    raw = write_raw(root / "raw")
    return run(spark, raw, str(root / "staging"), str(root / "out"))


@pytest.fixture(scope="module")
def tables(spark, catalog):
    return catalog.read(spark)


def by_id(df):
    return {r["recipe_id"]: r for r in df.collect()}


def test_main_contract(tables):
    main, index, details = tables
    assert schemas.contract_gaps(main, schemas.RECIPES_MAIN) == []
    assert schemas.contract_gaps(index, schemas.INGREDIENTS_INDEX) == []
    assert schemas.contract_gaps(details, schemas.RECIPES_NUTRITION_DETAIL) == []
    assert schemas.contract_gaps(details.drop("fat_g"), schemas.RECIPES_NUTRITION_DETAIL)
    assert distinct_keys(main, "recipe_id").first().asDict() == {"n_rows": 3, "n_keys": 3, "is_unique": True}


def test_main_values(tables):
    main = by_id(tables[0])
    bread, stew, tart = main["w01"], main["w02"], main["w03"]
    assert (bread.cook_minutes, bread.kaggle_energy_kcal, bread.mit_energy_kcal) == (45, 331.0, 312.5)
    assert (bread.nutri_score, bread.cook_time_category) == ("D", "moyen")
    assert bread.tags == ["bread", "nuts", "slow"]
    assert bread.description == 'A "dark" loaf,\nin two lines'
    assert bread.image_urls == ["http://i.example/1a.jpg", "http://i.example/1b.jpg"]
    assert bread.instructions_text == "Knead | Bake" and bread.n_steps == 2
    assert bread.ingredients_validated == ["rye", "honey", "yeast", "walnut halves"]
    assert (stew.nutri_score, tart.nutri_score) == (None, "C")
    assert (stew.cook_time_category, tart.cook_time_category) == ("inconnu", "inconnu")
    assert stew.n_ingredients_validated == 2 and stew.tags == []
    assert [main[i].has_image for i in sorted(main)] == [True, True, False]
    assert tart.image_url is None and tart.cook_minutes is None


def test_index_and_details(tables):
    _, index, details = tables
    assert rows(details.select("recipe_id")) == [("w01",), ("w03",)]
    assert index.filter("ingredient = 'tart shell'").count() == 0
    bread = {r["ingredient"] for r in index.filter("recipe_id = 'w01'").collect()}
    assert bread >= {"rye", "honey", "yeast", "walnut halves"}
    assert rows(owners_of_all(index, ["rye", "honey"])) == [("w01",)]
    assert rows(owners_of_any(index, ["rye", "honey"])) == [("w01",), ("w03",)]


def test_partition_folder_of_unscored_recipes(spark, catalog):
    files = spark.read.parquet(catalog.main).inputFiles()
    assert {f.split("nutri_score=")[1].split("/")[0] for f in files} == {"C", "D", "__HIVE_DEFAULT_PARTITION__"}


def test_info_and_missing_table(spark, catalog, tmp_path):
    stats = {r["table_name"]: r for r in info(spark, catalog.root).collect()}
    assert (stats["recipes_main"].n_rows, stats["recipes_main"].with_image, stats["recipes_main"].with_score) == (3, 2, 2)
    assert stats["ingredients_index"].n_rows == 8 and stats["recipes_nutrition_detail"].with_image is None
    with pytest.raises(FileNotFoundError):
        info(spark, str(tmp_path / "none"))


def test_views(spark, catalog):
    serving.register_catalog(spark, catalog.root)
    full = spark.table("recipes")
    assert full.columns[-5:] == ["fat_g", "protein_g", "salt_g", "sugars_g", "saturates_g"]
    assert full.count() == 3
    top = spark.sql("SELECT * FROM v_ingredient_catalog").first()
    assert (top.ingredient, top.recipe_count) == ("honey", 2)


def test_dashboard_and_quality_report(tables):
    main, index, details = tables
    charts = serving.dashboard(main, details, {"nutri_scores": ["D"], "kcal_min": 0, "kcal_max": 3500})
    assert rows(charts["score_counts"]) == [("D", 1)]
    assert rows(charts["class_counts"]) == [("long", 0), ("moyen", 1), ("rapide", 0)]
    assert charts["macro_totals"].first().sugars_g == 6.5
    assert rows(charts["top_tags"]) == [("bread", 1), ("nuts", 1), ("slow", 1)]
    assert rows(charts["scatter"]) == [(1.75, 6.5, "D", "Walnut Bread")]
    assert rows(charts["kcal_histogram"].select("bin", "bin_start", "count")) == [(0, 312.5, 1)]
    assert rows(serving.category_charts(main)) == [
        ("curve", "45", 1), ("score", "C", 1), ("score", "D", 1), ("time", "moyen", 1)
    ]
    report = quality_report(main, index, details)
    assert sum(r["count"] for r in report["completeness"].collect()) == 3
    assert {r["column_name"] for r in report["known_by_column"].collect()} == set(schemas.RECIPES_MAIN.names)
    assert report["outliers"].count() == 0
    assert [r["summary"] for r in report["macro_summary"].collect()] == ["count", "mean", "min", "max"]


def test_staging_schemas(spark, tmp_path):
    raw = write_raw(tmp_path / "raw")
    paths = ingest.ingest(spark, raw, str(tmp_path / "staging"))
    for name, contract in {
        "layer1": schemas.LAYER1, "layer2": schemas.LAYER2, "det_ingrs": schemas.DET_INGRS,
        "nutrition": schemas.NUTRITION, "kaggle": schemas.KAGGLE,
    }.items():
        assert schemas.contract_gaps(read_table(spark, paths[name]), contract) == [], name
    assert read_table(spark, paths["kaggle"]).first().kaggle_id is None
    assert by_title(read_table(spark, paths["nutrition"]))["plum tart"].salt_g == 0.15


def by_title(df):
    return {r["title_norm"]: r for r in df.collect()}


def test_assembly_of_json_text_staging(spark):
    wide = assemble(staging(spark))
    assert wide.count() == 3 and "energy_kcal" not in wide.columns and "mit_energy_kcal" in wide.columns
    got = {r["id"]: r for r in wide.collect()}
    assert got["w01"].ingredients_raw == ["rye", "honey"]
    assert got["w03"].image_url is None and got["w02"].cook_minutes is None
    assert got["w01"].n_steps == 2
    published = {r["recipe_id"]: r for r in publish.enriched(wide).collect()}
    assert published["w01"].nutri_score == "D" and published["w03"].has_image is False


def test_few_titles_leave_the_wide_rows_where_they_are(spark, monkeypatch):
    wide = assemble(staging(spark))
    assert "hashpartitioning(title_norm" not in wide._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr("larder.plans.assemble.BROADCAST_BYTES", -1)
    spread = assemble(staging(spark))
    assert "hashpartitioning(title_norm" in spread._jdf.queryExecution().executedPlan().toString()
    assert spread.columns == wide.columns and rows(spread) == rows(wide)


def test_append_twice_gives_the_same_catalog(spark, tmp_path, tables):
    raw = write_raw(tmp_path / "raw")
    for _ in range(2):
        ingest.ingest(spark, raw, str(tmp_path / "staging"), "append")
    again = read_staging(spark, str(tmp_path / "staging"))
    assert again["layer1"].count() == 6
    catalog = publish.publish(assemble(again), str(tmp_path / "out"))
    for ours, other in zip(catalog.read(spark), tables, strict=True):
        assert rows(ours) == rows(other)


def test_json_layouts_agree(spark, tmp_path):
    (tmp_path / "array.json").write_text(json.dumps(LAYER1, indent=2))
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, LAYER1)))
    (tmp_path / "array_lines.json").write_text("[" + ",\n".join(map(json.dumps, LAYER1)) + "]\n")
    (tmp_path / "array_lines2.json").write_text("[\n" + "\n,".join(map(json.dumps, LAYER1)) + "\n]")
    want = rows(read_json_records(spark, str(tmp_path / "array.json"), schemas.RAW_LAYER1), "id")
    assert len(want) == 3
    for layout, file in [("lines", "lines"), ("array_lines", "array_lines"), ("array_lines", "array_lines2")]:
        got = read_json_records(spark, str(tmp_path / f"{file}.json"), schemas.RAW_LAYER1, layout)
        assert rows(got, "id") == want
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        read_json_records(spark, str(tmp_path / "array.json"), schemas.RAW_LAYER1, "array_lines").collect()
    (tmp_path / "num.json").write_text('[{"id": 7, "title": null}]')
    num = read_json_records(spark, str(tmp_path / "num.json"), schemas.RAW_LAYER1)
    assert ingest.stage_layer1(num).first().asDict() == {
        "id": "7", "title": None, "url": None, "partition": None, "instructions_text": "",
        "ingredients_raw": [], "n_steps": 0, "title_norm": "",
    }


def test_layer2_flags(spark, tmp_path):
    (tmp_path / "l2.json").write_text(json.dumps(LAYER2 + [{"id": "x", "images": []}, {"id": "y"}]))
    raw = read_json_records(spark, str(tmp_path / "l2.json"), schemas.RAW_LAYER2)
    got = {r["id"]: r for r in ingest.stage_layer2(raw).collect()}
    assert got["w01"].image_url == "http://i.example/1a.jpg" and got["w01"].has_image
    assert (got["x"].image_url, got["x"].image_urls, got["x"].has_image) == (None, [], False)
    assert (got["y"].image_url, got["y"].image_urls, got["y"].has_image) == (None, [], False)


def test_det_ingrs_and_nutrition(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps(DET))
    det = ingest.stage_det_ingrs(read_json_records(spark, str(tmp_path / "d.json"), schemas.RAW_DET_INGRS))
    stew = det.filter("id = 'w02'").first()
    assert stew.ingredients_validated == ["lentils", "smoked ham"] and stew.n_ingredients_validated == 2
    (tmp_path / "n.json").write_text(json.dumps(NUTRITION + [{"title": None}]))
    nutr = ingest.stage_nutrition(read_json_records(spark, str(tmp_path / "n.json"), schemas.RAW_NUTRITION))
    none = by_title(nutr)[""]
    assert none.energy_kcal is None and none.sugars_g is None


def test_kaggle_first_seen(spark):
    raw = spark.createDataFrame(
        [
            ("Soup!", "10", "5", "['a']", "[1.0]", "2", "ten"),
            ("soup", "9", "x", "", "", "", ""),
            ("soup", None, "7", "", "", "", "no id"),
            ("!!", "1", "7", "", "", "", ""),
            (None, "2", "7", "", "", "", ""),
        ],
        "name string, id string, minutes string, tags string, nutrition string, n_steps string, description string",
    )
    got = ingest.stage_kaggle(raw).collect()
    assert len(got) == 1
    assert got[0].asDict() == {
        "kaggle_id": "9", "cook_minutes": None, "n_steps": None, "description": None, "tags": [],
        "title_norm": "soup", "kaggle_energy_kcal": None,
    }


def test_keep_one_is_total_and_null_safe(spark):
    data = [("k", 2, None, ["x"]), ("k", 2, "b", ["x"]), ("k", None, "a", None), (None, 1, "z", []), (None, 0, "y", [])]
    ddl = "k string, n int, s string, a array<string>"
    for parts in (1, 3, 5):
        df = spark.createDataFrame(data, ddl).repartition(parts)
        assert rows(keep_one(df, ["k"], ["n"]), "n") == [(None, 0, "y", []), ("k", 2, None, ["x"])]
        assert rows(keep_one(df, ["k"], ["n"], prefer="max"), "n") == [(None, 1, "z", []), ("k", 2, "b", ["x"])]
    twice = spark.createDataFrame([("",), ("a",), ("a",)], "k string")
    assert rows(keep_one(twice, ["k"])) == [("",), ("a",)]
    assert rows(first_seen(twice.withColumn("n", F.lit(1)), "k", "n")) == [("a", 1)]


@pytest.mark.parametrize("most_bytes", [64 << 20, -1])
def test_stored_rows_are_kept_as_by_keep_one(spark, monkeypatch, most_bytes):
    monkeypatch.setattr("larder.operators.dedupe.BROADCAST_BYTES", most_bytes)
    unique = [("u", 1, "x", ["a", None]), ("v", None, None, None)]
    equal = [("e", 2, "y", []), ("e", 2, "y", []), ("f", None, None, [None]), ("f", None, None, [None])]
    # Where nulls are tells these rows apart, and where an element ends.
    differing = [(None, 1, None, ["a"]), (None, None, "a", ["a"]), ("k", 3, "z", ["ab", "c"]), ("k", 3, "z", ["a", "bc"]), ("n", 1, "s", None), ("n", 1, "s", []), ("n", 1, "s", [None])]
    for data in (unique, unique + equal, unique + equal + differing, differing, []):
        df = spark.createDataFrame(data, "k string, n int, s string, a array<string>").repartition(3)
        kept = keep_one_stored(df, "k")
        assert kept.columns == df.columns and sorted(map(repr, rows(kept))) == sorted(map(repr, rows(keep_one(df, ["k"]))))
    assert rows(keep_one_stored(spark.createDataFrame([("",), ("a",), ("a",), (None,)], "k string"), "k")) == [(None,), ("",), ("a",)]


def test_counts_after_an_append_read_no_texts(spark, tmp_path):
    raw = write_raw(tmp_path / "raw")
    for _ in range(2):
        ingest.ingest(spark, raw, str(tmp_path / "staging"), "append")
    counts = assemble(read_staging(spark, str(tmp_path / "staging"))).agg(F.count("*"), F.count("image_url"), F.count("mit_energy_kcal"))
    assert "instructions_text" not in counts._jdf.queryExecution().executedPlan().toString()
    assert rows(counts) == [(3, 2, 2)]


def test_spread_join_equals_plain_join_under_skew(spark):
    base = spark.range(3000).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") < 1000, "").when(F.col("id") < 1200, None).otherwise(F.concat(F.lit("t"), F.col("id") % 50)).alias("t"),
    )
    dim = spark.range(40).select(F.concat(F.lit("t"), F.col("id")).alias("d"), F.col("id").alias("v"))
    dim = dim.union(spark.createDataFrame([("", 99), (None, 77)], "d string, v bigint"))
    want = rows(left_join_on(base, dim, "t", "d"))
    assert len(want) == 3000
    for width in (2, 32, 500):
        hot = frequent_values(base, "t", width=width)
        assert rows(spread_left_join(base, dim, "t", "d", hot, ["id"])) == want
    assert rows(frequent_values(base, "t", width=28)) == [("", 10)]


def test_untitled_recipes(spark):
    frames = staging(spark)
    frames["layer1"] = frames["layer1"].withColumn("title_norm", F.lit(""))
    frames["nutrition"] = frames["nutrition"].withColumn("title_norm", F.lit(""))
    assert assemble(frames).filter("mit_energy_kcal = 214.0").count() == 3
    assert assemble(frames, drop_empty_keys=True).filter("mit_energy_kcal is not null").count() == 0


def test_reassembled_lists(spark):
    df = spark.createDataFrame([("p", 2, "c"), ("p", 0, "a"), ("p", 1, None), ("q", 0, "z")], "p string, i int, v string")
    assert rows(reassembled(df, "p", "i", "v", "l")) == [("p", ["a", None, "c"]), ("q", ["z"])]


def test_int_overflow_becomes_null(spark):
    frames = staging(spark)
    frames["kaggle"] = frames["kaggle"].withColumn("cook_minutes", F.lit(2147483648))
    bread = publish.enriched(assemble(frames)).filter("recipe_id = 'w01'").first()
    assert (bread.cook_minutes, bread.cook_time_category) == (None, "inconnu")


def test_stream_appends_each_file_once(spark, tmp_path):
    source, target, check = tmp_path / "in", str(tmp_path / "staged"), str(tmp_path / "check")
    source.mkdir()
    for i, row in enumerate(LAYER1):
        (source / f"{i}.json").write_text(json.dumps(row) + "\n")
        append_new_files(spark, "layer1", str(source), target, check)
        append_new_files(spark, "layer1", str(source), target, check)
    staged = read_table(spark, target)
    assert schemas.contract_gaps(staged, schemas.LAYER1) == []
    assert rows(staged.select("id")) == [("w01",), ("w02",), ("w03",)]
    with pytest.raises(ValueError):
        append_new_files(spark, "kaggle", str(source), target, check)


def test_batch_and_stream_appends_add_up(spark, tmp_path):
    source, target, check = tmp_path / "in", str(tmp_path / "staged"), str(tmp_path / "check")
    source.mkdir()

    def batch(row):
        raw = read_json_records(spark, _lines(tmp_path, [row]), schemas.RAW_LAYER1, "lines")
        write_staging(RESOURCES["layer1"].stage(raw), target, "append")

    batch(LAYER1[0])
    (source / "1.json").write_text(json.dumps(LAYER1[1]) + "\n")
    append_new_files(spark, "layer1", str(source), target, check)
    batch(LAYER1[2])
    assert rows(read_table(spark, target).select("id")) == sorted((r["id"],) for r in LAYER1)
    frames = staging(spark)
    frames["layer1"] = read_table(spark, target)
    assert assemble(frames).count() == len(LAYER1)


def _lines(folder, records):
    path = folder / f"lines-{len(list(folder.iterdir()))}.json"
    path.write_text("".join(json.dumps(r) + "\n" for r in records))
    return str(path)


def test_each_csv_file_is_read_by_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('name,id,minutes\n"pie, ""big""",1,10\n')
    (tmp_path / "b.csv").write_text("id,minutes,name\n2,20,cake\n")
    (tmp_path / "c d.csv").write_text("minutes,name\n30,soup\n")
    (tmp_path / "e.csv").write_text("")
    for multi_line in (True, False):
        found = read_csv_records(spark, str(tmp_path), schemas.RAW_KAGGLE, multi_line).select("name", "id", "minutes", "tags")
        assert rows(found) == sorted([('pie, "big"', "1", "10", None), ("cake", "2", "20", None), ("soup", None, "30", None)], key=repr)


def test_backslashes_are_text(spark):
    df = spark.createDataFrame([("a\\b",), ("a\\",), ("ab",)], "t string")
    assert rows(df.filter(holds_text("t", "\\"))) == [("a\\",), ("a\\b",)]
    assert rows(df.filter(holds_text("t", "a\\B"))) == [("a\\b",)]


def test_unknown_options(spark, tmp_path):
    with pytest.raises(ValueError):
        read_json_records(spark, "x", schemas.RAW_LAYER1, "other")
    with pytest.raises(KeyError):
        write_staging(spark.range(1), str(tmp_path / "x"), "merge")
    assert Catalog("r").index == "r/ingredients_index"
