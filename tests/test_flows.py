"""The raw files that the compositions run from."""

from __future__ import annotations

from pathlib import Path

from larder.plans import ingest
from larder.workload import flows


def test_raw_files_are_compressed_and_read_whole(spark, tmp_path):
    tables = {
        "documents": ([(i, f"word {i}\nline", "en", "s1") for i in range(30)], "doc_id long, text string, lang string, source string"),
        "pages": ([(i, f"http://a/{i}") for i in range(20)], "page_id long, url string"),
        "events": ([(i, i % 3, 1.5) for i in range(10)], "event_id long, user_id long, value double"),
        "customer": ([(i, f'c "{i}"', i % 5, "M", -1.0 * i) for i in range(25)], "c_custkey long, c_name string, c_nationkey long, c_mktsegment string, c_acctbal double"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    root = flows._write_raw(spark, str(tmp_path))
    parts = [p for p in Path(root).rglob("part-*")]
    assert parts and all(p.suffix == ".gz" for p in parts)
    counts = {name: ingest.scan(spark, root, name, "lines").count() for name in ingest.RESOURCES}
    assert counts == {"layer1": 30, "layer2": 20, "det_ingrs": 30, "nutrition": 10, "kaggle": 25}
