"""Substring search by three-character grams: rows that cannot hold the text are left out before any text is read."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators.filters import holds_text
from larder.session import materialise, remove, scratch
from larder.sources.tables import TEXT_BYTES, planned_bytes, sink_width, write_clustered

SIZE = 3
# Rows of a cell, about; grams of a pattern that are looked up, the rarest ones.
CELL = 4096
LOOKED_UP = 4
# Rows that are Python objects at a time.
SLICE = 1000


@dataclass(frozen=True)
class GramIndex:
    """One row for each (gram, cell): how many rows of the cell have the gram, and their keys. A cell is a part of the keys
    by their hash, the same for all grams."""

    grams: DataFrame
    key: str
    column: str


def distinct_grams(text: bytes) -> np.ndarray:
    """The distinct grams of a text as sorted numbers of three times 21 bits."""
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.int64)
    return np.unique(points[:-2] << 42 | points[1:-1] << 21 | points[2:])


def _gram(number: int) -> str:
    return "".join(chr(number >> at & 0x1FFFFF) for at in (42, 21, 0))


def _grams_of_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each gram of a cell: how many of its rows have it, and their keys in order."""
    rows = pa.Table.from_batches(batches)
    rows = rows.take(pc.sort_indices(rows.column("k"))).combine_chunks()
    keys, grams, holders = rows.column("k").combine_chunks(), [np.empty(0, np.int64)], [np.empty(0, np.int32)]
    for i in range(0, rows.num_rows, SLICE):
        for j, text in enumerate(rows.column("text").slice(i, SLICE).to_pylist(), i):
            own = distinct_grams(text or b"")
            grams.append(own)
            holders.append(np.full(len(own), j, np.int32))
    found, owner = np.concatenate(grams), np.concatenate(holders)
    order = np.argsort(found, kind="stable")
    found, owner = found[order], owner[order]
    cuts = np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(found) else np.empty(0, np.int64)
    ends = np.append(cuts, len(found))
    cell = rows.column("cell")[0].as_py()
    for at in range(0, len(cuts), SLICE):
        some = ends[at : at + SLICE + 1]
        lists = pa.ListArray.from_arrays(pa.array((some - some[0]).astype(np.int32)), keys.take(pa.array(owner[some[0] : some[-1]])))
        names = [_gram(g) for g in found[some[:-1]].tolist()]
        columns = [pa.array(names, pa.string()), pa.array([cell] * len(names), pa.int64()), pa.array(np.diff(some)), lists]
        yield pa.RecordBatch.from_arrays(columns, names=["gram", "cell", "n", "keys"])


def create_gram_index(df: DataFrame, path: str, key: str, column: str) -> GramIndex:
    """Index the lower-cased ``column`` of ``df``; ``key`` is unique. Null and shorter texts have no gram.

    Texts are shuffled once, by cell; their grams are counted where they then are, in time that grows with their length.
    The table is clustered by gram, so a search reads the files of its grams only. A gram of every row is as many rows as
    there are cells.
    """
    cells = max(1, -(-df.count() // CELL))
    texts = df.where(F.col(key).isNotNull()).select(
        F.pmod(F.xxhash64(key), F.lit(cells)).alias("cell"), F.col(key).alias("k"), F.lower(column).cast("binary").alias("text")
    )
    # Texts are smaller than what they become, so more tasks than their bytes suggest; a given number is not merged.
    width = sink_width(planned_bytes(df), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), TEXT_BYTES)
    made = texts.repartition(width, "cell").groupBy("cell").applyInArrow(_grams_of_cell, f"gram string, cell bigint, n bigint, keys array<{dict(df.dtypes)[key]}>")
    # The bounds of the ranges come from a pass of their own, which reads this copy.
    copy = scratch(df.sparkSession, "held-grams")
    held = materialise(made, copy)
    write_clustered(held, path, ["gram", "cell"])
    remove(df.sparkSession, copy)
    return open_gram_index(df.sparkSession, path, key, dict(df.dtypes)[key], column)


def open_gram_index(spark: SparkSession, path: str, key: str, key_type: str, column: str) -> GramIndex:
    schema = f"gram string, cell bigint, n bigint, keys array<{key_type}>"
    return GramIndex(spark.read.schema(schema).parquet(path), key, column)


def pattern_grams(spark: SparkSession, query: str) -> list[str]:
    """The grams that a text must have to match ``query`` with its wildcards; none if no three characters stand together."""
    # The same function makes the text's letters small, so odd letters agree; a literal is folded, no job runs.
    lower = spark.sql("SELECT lower(q) AS q FROM VALUES (:q) AS t(q)", args={"q": f"%{query}%"}).first()["q"]
    pieces = re.split("[%_]", lower)
    return sorted({p[i : i + SIZE] for p in pieces for i in range(len(p) - SIZE + 1)})


def candidates(index: GramIndex, query: str, looked_up: int = LOOKED_UP) -> DataFrame | None:
    """Keys of the rows that have the rarest grams of ``query``; None if it has no gram and all rows are candidates.

    The numbers of the query's grams go to the driver. Key lists are intersected cell by cell.
    """
    wanted = pattern_grams(index.grams.sparkSession, query)
    if not wanted:
        return None
    found = index.grams.filter(F.col("gram").isin(wanted))
    sizes = {r["gram"]: r["n"] for r in found.groupBy("gram").agg(F.sum("n").alias("n")).collect()}
    if len(sizes) < len(wanted):
        return found.limit(0).select(F.explode("keys").alias(index.key))
    rare = sorted(wanted, key=lambda g: (sizes[g], g))[:looked_up]
    lists = index.grams.filter(F.col("gram").isin(rare)).groupBy("cell").agg(F.count("*").alias("m"), F.collect_list("keys").alias("lists"))
    both = F.aggregate(F.slice("lists", 2, len(rare)), F.col("lists")[0], F.array_intersect)
    return lists.filter(F.col("m") == len(rare)).select(F.explode(both).alias(index.key))


def holding(df: DataFrame, index: GramIndex, query: str) -> DataFrame:
    """The rows of ``df`` whose indexed column holds ``query``, as ``holds_text`` says: any case, ``%`` and ``_`` as wildcards.

    Every candidate's text is checked. Without three letters in a row this is a scan.
    """
    keys = candidates(index, query)
    found = df if keys is None else df.join(keys, index.key, "left_semi")
    return found.filter(holds_text(index.column, query))


def item_index(index: DataFrame, path: str | None = None, item: str = "ingredient") -> GramIndex:
    """The grams of the distinct items of an inverted index, which are far fewer than its rows."""
    return create_gram_index(index.select(item).distinct(), path or scratch(index.sparkSession, "item-grams"), item, item)


def items_holding(index: DataFrame, grams: GramIndex, query: str, item: str = "ingredient") -> DataFrame:
    """The rows of an inverted index whose item holds ``query``; the items that do are found first, from their grams alone."""
    keys = candidates(grams, query)
    if keys is None:
        return index.filter(holds_text(item, query))
    return index.join(keys.filter(holds_text(item, query)), item, "left_semi")
