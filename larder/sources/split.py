"""Records of one large file read by many tasks, where a record's end shows only to a reader of all that is before it.

A file is read in pieces that end at a byte that may end a record: ``}`` for an array of JSON objects, a line feed for CSV.
Whether it does depends on the quotes (and braces) before it. Each block of the file is scanned on its own and gives its
end state for both possible beginnings, inside or outside of quotes. A pass over the blocks, one row each, settles which
holds. A second scan, which knows that, cuts each block into records. Pieces are far smaller than records, so they are put
together again and looked through batch by batch where they are read; only the few records that a block's border cuts
are moved: they are a fragment on each side, put together by their order.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from larder.session import materialise

BLOCK = ("file", "block")
QUOTE, BACKSLASH, OPEN, CLOSE = b'"\\{}'


@dataclass(frozen=True)
class Format:
    """``end``: what ends a piece. ``braces``: whether records nest and quotes are escaped by backslashes."""

    end: str
    braces: bool


JSON = Format("}", True)
CSV = Format("\n", False)


def _pieces(spark: SparkSession, path: str | Sequence[str], kind: Format) -> DataFrame:
    """``file, block, value``: in a task, the pieces of a block follow each other in their order."""
    rows = spark.read.option("lineSep", kind.end).text(path)
    file = F.col("_metadata.file_path")
    # Pieces of JSON are as small as a word, so the file's name is not repeated with them.
    file = F.xxhash64(file) if kind.braces else file
    return rows.select(file.alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary"))


def _running(column: Column, *keys: str, order: Sequence[str]) -> Column:
    """The sum of a column over all rows before, within the keys."""
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(before), F.lit(0))


def _parts(batch: pa.RecordBatch, end: str) -> Iterator[tuple[pa.RecordBatch, bytes]]:
    """The rows of each block in a batch, and their text with all ends."""
    place = [pc.dictionary_encode(batch.column(c)).indices.to_numpy() for c in BLOCK]
    cuts = 1 + np.flatnonzero((np.diff(place[0]) != 0) | (np.diff(place[1]) != 0))
    for at, to in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        rows = batch.slice(at, to - at)
        pieces = rows.column("value").cast(pa.large_binary())
        whole = pa.LargeListArray.from_arrays(pa.array([0, len(pieces)], pa.int64()), pieces)
        yield rows, pc.binary_join(whole, pa.scalar(end.encode(), pa.large_binary()))[0].as_py() + end.encode()


def _signs(text: bytes, kind: Format) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places of quotes and of what may open or end a record, what is there, and whether the quotes up to it are odd."""
    row = np.frombuffer(text, np.uint8)
    quotes = row == QUOTE
    if kind.braces:
        slashes = np.flatnonzero(row == BACKSLASH)
        if len(slashes):
            # An odd run of backslashes escapes what follows it.
            first = slashes[np.append(True, np.diff(slashes) != 1)]
            last = slashes[np.append(np.diff(slashes) != 1, True)]
            quotes[last[(last - first) % 2 == 0] + 1] = False
        at = np.flatnonzero(quotes | (row == OPEN) | (row == CLOSE))
    else:
        at = np.flatnonzero(quotes | (row == ord(kind.end)))
    return at, row[at], np.cumsum(row[at] == QUOTE) % 2


def _net(what: np.ndarray) -> np.ndarray:
    return (what == OPEN).astype(np.int64) - (what == CLOSE)


def _ends(text: bytes, kind: Format, inside: int, depth: int) -> tuple[np.ndarray, int, int]:
    """Where records end in a text that begins ``inside`` quotes or not and so many braces deep, and the same for its end."""
    at, what, odd = _signs(text, kind)
    free = (odd + inside) % 2 == 0
    then = int((inside + (what == QUOTE).sum()) % 2)
    at, what = at[free & (what != QUOTE)], what[free & (what != QUOTE)]
    if not kind.braces:
        return at, then, depth
    deep = depth + np.cumsum(_net(what))
    return at[(what == CLOSE) & (deep == 0)], then, int(deep[-1]) if len(deep) else depth


def _scanner(kind: Format) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of ``blocks``: quotes of a block, and braces opened less those closed if it begins outside or inside quotes."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, found = None, [0, 0, 0, b""]

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({n: [v] for n, v in zip([*BLOCK, "quotes", "net0", "net1", "first"], [*own, *found], strict=True)})

        for batch in batches:
            if not batch.num_rows:
                continue
            for rows, text in _parts(batch, kind.end):
                place = [rows.column(c)[0].as_py() for c in BLOCK]
                if place != own:
                    if own is not None:
                        yield row()
                    # Headers are at the beginning of a file.
                    own, found = place, [0, 0, 0, b"" if place[1] or kind.braces else rows.column("value")[0].as_py()]
                _, what, odd = _signs(text, kind)
                sums = [int((what == QUOTE).sum()), 0, 0]
                if kind.braces:
                    # After an odd number of quotes the text is outside of them if it began inside.
                    flip = found[0] % 2
                    sums[1:] = [int(_net(what[(odd + flip) % 2 == s]).sum()) for s in (0, 1)]
                found = [*(a + b for a, b in zip(found[:3], sums, strict=True)), found[3]]
        if own is not None:
            yield row()

    return scan


def _cutter(kind: Format) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows ``file, block, number, closes, continued, text`` of the records and fragments of each block."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, inside, depth, number, continued, rest = None, 0, 0, 0, False, []

        def made(rows: list[tuple], places: pa.RecordBatch) -> pa.RecordBatch:
            names = [*BLOCK, "number", "closes", "continued", "text"]
            types = [*(places.schema.field(c).type for c in BLOCK), pa.int64(), pa.int32(), pa.bool_(), pa.binary()]
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        def left() -> list[tuple]:
            text = b"".join(rest)
            return [(*own, number, 0, continued and not number, text[:-1])] if text else []

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            out, last = [], batch
            for rows, text in _parts(batch, kind.end):
                place = [rows.column(c)[0].as_py() for c in BLOCK]
                if place != own:
                    out += left() if own is not None else []
                    inside, depth = (rows.column(c)[0].as_py() for c in ("begins", "depth"))
                    own, number, continued, rest = place, 0, inside == 1 or depth > 0, []
                ends, inside, depth = _ends(text, kind, inside, depth)
                start = 0
                for end in ends.tolist():
                    rest.append(text[start:end])
                    out.append((*own, number, 1, continued and not number, b"".join(rest)))
                    start, number, rest = end + 1, number + 1, []
                rest.append(text[start:])
            yield made(out, batch)
        if own is not None:
            yield made(left(), last)

    return cut


def _types(pieces: DataFrame) -> str:
    return ", ".join(f"{c} {dict(pieces.dtypes)[c]}" for c in BLOCK)


def blocks(pieces: DataFrame, kind: Format) -> DataFrame:
    """One row for each block: whether and how deep inside a record it begins, and its first piece if that may be a header.

    Each block is scanned for both beginnings at once; the order of the blocks then settles them.
    """
    whole = pieces.mapInArrow(_scanner(kind), f"{_types(pieces)}, quotes long, net0 long, net1 long, first binary")
    whole = whole.withColumn("begins", _running(F.col("quotes"), "file", order=["block"]) % 2)
    settled = F.when(F.col("begins") == 0, F.col("net0")).otherwise(F.col("net1"))
    whole = whole.withColumn("depth", _running(settled, "file", order=["block"]))
    return whole.select(*BLOCK, "begins", "depth", F.col("first").cast("string"))


def records(pieces: DataFrame, borders: DataFrame, kind: Format) -> DataFrame:
    """``file, block, number, closes, text``: all records, from the pieces and the ``blocks`` of their files.

    ``text`` is without what ends it; ``closes`` is 0 for what is left open at the end of a file. The borders, a row for
    each block, go to every task.
    """
    known = pieces.join(F.broadcast(borders.select(*BLOCK, "begins", "depth")), list(BLOCK))
    texts = known.mapInArrow(_cutter(kind), f"{_types(pieces)}, number long, closes int, continued boolean, text binary")
    texts = materialise(texts.withColumn("text", F.col("text").cast("string")), name="records")
    whole = texts.where("closes = 1 AND NOT continued")
    # Two fragments a block at most: the end of a record that began before, and one that goes on after.
    cut = texts.where("closes = 0 OR continued")
    chain = _running(F.when(F.col("continued"), 0).otherwise(1), "file", order=["block", "number"]) + F.when(F.col("continued"), 0).otherwise(1)
    joined = F.transform(F.array_sort(F.collect_list(F.struct("block", "number", "text"))), lambda p: p["text"])
    cut = cut.withColumn("chain", chain).groupBy("file", "chain").agg(
        F.min(F.struct("block", "number")).alias("place"), F.max("closes").alias("closes"), F.array_join(joined, kind.end).alias("text")
    )
    columns = ["file", "block", "number", "closes", "text"]
    return whole.select(*columns).unionByName(cut.select("file", "place.*", "closes", "text"))


def json_objects(spark: SparkSession, path: str | Sequence[str], schema: StructType) -> DataFrame:
    """One row per object of JSON arrays of objects in any formatting, parsed by as many tasks as the files have blocks.

    A file that ends inside an object, or with anything but array ends behind its last one, fails the job.
    """
    pieces = _pieces(spark, path, JSON)
    found = records(pieces, materialise(blocks(pieces, JSON), name="blocks"), JSON)
    text = F.regexp_replace("text", r"^[\s\[\],\ufeff]+", "")
    rows = found.select(F.when(F.col("closes") == 1, F.concat(text, F.lit("}"))).otherwise(text).alias("text")).where("text <> ''")
    return rows.select(F.from_json("text", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def csv_records(spark: SparkSession, path: str | Sequence[str], schema: StructType) -> DataFrame:
    """One row per record of CSV files, matched to ``schema`` (strings) by each file's header, its first line.

    Fields with quotes, commas or line breaks are in quotes, and quotes in them are doubled; fields out of quotes hold no quote.
    A column that the file or the row lacks is null. A file that ends inside quotes fails the job. Distinct headers go to the
    driver, not the files.
    """
    pieces = _pieces(spark, path, CSV)
    borders = materialise(blocks(pieces, CSV), name="blocks")
    heads = borders.where("block = 0").select("file", F.regexp_replace("first", "^\ufeff|\r$", "").alias("header"))
    cut = F.raise_error(F.concat(F.lit("the file ends inside quotes: "), F.col("file")))
    # A last line without a line feed is closed as any other.
    text = F.when(F.col("closes") == 1, F.regexp_replace("text", "\r$", "")).otherwise(cut.cast("string"))
    rows = records(pieces, borders, CSV).where("NOT (block = 0 AND number = 0)").select("file", text.alias("text"))
    rows = rows.where(F.trim("text") != "").join(heads, "file")

    def one(header: str) -> DataFrame:
        names = next(csv.reader([header]))
        kind = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))])
        parsed = rows.where(F.col("header") == header).select(F.from_csv("text", kind.simpleString()[7:-1].replace(":", " "), {"escape": '"'}).alias("r"))
        place = {name: i for i, name in reversed(list(enumerate(names)))}
        columns = (F.col(f"r.c{place[f.name]}") if f.name in place else F.lit(None).cast("string") for f in schema)
        return parsed.select(*(c.alias(f.name) for c, f in zip(columns, schema, strict=True)))

    headers = sorted(r["header"] for r in heads.select("header").distinct().collect() if r["header"])
    return reduce(DataFrame.unionByName, map(one, headers)) if headers else spark.createDataFrame([], schema)
