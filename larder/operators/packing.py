"""Wide columns as one compressed value of each row, for rows that move and are sorted before their texts are read."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

CODEC, LEVEL = "zstd", 6
# JSON text has no control characters: one stands for what is between the elements of a list, which packs smaller.
BETWEEN, SIGN = b'","', b"\x1f"
# The length of the text comes before its compressed bytes, which do not hold it.
LENGTH_BYTES = 4
# Rows of an Arrow batch that are Python objects at a time.
SLICE = 1000
# What ``to_json`` wrote is read again whatever its length; anything else is an error.
JSON = {"mode": "FAILFAST", "maxStringLen": str(2**31 - 1)}


def _compressing(name: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec(CODEC, compression_level=LEVEL)

        def value(text: bytes) -> bytes:
            text = text.replace(BETWEEN, SIGN)
            return len(text).to_bytes(LENGTH_BYTES, "little") + codec.compress(text, asbytes=True)

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                texts = rows.column(name).cast(pa.binary()).to_pylist()
                yield rows.set_column(rows.schema.get_field_index(name), name, pa.array(map(value, texts), pa.binary()))

    return task


def _texts(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    codec = pa.Codec(CODEC)

    def text(value: bytes | None) -> bytes | None:
        if value is None:
            return None
        length, held = int.from_bytes(value[:LENGTH_BYTES], "little"), value[LENGTH_BYTES:]
        return codec.decompress(held, length, asbytes=True).replace(SIGN, BETWEEN)

    for part in parts:
        for at in range(0, len(part), SLICE):
            yield pa.array(map(text, part.slice(at, SLICE).to_pylist()), pa.binary()).cast(pa.string())


# The signature is given, as annotations are strings here.
_texts.__annotations__ = {"parts": Iterator[pa.Array], "return": Iterator[pa.Array]}


def packed(df: DataFrame, columns: Sequence[str], into: str) -> DataFrame:
    """``df`` with the columns as one binary column, a compressed JSON record; the last column."""
    others = [c for c in df.columns if c not in columns]
    rows = df.select(*others, F.to_json(F.struct(*columns)).alias(into))
    schema = StructType([*rows.schema.fields[:-1], StructField(into, BinaryType())])
    return rows.mapInArrow(_compressing(into), schema)


def unpacked(df: DataFrame, column: str, schema: StructType) -> DataFrame:
    """The columns that ``packed`` put into ``column``; null where the value is. The order of the rows stays."""
    others = [c for c in df.columns if c != column]
    text = F.arrow_udf(_texts, "string").asNondeterministic()(F.col(column))
    return df.withColumn(column, F.from_json(text, schema, JSON)).select(*others, f"{column}.*")
