"""How much of each text also stands in other rows, told by strings of whole words. DataFrame joins on picked strings.

Of the strings of ``WORDS`` words that lie in a window of ``WINDOW`` words, the one of least hash is picked. So any passage of
WINDOW words that two texts share has a picked string of both, while only about one string in ten is counted.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import slices, texts_of
from larder.session import materialise, remove, scratch

WORDS = 32
WINDOW = 50
_MIX = np.uint64(0x9E3779B97F4A7C15)


def picked(text: bytes) -> np.ndarray:
    """The distinct hashes of the picked strings of a text; none if it has fewer than ``WINDOW`` words."""
    words = text.split()
    if len(words) < WINDOW:
        return np.empty(0, np.int64)
    own = (np.fromiter(map(zlib.crc32, words), np.uint64, len(words)) + np.uint64(1)) * _MIX
    n = len(words) - WORDS + 1
    total, width, done = np.zeros(n, np.uint64), 1, 0
    while done < WORDS:
        if WORDS & width:
            total = (total ^ (total >> np.uint64(31))) * _MIX + own[done : done + n]
            done += width
        if done < WORDS:
            own = own[:-width] * _MIX + own[width:]
            own ^= own >> np.uint64(29)
            width *= 2
    total = total * _MIX
    least = np.lib.stride_tricks.sliding_window_view(total, WINDOW - WORDS + 1).min(axis=1)
    return np.unique(least).view(np.int64)


def _picked_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a text and its hash to the hashes of its picked strings."""
    for part in parts:
        for some in slices(part):
            found = [picked(t) for t in texts_of(some.column(0))]
            texts = np.repeat(some.column(1).to_numpy(), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *found])), pa.array(texts)], ["string", "x"])


def text_hash(text: Column) -> Column:
    return F.xxhash64(text).alias("x")


def shared_strings(texts: DataFrame) -> DataFrame:
    """``x, n_shared``: for each distinct text of rows ``t`` with any, how many of its picked strings stand in another row too.

    A text is known by its ``text_hash``. Strings are counted in each task before they meet; rows with equal texts share
    all their strings.
    """
    spark, path = texts.sparkSession, scratch(texts.sparkSession, "picked")
    rows = materialise(texts.select("t", text_hash(F.col("t"))).mapInArrow(_picked_rows, "string long, x long"), path)
    again = rows.groupBy("string").count().where("count > 1").select("string")
    shared = rows.join(again, "string", "left_semi").distinct().groupBy("x").agg(F.count("*").alias("n_shared"))
    shared = materialise(shared, name="shared-strings")
    remove(spark, path)
    return shared
