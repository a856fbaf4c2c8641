"""Helpers shared by the operators: whole texts as Arrow batches, added columns, word splitting."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: what separates words in every contract of this package.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


# Rows of an Arrow batch that are Python objects at a time.
SLICE = 1000


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The UTF-8 bytes of each text; a null counts as the empty text."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def decoded(text: bytes) -> str:
    """The text of UTF-8 bytes; bytes that are none become replacement characters, as a column may hold anything."""
    return text.decode("utf-8", "replace")


def slices(part: pa.Array | pa.RecordBatch) -> Iterator[pa.Array | pa.RecordBatch]:
    """A batch in parts of ``SLICE`` rows, so that no more texts than these are Python objects at once."""
    for i in range(0, len(part) if isinstance(part, pa.Array) else part.num_rows, SLICE):
        yield part.slice(i, SLICE)


def with_arrow(df: DataFrame, name: str, text: str, returns: str, rows: Callable[[list[bytes]], pa.Array]) -> DataFrame:
    """``df`` with the column ``name`` computed from the whole texts by ``rows``; a column of that name is replaced.

    Only the text goes to Python, once; all other columns stay in the JVM.
    """

    def batches(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            for some in slices(part):
                yield rows(texts_of(some))
        give_back()

    # The signature is given, as annotations of local functions are strings here.
    batches.__annotations__ = {"parts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    # A deterministic function would be computed again for each filter that the optimizer derives from its result.
    once = F.arrow_udf(batches, returns).asNondeterministic()
    return df.withColumn(name, once(F.col(quoted(text)).cast("string")))


def groups(texts: list[bytes], size: int = 4_000_000) -> Iterator[list[bytes]]:
    """The texts in their order, in groups of about ``size`` bytes, so that work on a group fits in memory."""
    some: list[bytes] = []
    room = size
    for text in texts:
        some.append(text)
        room -= len(text)
        if room <= 0:
            yield some
            some, room = [], size
    if some:
        yield some


def quoted(name: str) -> str:
    """A column name that may hold dots or backticks."""
    return "`" + name.replace("`", "``") + "`"


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of ``df`` has, whatever its case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def n_bytes(text: str) -> Column:
    return F.coalesce(F.octet_length(F.col(quoted(text))), F.lit(0)).cast("long")


def remembered(cache: dict, keys: set, learn: Callable[[list], Iterable], most: int = 1_000_000) -> dict:
    """``cache`` holding at least ``keys``: unknown ones are learned together. Emptied first if it outgrew ``most``."""
    if len(cache) > most:
        cache.clear()
    new = list(keys.difference(cache))
    if new:
        cache.update(zip(new, learn(new), strict=True))
    return cache


# Only the C library of Linux has it; elsewhere memory goes back as the library sees fit.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None


def give_back() -> None:
    """Return the memory that a worker process has freed to the machine; the allocators would keep it for the process."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


_owner: list = ["", lambda: None]


def takes_worker(name: str, forget: Callable[[], object]) -> None:
    """An operator says so when it uses a worker process; what another one remembers there is forgotten then.

    The memory goes back to the machine, as idle workers keep what they hold beside the tasks of later stages.
    """
    if _owner[0] != name:
        _owner[1]()
        _owner[:] = [name, forget]
        gc.collect()
        give_back()
