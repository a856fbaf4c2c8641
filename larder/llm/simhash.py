"""Near-duplicate classes by 64-bit fingerprints of word shingles, compared exactly in tiles.

Two fingerprints within ``RADIUS`` = 3 bits agree on one of four 16-bit blocks, and of the other 48 bits on one of four
12-bit blocks. So each distinct fingerprint enters 16 buckets of 28 bits, and every linked pair meets in one of them.
A bucket's fingerprints, in the order of their bit counts, form tiles; tile pairs whose bit counts are further apart
than the radius are skipped, the others are compared by exclusive-or and bit counts, without a cap. A bucket over
``BUCKET`` fingerprints is split: its tiles are dealt to tasks as tile pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import fresh, quoted, with_arrow
from larder.llm.components import components
from larder.session import materialise

RADIUS = 3
SEED = 42
SHINGLE = 3
TILE = 256
BUCKET = 2048


def fingerprint(text: bytes) -> int:
    """The fingerprint as a signed 64-bit integer: 0 without words, one shingle if there are fewer than three words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    n = max(1, len(words) - SHINGLE + 1)
    spans = zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)
    raw = b"".join([xxhash.xxh64_digest(joined[s:e], SEED) for s, e in spans])
    bits = np.zeros(64, np.int64)
    for at in range(0, len(raw), 8 * 65_536):
        part = np.frombuffer(raw, np.uint8, min(len(raw) - at, 8 * 65_536), at).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > n).tobytes(), "big", signed=True)


def with_fingerprints(docs: DataFrame, text: str = "text", name: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint of the whole text as a long; a null text counts as empty."""
    return with_arrow(docs, name, text, "long", lambda texts: pa.array([fingerprint(t) for t in texts], pa.int64()))


def hex_digits(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def _bucket_keys(fp: Column) -> Column:
    """The 16 buckets of a fingerprint: which blocks, their 16 bits, their 12 bits."""
    keys = []
    for i in range(4):
        block = F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))
        low = fp.bitwiseAND(F.lit((1 << 16 * i) - 1))
        rest = low if i == 3 else low.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, 16 * (i + 1)), 16 * i))
        for j in range(4):
            part = F.shiftrightunsigned(rest, 12 * j).bitwiseAND(F.lit(0xFFF))
            keys.append(F.lit((4 * i + j) << 28).bitwiseOR(F.shiftleft(block, 12)).bitwiseOR(part))
    return F.array(*keys)


def _near(bucket: np.ndarray) -> np.ndarray:
    """Which of a bucket's fingerprints (ordered by bit count) are within the radius of each other, tile by tile."""
    n, counts = len(bucket), np.bitwise_count(bucket)
    near = np.zeros((n, n), bool)
    for i in range(0, n, TILE):
        for j in range(i, n, TILE):
            if int(counts[j]) - int(counts[min(i + TILE, n) - 1]) > RADIUS:
                break  # the tiles are ordered by bit count, so all later ones are as far
            a, b = bucket[i : i + TILE], bucket[j : j + TILE]
            near[i : i + TILE, j : j + TILE] = np.bitwise_count(a[:, None] ^ b[None, :]) <= RADIUS
    return near | near.T


def _forest(bucket: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links that connect the bucket's classes, one for each fingerprint but the first of a class."""
    near = _near(bucket)
    np.fill_diagonal(near, False)
    free = near.any(axis=1)
    for first in range(len(bucket)):
        if not free[first]:
            continue
        free[first] = False
        front = np.array([first])
        while len(front):
            front = np.flatnonzero(near[front].any(axis=0) & free)
            free[front] = False
            for other in front:
                yield int(bucket[first]), int(bucket[other])


def _links_in_buckets(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``key, fp`` in the order of key and bit count; a bucket may go on in the next batch."""
    keys, fps = np.empty(0, np.int64), np.empty(0, np.int64)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def found(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        cuts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
        sizes = np.diff(np.append(cuts, len(keys)))
        links = {
            link
            for at, n in zip(cuts[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True)
            for link in _forest(fps[at : at + n].view(np.uint64))
        }
        a, b = zip(*links, strict=True) if links else ((), ())
        values = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, b)]
        return pa.RecordBatch.from_arrays(values, schema=schema)

    for part in parts:
        keys = np.concatenate([keys, part.column(0).to_numpy(zero_copy_only=False)])
        fps = np.concatenate([fps, part.column(1).to_numpy(zero_copy_only=False)])
        if len(keys):
            whole = int(np.searchsorted(keys, keys[-1], "left"))
            yield found(keys[:whole], fps[:whole])
            keys, fps = keys[whole:], fps[whole:]
    yield found(keys, fps)


def _compared(rows: DataFrame) -> DataFrame:
    ordered = rows.repartition("key").sortWithinPartitions("key", F.bit_count("fp"), "fp")
    return ordered.select("key", "fp").mapInArrow(_links_in_buckets, "a long, b long")


def _tile_pairs(rows: DataFrame, tile: int) -> DataFrame:
    """Rows of large buckets, once for each tile pair they take part in; ``key`` then stands for the pair.

    A tile holds fingerprints of one bit count, told apart by a hash if there are more than ``tile``. Pairs of tiles
    whose bit counts are further apart than the radius are not made. The tables of tiles have no rows of fingerprints.
    """
    counted = rows.withColumn("bits", F.bit_count("fp"))
    tiles = counted.groupBy("key", "bits").agg(F.ceil(F.count("*") / tile).cast("int").alias("n"))
    each = tiles.select("key", "bits", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("salt"))
    other = each.select("key", F.col("bits").alias("bits2"), F.col("salt").alias("salt2"))
    ordered = F.expr("bits2 - bits BETWEEN 0 AND 3 AND (bits2 > bits OR salt2 >= salt)")
    pairs = each.join(other, "key").where(ordered)
    pairs = pairs.withColumn("pair", F.xxhash64("key", "bits", "salt", "bits2", "salt2"))
    sides = pairs.select("key", "bits", "salt", "pair").unionByName(
        pairs.select("key", F.col("bits2").alias("bits"), F.col("salt2").alias("salt"), "pair")
    )
    placed = counted.join(tiles, ["key", "bits"]).withColumn("salt", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
    return placed.join(sides.distinct(), ["key", "bits", "salt"]).select(F.col("pair").alias("key"), "fp")


def links(fingerprints: DataFrame, fp: str = "fp", bucket: int = BUCKET) -> DataFrame:
    """``a, b``: links that connect all fingerprints within the radius of each other, a forest of each bucket.

    Nulls are left out. The result has at most one link for each fingerprint and bucket, never all pairs.
    """
    distinct = materialise(fingerprints.where(F.col(fp).isNotNull()).select(F.col(fp).alias("fp")).distinct(), name="fps")
    rows = distinct.select(F.explode(_bucket_keys(F.col("fp"))).alias("key"), "fp")
    large = materialise(rows.groupBy("key").count().where(F.col("count") > bucket).select("key"), name="large-buckets")
    if large.isEmpty():
        return _compared(rows)
    dealt = _tile_pairs(rows.join(large, "key", "left_semi"), bucket // 2)
    return _compared(rows.join(large, "key", "left_anti")).unionByName(_compared(dealt.distinct()))


def _rooted(marked: DataFrame) -> DataFrame:
    """``fp, root, first``: each distinct fingerprint, its class, and the least key that has it."""
    first = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(first)).withColumnsRenamed({"node": "fp", "component": "root"})
    return first.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def clusters(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, fp, component_id`` for each row: the least key among all documents its fingerprint reaches.

    Null, empty and blank texts have the fingerprint 0 and are linked like any other. Rows with a null key keep it;
    if all keys of a class are null, so is its component. Repeated rows and equal keys all stay. An empty table gives
    an empty result. Only key and text are read; the texts go to Python once and are not shuffled.
    """
    marked = docs.select(F.col(quoted(key)).alias("doc_id"), F.col(quoted(text)).alias("text"))
    marked = materialise(with_fingerprints(marked).select("doc_id", "fp"), name="simhash")
    rooted = _rooted(marked)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return marked.join(rooted.select("fp", "root").join(least, "root"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of ``docs`` for each class of near duplicates: the one with the least key.

    A class all of whose keys are null keeps one row too. Columns, also such as ``fp``, stay as they are. Of rows that
    share both key and fingerprint, any one stays.
    """
    fp, least = fresh(docs, "fp", "least_key")
    marked = materialise(with_fingerprints(docs, text, fp), name="simhash")
    rooted = _rooted(marked.select(F.col(quoted(key)).alias("doc_id"), F.col(fp).alias("fp")))
    # Nulls come last, so a class with any key has one in its row here.
    best = F.min(F.struct(F.col("first").isNull().alias("unknown"), "first", "fp")).alias("best")
    kept = rooted.groupBy("root").agg(best).select(F.col("best.first").alias(least), F.col("best.fp").alias("kept_fp"))
    same = (marked[fp] == kept["kept_fp"]) & marked[key].eqNullSafe(kept[least])
    return marked.join(kept, same, "left_semi").dropDuplicates([key, fp]).drop(fp)
