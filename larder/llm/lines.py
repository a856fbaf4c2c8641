"""Removal of lines that many documents hold, by probing a sharded minimal perfect hash.

1. Each document's long enough line keys, as 128-bit hashes and once a document, are counted; hashes that occur in
   ``least`` documents are dealt to shards of about ``SHARD`` by their high bits.
2. A task makes each shard's minimal perfect hash, and arrays in its order: the hash's low 64 bits as a fingerprint, the
   number of documents, and the last document, which keeps its lines.
3. Documents probe the arrays; their lines are not joined. Up to ``RESIDENT`` bytes of arrays, each worker reads the shards
   from the shared folder once. A larger index is probed in parts: the documents' hashes are dealt to the parts at random
   within a part, so a frequent line is many tasks' work, and each task reads the shards of its part only.

A line is mistaken for another one if 128 bits agree: high bits and place are the shard's, the low 64 the fingerprint.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import fresh, quoted, slices, texts_of
from larder.llm.line_index import PerfectHash
from larder.llm.token_files import shared_uri
from larder.session import materialise

# What a line's key is stripped of at both ends.
BLANKS = b" \t\n\x0b\x0c\r"
CHARACTERS = 20
LEAST = 3
SHARD = 50_000
RESIDENT = 256 << 20
# Bytes that a key takes in the arrays: fingerprint, count, last document, and its bits.
KEY_BYTES = 21
# Tasks that share a part of a large index.
SPREAD = 64

SHARDS = "shard int, sizes array<bigint>, bits binary, fingerprints binary, counts binary, last binary"


def key_of(line: bytes) -> bytes:
    return line.strip(BLANKS).lower()


def _long(key: bytes, characters: int) -> bool:
    if len(key) < characters or key.isascii():
        return len(key) >= characters
    # Bytes that go on with a character start none.
    return int(np.count_nonzero((np.frombuffer(key, np.uint8) & 0xC0) != 0x80)) >= characters


def hashed(text: bytes, characters: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The lines of a text, which of them have a key of so many characters, and these keys' hashes as high and low bits."""
    lines = text.split(b"\n")
    keys = [key_of(line) for line in lines]
    at = [i for i, k in enumerate(keys) if _long(k, characters)]
    digests = np.frombuffer(b"".join([xxhash.xxh3_128_digest(keys[i]) for i in at]), np.uint64).reshape(-1, 2)
    return lines, np.array(at, np.int64), digests


def _line_rows(characters: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of a text and other columns to the hashes of each row's distinct long keys, with the other columns."""

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for some in slices(part):
                found = [np.unique(hashed(t, characters)[2], axis=0) for t in texts_of(some.column(0))]
                rows = np.concatenate([np.empty((0, 2), np.uint64), *found]).view(np.int64)
                at = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]).astype(np.int64))
                others = [column.take(at) for column in some.columns[1:]]
                yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1]), *others], ["high", "low", *part.schema.names[1:]])

    return task


def repeated_lines(docs: DataFrame, least: int = LEAST, characters: int = CHARACTERS) -> DataFrame:
    """``high, low, n, last``: hashes of the line keys of rows ``t, k`` in so many documents, and the last of these ``k``.

    Equal keys are one document. Counts are combined before each shuffle, and a line that very many documents hold is
    made distinct by line and document, then counted by task.
    """
    rows = docs.select("t", "k").mapInArrow(_line_rows(characters), "high long, low long, k long").distinct()
    counted = rows.groupBy("high", "low").agg(F.count("*").alias("n"), F.max("k").alias("last"))
    return counted.where(F.col("n") >= least)


def _shard_of(high: Column, shards: int) -> Column:
    return (F.shiftrightunsigned(high, 32) % shards).cast("int")


def _shards(high: np.ndarray, shards: int) -> np.ndarray:
    return ((high >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def _built(table: pa.Table) -> pa.Table:
    """One shard's arrays, from its rows of ``high, low, n, last``."""
    high, low, n, last = (table.column(c).to_numpy() for c in ("high", "low", "n", "last"))
    high, low = high.view(np.uint64), low.view(np.uint64)
    index = PerfectHash.of(high, low)
    order = np.argsort(index.numbers(high, low))
    sizes, bits = index.packed()
    counts = np.minimum(n[order], (1 << 32) - 1).astype(np.uint32)
    columns = [[table.column("shard")[0].as_py()], [sizes], [bits], [low[order].tobytes()], [counts.tobytes()], [last[order].tobytes()]]
    types = [pa.int32(), pa.list_(pa.int64()), *[pa.binary()] * 4]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[f.split()[0] for f in SHARDS.split(", ")])


def build(found: DataFrame, path: str, shard: int = SHARD, resident: int = RESIDENT) -> tuple[int, int]:
    """Write the shards of the rows ``high, low, n, last`` below ``path``; returns the numbers of shards and of parts.

    The number of rows alone goes to the driver. A shard is one task's work and bounded, as hashes are even.
    """
    found = materialise(found, f"{path}/lines")
    n = found.count()
    shards = max(1, -(-n // shard))
    parts = max(1, -(-n * KEY_BYTES // resident))
    made = found.withColumn("shard", _shard_of(F.col("high"), shards)).groupBy("shard").applyInArrow(_built, SHARDS)
    made.withColumn("part", F.col("shard") % parts).write.partitionBy("part").parquet(f"{path}/shards")
    return shards, parts


class Index:
    """The shards of some parts, read from the shared folder."""

    def __init__(self, path: str, part: int):
        self.shards: dict[int, tuple] = {}
        store, root = fs.FileSystem.from_uri(f"{path}/shards/part={part}")
        for file in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if file.path.endswith(".parquet"):
                with store.open_input_file(file.path) as source:
                    for r in pq.read_table(source).to_pylist():
                        arrays = (np.frombuffer(r[c], t) for c, t in (("fingerprints", np.uint64), ("counts", np.uint32), ("last", np.int64)))
                        self.shards[r["shard"]] = (PerfectHash.unpacked(r["sizes"], r["bits"]), *arrays)

    def probe(self, shards: int, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and last document of each hash; a count of 0 for one that the index does not have."""
        shard = _shards(high, shards)
        count, last = np.zeros(len(high), np.int64), np.zeros(len(high), np.int64)
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.append(True, np.diff(shard[order]) != 0)) if len(order) else []
        for own in np.split(order, cuts[1:]) if len(order) else []:
            held = self.shards.get(int(shard[own[0]]))
            if held is not None:
                index, fingerprints, counts, lasts = held
                number = index.numbers(high[own], low[own])
                known = (number >= 0) & (fingerprints[number] == low[own])
                count[own[known]], last[own[known]] = counts[number[known]], lasts[number[known]]
        return count, last


_held: dict[tuple[str, int], Index] = {}


def _index(path: str, part: int) -> Index:
    """A worker keeps the index that it used last."""
    if (path, part) not in _held:
        _held.clear()
        _held[path, part] = Index(path, part)
    return _held[path, part]


def _loses(path: str, part: int, shards: int, rows: np.ndarray, keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which hashes are in the index, with a last document that is not the one whose number is in ``keys``."""
    count, last = _index(path, part).probe(shards, rows[:, 0], rows[:, 1])
    return (count > 0) & ~(known & (last == keys))


def _numbers(keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return keys.fill_null(0).to_numpy(zero_copy_only=False), keys.is_valid().to_numpy(zero_copy_only=False)


CLEANED = pa.struct([("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept", pa.binary())])


CLEANED_SQL = "struct<n_lines: bigint, n_dropped: bigint, kept: binary>"


def _cleaned(lines: list[bytes], gone: np.ndarray) -> tuple[int, int, bytes]:
    if not len(gone):
        return len(lines), 0, b"\n".join(lines)
    lost = set(gone.tolist())
    return len(lines), len(lost), b"\n".join([line for i, line in enumerate(lines) if i not in lost])


def _struct(rows: list[tuple[int, int, bytes]]) -> pa.Array:
    columns = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, CLEANED, strict=True)], fields=list(CLEANED))


def _cleaned_texts(texts: list[bytes], characters: int, lost: Callable[[np.ndarray, list[int]], np.ndarray]) -> pa.Array:
    """The texts without the lines whose hashes ``lost`` tells, which it is asked for all texts at once."""
    found = [hashed(t, characters) for t in texts]
    sizes = [len(at) for _, at, _ in found]
    gone = lost(np.concatenate([np.empty((0, 2), np.uint64), *[d for _, _, d in found]]), sizes)
    each = np.split(gone, np.cumsum(sizes)[:-1]) if sizes else []
    return _struct([_cleaned(lines, at[own]) for (lines, at, _), own in zip(found, each, strict=True)])


def _near(path: str, shards: int, characters: int) -> Callable[..., Column]:
    """The cleaned text of rows ``t, k``, by a whole index in each worker."""

    def batches(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, keys in parts:
            done = [_struct([])]
            for some, own in zip(slices(texts), slices(keys), strict=True):
                known = _numbers(own)
                lost = lambda rows, sizes: _loses(path, 0, shards, rows, *(np.repeat(x, sizes) for x in known))  # noqa: B023, E731
                done.append(_cleaned_texts(texts_of(some), characters, lost))
            yield pa.concat_arrays(done)

    batches.__annotations__ = {"parts": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(batches, CLEANED_SQL).asNondeterministic()


def _listed(characters: int) -> Callable[..., Column]:
    """The cleaned text of rows ``t, lost``, by the hashes that each row loses."""

    def batches(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in parts:
            done = [_struct([])]
            for some, own in zip(slices(texts), slices(lists), strict=True):
                gone = [{(r["high"], r["low"]) for r in row or ()} for row in own.to_pylist()]

                def lost(rows: np.ndarray, sizes: list[int], gone: list[set] = gone) -> np.ndarray:
                    row = np.repeat(np.arange(len(sizes)), sizes).tolist()
                    pairs = zip(*(rows[:, c].view(np.int64).tolist() for c in (0, 1)), strict=True)
                    return np.array([p in gone[i] for i, p in zip(row, pairs, strict=True)], bool)

                done.append(_cleaned_texts(texts_of(some), characters, lost))
            yield pa.concat_arrays(done)

    batches.__annotations__ = {"parts": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(batches, CLEANED_SQL).asNondeterministic()


def _lost_by_text(rows: DataFrame, path: str, shards: int, parts: int, characters: int) -> DataFrame:
    """``k, x, lost``: the hashes that the distinct texts of rows ``t, k, x`` lose, by an index in parts."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, lost = batch.column("part").to_numpy(), np.zeros(batch.num_rows, bool)
            hashes = np.stack([batch.column(c).to_numpy().view(np.uint64) for c in ("high", "low")], axis=1)
            known = _numbers(batch.column("k"))
            for p in np.unique(part).tolist():
                own = part == p
                lost[own] = _loses(path, p, shards, hashes[own], *(x[own] for x in known))
            yield batch.filter(pa.array(lost))

    hashes = rows.mapInArrow(_line_rows(characters), "high long, low long, k long, x long").distinct()
    hashes = hashes.withColumn("part", _shard_of(F.col("high"), shards) % parts)
    # A part's rows go to tasks by text, so that a frequent line is the work of many.
    dealt = hashes.repartition("part", F.pmod("x", F.lit(SPREAD))).sortWithinPartitions("part")
    lost = dealt.mapInArrow(task, "high long, low long, k long, x long, part int")
    return lost.groupBy("k", "x").agg(F.collect_list(F.struct("high", "low")).alias("lost"))  # one text's lines


def without_repeated_lines(
    docs: DataFrame, text: str = "text", key: str = "doc_id", least: int = LEAST, characters: int = CHARACTERS, resident: int = RESIDENT
) -> DataFrame:
    """``docs`` with ``text`` less the lines that ``least`` documents hold, and with ``n_lines`` (before) and ``n_dropped``.

    A line's key is the line without blanks at its ends, A-Z lower-cased; keys of fewer ``characters`` (code points) are
    left alone. The document with the greatest ``key`` (a number) that holds a key of a line keeps all its lines of that
    key, all others lose them. A null or empty text is one empty line and becomes an empty text. Documents are told apart
    by ``key``: rows that share it are one document and fare alike, null keys are one document before all others. Other
    columns stay, but for ones named ``n_lines`` or ``n_dropped``, which are replaced. An empty table gives an empty
    result. Memory is ``resident`` bytes of arrays and a slice of texts in a worker.
    """
    k, t, x, lost, done = fresh(docs, "k", "t", "x", "lost", "done")
    spark = docs.sparkSession
    own = docs.withColumns({k: F.col(quoted(key)).cast("long"), t: F.coalesce(F.col(quoted(text)).cast("string"), F.lit(""))})
    own = own.withColumn(x, F.xxhash64(t))
    rows = own.select(F.col(t).alias("t"), F.col(k).alias("k"), F.col(x).alias("x"))
    path = shared_uri(spark, "line-index")
    shards, parts = build(repeated_lines(rows, least, characters), path, resident=resident)
    if parts == 1:
        own = own.withColumn(done, _near(path, shards, characters)(t, k))
    else:
        found = materialise(_lost_by_text(rows, path, shards, parts, characters), name="lost-lines")
        found = found.select(F.col("k").alias("k2"), F.col("x").alias("x2"), F.col("lost").alias(lost))
        own = own.join(found, own[k].eqNullSafe(found["k2"]) & (own[x] == found["x2"]), "left")
        own = own.withColumn(done, _listed(characters)(t, lost))
    own = own.withColumns({"n_lines": F.col(f"{done}.n_lines"), "n_dropped": F.col(f"{done}.n_dropped")})
    kept = F.col(f"{done}.kept").cast("string")
    return own.select(*[kept.alias(c) if c == text else quoted(c) for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")], "n_lines", "n_dropped")


def report(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of ``without_repeated_lines``, for each row of ``docs``."""
    rows = docs.select(F.col(quoted(key)).alias("doc_id"), F.col(quoted(text)).alias("text"))
    return without_repeated_lines(rows).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH numbered AS (
    SELECT row_number() OVER () AS r, doc_id, text FROM documents
), split AS (
    SELECT r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
    FROM numbered
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM split
), often AS (
    SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), judged AS (
    SELECT keyed.*, often.k IS NOT NULL AND doc_id <> last AS gone FROM keyed LEFT JOIN often USING (k)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r
"""
