"""Token-id files in seekable zstandard frames, so that a reader decompresses only the documents it wants.

A file is: data frames of ``frame_tokens`` little-endian unsigned 32-bit ids each (the last one shorter); one skippable
frame with the document index (8-byte count, then the arrays doc_id int64, known uint8, n_tokens int64); and the seek
table as the last frame: for every frame its compressed size, its content size and the low half of the XXH64 of its
content, then the number of frames, a descriptor byte and the closing magic number. Plain zstandard tools read the ids
of such a file as one stream.

Files hold ascending ranges of doc_id. Each task writes files under names of its own and returns their names as rows;
that manifest, itself a table in the shared folder, says which files count, so a retried or doubled task does no harm.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from larder.llm.common import decoded, give_back, groups, quoted, remembered, slices, takes_worker, texts_of
from larder.llm.token_counts import Splitter, byte_letters, chunks
from larder.session import materialise, scratch
from larder.sources.tables import planned_bytes, sink_width

# Fixed values of the seekable format.
INDEX_MAGIC, TABLE_MAGIC, CLOSING_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
WITH_CHECKSUMS = 0x80
IDS = np.dtype("<u4")
# Letters from here on are left to the library's own rules.
SIMPLE = "\u0250"
# Stands between chunks where many are looked up at once; no vocabulary has this id.
CHUNK_END = b"\xff" * 4
# Chunks and pre-tokens that a worker process remembers before it starts anew.
MOST_KNOWN = 400_000
# Bytes of texts that are split into chunks, all of them Python objects, at a time.
SPLIT_BYTES = 1_000_000
MANIFEST = "part int, file string, n_docs long, n_tokens long, n_bytes long"


def low_hash(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class FrameWriter:
    """Writes one file: ids go out frame by frame, the index and the seek table at the end."""

    def __init__(self, out: BinaryIO, frame_tokens: int):
        self.out, self.frame_bytes = out, frame_tokens * IDS.itemsize
        self.press, self.waiting, self.table = zstandard.ZstdCompressor(level=1), bytearray(), bytearray()
        self.docs: list[tuple[int, int, int]] = []
        self.frames = self.written = 0

    def _put(self, frame: bytes, content: bytes) -> None:
        self.out.write(frame)
        self.written += len(frame)
        self.table += struct.pack("<III", len(frame), len(content), low_hash(content))
        self.frames += 1

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id or 0, doc_id is not None, len(ids) // IDS.itemsize))
        self.waiting += ids
        while len(self.waiting) >= self.frame_bytes:
            self._flush(self.frame_bytes)

    def _flush(self, n: int) -> None:
        content = bytes(self.waiting[:n])
        del self.waiting[:n]
        self._put(self.press.compress(content), content)

    def close(self) -> None:
        if self.waiting:
            self._flush(len(self.waiting))
        ids, known, sizes = zip(*self.docs, strict=True) if self.docs else ((), (), ())
        index = struct.pack("<Q", len(ids)) + np.array(ids, "<i8").tobytes() + np.array(known, "u1").tobytes()
        index += np.array(sizes, "<i8").tobytes()
        self._put(struct.pack("<II", INDEX_MAGIC, len(index)) + index, b"")
        body = bytes(self.table) + struct.pack("<IBI", self.frames, WITH_CHECKSUMS, CLOSING_MAGIC)
        self.out.write(struct.pack("<II", TABLE_MAGIC, len(body)) + body)
        self.written += 8 + len(body)


class FrameReader:
    """Reads one file: the tables first, then only the frames that the wanted documents touch."""

    def __init__(self, source: BinaryIO):
        self.source = source
        size = source.seek(0, 2)
        frames, kind, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != CLOSING_MAGIC or kind != WITH_CHECKSUMS:
            raise ValueError("no seek table at the end of the file")
        rows = np.frombuffer(self._at(size - 9 - 12 * frames, 12 * frames), "<u4").reshape(-1, 3).astype(np.int64)
        self.sizes, self.hashes = rows[:, 0], rows[:, 2]
        self.places, self.starts = np.cumsum(rows[:, 0]) - rows[:, 0], np.cumsum(rows[:, 1]) - rows[:, 1]
        self.contents = rows[:, 1]
        raw = self._at(int(self.places[-1]), int(self.sizes[-1]))
        if low_hash(b"") != self.hashes[-1] or struct.unpack("<II", raw[:8]) != (INDEX_MAGIC, len(raw) - 8):
            raise ValueError("no document index before the seek table")
        n = struct.unpack("<Q", raw[8:16])[0]
        self.doc_ids = np.frombuffer(raw, "<i8", n, 16)
        self.known = np.frombuffer(raw, "u1", n, 16 + 8 * n).astype(bool)
        self.n_tokens = np.frombuffer(raw, "<i8", n, 16 + 9 * n)
        self.first = np.cumsum(self.n_tokens) - self.n_tokens
        self.open_frame, self.content = -1, b""
        self.unpack = zstandard.ZstdDecompressor()

    def _at(self, place: int, n: int) -> bytes:
        self.source.seek(place)
        return self.source.read(n)

    def _frame(self, k: int) -> bytes:
        if k != self.open_frame:
            raw = self._at(int(self.places[k]), int(self.sizes[k]))
            content = self.unpack.decompress(raw, max_output_size=int(self.contents[k]))
            if low_hash(content) != self.hashes[k]:
                raise ValueError(f"frame {k} is damaged")
            self.open_frame, self.content = k, content
        return self.content

    def document(self, i: int) -> bytes:
        """The ids of the file's i-th document as bytes."""
        at, left, out = int(self.first[i]) * IDS.itemsize, int(self.n_tokens[i]) * IDS.itemsize, []
        k = int(np.searchsorted(self.starts[:-1], at, "right")) - 1
        while left > 0:
            inner = at - int(self.starts[k])
            piece = self._frame(k)[inner : inner + left]
            out.append(piece)
            at, left, k = at + len(piece), left - len(piece), k + 1
        return b"".join(out)


class Encoder:
    """Texts to id bytes with the library. As no token spans white space, each distinct chunk is encoded once.

    Chunks of letters below ``SIMPLE``, where no rule depends on Unicode's version, go to the library's model by
    pre-tokens, and each distinct pre-token once; all others go through the whole library.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self.split = Splitter(json.load(file))
        self.library = Tokenizer.from_file(path)
        self.letters = str.maketrans(dict(enumerate(byte_letters())))
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        tokens = self.library.model.tokenize(word.encode().decode("latin-1").translate(self.letters))
        return struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])

    def _plain(self, some: list[str]) -> list[bytes]:
        """The ids of chunks, looked up by pre-token in one row of ids and cut at the chunks' ends."""
        flat = self.split.flat(some)
        known = remembered(self.words, set(flat) - {"\n"}, lambda new: map(self._word, new), MOST_KNOWN)
        known["\n"] = CHUNK_END
        row = b"".join(map(known.__getitem__, flat))
        ends = (np.flatnonzero(np.frombuffer(row, IDS) == np.frombuffer(CHUNK_END, IDS)) * IDS.itemsize).tolist()
        return [row[a:b] for a, b in zip([0, *(e + IDS.itemsize for e in ends)], ends)]  # noqa: B905

    def _learn(self, new: list[str]) -> list[bytes]:
        odd = {c for c in new if not (c.isascii() or max(c) < SIMPLE) or "<|" in c and self.split.has_special(c)}
        if not odd:
            return self._plain(new)
        whole = [c for c in new if c in odd]
        out: dict[str, bytes] = {}
        for i in range(0, len(whole), 10_000):
            found = self.library.encode_batch_fast(whole[i : i + 10_000], add_special_tokens=False)
            out.update((c, np.array(e.ids, IDS).tobytes()) for c, e in zip(whole[i : i + 10_000], found, strict=True))
        rest = [c for c in new if c not in odd]
        out.update(zip(rest, self._plain(rest), strict=True))
        return [out[c] for c in new]

    def __call__(self, texts: list[bytes]) -> Iterator[bytes]:
        split = [chunks(decoded(t)) for t in texts]
        known = remembered(self.chunks, set().union(*split), self._learn, MOST_KNOWN)
        for own in split:
            yield b"".join(map(known.__getitem__, own))


@lru_cache(maxsize=4)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def encoder(path: str) -> Encoder:
    """The encoder of a worker process, which keeps what it has learned while the process works on token files."""
    takes_worker("token_files", _encoder.cache_clear)
    return _encoder(path)


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int | None,
    text: str = "text",
    key: str = "doc_id",
    frame_tokens: int = 32_768,
) -> DataFrame:
    """Write the ids of every text in ascending ``key`` order below ``path``; returns the manifest (``MANIFEST``).

    Nulls: a text counts as empty (its document is the end id alone), a null key comes first. Documents with equal keys
    all stay, ordered by text. An empty table makes no file. One shuffle, by ranges of the key; rows with one repeated
    key are told apart by their text's hash, so no range is unbounded. A long document spans frames; memory is one
    batch of texts and one frame.
    """
    end = b"" if end_id is None else np.array([end_id], IDS).tobytes()

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = name = out = stream = None
        for rows in (some for part in parts for some in slices(part)):
            ids = iter(rows.column(0).to_pylist())
            for some in groups(texts_of(rows.column(1)), SPLIT_BYTES):
                if out is None:
                    store, root = fs.FileSystem.from_uri(path)
                    store.create_dir(root, recursive=True)
                    number = TaskContext.get().partitionId()
                    name = f"part-{number:06d}-{uuid.uuid4().hex}.zst"
                    stream = store.open_output_stream(f"{root}/{name}", compression=None)
                    out = FrameWriter(stream, frame_tokens)
                for encoded in encoder(tokenizer)(some):
                    out.add(next(ids), encoded + end)
        if out is not None:
            out.close()
            stream.close()
            n = sum(d[2] for d in out.docs)
            give_back()
            yield pa.RecordBatch.from_pydict(
                {"part": [number], "file": [name], "n_docs": [len(out.docs)], "n_tokens": [n], "n_bytes": [out.written]},
                schema=pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64())]),
            )

    k, t = F.col(quoted(key)).cast("long").alias("k"), F.col(quoted(text)).cast("string").alias("t")
    rows = docs.select(k, t)
    # Adaptive execution merges small ranges and splits none, so a large input needs its own width.
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width, order = sink_width(planned_bytes(rows), least), (F.col("k"), F.xxhash64("t"))
    rows = rows.repartitionByRange(width, *order) if width > least else rows.repartitionByRange(*order)
    rows = rows.sortWithinPartitions("k", "t")
    return materialise(rows.mapInArrow(task, MANIFEST), f"{path}/manifest")


def read(spark: SparkSession, path: str, wanted: list[int] | None = None, tokens: bool = True) -> DataFrame:
    """The documents of the files below ``path``: doc_id, start, n_tokens, ids_crc32 and, if asked for, tokens.

    ``start`` counts the ids of all documents before it. ``wanted`` limits the result to some doc_ids; only the frames
    that hold them are decompressed then. A damaged frame raises an error.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    # One row for each file, not for each document.
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("file", F.coalesce(before, F.lit(0)).alias("base"))
    chosen = None if wanted is None else np.array(sorted(wanted), np.int64)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", tokens array<long>" if tokens else "")
    types = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    arrow = pa.schema(types + ([("tokens", pa.list_(pa.int64()))] if tokens else []))

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A worker that wrote files needs its encoder no more.
        takes_worker("token_readers", lambda: None)
        store, root = fs.FileSystem.from_uri(path)
        for part in parts:
            for name, base in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                with store.open_input_file(f"{root}/{name}") as source:
                    file = FrameReader(source)
                    take = np.arange(len(file.doc_ids))
                    if chosen is not None:
                        take = take[file.known & np.isin(file.doc_ids, chosen)]
                    for some in np.array_split(take, max(1, -(-len(take) // 512))):
                        ids = [file.document(int(i)) for i in some]
                        columns = {
                            "doc_id": [int(file.doc_ids[i]) if file.known[i] else None for i in some],
                            "start": [base + int(file.first[i]) for i in some],
                            "n_tokens": [int(file.n_tokens[i]) for i in some],
                            "ids_crc32": [zlib.crc32(x) for x in ids],
                        }
                        if tokens:
                            columns["tokens"] = [np.frombuffer(x, IDS) for x in ids]
                        yield pa.RecordBatch.from_pydict(columns, schema=arrow)

    n = max(1, manifest.count())
    return files.repartition(n).mapInArrow(task, schema)


def shared_uri(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one as a URI, which Spark and the tasks' file systems both understand."""
    path = scratch(spark, name)
    return path if "://" in path else "file://" + path.removeprefix("file:")


def write_and_read(docs: DataFrame, tokenizer: str, end_id: int | None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Write the files to a new folder below the shared one and read them back, without the ids themselves.

    Nulls, empty and long texts, equal keys and repeated rows are as in ``write``; other columns are not read. An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    path = shared_uri(spark, "token-files")
    write(docs, path, tokenizer, end_id, text, key)
    return read(spark, path, tokens=False)
