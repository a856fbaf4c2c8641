"""Removal of long repeated byte strings, within and across documents, by longest-previous-factor arrays.

A string of ``LENGTH`` bytes that starts at two places is a repeat. Suffix order over a whole corpus does not fit in one
place, so strings that can be equal are first brought together:

1. Each window of LENGTH bytes names the leftmost least hash among its runs of ``GRAM`` bytes, its anchor. Equal windows
   name equal anchors, and neighbouring windows mostly the same one, so a text has about one anchor in 140 bytes.
2. Only anchors that occur twice go on. The bytes of an anchor's consecutive windows are its context. Equal contexts are
   one context with a count, wherever they stand; all their windows repeat.
3. Different contexts of an anchor meet in one buffer. Their windows' suffix order and longest previous factors there show
   which windows have an equal one, or an earlier one. Windows of different anchors differ, so the answer is exact for the
   whole corpus.
4. An anchor with more than ``CONTEXTS`` different contexts is not brought together: its windows are counted by their
   128-bit hash, which is combined before the shuffle.

``keep="first"`` removes later copies and keeps the first, in the order of key, hash and place; ``keep="none"`` removes
every copy. Offsets are bytes of the UTF-8 text throughout; what is removed is decided on the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import quoted, texts_of
from larder.llm.passages import shared_strings, text_hash
from larder.llm.suffixes import SuffixRanks, longest_previous_factors
from larder.session import materialise, remove, scratch

LENGTH = 400
GRAM = 128
CONTEXTS = 2048
# Bytes that one suffix order is made of, unless one anchor has more.
BUFFER = 1_000_000
# Bytes of a text that are hashed at once.
PIECE = 1 << 18
PLACE_BITS = np.uint64(20)

_MIX, _BYTES = np.uint64(0x9E3779B97F4A7C15), np.random.default_rng(20).integers(0, 1 << 64, 256, np.uint64)


def _gram_hashes(text: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from each position, by doubling."""
    out, length = _BYTES[text], 1
    while length < GRAM:
        out = out[:-length] * _MIX + out[length:]
        out ^= out >> np.uint64(29)
        length *= 2
    return out * _MIX


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    length = 1
    while 2 * length <= width:
        values = np.minimum(values[:-length], values[length:])
        length *= 2
    rest = width - length
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``hash, first, last`` of each run of windows with one anchor, in the order of the text.

    A run that spans two pieces is two runs; piece borders depend on the place in the text, so such runs are joined.
    """
    hashes, places, first = [], [], []
    n = len(text) - LENGTH + 1
    for begin in range(0, max(n, 0), PIECE):
        part = np.frombuffer(text, np.uint8, min(PIECE + LENGTH - 1, len(text) - begin), begin)
        grams = _gram_hashes(part)
        # The hash's high bits decide, the place in the low bits settles ties for the leftmost.
        packed = (grams >> PLACE_BITS << PLACE_BITS) | np.arange(len(grams), dtype=np.uint64)
        at = (_sliding_least(packed, LENGTH - GRAM + 1) & np.uint64((1 << 20) - 1)).astype(np.int64)
        starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        hashes.append(grams[at[starts]].view(np.int64))
        places.append(at[starts] + begin)
        first.append(starts + begin)
    if not first:
        return (np.empty(0, np.int64),) * 3
    h, p, a = map(np.concatenate, (hashes, places, first))
    own = np.append(True, p[1:] != p[:-1])
    h, a = h[own], a[own]
    return h, a, np.append(a[1:], n) - 1


def _anchor_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's distinct anchors, and whether the text itself has one twice."""
    for part in parts:
        for i in range(0, part.num_rows, 512):
            some = part.slice(i, 512)
            found = [np.unique(anchors(t)[0], return_counts=True) for t in texts_of(some.column(2))]
            sizes = [len(h) for h, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([h for h, _ in found])),
                    *(pa.array(np.repeat(some.column(k).to_numpy(zero_copy_only=False), sizes)) for k in (0, 1)),
                    pa.array(np.concatenate([n > 1 for _, n in found])),
                ],
                ["anchor", "x", "y", "twice"],
            )


CONTEXT = pa.schema(
    [
        ("anchor", pa.int64()), ("c", pa.binary()), ("context", pa.binary()), ("d", pa.binary()), ("o", pa.int64()),
        ("starts", pa.list_(pa.int64())),
    ]
)


def _context_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``d, text, repeated anchors, o`` to the contexts of these anchors; equal ones of a text are one row."""
    for part in parts:
        for i in range(0, part.num_rows, 256):
            some, rows = part.slice(i, 256), []
            lists = (some.column(0).to_pylist(), texts_of(some.column(1)), *(some.column(k).to_pylist() for k in (2, 3)))
            for d, text, known, o in zip(*lists, strict=True):
                h, first, last = anchors(text)
                own: dict[tuple[int, bytes], list[int]] = {}
                for k in np.flatnonzero(np.isin(h, np.array(known, np.int64))).tolist():
                    own.setdefault((int(h[k]), text[first[k] : last[k] + LENGTH]), []).append(int(first[k]))
                rows += [(a, xxhash.xxh3_128_digest(c), c, d, o, starts) for (a, c), starts in own.items()]
            columns = zip(*rows, strict=True) if rows else ((),) * len(CONTEXT)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, CONTEXT, strict=True)], schema=CONTEXT)


SPANS = pa.schema([("anchor", pa.int64()), ("c", pa.binary()), ("spans", pa.list_(pa.int64()))])


def _spans(flags: np.ndarray) -> list[int]:
    """First and last place of each run of set flags, one after the other."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    edges[1::2] -= 1
    return edges.tolist()


def _repeated_windows(contexts: list[bytes], later: bool) -> list[list[int]]:
    """For each context the places of windows that have an equal one among all windows, or an earlier one if ``later``."""
    text = np.frombuffer(b"".join(contexts), np.uint8)
    sizes = np.array([len(c) for c in contexts])
    begins = np.cumsum(sizes) - sizes
    windows = sizes - LENGTH + 1
    starts = np.arange(windows.sum()) + np.repeat(begins - (np.cumsum(windows) - windows), windows)
    ranks = SuffixRanks(text, LENGTH)
    flags = np.zeros(len(text), bool)
    # A window that shares no rank has shorter factors than LENGTH, so the arrays are needed for the others only.
    shared = np.intersect1d(starts, ranks.shared, assume_unique=True)
    for order in (shared,) if later else (shared, -shared):
        flags[shared[longest_previous_factors(ranks, shared, order) >= LENGTH]] = True
    return [_spans(flags[b : b + w]) for b, w in zip(begins.tolist(), windows.tolist(), strict=True)]


def _comparison(later: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows ``anchor, c, context``, an anchor's in the order of time; anchors are brought together up to a buffer."""

    def settled(rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
        spans = _repeated_windows([r[2] for r in rows], later) if rows else []
        columns = ([r[0] for r in rows], [r[1] for r in rows], spans)
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, SPANS, strict=True)], schema=SPANS)

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[int, bytes, bytes]] = []
        size = 0
        for part in parts:
            for row in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                if size >= BUFFER and row[0] != waiting[-1][0]:
                    yield settled(waiting)
                    waiting, size = [], 0
                waiting.append(row)
                size += len(row[2])
        yield settled(waiting)

    return task


WINDOWS = pa.schema([("w", pa.binary()), ("anchor", pa.int64()), ("c", pa.binary()), ("at", pa.int32())])


def _window_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of the contexts of a large anchor, by its hash."""
    for part in parts:
        for anchor, c, context in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
            n = len(context) - LENGTH + 1
            hashes = [xxhash.xxh3_128_digest(context[i : i + LENGTH]) for i in range(n)]
            columns = (hashes, [anchor] * n, [c] * n, np.arange(n, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, WINDOWS, strict=True)], schema=WINDOWS)


def _counted_windows(large: DataFrame, later: bool) -> DataFrame:
    """``anchor, c, spans`` for anchors with very many contexts: windows whose hash occurs twice, or has been before."""
    rows = large.select("anchor", "c", "context").mapInArrow(_window_rows, "w binary, anchor long, c binary, at int")
    rows = materialise(rows, name="windows")
    if later:
        rows = rows.join(large.select("anchor", "c", "first"), ["anchor", "c"])
        rows = rows.withColumn("time", F.struct("first.o", "first.d", (F.col("first.start") + F.col("at")).alias("start")))
        least = rows.groupBy("w").agg(F.count("*").alias("n"), F.min("time").alias("least")).where("n > 1")
        rows = rows.join(least, "w").where("time > least")
    else:
        rows = rows.join(rows.groupBy("w").count().where("count > 1").select("w"), "w", "left_semi")
    at = rows.groupBy("anchor", "c").agg(F.collect_set("at").alias("at"))  # one context's windows
    return at.select("anchor", "c", F.flatten(F.transform("at", lambda i: F.array(i, i))).cast("array<long>").alias("spans"))


def _rest(text: bytes, windows: np.ndarray) -> tuple[int, int, bytes]:
    """Removed bytes, removed runs and the remaining text, for windows given as first and last starts."""
    change = np.zeros(len(text) + 1, np.int64)
    np.add.at(change, windows[:, 0], 1)
    np.add.at(change, windows[:, 1] + LENGTH, -1)
    gone = np.cumsum(change[:-1]) > 0
    runs = int(np.count_nonzero(np.diff(np.concatenate([[False], gone]).astype(np.int8)) == 1))
    return int(gone.sum()), runs, np.frombuffer(text, np.uint8)[~gone].tobytes()


KEPT = "d binary, n_removed long, n_spans long, kept binary"


def _kept_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``d, text, found`` to what is left of the text."""
    for part in parts:
        for i in range(0, part.num_rows, 256):
            some = part.slice(i, 256)
            ds, out = some.column(0).to_pylist(), []
            for text, found in zip(texts_of(some.column(1)), some.column(2).to_pylist(), strict=True):
                windows = [
                    (start + a, start + b)
                    for f in found
                    for starts, spans in ((f["starts"], f["spans"]), (f["again"], f["whole"]))
                    for start in starts
                    for a, b in zip(spans[::2], spans[1::2], strict=True)
                ]
                out.append(_rest(text, np.array(windows, np.int64).reshape(-1, 2)))
            removed, runs, kept = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ds, pa.binary()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())],
                ["d", "n_removed", "n_spans", "kept"],
            )


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _occurrences(texts: DataFrame) -> DataFrame:
    """``d, t, anchors, o``: distinct texts, those of their anchors that occur twice in all texts, and their least ``o``.

    A text is known by two independent 64-bit hashes here, so that its anchors and the text itself are dealt out alike.
    """
    marked = texts.select(F.xxhash64("t").alias("x"), F.xxhash64(F.lit(1), "t").alias("y"), "t", "o")
    copy = scratch(texts.sparkSession, "anchors")
    rows = materialise(marked.select("x", "y", "t").mapInArrow(_anchor_rows, "anchor long, x long, y long, twice boolean"), copy)
    # Copies of a text have its anchors too; they are settled by the text's count.
    least = rows.groupBy("anchor").agg(*(f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("x", "y")), F.max("twice").alias("twice"))
    again = least.where("twice OR min_x <> max_x OR min_y <> max_y").select("anchor")
    own = rows.join(again, "anchor", "left_semi").groupBy("x", "y").agg(F.collect_set("anchor").alias("anchors"))
    distinct = marked.groupBy("x", "y").agg(F.first("t").alias("t"), F.min("o").alias("o"))
    held = materialise(distinct.join(own, ["x", "y"]).select(_digest(F.col("t")).alias("d"), "t", "anchors", "o"), name="repeat-texts")
    remove(texts.sparkSession, copy)
    return held


def removals(texts: DataFrame, contexts: int = CONTEXTS, keep: str = "none") -> DataFrame:
    """``d, n_removed, n_spans, kept`` for each distinct text ``t`` (its SHA-256 ``d``) with a repeated window.

    ``texts`` has ``t`` and ``o``, the order in which first copies are told. ``kept`` is the rest after every byte that a
    repeat covers has gone.
    """
    later = {"none": False, "first": True}[keep]
    held = _occurrences(texts)
    columns = "anchor long, c binary, context binary, d binary, o long, starts array<long>"
    found = materialise(held.select("d", "t", "anchors", "o").mapInArrow(_context_rows, columns), name="contexts")
    first = F.min(F.struct("o", "d", F.col("starts")[0].alias("start"))).alias("first")
    each = found.groupBy("anchor", "c").agg(F.sum(F.size("starts")).alias("n"), F.first("context").alias("context"), *([first] if later else []))
    each = materialise(each, name="distinct-contexts")
    per_anchor = each.groupBy("anchor").agg(F.count("*").alias("m"), F.min("n").alias("least"))
    # Without a first copy to keep, contexts that occur twice need no comparison, unless others may equal parts of them.
    mixed = each.join(per_anchor if later else per_anchor.where("m > 1 AND least = 1"), "anchor")
    small = mixed.where(F.col("m") <= contexts).repartition("anchor").sortWithinPartitions("anchor", *(["first"] if later else []))
    some = small.select("anchor", "c", "context").mapInArrow(_comparison(later), "anchor long, c binary, spans array<long>")
    some = some.unionByName(_counted_windows(mixed.where(F.col("m") > contexts), later)).where(F.size("spans") > 0)
    none, whole = F.array().cast("array<long>"), F.array(F.lit(0).cast("long"), F.octet_length("context").cast("long") - LENGTH)
    if later:
        # The first occurrence loses what has been before, all others of the same context are copies of it.
        spans = each.withColumn("whole", whole).drop("context", "n").join(some, ["anchor", "c"], "left")
        hits = found.drop("context").join(spans, ["anchor", "c"])
        own = (F.col("first.o") == F.col("o")) & (F.col("first.d") == F.col("d"))
        hits = hits.select(
            "d", F.when(own, F.slice("starts", 1, 1)).otherwise(none).alias("starts"), F.coalesce("spans", none).alias("spans"),
            F.when(own, F.expr("slice(starts, 2, size(starts))")).otherwise(F.col("starts")).alias("again"), "whole",
        )
    else:
        # All windows of a context that occurs twice repeat, whatever the comparison has found of them.
        full = each.where("n > 1").select("anchor", "c", whole.alias("spans"))
        spans = full.unionByName(some.join(full.select("anchor", "c"), ["anchor", "c"], "left_anti"))
        hits = found.select("anchor", "c", "d", "starts").join(spans, ["anchor", "c"])
        hits = hits.select("d", "starts", "spans", none.alias("again"), none.alias("whole"))
    by_text = hits.groupBy("d").agg(F.collect_list(F.struct("starts", "spans", "again", "whole")).alias("found"))
    return held.select("d", "t").join(by_text, "d").mapInArrow(_kept_rows, KEPT)


def _marked(docs: DataFrame, text: str, key: str) -> DataFrame:
    t = F.coalesce(F.col(quoted(text)).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(quoted(key)).alias("doc_id"), t.alias("t"))
    return rows.select("doc_id", "t", _digest(F.col("t")).alias("d"), F.octet_length("t").cast("long").alias("n_bytes"))


def _changed(marked: DataFrame, contexts: int, kept: Column, keep: str = "none") -> DataFrame:
    """``d, n_copies, least, n_removed, n_spans, kept`` for texts that repeat or hold a repeat; ``kept`` is made of the rest."""
    long = marked.where(F.col("n_bytes") >= LENGTH)
    copies = long.groupBy("d").agg(F.count("*").alias("n_copies"), F.min("doc_id").alias("least")).where("n_copies > 1")
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("o")
    return removals(long.select("t", order), contexts, keep).withColumn("kept", kept).join(copies, "d", "full")


def _settled(
    marked: DataFrame, changed: DataFrame, whole: Column, none: Column, keep: str = "none", others: Sequence[str] = ()
) -> DataFrame:
    """A text that occurs twice is removed whole, but for the first if it is kept; one without any repeat stays ``whole``."""
    copied = F.coalesce(F.col("n_copies") > 1, F.lit(False))
    if keep == "first":
        copied &= ~F.col("doc_id").eqNullSafe(F.col("least"))
    return marked.join(changed, "d", "left").select(
        "doc_id", "n_bytes",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copied, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, none).otherwise(F.coalesce(F.col("kept"), whole)).alias("kept"), *others,
    )


def without_repeats(
    docs: DataFrame, text: str = "text", key: str = "doc_id", contexts: int = CONTEXTS, keep: str = "first"
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` for each row of ``docs``; ``kept`` is the remaining text as bytes.

    Every byte covered by a string of ``LENGTH`` bytes that also starts elsewhere, in the same or another document, is
    removed; with ``keep="first"`` only where that string has started before, by key (a number), then by the text's hash,
    then by place. Nulls count as empty texts, a null key comes last; texts shorter than LENGTH stay whole; rows with equal
    texts are copies of each other, and rows that share their key too fare alike. An empty table gives an empty result.
    Other columns are not read.

    Texts are shuffled, copies as one. A text's own anchors and contexts meet in one row, as the text itself does;
    nothing else that can grow with the number of documents meets in one task.
    """
    marked = _marked(docs, text, key)
    return _settled(marked, _changed(marked, contexts, F.col("kept"), keep), F.col("t"), F.lit(b""), keep)


def report(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """As ``without_repeats`` keeping no copy, with the SHA-256 of the remaining bytes, so texts without repeats are not moved again.

    A passage of 50 words mostly has fewer than LENGTH bytes. ``n_shared`` therefore counts, beside what is removed, the
    strings of 32 words that ``passages`` picks of the text and finds in another row too, 0 for a text without such.
    """
    marked = _marked(docs, text, key)
    changed = _changed(marked, CONTEXTS, F.sha2("kept", 256))
    rows = marked.select("*", text_hash(F.col("t"))).drop("t")
    out = _settled(rows, changed, F.lower(F.hex("d")), F.sha2(F.lit(b""), 256), others=("x",))
    shared = F.coalesce("n_shared", F.lit(0)).cast("long").alias("n_shared")
    out = out.join(shared_strings(marked.select("t")), "x", "left").withColumn("n_shared", shared)
    return out.drop("x").withColumnRenamed("kept", "kept_sha256")
