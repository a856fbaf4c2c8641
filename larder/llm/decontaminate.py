"""Benchmark decontamination: rare n-gram seeds find candidate passages, Smith-Waterman alignment judges them.

Items and texts are compared as words (letters and digits, lower case). Every run of three words of an item is a seed, or of
two words if an alignment could break all runs of three.
An alignment that keeps ``SIMILARITY`` of an item's words keeps at least a computable number of its seeds, so it keeps one of
the rarest of them: seeds that are frequent in the corpus need not be looked at, and nothing is lost. The passage around
such a seed, if enough seeds of the item lie in it, is aligned with the whole item.

The items are the stated query set: they are taken in blocks of bounded size, each block's seeds travel with the tasks,
and each task reads its own texts. Texts are neither shuffled nor joined, whatever passage a third of them share.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import repeat
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import decoded, fresh, give_back, quoted, slices, takes_worker, texts_of, with_arrow

SEED_WORDS = 3
SIMILARITY = 0.8
# The same as a fraction, for bounds that must not depend on rounding.
KEPT, OF = 4, 5
# Text of the items that one pass over the corpus looks for.
BLOCK_BYTES = 8_000_000
# Cells of the alignment tables that are filled at once.
CELLS = 1_000_000

WORDS = re.compile(r"[^\W_]+")
# Scores, with matches and columns of the best alignment in the lower bits, so that one maximum carries all three.
SCORE, MATCHED = 1 << 40, 1 << 20
MATCH, MISMATCH, GAP = 2 * SCORE + MATCHED - 1, -SCORE - 1, -SCORE - 1

FOUND = "array<struct<item: int, similarity: double, end: int>>"
FOUND_TYPE = pa.list_(pa.struct([("item", pa.int32()), ("similarity", pa.float64()), ("end", pa.int32())]))


def words_of(text: bytes | str) -> list[str]:
    return WORDS.findall((decoded(text) if isinstance(text, bytes) else text).lower())


def _unbroken(n_words: int, seed: int) -> int:
    """Seeds of ``seed`` words that an alignment of the wanted similarity keeps at least, in whole numbers.

    A lost word breaks up to ``seed`` of them, an inserted one up to ``seed - 1``; of n words, l lost and i inserted ones
    leave the similarity at (n - l) / (n + i).
    """
    spare = (OF - KEPT) * n_words
    broken = max(seed * lost + (seed - 1) * ((spare - OF * lost) // KEPT) for lost in range(spare // OF + 1))
    return n_words - (seed - 1) - broken


@cache
def seed_words(n_words: int) -> int:
    """Words of an item's seeds: as many as leave every wanted alignment a seed."""
    return next((n for n in range(min(SEED_WORDS, n_words), 1, -1) if _unbroken(n_words, n) > 0), min(1, n_words))


@cache
def least_shared(n_words: int) -> int:
    """Seeds that an alignment of the wanted similarity keeps at least."""
    return max(1, _unbroken(n_words, seed_words(n_words)))


@dataclass
class Block:
    """Some items as word numbers (0: a word of no item), and their seeds, sorted by code."""

    words: dict[str, int]
    items: list[np.ndarray]
    codes: np.ndarray
    # By seed: where in which items it stands, and whether it is among the rare ones there.
    places: list[list[tuple[int, int]]]
    rare: list[set[int]] | None = None

    @staticmethod
    def of(texts: list[str]) -> Block:
        split = [words_of(t) for t in texts]
        words = {w: i + 1 for i, w in enumerate(sorted({w for s in split for w in s}))}
        items = [np.array([words[w] for w in s], np.int64) for s in split]
        places = defaultdict(list)
        for item, ids in enumerate(items):
            n = seed_words(len(ids))
            for at, code in enumerate(_codes(ids, len(words) + 1, n).tolist() if n else []):
                places[code].append((item, at))
        codes = np.array(sorted(places), np.int64)
        return Block(words, items, codes, [places[c] for c in codes.tolist()])

    def numbers(self, text: bytes) -> np.ndarray:
        own = words_of(text)
        return np.fromiter(map(self.words.get, own, repeat(0)), np.int64, len(own))

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in the text and numbers of the seeds that start there. Short items have shorter seeds."""
        at, seeds = [], []
        for n in {seed_words(len(i)) for i in self.items if len(i)} if len(self.codes) else ():
            codes = _codes(ids, len(self.words) + 1, n)
            where = np.flatnonzero(codes)
            k = np.minimum(np.searchsorted(self.codes, codes[where]), len(self.codes) - 1)
            same = self.codes[k] == codes[where]
            at.append(where[same])
            seeds.append(k[same])
        return (np.concatenate(at), np.concatenate(seeds)) if at else (np.empty(0, np.int64), np.empty(0, np.int64))

    def choose_rare(self, documents: np.ndarray) -> None:
        """Keep, of each item, the rarest seeds: one more than an alignment can lose."""
        own = defaultdict(list)
        for seed, places in enumerate(self.places):
            for item, at in places:
                own[item].append((int(documents[seed]), at, seed))
        self.rare = [set() for _ in self.items]
        for item, seeds in own.items():
            n = len(seeds) - min(len(seeds), least_shared(len(self.items[item]))) + 1
            self.rare[item] = {seed for _, _, seed in sorted(seeds)[:n]}

    def passages(self, ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``item, first, last`` word positions of passages that may hold an edited copy of the item."""
        spans = defaultdict(list)
        for at, seed in zip(*(x.tolist() for x in self.hits(ids)), strict=True):
            for item, place in self.places[seed]:
                spans[item].append((at - place, at, seed))
        for item, found in spans.items():
            rare, n = self.rare[item], len(self.items[item])
            if not any(seed in rare for _, _, seed in found):
                continue
            slack = ceil(n * (1 / SIMILARITY - 1 + 1 - SIMILARITY)) + 1
            found.sort()
            group: list[tuple[int, int, int]] = []
            # Seeds on neighbouring diagonals belong to one passage.
            for hit in [*found, None]:
                if group and (hit is None or hit[0] - group[-1][0] > slack):
                    if len({at for _, at, _ in group}) >= least_shared(n) and any(seed in rare for _, _, seed in group):
                        yield item, max(0, group[0][0] - slack), min(len(ids), group[-1][0] + n + slack)
                    group = []
                if hit is not None:
                    group.append(hit)


def _codes(ids: np.ndarray, base: int, n: int) -> np.ndarray:
    """One number for each run of ``n`` known words, 0 if a word is unknown. Runs of different length never share one."""
    if len(ids) < n:
        return np.empty(0, np.int64)
    runs = [ids[i : len(ids) - n + 1 + i] for i in range(n)]
    code, known = np.zeros(len(runs[0]), np.int64), np.ones(len(runs[0]), bool)
    for run in runs:
        code, known = code * base + run, known & (run > 0)
    return np.where(known, code, 0)


def align(pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[float, int]]:
    """Smith-Waterman of each (item, passage): similarity of the best alignment and where it ends in the passage.

    A match scores 2, a mismatch or gap -1. Similarity is matched words over the longer of item and alignment. All
    pairs of a group are filled row by row together; gaps along a row come from a running maximum.
    """
    out: list[tuple[float, int]] = [(0.0, 0)] * len(pairs)
    order = sorted((i for i, (a, b) in enumerate(pairs) if len(a) and len(b)), key=lambda i: len(pairs[i][1]))
    while order:
        width, some = len(pairs[order[-1]][1]), []
        while order and (not some or (len(some) + 1) * width <= CELLS):
            some.append(order.pop())
        rows = max(len(pairs[i][0]) for i in some)
        items, passages = np.full((len(some), rows), -1, np.int64), np.full((len(some), width), -2, np.int64)
        for k, i in enumerate(some):
            items[k, : len(pairs[i][0])], passages[k, : len(pairs[i][1])] = pairs[i]
        steps = np.arange(1, width + 1, dtype=np.int64) * -GAP
        above = np.zeros((len(some), width + 1), np.int64)
        best, end = np.zeros(len(some), np.int64), np.zeros(len(some), np.int64)
        for r in range(rows):
            open_ = np.maximum(above[:, :-1] + np.where(passages == items[:, r : r + 1], MATCH, MISMATCH), above[:, 1:] + GAP)
            np.maximum(open_, 0, out=open_)
            here = np.maximum.accumulate(open_ + steps, axis=1) - steps
            np.maximum(here, 0, out=here)
            above[:, 1:] = here
            top = here.argmax(axis=1)
            value = here[np.arange(len(some)), top]
            end = np.where(value > best, top + 1, end)
            best = np.maximum(best, value)
        columns = -best % MATCHED
        matched = ((best + columns) // MATCHED) % MATCHED
        for k, i in enumerate(some):
            out[i] = (float(matched[k]) / max(len(pairs[i][0]), int(columns[k]), 1), int(end[k]))
    return out


def blocks(items: DataFrame, text: str, key: str) -> Iterator[tuple[list[int | None], Block]]:
    """The items in blocks of about ``BLOCK_BYTES``; the driver reads them partition by partition."""
    keys, texts, size = [], [], 0
    for row in items.select(F.col(quoted(key)).alias("k"), F.col(quoted(text)).cast("string").alias("t")).toLocalIterator():
        keys.append(row["k"])
        texts.append(row["t"] or "")
        size += len(texts[-1])
        if size >= BLOCK_BYTES:
            yield keys, Block.of(texts)
            keys, texts, size = [], [], 0
    if keys:
        yield keys, Block.of(texts)


def _rare_seeds(docs: DataFrame, block: Block, text: str) -> None:
    """Count the documents that hold each seed, over the whole corpus, and mark each item's rarest seeds."""

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        takes_worker("decontaminate", lambda: None)
        counts = np.zeros(len(block.codes), np.int64)
        for part in parts:
            for some in slices(part):
                for t in texts_of(some.column(0)):
                    counts[np.unique(block.hits(block.numbers(t))[1])] += 1
        seeds = np.flatnonzero(counts)
        give_back()
        yield pa.RecordBatch.from_pydict({"seed": pa.array(seeds, pa.int64()), "n": pa.array(counts[seeds], pa.int64())})

    rows = docs.select(F.col(quoted(text)).cast("string")).mapInArrow(task, "seed long, n long")
    counts = np.zeros(len(block.codes), np.int64)
    for row in rows.groupBy("seed").agg(F.sum("n").alias("n")).collect():  # at most the block's seeds
        counts[row["seed"]] = row["n"]
    block.choose_rare(counts)


def _found(texts: list[bytes], block: Block) -> pa.Array:
    """For each text the items that it holds a copy of, the best passage of each."""
    takes_worker("decontaminate", lambda: None)
    out: list[dict[int, tuple[float, int]]] = [{} for _ in texts]
    asked = []
    for row, t in enumerate(texts):
        ids = block.numbers(t)
        asked += [(row, item, a, (block.items[item], ids[a:b])) for item, a, b in block.passages(ids)]
    for (row, item, a, _), (similarity, end) in zip(asked, align([pair for *_, pair in asked]), strict=True):
        if similarity >= SIMILARITY and similarity > out[row].get(item, (0.0, 0))[0]:
            out[row][item] = (similarity, a + end)
    rows = [[{"item": i, "similarity": s, "end": e} for i, (s, e) in sorted(o.items())] for o in out]
    return pa.array(rows, FOUND_TYPE)


def with_copies(docs: DataFrame, block: Block, text: str, name: str) -> DataFrame:
    """``docs`` with the copies of the block's items in each whole text: item number, similarity, word after its end."""
    _rare_seeds(docs, block, text)
    return with_arrow(docs, name, text, FOUND, lambda texts: _found(texts, block))


def matches(
    docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id"
) -> DataFrame:
    """``doc_id, item_id, similarity, end_word``: every document that holds an item, edited or not, at its best passage.

    Null or empty texts and items hold and match nothing; items of one or two words are sought as they are. Repeated
    documents and items each have their rows; an empty table on either side gives no rows. Texts are whole: a copy may
    stand anywhere.
    """
    rows = docs.select(F.col(quoted(key)).alias("doc_id"), F.col(quoted(text)).alias("text"))
    out = None
    for keys, block in blocks(items, item_text, item_key):
        found = with_copies(rows, block, "text", "found").select("doc_id", F.explode("found").alias("f"))
        names = F.array(*map(F.lit, keys)) if len(keys) <= 1000 else None
        if names is None:  # a table of the block's keys, as long as the block
            lookup = F.broadcast(docs.sparkSession.createDataFrame(list(enumerate(keys)), "n int, item_id long"))
            found = found.join(lookup, F.col("f.item") == lookup["n"])
        else:
            found = found.withColumn("item_id", F.element_at(names, F.col("f.item") + 1).cast("long"))
        part = found.select("doc_id", "item_id", F.col("f.similarity").alias("similarity"), F.col("f.end").alias("end_word"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        return rows.limit(0).select("doc_id", *(F.lit(None).cast(t).alias(n) for n, t in (("item_id", "long"), ("similarity", "double"), ("end_word", "int"))))
    return out


def clean(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", item_key: str = "item_id") -> DataFrame:
    """The rows of ``docs`` that hold no copy of any item.

    Null and empty texts hold none and stay; long ones are searched whole; repeated rows fare alike; other columns stay.
    Null items and an empty table of items leave all rows, empty ``docs`` give an empty result.
    """
    for _, block in blocks(items, item_text, item_key):
        (name,) = fresh(docs, "copies")
        docs = with_copies(docs, block, text, name).where(F.size(name) == 0).drop(name)
    return docs
