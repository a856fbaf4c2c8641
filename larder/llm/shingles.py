"""Near duplicates by the exact Jaccard similarity of their sets of five-word shingles.

Texts with equal sets are one class. Two sets that are alike share one of the first ``n - ceil(LEAST * n) + 1`` shingles
of each in any common order; shingles that a sample of the texts finds frequent come last, so the looked-up ones are rare.
The first one that they share is in the first ninth of the smaller set. The order only steers the work, every pair of a
similarity of ``LEAST`` or more is found, and each is judged on whole sets, unless the exclusive-or of two rows of bits
shows that more than the bound allows differs.

Classes whose texts have SimHash fingerprints (``simhash``) within its radius of each other are judged first, those that are
not alike are no link. Three of 64 bits show few of the pairs near the bound, so the others are looked for by shingles:
classes that share a looked-up shingle are first linked to one of them, twice; after that only classes that are not
connected yet meet as pairs. So a large group of near copies is a star, not all its pairs.

Texts are hashed in one pass. Only those of pairs to be judged are read again. Tables of this stage are deleted with it.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import simhash
from larder.llm.common import fresh, quoted, takes_worker, with_arrow
from larder.llm.components import components
from larder.llm.spotsigs import likeness
from larder.session import materialise, remove, scratch

SHINGLE = 5
# The least similarity of near duplicates, as a fraction, so that no bound depends on rounding.
LEAST = (4, 5)
SEED = 42
# One of so many classes is looked at for frequent shingles: those of several of these, at most so many.
SAMPLED = 4
SEVERAL = 3
FREQUENT = 400_000
# Rounds in which classes are linked to one of their bucket before the rest meets as pairs: these at least, then as long as
# one of so many judged pairs is a link, these at most.
STARS, WORTH, MOST_STARS = 2, 3, 12
STAR, HEADS = 8, 4


def shingles(text: bytes) -> np.ndarray:
    """The distinct shingles of a whole text as sorted hashes; one if there are fewer than five words, none without words."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.int64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    n = max(1, len(words) - SHINGLE + 1)
    spans = zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)
    return np.unique(np.frombuffer(b"".join([xxhash.xxh64_digest(joined[s:e], SEED) for s, e in spans]), np.int64))


def _class(own: np.ndarray) -> int:
    return int.from_bytes(xxhash.xxh64_digest(own.tobytes(), SEED), "big", signed=True)


def _lists(lists: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *lists])))


def _sets(texts: list[bytes]) -> pa.Array:
    return _lists([shingles(t) for t in texts])


def looked_up(n: int) -> int:
    """How many shingles of a set of ``n``, the first in the common order, another set that is alike has one of."""
    return n + 1 - -(-n * LEAST[0] // LEAST[1])


# Rows of bits as long as a mark ride along with the shingles that are looked up.
MARK = ["w0", "w1", "w2", "w3"]
HASHED = pa.struct([("class", pa.int64()), ("n", pa.int32()), ("sigs", pa.list_(pa.int64())), ("bits", pa.binary()), *((w, pa.int64()) for w in MARK)])
HASHED_SQL = f"struct<class: bigint, n: int, sigs: array<bigint>, bits: binary, {', '.join(f'{w}: bigint' for w in MARK)}>"


def parities(own: np.ndarray) -> bytes:
    """A bit for each of four places a shingle or more, set if an odd number of the shingles have the place.

    Bits of two sets that differ are of shingles that one of the sets has alone, so there are as many of these at least. The
    number of places is a power of two, and the two halves of a row make the row of half the places by exclusive-or.
    """
    places = max(64 * len(MARK), 1 << max(0, 4 * len(own) - 1).bit_length())
    return np.packbits((np.bincount(own & (places - 1), minlength=places) & 1).astype(bool)).tobytes()


def folded(bits: bytes, size: int) -> np.ndarray:
    row = np.frombuffer(bits, np.uint8)
    while len(row) > size:
        row = row[: len(row) // 2] ^ row[len(row) // 2 :]
    return row


def bits_apart(one: bytes, other: bytes) -> int:
    size = min(len(one), len(other))
    return int(np.bitwise_count(folded(one, size) ^ folded(other, size)).sum())


def _with_hashes(rows: DataFrame, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``rows`` with ``class, n, sigs, bits`` and ``MARK`` for ``text``: its class, how many shingles it has, those to be looked up, rare
    ones first, its ``parities``, and these folded to a mark of four numbers."""
    known, counts = frequent

    def hashed(texts: list[bytes]) -> pa.Array:
        takes_worker("shingles", gc.collect)
        classes, sizes, lists, bits = [], [], [], []
        for text in texts:
            own = shingles(text)
            classes.append(_class(own))
            sizes.append(len(own))
            bits.append(parities(own))
            if len(own):
                rank = np.zeros(len(own), np.int64)
                if len(known):
                    k = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    rank = np.where(known[k] == own, counts[k], 0)
                own = own[np.lexsort((own, rank))[: looked_up(len(own))]]
            lists.append(own)
        rows = np.array([folded(b, 8 * len(MARK)) for b in bits], np.uint8).reshape(-1, 8 * len(MARK)).view(np.int64)
        marks = [pa.array(np.ascontiguousarray(rows[:, i])) for i in range(len(MARK))]
        return pa.StructArray.from_arrays([pa.array(classes, pa.int64()), pa.array(sizes, pa.int32()), _lists(lists), pa.array(bits, pa.binary()), *marks], fields=list(HASHED))

    (name,) = fresh(rows, "hashed")
    return with_arrow(rows, name, "text", HASHED_SQL, hashed).select(*rows.drop("text").columns, f"{name}.*")


def _frequent(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several texts of the sample have, in order, and their numbers; at most ``FREQUENT``."""
    some = texts.where(F.pmod("x", F.lit(SAMPLED)) == 0).dropDuplicates(["x", "y"])
    sets = with_arrow(some, "sigs", "text", "array<bigint>", _sets)
    counted = sets.select(F.explode("sigs").alias("sig")).groupBy("sig").count().where(F.col("count") >= SEVERAL)
    most = counted.orderBy(F.desc("count"), "sig").limit(FREQUENT).toArrow()
    known, counts = (most.column(c).to_numpy() for c in ("sig", "count"))
    order = np.argsort(known)
    return known[order], counts[order]


def _fits(rest: Column, n: Column, m: Column) -> Column:
    """Whether sets of these sizes are alike if they share so many shingles."""
    p, q = LEAST
    return rest * F.lit(p + q).cast("long") >= (n + m).cast("long") * p


def _alike(n: Column, m: Column, at: Column, to: Column) -> Column:
    """Whether sets of these sizes can be alike if the first shingle that they share has these places."""
    p, q = LEAST
    long, short = F.greatest(n, m).cast("long"), F.least(n, m).cast("long")
    return (short * q >= long * p) & _fits(F.least(n - at, m - to), n, m)


def _marks_allow(other: str) -> Column:
    """Whether sets can be alike by their marks: a row's own, and those in its columns or field of the name ``other``."""
    apart = reduce(add, (F.bit_count(F.col(w).bitwiseXOR(F.col(other.format(w)))) for w in MARK))
    n, m = F.col("n"), F.col(other.format("n"))
    # Shingles of one set alone are counted in both sizes, shared ones twice.
    return _fits((n + m - apart).cast("double") / 2, n, m)


def _leads(n: str, at: str) -> Column:
    """Whether the shingle at this place may be the first that the set shares with a larger one that is alike.

    Of two sets that are alike the smaller one, of n shingles, has 2 LEAST / (1 + LEAST) n in common with the other or more.
    """
    return _fits(F.col(n) - F.col(at), F.col(n), F.col(n))


class _Scratch:
    """Tables in the shared folder that the stage deletes when it is done with them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write the table; the one that had its name before goes, as the new one is made of it."""
        path, old = scratch(self.spark, name), self.paths.get(name)
        df = materialise(df, path)
        self.paths[name] = path
        if old:
            remove(self.spark, old)
        return df

    def drop(self, *names: str) -> None:
        """Delete tables."""
        for name in names:
            remove(self.spark, self.paths.pop(name))
        release(self.spark)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that nothing refers to, which it does when the driver's memory is swept."""
    gc.collect()
    spark._jvm.System.gc()


def _bits_apart(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for one, other in parts:
        yield pa.array([bits_apart(a, b) for a, b in zip(one.to_pylist(), other.to_pylist(), strict=True)], pa.int32())


_bits_apart.__annotations__ = {"parts": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}


ROW = ["key", "no_key", "x", "y"]


def _judged(texts: DataFrame, classes: DataFrame, pairs: DataFrame, held: _Scratch) -> DataFrame:
    """``a, b``: the pairs whose whole sets are alike. Only the texts of pairs whose ``parities`` allow it are read."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    own = held.keep(classes.join(asked, "class", "left_semi").select("class", "n", "bits"), "parities")
    met = pairs.join(own.toDF("a", "n", "bits"), "a").join(own.toDF("b", "m", "bits2"), "b")
    apart = F.arrow_udf(_bits_apart, "int").asNondeterministic()("bits", "bits2")
    met = met.withColumn("apart", apart)
    # Shingles of one set alone are counted in both sizes, shared ones twice.
    allowed = _fits((F.col("n") + F.col("m") - F.col("apart")).cast("double") / 2, F.col("n"), F.col("m"))
    pairs = held.keep(met.where(allowed).select("a", "b"), "allowed")
    asked = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    asked = held.keep(classes.join(asked, "class", "left_semi").select("class", "again", *ROW), "asked")

    def sets(again: bool) -> DataFrame:
        found = texts.join(asked.where(F.col("again") == again).drop("again"), ROW)
        return with_arrow(found, "s", "text", "array<bigint>", _sets).select("class", "s")

    # Rows that are repeated as a whole give their set more than once.
    repeated = sets(True).groupBy("class").agg(F.first("s").alias("s"))
    every = held.keep(sets(False).unionByName(repeated), "sets")
    release(texts.sparkSession)
    found = pairs.join(every.toDF("a", "s"), "a").join(every.toDF("b", "s2"), "b")
    return found.where(likeness(F.col("s"), F.col("s2")) >= LEAST[0] / LEAST[1]).select("a", "b")


def _with_roots(rows: DataFrame, links: DataFrame | None) -> DataFrame:
    if links is None:
        return rows.withColumn("root", F.col("class"))
    roots = components(links).withColumnsRenamed({"node": "class", "component": "root"})
    return rows.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))


def _open(rows: DataFrame) -> DataFrame:
    """The rows of shingles that classes share which are not connected, and that lead in one of them."""
    mixed = rows.groupBy("sig").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.max(_leads("n", "at")).alias("leads"))
    return rows.join(mixed.where("least < most AND leads").select("sig"), "sig", "left_semi")


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _size_class(n: Column) -> Column:
    """Sets that are alike are in the same or in neighbouring classes of size."""
    return F.floor(F.log(n.cast("double")) / float(np.log(LEAST[1] / LEAST[0]) * (1 + 1e-9))).cast("int")


def _all_pairs(rows: DataFrame) -> DataFrame:
    """``a, b``: the classes of ``rows`` that can be alike and are not connected.

    The smaller set of a pair leads at the shingle, the larger one is in its class of size or the next one. Sets of which
    much differs before their first shared shingle lead nowhere, so a template's pages do not meet.
    """
    small = rows.where(_leads("n", "at")).withColumn("size", F.explode(F.array(_size_class(F.col("n")), _size_class(F.col("n")) + 1)))
    large = rows.select("sig", F.col("class").alias("other"), F.col("n").alias("m"), F.col("at").alias("to"), F.col("root").alias("root2"), *(F.col(w).alias(f"other_{w}") for w in MARK))
    large = large.withColumn("other_n", F.col("m"))
    met = small.join(large.withColumn("size", _size_class(F.col("m"))), ["sig", "size"])
    met = met.where((F.col("root") != F.col("root2")) & (F.col("n") <= F.col("m")))
    return met.where(_alike(F.col("n"), F.col("m"), F.col("at"), F.col("to")) & _marks_allow("other_{}")).select(*_ordered("class", "other")).distinct()


def _stars(rows: DataFrame, turn: int) -> DataFrame:
    """``a, b``: classes with some that they share a shingle with, and are not connected to, as many as there are rows at most.

    The first turn has a star for each shingle. In a later one its classes are dealt out by chance to stars of about
    ``STAR``, in each turn to others. A star's head is one for which the shingle is early enough in the order to be the first that it shares with
    a set of its size. A class is judged with the ``HEADS`` heads of most of its shingles.
    """
    chance = F.xxhash64(F.lit(turn), "class")
    if turn:
        sizes = rows.groupBy("sig").agg(F.ceil(F.count("*") / STAR).alias("stars"))
        rows = rows.join(sizes, "sig").withColumn("star", F.pmod(chance, "stars"))
    else:
        rows = rows.withColumn("star", F.lit(0))
    head = F.min(F.struct((~_leads("n", "at")).alias("late"), F.xxhash64(F.lit(-turn), "class").alias("o"), "class", "n", "at", "root", *MARK))
    met = rows.join(rows.groupBy("sig", "star").agg(head.alias("head")), ["sig", "star"]).where(F.col("root") != F.col("head.root"))
    met = met.where(_alike(F.col("n"), F.col("head.n"), F.col("at"), F.col("head.at")) & _marks_allow("head.{}"))
    votes = met.groupBy("class", F.col("head.class").alias("other")).count()
    best = votes.groupBy("class").agg(F.slice(F.sort_array(F.collect_list(F.struct("count", "other")), False), 1, HEADS).alias("best"))
    best = best.select("class", F.explode("best.other").alias("other"))
    return best.select(*_ordered("class", "other")).distinct()


def _by_fingerprints(prints: DataFrame) -> DataFrame:
    """``a, b``: classes that fingerprints link, from the rows ``fp, class`` of all texts: those of one fingerprint are a star."""
    heads = prints.groupBy("fp").agg(F.min("class").alias("head"))
    same = prints.join(heads, "fp").select("class", F.col("head").alias("other"))
    near = simhash.links(heads)
    near = near.join(heads.toDF("a", "class"), "a").join(heads.toDF("b", "other"), "b").select("class", "other")
    return same.unionByName(near).where("class != other").select(*_ordered("class", "other")).distinct()


def links(texts: DataFrame, classes: DataFrame, prints: DataFrame, held: _Scratch) -> DataFrame:
    """``a, b``: links that connect all ``classes`` whose sets are alike; ``prints`` has their fingerprints.

    ``classes`` has a row for each class: ``class, n, sigs, bits``, the columns of ``ROW``, by which its text is found in
    ``texts``, and whether it is found there ``again``.
    """
    pairs = held.keep(_by_fingerprints(prints), "pairs")
    found = _added(_judged(texts, classes, pairs, held), None, held)
    keys = classes.select("class", "n", F.posexplode("sigs").alias("at", "sig"))
    # Each class has a shingle once, so one that occurs twice is of two classes.
    shared = keys.groupBy("sig").agg(F.count("*").alias("c"), F.max(_leads("n", "at")).alias("leads")).where("c > 1 AND leads")
    # Most shingles are of one class alone; the marks, far longer than these rows, follow the others only.
    keys = keys.join(shared.select("sig"), "sig", "left_semi").join(classes.select("class", *MARK), "class")
    keys = held.keep(keys, "shared")
    n, links_of_turn, judged = found.count(), 0, 1
    for turn in range(MOST_STARS):
        if turn >= STARS and links_of_turn * WORTH < judged:
            break
        rows = held.keep(_open(_with_roots(keys, found)), "open")
        pairs = held.keep(_stars(rows, turn), "pairs")
        found = _added(_judged(texts, classes, pairs, held), found, held)
        judged, before, n = pairs.count(), n, found.count()
        links_of_turn = n - before
        if not judged:
            break
    rows = held.keep(_open(_with_roots(keys, found)), "open")
    pairs = held.keep(_all_pairs(rows), "pairs")
    found = _added(_judged(texts, classes, pairs, held), found, held)
    held.drop("shared", "open", "pairs")
    return found


def _added(judged: DataFrame, found: DataFrame | None, held: _Scratch) -> DataFrame:
    found = held.keep(judged if found is None else found.unionByName(judged), "alike")
    held.drop("parities", "allowed", "asked", "sets")
    return found


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of ``docs`` for each class of near duplicates: the one with the least key.

    Null, empty and blank texts have no shingles and are alike. A class all of whose keys are null keeps one row too.
    Columns, also such as ``class``, stay as they are. Of rows that share key and text, any one stays. An empty table
    gives an empty result. Keys are numbers. A row is found again by its key and the hash and length of its text.
    """
    k, t = F.col(quoted(key)).cast("long"), F.coalesce(F.col(quoted(text)).cast("string"), F.lit(""))
    row = [F.coalesce(k, F.lit(0)), k.isNull(), F.xxhash64(t), F.octet_length(t)]
    held = _Scratch(docs.sparkSession)
    texts = docs.select(*(c.alias(n) for c, n in zip(row, ROW, strict=True)), t.alias("text"))
    marked = held.keep(_with_hashes(simhash.with_fingerprints(texts), _frequent(texts)), "hashes")
    prints = held.keep(marked.select("fp", "class").distinct(), "prints")
    # Nulls come last, so a class with any key has one in its row here.
    best = F.min(F.struct("no_key", "key", "x", "y")).alias("best")
    classes = marked.groupBy("class").agg(best, *(F.first(c).alias(c) for c in ("n", "sigs", "bits", *MARK)))
    again = marked.groupBy(*ROW).agg((F.count("*") > 1).alias("again")).where("again")
    classes = classes.select("class", "n", "sigs", "bits", *MARK, "best.*").join(again, ROW, "left")
    classes = held.keep(classes.withColumn("again", F.coalesce("again", F.lit(False))), "classes")
    held.drop("hashes")
    found = links(texts, classes, prints, held)
    kept = _with_roots(classes, found).groupBy("root").agg(best).select("best.*")
    names = fresh(docs, *ROW)
    kept = materialise(kept.select(*(F.col(n).alias(m) for n, m in zip(ROW, names, strict=True))), name="kept")
    held.drop("classes", "alike", "prints")
    own = docs.withColumns(dict(zip(names, row, strict=True)))
    return own.join(kept, names, "left_semi").dropDuplicates(names).drop(*names)
