"""Spelling variants: words one edit apart, found by pivotal grams, and the frequent form that a rare word stands for.

A word's pairs of neighbouring characters (grams) come in one order of all words, rare ones first. Its prefix is the first
three of them, with all that equal the third. Two grams of the prefix that share no character are its pivots: the pair of
least frequency, by dynamic programming over the places. One edit touches one of the two at most. So of two words an edit
apart, a pivot of the one whose prefix ends earlier in the order is in the prefix of the other, moved by one place at most.

The pivot that an edit leaves alone has the edit on one side, and the other side is the same in both words. Pivots and
prefixes therefore meet by gram, place, length and the text of the unedited side, one case for each side and kind of edit;
what meets is verified by the edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import quoted, slices, texts_of
from larder.session import materialise, remove, scratch

# Fixed value: UTF-8 of the runs [A-Za-zÀ-ÿ]+, once A-Z are lower-cased.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
CHARACTERS = 6
LEAST = 5
TIMES = 5
DIVISOR = 199
# Words that a task counts before it hands them on.
COUNTED = 200_000
# With so many grams first in the order, a word keeps one of two pivots after an edit.
PREFIX = 3


def _without_one(run: bytes, h: int) -> bytes:
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def _word_rows(divisor: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows ``key, text`` to words with their number, added up over many texts."""

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def counted() -> pa.RecordBatch:
            columns = [pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for some in (s for part in parts for s in slices(part)):
            for key, text in zip(some.column(0).to_pylist(), texts_of(some.column(1)), strict=True):
                own = Counter(RUN.findall(text.lower()))
                if divisor:
                    begin = zlib.crc32(f"{'' if key is None else key}:".encode())
                    for run in [r for r in own if zlib.crc32(r, begin) % divisor == 0]:
                        counts[_without_one(run, zlib.crc32(run, begin))] += own.pop(run)
                counts.update(own)
                if len(counts) > COUNTED:
                    yield counted()
                    counts.clear()
        yield counted()

    return task


def words(
    docs: DataFrame, text: str = "text", key: str = "doc_id", characters: int = CHARACTERS, least: int = LEAST, divisor: int | None = DIVISOR
) -> DataFrame:
    """``word, n``: the runs of letters of whole texts, A-Z lower-cased, of so many characters and occurrences.

    With a ``divisor``, a run whose crc32 of ``<key>:<run>`` it divides loses the character at that number (modulo its
    length) first. A null text has no runs, a null key counts as empty. Numbers are added up in each task, then by word, so
    a frequent word is no more rows than there are tasks and flushes. Repeated rows count each; an empty table has no words.
    """
    rows = docs.select(F.col(quoted(key)).alias("k"), F.col(quoted(text)).cast("string").alias("t"))
    counted = rows.mapInArrow(_word_rows(divisor), "word string, n long").where(F.length("word") >= characters)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def grams(word: str) -> list[str]:
    return [word[i : i + 2] for i in range(len(word) - 1)]


def pivots(places: list[int], weights: list[int]) -> tuple[int, int]:
    """Two of the ``places`` (ascending), two or more apart, of least total weight.

    ``best[i]`` is the lightest of the first ``i`` places; the lightest pair ends at a place with the best one that is far
    enough before it.
    """
    best, pair, least, far = [-1], None, None, 0
    for i, place in enumerate(places):
        while far < i and places[far] <= place - 2:
            far += 1
        if far:
            other = best[far]
            total = weights[i] + weights[other]
            if least is None or total < least:
                least, pair = total, (places[other], place)
        best.append(i if best[i] < 0 or weights[i] < weights[best[i]] else best[i])
    if pair is None:
        raise ValueError("no two places are apart")
    return pair


SIDES = pa.schema([("word", pa.string()), ("n", pa.int64()), ("pivot", pa.bool_()), ("size", pa.int32()), ("side", pa.string()), ("reach", pa.int64())])
SIDES_SQL = "word string, n long, pivot boolean, size int, side string, reach long"


def _side_rows(rank: dict[str, int], count: dict[str, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Words to their prefix grams, twice each, and which of them are pivots.

    ``side`` is the text from the word's start to the gram's end, for edits after it, or from the gram's start to the word's
    end, for edits before it. Its length is the gram's place from the end that stays, which the edit does not move.
    ``reach`` is the rank of the prefix's last gram.
    """

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in (s for part in parts for s in slices(part)):
            out = []
            for word, n in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                own = grams(word)
                ranks = [rank[g] for g in own]
                reach = sorted(ranks)[PREFIX - 1]
                places = [i for i, r in enumerate(ranks) if r <= reach]
                chosen = pivots(places, [count[own[i]] for i in places])
                for i in places:
                    out += [(word, n, i in chosen, len(word), side, reach) for side in ("<" + word[: i + 2], ">" + word[i:])]
            columns = zip(*out, strict=True) if out else ((),) * len(SIDES)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SIDES, strict=True)], schema=SIDES)

    return task


def near_pairs(counted: DataFrame) -> DataFrame:
    """``a, n, b, m``: all pairs of the words of rows ``word, n`` that are one edit apart, once, ``a`` before ``b``.

    Words have four characters at least, so that a prefix has three grams. The grams' counts go to the driver; there are at
    most 8,100 of them, as letters are of 90 kinds (a-z and the 64 from U+00C0).
    """
    at = F.sequence(F.lit(1), F.length("word") - 1)
    each = counted.select(F.explode(F.transform(at, lambda i: F.substring(F.col("word"), i, F.lit(2)))).alias("gram"))
    count = {r["gram"]: r["count"] for r in each.groupBy("gram").count().collect()}
    rank = {g: i for i, g in enumerate(sorted(count, key=lambda g: (count[g], g)))}
    path = scratch(counted.sparkSession, "grams")
    rows = materialise(counted.select("word", "n").mapInArrow(_side_rows(rank, count), SIDES_SQL), path)
    # The edit takes a character away, puts one there or keeps the length.
    ours = rows.where("pivot").withColumn("size", F.explode(F.array(*[F.col("size") + d for d in (-1, 0, 1)])))
    theirs = rows.select(F.col("word").alias("other"), F.col("n").alias("m"), "size", "side", F.col("reach").alias("reach2"))
    met = ours.join(theirs, ["side", "size"]).where("reach <= reach2").where(F.levenshtein("word", "other", 1) == 1)
    first = F.col("word") < F.col("other")
    names = (("word", "other", "a"), ("n", "m", "n"), ("other", "word", "b"), ("m", "n", "m"))
    pairs = materialise(met.select(*(F.when(first, F.col(x)).otherwise(F.col(y)).alias(z) for x, y, z in names)).distinct(), name="near-words")
    remove(counted.sparkSession, path)
    return pairs


def _last_forms(forms: DataFrame) -> DataFrame:
    """``word, root`` for rows ``word, form``: where following forms ends. Each round doubles the forms that are followed.

    A form has ``TIMES`` its word's occurrences, so no chain is longer than the logarithm of these and none is a circle.
    """
    spark, path = forms.sparkSession, scratch(forms.sparkSession, "forms")
    reached = materialise(forms.select("word", F.col("form").alias("root")), path)
    while True:
        later = reached.select(F.col("word").alias("root"), F.col("root").alias("later"))
        if reached.join(later, "root", "left_semi").isEmpty():
            return reached
        old, path = path, scratch(spark, "forms")
        further = reached.join(later, "root", "left").select("word", F.coalesce("later", "root").alias("root"))
        reached = materialise(further, path)
        remove(spark, old)


def variants(counted: DataFrame, times: int = TIMES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each of the distinct words of rows ``word, n``.

    ``n_near`` counts the words one inserted, deleted or replaced character away. ``form`` is the one of them with the
    greatest n, ties to the first by code points, if that n is ``times`` (two at least) the word's n or more; else form and
    form_n are null. ``root`` is where following forms from the word ends, the word itself without a form. A word with very
    many near ones is counted by task first. An empty table gives an empty result.
    """
    if times < 2:
        raise ValueError("a form has twice its word's occurrences at least")
    pairs = near_pairs(counted)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), "m")
    both = both.unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n").alias("m")))
    best = F.min(F.struct((-F.col("m")).alias("less"), "other")).alias("best")
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), best)
    rows = counted.select("word", "n").join(near, "word", "left")
    stands = -F.col("best.less") >= times * F.col("n")
    rows = rows.select(
        "word", F.when(stands, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(stands, -F.col("best.less")).alias("form_n"),
    )
    rows = materialise(rows, name="near-forms")
    out = rows.join(_last_forms(rows.where("form IS NOT NULL")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def report(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``variants`` of the ``words`` of whole texts, with the contract's lost characters."""
    return variants(materialise(words(docs, text, key), name="words"))
