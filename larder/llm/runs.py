"""Periodic runs of words: stretches that repeat a shorter stretch, found as maximal pairs of each text.

A maximal pair is a stretch of words at two places, with other words before and after it. Suffixes of a text's words are put
in order, and the tree of their common prefixes (longest common prefix intervals) is walked from the leaves up. An
interval holds its places in the order of the text, each in the class of the word to its left; where two children of an
interval meet, neighbouring places of different left-word classes are a maximal pair as long as the interval is deep.

If the places are d apart and the pair is long enough, 2 d and the least length of a run less d, the words from the first
place to the second pair's end are a run of period d: maximality on both sides is that of the run, so nothing is extended. The
smallest period's pair has no place between its two, so neighbours are enough; multiples of a period give the same stretch,
of which the smallest period stays.

A run's pair has a least number of words (16 for 24 words and three periods), so only suffixes that share so many words with
another one are ordered; most texts have none.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import WORD_PATTERN, quoted, with_arrow

# Fixed values of the contract: the least words of a run, and how often it holds its period at least.
LEAST = 24
TIMES = 3
_MIX = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]


def least_pair(least: int, times: int) -> int:
    """The fewest words that the pair of a run has: its length less its period."""
    if times < 3:
        raise ValueError("a run holds its period three times at least")
    return min(max(least, times * d) - d for d in range(1, least + 1))


def _seen_again(ids: np.ndarray, length: int) -> np.ndarray:
    """Places whose next ``length`` words may occur elsewhere too, by a hash of them that is made by doubling."""
    n = len(ids) - length + 1
    if n < 2:
        return np.empty(0, np.int64)
    own, total = (ids.astype(np.uint64) + np.uint64(1)) * _MIX, np.zeros(n, np.uint64)
    width, done = 1, 0
    while done < length:
        if length & width:
            total = (total ^ (total >> np.uint64(31))) * _MIX + own[done : done + n]
            done += width
        if done < length:
            own = own[:-width] * _MIX + own[width:]
            own ^= own >> np.uint64(29)
            width *= 2
    order = np.argsort(total)
    same = total[order][1:] == total[order][:-1]
    return np.sort(order[np.append(False, same) | np.append(same, False)])


def _ordered(ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes ``at`` in their order, and each one's common beginning with the one before it.

    Ranks by 1, 2, 4 ... words are made for all suffixes until those asked for differ; they give the common beginnings too.
    """
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64) + 1
    levels, length = [rank], 1
    while len(np.unique(rank[at])) < len(at):
        later = np.zeros(n, np.int64)
        later[: n - length] = rank[length:]
        rank = np.unique(rank * (n + 2) + later, return_inverse=True)[1] + 1
        length *= 2
        levels.append(rank.astype(np.int32) if n < 1 << 31 else rank)
    order = at[np.argsort(rank[at])]
    same = np.zeros(len(order) - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = order[:-1] + same, order[1:] + same
        # A rank may stand for fewer words at the end of the text, where it is no other suffix's.
        fits = (a < n) & (b < n)
        fits[fits] = levels[k][a[fits]] == levels[k][b[fits]]
        same[fits] += 1 << k
    return order, np.append(0, same)


def _pairs(order: np.ndarray, common: np.ndarray, left: list[int], least: int, times: int, shortest: int) -> dict[tuple[int, int], int]:
    """Runs as ``(start, end): period`` from the interval tree of suffixes in order."""
    found: dict[tuple[int, int], int] = {}

    def met(a: int, b: int, depth: int) -> None:
        d = b - a
        if left[a] != left[b] and depth + d >= max(least, times * d):
            run = (a, b + depth)
            found[run] = min(d, found.get(run, d))

    def joined(one: list[int], other: list[int], depth: int) -> list[int]:
        """The places of two children in the order of the text; the fewer are looked up among the more."""
        few, many = sorted((one, other), key=len)
        if len(few) * 8 > len(many):
            marked = sorted([(p, 0) for p in few] + [(p, 1) for p in many])
            for (a, x), (b, y) in zip(marked, marked[1:]):  # noqa: B905
                if x != y:
                    met(a, b, depth)
            return [p for p, _ in marked]
        for p in few:
            at = bisect_left(many, p)
            if at:
                met(many[at - 1], p, depth)
            if at < len(many):
                met(p, many[at], depth)
        for p in few:
            many.insert(bisect_left(many, p), p)
        return many

    open_: list[tuple[int, list[int]]] = []
    own = [int(order[0])]
    for place, depth in zip(order[1:].tolist(), common[1:].tolist(), strict=True):
        while open_ and open_[-1][0] > depth:
            above, held = open_.pop()
            own = joined(held, own, above)
        if depth >= shortest:
            if open_ and open_[-1][0] == depth:
                open_[-1] = (depth, joined(open_[-1][1], own, depth))
            else:
                open_.append((depth, own))
        own = [place]
    while open_:
        above, held = open_.pop()
        own = joined(held, own, above)
    return found


def runs(words: list[bytes], least: int = LEAST, times: int = TIMES) -> list[Run]:
    """Every run of a text's words as start, length and smallest period, by start, then period."""
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    shortest = least_pair(least, times)
    at = _seen_again(ids, shortest)
    if not len(at):
        return []
    order, common = _ordered(ids, at)
    pairs = _pairs(order, common, [-1, *ids.tolist()], least, times, shortest)
    return sorted(((a, b - a, d) for (a, b), d in pairs.items()), key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], found: list[Run]) -> list[bytes]:
    """The words that no run has after its first period."""
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [w for w, g in zip(words, np.cumsum(gone).tolist(), strict=False) if not g]


FOUND = pa.struct(
    [
        ("n_words", pa.int64()),
        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
        ("collapsed", pa.binary()),
    ]
)
FOUND_SQL = "struct<n_words: bigint, runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: binary>"


def _found(texts: list[bytes], least: int, times: int) -> pa.Array:
    rows = []
    for text in texts:
        words = text.split()
        own = runs(words, least, times)
        rows.append({"n_words": len(words), "runs": [dict(zip(("start", "length", "period"), r, strict=True)) for r in own], "collapsed": b" ".join(collapsed(words, own))})
    return pa.array(rows, FOUND)


def with_runs(docs: DataFrame, text: str = "text", name: str = "periodic", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``docs`` with the struct ``name``: ``n_words``, ``runs`` and the ``collapsed`` text (words joined by one space).

    A run is a stretch of words whose smallest period is q, of ``least`` words and ``times`` periods at least, that no
    neighbouring word goes on. Runs are by start, then period; ``collapsed`` drops what any run has after its first period. Words are
    what blanks separate. A null, empty or blank text has no words and no runs, and collapses to an empty text. Rows are
    judged alone, so ties and repeated rows fare alike; a column called ``name`` is replaced; an empty table gives an
    empty one. No shuffle; memory is a slice of texts, and for a text with runs 4 bytes a word for each doubling of its longest repeat.
    """
    return with_arrow(docs, name, text, FOUND_SQL, lambda texts: _found(texts, least, times))


def planted(rows: DataFrame) -> DataFrame:
    """The contract's input, of rows ``doc_id, text``: a tenth, by doc_id, go on with a repeated stretch of their own words."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD_PATTERN), F.lit(0)))
    # In steps, so that none of them is worked out again for each word.
    rows = rows.withColumn("h", h).withColumn("words", words)
    rows = rows.withColumns({"g": F.expr("h div 10"), "n": F.coalesce(F.size("words"), F.lit(0)).cast("long")})
    rows = rows.withColumn("a", F.try_mod("g", "n")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    made = F.expr("transform(sequence(0L, n - 1), i -> get(words, cast(if(i < a, i, a + (i - a) % p) AS int)))")
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(made, " ")).otherwise(F.col("text")).alias("text"))


def report(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256`` of the contract's texts.

    The run shown has the greatest length / period, compared exactly; ties go to the smaller start, then period.
    """
    rows = docs.select(F.col(quoted(key)).alias("doc_id"), F.col(quoted(text)).cast("string").alias("text"))
    rows = with_runs(planted(rows))
    found = F.col("periodic.runs")
    # a / b > c / d is a d > c b; the runs come by start and period, so the first of equals is kept.
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    kind = "struct<start: bigint, length: bigint, period: bigint>"
    best = F.aggregate(found, F.lit(None).cast(kind), lambda best, r: F.when(better(best, r), r).otherwise(best))
    lines = F.transform(found, lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    rows = rows.withColumn("best", best)
    return rows.select(
        "doc_id",
        F.size(found).cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("periodic.collapsed", 256).alias("collapsed_sha256"),
    )
