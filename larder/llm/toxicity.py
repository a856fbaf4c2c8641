"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols: insult, threat, target, negation, reported speech, clause end, other. Small transducers each follow
one thing (a negation nearby, a target nearby, speech reported in this clause, an insult or threat); their composition is
one machine that, for each insult or threat, puts out a label such as "insult, not negated, not reported, with target".
Counts of labels, weighted, make the score. Patterns for insults and threats (word beginnings) and the labels' weights
are learned from labelled rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import decoded, fresh, quoted, takes_worker, texts_of, with_arrow

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = range(7)

# Words of each symbol in English, German, French and Spanish.
TARGETS = "you your yours he she they them him her du dich dir ihr euch sie tu te toi vous il elle usted ustedes él ella"
NEGATIONS = "not no never isn't aren't nicht kein keine nie pas jamais ni nunca sin sans ohne"
REPORTS = "said says called calls quoted reported sagte sagt nannte dit dits disait dijo dice llamó"
INSULTS = (
    "idiot moron stupid loser pathetic worthless disgusting scum trash clown imbecile dumb "
    "dummkopf trottel abschaum crétin ordure connard estúpido imbécil escoria"
)
THREATS = "kill murder strangle töten umbringen tuer étrangler matar asesinar"

# Labelled rows that the fit reads at most, those with the least hashed key.
SAMPLE = 20_000
# Beginnings of words that may become patterns, in letters.
STEMS = range(3, 9)
# Patterns that the fit looks at, those of most toxic rows, and toxic rows that a new one must add.
CANDIDATES = 4000
LEAST_GAIN = 2
THRESHOLD = 0.7
# Words that a worker process remembers before it starts anew.
MOST_WORDS = 200_000

TOKENS = re.compile(r"[^\W\d_]+|[.!?;\n]")
ENDS = frozenset(".!?;\n")


@dataclass(frozen=True)
class Transducer:
    """A deterministic machine over symbols: (state, symbol) to (next state, output)."""

    start: object
    moves: dict

    def compose(self, other: Transducer) -> Transducer:
        """Both machines side by side on the same symbols; outputs are joined. Only reachable states are built."""
        start, moves = (self.start, other.start), {}
        todo = [start]
        while todo:
            a, b = state = todo.pop()
            for symbol in range(7):
                (a2, out), (b2, out2) = self.moves[a, symbol], other.moves[b, symbol]
                moves[state, symbol] = ((a2, b2), out + out2)
                if ((a2, b2), 0) not in moves and (a2, b2) != state:
                    todo.append((a2, b2))
        return Transducer(start, moves)


def nearby(symbol: int, reach: int, name: str) -> Transducer:
    """Puts out at each insult or threat whether ``symbol`` came within ``reach`` words before, in the same clause."""
    moves = {}
    for left, s in product(range(reach + 1), range(7)):
        then = 0 if s == END else reach if s == symbol else max(0, left - 1)
        moves[left, s] = (then, ((name, left > 0),) if s in (INSULT, THREAT) else ())
    return Transducer(0, moves)


def kinds() -> Transducer:
    """Puts out which kind of match a word is."""
    names = {INSULT: "insult", THREAT: "threat"}
    return Transducer(0, {(0, s): (0, (("kind", names[s]),) if s in names else ()) for s in range(7)})


def grammar() -> tuple[np.ndarray, np.ndarray, list[tuple]]:
    """The composed machine as tables: next state and label (or -1) by state and symbol, and the labels."""
    parts = (kinds(), nearby(NEGATION, 3, "negated"), nearby(REPORT, 64, "reported"), nearby(TARGET, 6, "targeted"))
    whole = reduce(Transducer.compose, parts)
    states = {whole.start: 0} | {s: i + 1 for i, s in enumerate(sorted({s for s, _ in whole.moves} - {whole.start}, key=repr))}
    labels = sorted({out for _, out in whole.moves.values() if out}, key=repr)
    then, label = np.zeros((len(states), 7), np.int32), np.full((len(states), 7), -1, np.int32)
    for (state, symbol), (after, out) in whole.moves.items():
        then[states[state], symbol] = states[after]
        if out:
            label[states[state], symbol] = labels.index(out)
    return then, label, labels


THEN, LABEL, LABELS = grammar()
MOVES = [list(zip(a, b, strict=True)) for a, b in zip(THEN.tolist(), LABEL.tolist(), strict=True)]


class Lexicon(dict):
    """Symbols by word. Unknown words are looked up by their beginnings once and remembered."""

    def __init__(self, insults: frozenset[str], threats: frozenset[str]):
        super().__init__()
        self.stems = {s: INSULT for s in insults} | {s: THREAT for s in threats}
        self.lengths = sorted({len(s) for s in self.stems}, reverse=True)
        self.fixed = {w: s for s, words in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in words.split()}
        self.fixed |= {e: END for e in ENDS}

    def __missing__(self, word: str) -> int:
        symbol = self.fixed.get(word, OTHER)
        for n in self.lengths:
            symbol = symbol or self.stems.get(word[:n], OTHER)
        if len(self) > MOST_WORDS:
            self.clear()
        self[word] = symbol
        return symbol


@dataclass
class Model:
    """Patterns, label weights and intercept."""

    insults: frozenset[str]
    threats: frozenset[str]
    weights: tuple[float, ...]
    intercept: float


_LEXICONS: dict[tuple, Lexicon] = {}


def lexicon(insults: frozenset[str], threats: frozenset[str]) -> Lexicon:
    """A worker process keeps the lexicon of one model from batch to batch."""
    takes_worker("toxicity", _LEXICONS.clear)
    if (insults, threats) not in _LEXICONS:
        _LEXICONS.clear()
    return _LEXICONS.setdefault((insults, threats), Lexicon(insults, threats))


def tokens(text: bytes) -> list[str]:
    return TOKENS.findall(decoded(text).lower())


def matched_labels(text: bytes, words: Lexicon) -> np.ndarray:
    """How often the machine puts out each label over the whole text."""
    symbols = list(map(words.__getitem__, tokens(text)))
    counts = np.zeros(len(LABELS))
    if INSULT in symbols or THREAT in symbols:
        state = 0
        for symbol in symbols:
            state, label = MOVES[state][symbol]
            if label >= 0:
                counts[label] += 1
    return counts


def scores(texts: list[bytes], model: Model) -> np.ndarray:
    words = lexicon(model.insults, model.threats)
    counts = np.array([matched_labels(t, words) for t in texts]).reshape(len(texts), len(LABELS))
    return 1 / (1 + np.exp(-(np.log1p(counts) @ np.array(model.weights) + model.intercept)))


def is_held_out(key: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(quoted(key)).cast("string")), F.lit(3)) == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, text: str, key: str, label: str) -> DataFrame:
    """``text, y`` of at most ``SAMPLE`` labelled rows that are not held out, each text once."""
    known = labels.where(~is_held_out(key) & F.col(quoted(key)).isNotNull() & F.col(quoted(label)).isin(0, 1))
    chosen = known.groupBy(F.col(quoted(key)).alias("k")).agg(F.max(quoted(label)).alias("y"))
    chosen = F.broadcast(chosen.orderBy(F.xxhash64("k"), "k").limit(SAMPLE))  # SAMPLE rows of two numbers
    rows = docs.select(F.col(quoted(key)).alias("k"), F.col(quoted(text)).cast("string").alias("t")).join(chosen, "k")
    return rows.groupBy(F.sha2("t", 256).alias("d")).agg(F.first("t").alias("t"), F.max("y").alias("y")).select("t", "y")


def _stems_of(text: bytes) -> set[str]:
    words = {w for w in tokens(text) if w not in ENDS}
    return {w[:n] for w in words for n in STEMS if len(w) >= n}


def _count_stems(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the sample to how many toxic and other rows have each word beginning."""
    counts = Counter(), Counter()
    for part in parts:
        for text, y in zip(texts_of(part.column(0)), part.column(1).to_pylist(), strict=True):
            counts[y].update(_stems_of(text))
    stems = list(counts[0].keys() | counts[1].keys())
    for i in range(0, len(stems), 50_000):
        some = stems[i : i + 50_000]
        yield pa.RecordBatch.from_pydict(
            {"stem": some, "toxic": [counts[1][s] for s in some], "other": [counts[0][s] for s in some]},
            schema=pa.schema([("stem", pa.string()), ("toxic", pa.int64()), ("other", pa.int64())]),
        )


def _cover(rows: list[tuple[int, list[str]]], other: dict[str, int]) -> frozenset[str]:
    """Patterns that together explain the toxic rows, the one that explains most first; of equals the longest."""
    left = [set(stems) for y, stems in rows if y]
    gain = Counter(s for stems in left for s in stems)
    chosen: set[str] = set()
    while gain:
        best = max(gain, key=lambda s: (gain[s] - 20 * other[s], len(s), s))
        if gain[best] - 20 * other[best] < LEAST_GAIN:
            break
        chosen.add(best)
        for stems in [stems for stems in left if best in stems]:
            gain.subtract(stems)
        left = [stems for stems in left if best not in stems]
    return frozenset(chosen)


def _regress(counts: np.ndarray, y: np.ndarray, penalty: float = 0.01) -> np.ndarray:
    """Logistic regression by Newton steps; the intercept is last."""
    x = np.hstack([np.log1p(counts), np.ones((len(y), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        w -= np.clip(np.linalg.solve(curve, slope), -4, 4)
    return w


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic") -> Model:
    """Learn patterns and weights from at most ``SAMPLE`` labelled rows whose key is not held out.

    Rows with a null key or label, and labels other than 0 and 1, teach nothing. If labels or one of their classes are
    missing, the fixed words count with fixed weights. The driver holds the sample's pattern matches, never its texts.
    """
    insults, threats = frozenset(INSULTS.split()), frozenset(THREATS.split())
    rows = sample(docs, labels, text, key, label).persist()
    try:
        stems = rows.mapInArrow(_count_stems, "stem string, toxic long, other long").groupBy("stem")
        stems = stems.agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).where("toxic >= 2 AND other * 20 < toxic")
        other = {r["stem"]: r["other"] for r in stems.orderBy(F.desc("toxic"), "stem").limit(CANDIDATES).collect()}
        wanted = frozenset(other)

        def matches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                found = [sorted(_stems_of(t) & wanted) for t in texts_of(part.column(0))]
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(found, pa.list_(pa.string()))], ["y", "stems"])

        toxic = rows.where("y = 1").mapInArrow(matches, "y int, stems array<string>")
        learned = _cover([(r["y"], r["stems"]) for r in toxic.collect()], other)
        insults |= learned
        known = _counted(rows, insults, threats)
    finally:
        rows.unpersist()
    y = np.array([k[0] for k in known], float)
    if len(set(y)) < 2:
        return Model(insults, threats, tuple(6.0 if ("negated", False) in name else 1.0 for name in LABELS), -3.0)
    weights = _regress(np.array([k[1] for k in known]), y)
    return Model(insults, threats, tuple(weights[:-1].tolist()), float(weights[-1]))


def _counted(rows: DataFrame, insults: frozenset[str], threats: frozenset[str]) -> list[tuple[int, list[float]]]:
    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = lexicon(insults, threats)
        for part in parts:
            counts = [matched_labels(t, words) for t in texts_of(part.column(0))]
            yield pa.RecordBatch.from_arrays([part.column(1), pa.array(counts, pa.list_(pa.float64()))], ["y", "counts"])

    return [(r["y"], r["counts"]) for r in rows.mapInArrow(task, "y int, counts array<double>").collect()]


def with_scores(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text, 0 to 1; null and empty texts get the score of no match.

    Rows stay as they are, repeats included; a column of the same name is replaced. There is no shuffle.
    """
    return with_arrow(docs, name, text, "double", lambda texts: pa.array(scores(texts, model), pa.float64()))


def accepted(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold, learned from ``labels``.

    Null, empty and very long texts are scored as any other, whole; repeated rows and equal keys fare alike; other columns
    stay, ``score`` among them. Empty ``docs`` give an empty result, without labels the given patterns decide.
    """
    (name,) = fresh(docs, "score")
    return with_scores(docs, fit(docs, labels, text, key), text, name).where(F.col(name) < THRESHOLD).drop(name)
