"""Token counts of whole texts under a public byte-level BPE vocabulary with word ends.

The merges run on ragged numpy arrays: all pre-tokens of a batch lie end to end in one symbol array. In a round every
pre-token applies its own lowest-ranked pair wherever it occurs, all pre-tokens at once; a pre-token retires when none
of its pairs has a rank. The symbols that survive are the tokens.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from larder.llm.common import decoded, groups, remembered, takes_worker, with_arrow

# Fixed value: characters that the vocabulary's rules call white space.
SPACES = "\t\n\x0b\x0c\r\x20\x85\xa0  -     　"
CHUNKS = regex.compile(f"[^{SPACES}]+")
# Python's str.split also cuts at these, the vocabulary's rules do not.
ODD_SPLITS = regex.compile("[\x1c-\x1f]")
NO_RANK = np.iinfo(np.int64).max


def chunks(text: str) -> list[str]:
    """Maximal runs without white space. No token of the vocabulary spans two of them."""
    return CHUNKS.findall(text) if ODD_SPLITS.search(text) else text.split()


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary: itself, or one above U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class Splitter:
    """The vocabulary's rules before the merges: special strings, normal form, lower case, pre-tokens."""

    def __init__(self, spec: dict):
        steps = spec["pre_tokenizer"]["pretokenizers"]
        words = next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split")
        self.words, self.words_and_ends = regex.compile(words), regex.compile(words + "|\n")
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

    @staticmethod
    def normal(text: str) -> str:
        # Lower case letter by letter: a sigma at a word's end is not special here.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def has_special(self, chunk: str) -> bool:
        return self.special is not None and self.special.search(chunk) is not None

    def parts(self, chunk: str) -> tuple[list[str], int]:
        """The pre-tokens of one chunk, and how many special strings stand between them."""
        parts = self.special.split(chunk) if self.special else [chunk]
        return [w for part in parts[::2] for w in self.words.findall(self.normal(part))], len(parts) // 2

    def flat(self, some: list[str]) -> list[str]:
        """The pre-tokens of all chunks in one list, with a line end after each chunk; no chunk may hold a special string."""
        return self.words_and_ends.findall(self.normal("\n".join(some)) + "\n") if some else []

    def plain(self, some: list[str]) -> Iterator[list[str]]:
        """The pre-tokens of each chunk."""
        own: list[str] = []
        for word in self.flat(some):
            if word == "\n":
                yield own
                own = []
            else:
                own.append(word)


class RankTable:
    """The vocabulary's pairs as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, letters = spec["model"], byte_letters()
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        self.inner = np.array([vocab[x] for x in letters], np.int64)
        self.last = np.array([vocab[x + end] for x in letters], np.int64)
        self.width = max(vocab.values()) + 1
        pairs = [(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        codes = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(codes)
        self.codes, self.ranks = codes[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.split = Splitter(spec)

    def surviving(self, words: list[bytes]) -> np.ndarray:
        """How many symbols are left of each pre-token after all merges."""
        sizes = np.array([len(w) for w in words], np.int64)
        left = sizes.copy()
        flat = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[flat]
        ends = np.cumsum(sizes) - 1
        symbols[ends] = self.last[flat[ends]]
        owner = np.repeat(np.arange(len(words)), sizes)
        while len(symbols) > 1:
            code = symbols[:-1] * self.width + symbols[1:]
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            known = (self.codes[at] == code) & (owner[:-1] == owner[1:])
            rank = np.append(np.where(known, self.ranks[at], NO_RANK), NO_RANK)
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(owner))))
            pick = (rank == lowest) & (rank != NO_RANK)
            # In a run such as aaaa the same pair overlaps itself: every other one counts, from the left.
            place = np.arange(len(pick))
            run = np.maximum.accumulate(np.where(pick, -1, place))
            pick &= (place - run) % 2 == 1
            symbols[pick] = self.merged[rank[pick]]
            np.subtract.at(left, owner[pick], 1)
            stay = lowest != NO_RANK
            stay[1:] &= ~pick[:-1]
            symbols, owner = symbols[stay], owner[stay]
        return left


@lru_cache(maxsize=4)
def table(path: str) -> tuple[RankTable, dict[str, int]]:
    """The rank table of a worker process and its memory of chunks."""
    return RankTable(path), {}


def count_chunks(ranks: RankTable, new: list[str]) -> list[int]:
    odd = {c: ranks.split.parts(c) for c in new if ranks.split.has_special(c)}
    plain = zip([c for c in new if c not in odd], ranks.split.plain([c for c in new if c not in odd]), strict=True)
    words = {c: own for c, own in plain} | {c: own for c, (own, _) in odd.items()}
    distinct = list({w for own in words.values() for w in own})
    left = ranks.surviving([w.encode() for w in distinct]).tolist() if distinct else []
    size = dict(zip(distinct, left, strict=True))
    return [sum(map(size.__getitem__, words[c])) + (odd[c][1] if c in odd else 0) for c in new]


def count_texts(texts: list[bytes], path: str) -> list[int]:
    takes_worker("token_counts", table.cache_clear)
    ranks, cache = table(path)
    counts: list[int] = []
    for some in groups(texts):
        split = [chunks(decoded(text)) for text in some]
        known = remembered(cache, set().union(*split), lambda new: count_chunks(ranks, new))
        counts += [sum(map(known.__getitem__, own)) for own in split]
    return counts


def with_token_counts(
    docs: DataFrame, tokenizer: str, text: str = "text", name: str = "n_tokens", limit: int | None = None
) -> DataFrame:
    """``docs`` with ``n_tokens``, and with ``over_limit`` (more than ``limit``) if a limit is given.

    ``tokenizer`` is the path of the vocabulary file on every executor. Begin, end and added tokens are not counted;
    special strings inside a text count as one token each. A null or empty text has 0 tokens. Texts are never cut.
    Rows stay as they are, ties and repeats included; existing columns of the new names are replaced. There is no
    shuffle.
    """
    out = with_arrow(docs, name, text, "long", lambda texts: pa.array(count_texts(texts, tokenizer), pa.int64()))
    return out if limit is None else out.withColumn("over_limit", out[name] > limit)
