"""Suffix order and longest-previous-factor arrays of one byte buffer, vectorised over all its suffixes.

Suffixes are ranked by their first 8, 16, 32 ... bytes: a rank of twice the length comes from two ranks of half of it, and
only suffixes that still share a rank are sorted again. In suffix order, the nearest suffixes before and after one that
start earlier in the text (previous and next smaller positions) include its longest earlier match.
"""

from __future__ import annotations

import numpy as np

FIRST = 8


class SuffixRanks:
    """Ranks of all suffixes by their first ``limit`` bytes, and of the steps on the way there."""

    def __init__(self, text: np.ndarray, limit: int):
        if limit < FIRST:
            raise ValueError(f"limit must be {FIRST} at least")
        self.text, self.limit, n = text, limit, len(text)
        padded = np.concatenate([text, np.zeros(FIRST, np.uint8)]).astype(np.uint64)
        key = np.zeros(n, np.uint64)
        for i in range(FIRST):
            key = (key << np.uint64(8)) | padded[i : i + n]
        self.shared = np.arange(n)
        rank = self._refine(np.zeros(n, np.int64), key)
        # A suffix that ends early comes before one that goes on with zeros.
        rank = self._refine(rank, self._joined(rank, np.minimum(n - self.shared, FIRST)))
        self.levels, length = [(FIRST, rank)], FIRST
        while length < limit:
            step = min(length, limit - length)
            at = self.shared + step
            # What is past the end is less than any rank.
            later = np.where(at < n, rank[np.minimum(at, n - 1)] + 1, 0)
            rank = self._refine(rank, self._joined(rank, later))
            length += step
            self.levels.append((length, rank))
        self.rank = rank

    def _joined(self, rank: np.ndarray, later: np.ndarray) -> np.ndarray:
        return rank[self.shared] * (len(self.text) + FIRST) + later

    def _refine(self, rank: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Split the classes of ``self.shared`` by ``key``, which orders whole classes too.

        A class's rank is the number of suffixes before it.
        """
        if not len(self.shared):
            return rank
        order = np.argsort(key)
        key, at = key[order], self.shared[order]
        own, place = rank[at], np.arange(len(at))
        new_class = np.append(True, own[1:] != own[:-1])
        new_key = np.append(True, key[1:] != key[:-1])
        class_start = np.maximum.accumulate(np.where(new_class, place, 0))
        key_start = np.maximum.accumulate(np.where(new_key, place, 0))
        out = rank.copy()
        out[at] = own + key_start - class_start
        alone = new_key & np.append(new_key[1:], True)
        self.shared = at[~alone]
        return out

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common beginning of suffixes a and b, up to ``limit``."""
        n, same = len(self.text), np.zeros(len(a), np.int64)
        for length, rank in reversed(self.levels):
            fits = (same + length <= self.limit) & self._agrees(rank, a, b, same)
            same = np.where(fits, same + length, same)
        for _ in range(FIRST - 1):
            at, other = a + same, b + same
            inside = (np.maximum(at, other) < n) & (same < self.limit)
            equal = inside & (self.text[np.minimum(at, n - 1)] == self.text[np.minimum(other, n - 1)])
            same = same + equal
        # Zeros after the end may have looked like bytes of the text.
        return np.minimum(same, n - np.maximum(a, b))

    def _agrees(self, rank: np.ndarray, a: np.ndarray, b: np.ndarray, shift: np.ndarray) -> np.ndarray:
        n = len(self.text)
        at, other = a + shift, b + shift
        inside = np.maximum(at, other) < n
        return inside & (rank[np.minimum(at, n - 1)] == rank[np.minimum(other, n - 1)])


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """Index of the nearest earlier value that is smaller, or -1; all at once, by jumping over larger ones."""
    out = np.arange(len(values)) - 1
    open_ = np.flatnonzero((out >= 0) & (values[out] >= values)) if len(values) else np.empty(0, np.int64)
    while len(open_):
        # A pointer may jump to where its target points: all between are larger than the target.
        out[open_] = out[out[open_]]
        open_ = open_[(out[open_] >= 0) & (values[out[open_]] >= values[open_])]
    return out


def longest_previous_factors(ranks: SuffixRanks, starts: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each suffix of ``starts`` the length of its longest match with another one that is earlier by ``order``.

    ``order`` gives each start's place in time; lengths stop at the ranks' limit.
    """
    by_suffix = np.lexsort((order, ranks.rank[starts]))
    sa, time = starts[by_suffix], order[by_suffix]
    before = previous_smaller(time)
    after = len(sa) - 1 - previous_smaller(time[::-1])[::-1]
    out = np.zeros(len(sa), np.int64)
    for other in (before, after):
        known = np.flatnonzero((other >= 0) & (other < len(sa)))
        out[known] = np.maximum(out[known], ranks.common(sa[known], sa[other[known]]))
    lengths = np.zeros(len(sa), np.int64)
    lengths[by_suffix] = out
    return lengths
