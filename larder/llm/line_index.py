"""Minimal perfect hash of 128-bit keys in numpy: a shard of an index that arrays follow.

Levels of bit arrays: a key's place on a level is a hash of key and level; a place that one key alone has is set and is
that key's, keys that share a place go on to the next level. A key's number is the count of set places before its own,
over all levels. Twice as many places as keys are left make a level, so 0.6 of them settle on each and about four bits a
key are kept. A key that is none of the shard's may get a number too; the fingerprint stored under it tells.
"""

from __future__ import annotations

import numpy as np

PLACES = 2
_A = 0x9E3779B97F4A7C15
_B, _C = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _places(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
    step = np.uint64((level + 1) * _A % (1 << 64))
    return (_mixed(high ^ _mixed(low + step)) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Numbers 0 to n - 1 of n distinct keys, given as their high and low 64 bits."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before, self.n = [], 0
        for bits in levels:
            self.before.append(self.n + np.cumsum(bits) - bits)
            self.n += int(np.count_nonzero(bits))

    @classmethod
    def of(cls, high: np.ndarray, low: np.ndarray) -> PerfectHash:
        levels = []
        while len(high):
            size = PLACES * len(high)
            at = _places(high, low, len(levels), size)
            bits = np.bincount(at, minlength=size) == 1
            levels.append(bits)
            left = ~bits[at]
            high, low = high[left], low[left]
        return cls(levels)

    def numbers(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Each key's number; -1 where no level has its place, any number for other unknown keys."""
        out, open_ = np.full(len(high), -1, np.int64), np.arange(len(high))
        for level, (bits, before) in enumerate(zip(self.levels, self.before, strict=True)):
            at = _places(high[open_], low[open_], level, len(bits))
            found = bits[at]
            out[open_[found]] = before[at[found]]
            open_ = open_[~found]
        return out

    def packed(self) -> tuple[list[int], bytes]:
        return [len(bits) for bits in self.levels], b"".join(np.packbits(bits).tobytes() for bits in self.levels)

    @classmethod
    def unpacked(cls, sizes: list[int], raw: bytes) -> PerfectHash:
        levels, at = [], 0
        for size in sizes:
            width = -(-size // 8)
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, width, at), count=size).astype(bool))
            at += width
        return cls(levels)
