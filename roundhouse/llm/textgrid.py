"""Words and word hashes of many texts at once, as NumPy arrays.

A word is a run of letters, digits, marks and underscores, compared in lower case. Code points from
0x20000 on count as letters.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = 1 << 20


@cache
def _lowered() -> np.ndarray:
    """Code point -> its lower case if it belongs to a word, else 0."""
    out = np.zeros(0x20000, np.uint32)
    for point in range(0x20000):
        char = chr(point)
        if char.isalnum() or char == "_" or unicodedata.category(char)[0] == "M":
            low = char.lower()
            out[point] = ord(low) if len(low) == 1 else point
    return out


@cache
def _few_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(_STEP)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    with np.errstate(over="ignore"):
        return tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, x, np.uint64)])) for x in (_BASE, inverse))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(32))


class WordGrid:
    """starts, ends: places of words; doc: the text of each word; hashes: 64 bits of each word."""

    def __init__(self, texts: list[str]):
        self.size = len(texts)
        points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.text_ends = np.cumsum([len(x) + 1 for x in texts], dtype=np.int64)
        self.points = points
        table = _lowered()
        low = table[np.minimum(points, 0x1FFFF)]
        if len(points) and points.max() >= 0x20000:
            low = np.where(points >= 0x20000, points, low)
        inside = low > 0
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edge = np.concatenate([[0], edge])
        self.starts, self.ends = edge[::2], edge[1::2]
        self.doc = np.searchsorted(self.text_ends, self.starts, side="right")
        up, self._down = _few_powers() if len(points) <= _STEP else _powers(len(points))  # those of a very long text aren't kept
        with np.errstate(over="ignore"):
            self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[: len(low)], dtype=np.uint64)])
        self.hashes = self.hash_of(self.starts, self.ends)

    def hash_of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of the lowered code points from starts to ends, the same wherever they stand."""
        return mix((self._sums[ends] - self._sums[starts]) * self._down[starts] + (ends - starts).astype(np.uint64))

    def words_per_text(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.size)


def shingles(grid: WordGrid, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of `width` words and the text of each; a shorter text with words has one run, all its words."""
    words, counts = grid.hashes, grid.words_per_text()
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    runs = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    doc = np.repeat(np.arange(grid.size), runs)
    at = np.arange(runs.sum()) - np.repeat(np.concatenate([[0], np.cumsum(runs)])[:-1], runs) + np.repeat(first, runs)
    left = np.repeat(first + counts, runs) - at
    out = np.zeros(len(at), np.uint64)
    for k in range(width):
        own = words[np.minimum(at + k, max(len(words) - 1, 0))] if len(words) else out
        out = mix(out + np.where(left > k, own, np.uint64(0)) + np.uint64(k + 1))
    return out, doc
