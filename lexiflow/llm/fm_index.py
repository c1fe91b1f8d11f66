"""A compressed FM-index of one shard: a wavelet matrix over the Burrows-Wheeler transform of its words.

The suffix array is sorted by the first `depth` words alone, which is all that patterns of at most that length need: of the suffixes
that begin with a pattern, all stand together, and stepping back from them lands where the longer pattern's suffixes do.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with rank: 64-bit words, and the count of ones before each."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n + 64) // 64 * 64, dtype=np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))]).astype(np.uint32)
        self.zeros = n - int(self.before[-1])

    def ones(self, i: np.ndarray) -> np.ndarray:
        """How many ones stand before each place."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word].astype(np.int64) + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Ranks of symbols in a sequence, a bit vector for each bit of a symbol."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = []
        self.bits = max(1, int(sigma - 1).bit_length())
        now = symbols
        for b in range(self.bits - 1, -1, -1):
            bit = (now >> b) & 1
            self.levels.append((b, Bits(bit.astype(np.uint8))))
            now = np.concatenate([now[bit == 0], now[bit == 1]])
        self.begin = self._walk(np.arange(sigma), np.zeros(sigma, dtype=np.int64))

    def _walk(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for b, level in self.levels:
            one = level.ones(i)
            i = np.where((c >> b) & 1 == 1, level.zeros + one, i - one)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol c stands before place i."""
        return self._walk(c, i) - self.begin[c]


def sorted_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of the text by the `depth` symbols that start there; equal ones in the order of the text."""
    n = len(text)

    def joined(a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
        later = np.zeros(n, dtype=np.int64)
        later[: n - step] = b[step:] + 1
        key = a * (int(b.max()) + 2) + later
        order = np.argsort(key, kind="stable")
        fresh = np.concatenate([[0], (np.diff(key[order]) != 0).astype(np.int64)])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(fresh)
        return rank

    ranks = {1: text.astype(np.int64)}
    size = 1
    while size * 2 <= depth:
        ranks[size * 2] = joined(ranks[size], ranks[size], size)
        size *= 2
    now, left = ranks[size], depth - size
    at = size
    while left:
        step = 1 << (left.bit_length() - 1)
        now = joined(now, ranks[step], at)
        at += step
        left -= step
    return np.argsort(now, kind="stable")


class FMIndex:
    def __init__(self, text: np.ndarray, sigma: int, depth: int):
        self.text, self.depth = text, depth
        self.places = sorted_suffixes(text, depth)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        self.wavelet = WaveletMatrix(text[self.places - 1], sigma)

    def matching(self, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each place of the text just after a word: how many of the words before it, up to depth, stand elsewhere in the text
        too, one after another (the matching statistic), and the range of suffixes that begin with as many."""
        lo, hi = np.zeros(len(ends), dtype=np.int64), np.full(len(ends), len(self.text), dtype=np.int64)
        length = np.zeros(len(ends), dtype=np.int64)
        live = np.arange(len(ends))
        for step in range(1, self.depth + 1):
            c = self.text[ends[live] - step]
            both = self.wavelet.rank(np.concatenate([c, c]), np.concatenate([lo[live], hi[live]]))
            new_lo, new_hi = self.before[c] + both[: len(c)], self.before[c] + both[len(c) :]
            more = new_hi - new_lo > 1  # besides the word itself
            live = live[more]
            if not len(live):
                break
            lo[live], hi[live], length[live] = new_lo[more], new_hi[more], step
        return length, lo, hi
