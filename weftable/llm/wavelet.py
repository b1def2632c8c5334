"""Wavelet matrix: counts of any symbol before any place of a sequence, in numpy.

Level by level, from the highest bit, the sequence is parted stably into symbols with a zero and with a one; each
level keeps its bits in words of 64 with the ones before each word. A rank is one lookup a level, for all queries at once.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with the number of ones before any place."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.bits, self.levels = bits, []
        for level in range(bits):
            ones = (symbols >> (bits - 1 - level)) & 1 == 1
            self.levels.append((Bits(ones), int(len(symbols) - np.count_nonzero(ones))))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, (ones, zeros) in enumerate(self.levels):
            rank = ones.rank(at)
            at = np.where((symbols >> (self.bits - 1 - level)) & 1 == 1, zeros + rank, at - rank)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each of ``symbols`` lies before each place: one row per symbol, one column per place."""
        symbols = np.asarray(symbols)[:, None]
        grid = np.broadcast_to(at, (len(symbols), len(at)))
        return self._down(symbols, grid) - self._down(symbols, np.zeros((len(symbols), 1), dtype=np.int64))

    def count(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How many symbols of a set lie before each place."""
        return self.rank(symbols, at).sum(axis=0)

    def place(self, symbols: np.ndarray, k: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Least place in lo..hi before which ``k`` or more symbols of the set lie, by bisection on their ranks; else ``hi``."""
        lo, hi = lo.copy(), hi.copy()
        while (open_ := lo < hi).any():
            middle = (lo + hi) >> 1
            enough = self.count(symbols, middle) >= k
            hi = np.where(open_ & enough, middle, hi)
            lo = np.where(open_ & ~enough, middle + 1, lo)
        return lo
