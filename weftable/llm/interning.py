"""Encoding each distinct chunk of text once, within a bounded store."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable, Sequence
from itertools import chain

import numpy as np


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` that begin at ``starts``, one after another."""
    before = np.cumsum(sizes) - sizes
    return flat[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


class _Codes(dict):
    """Gives each new chunk the next number and notes it as pending."""

    def __init__(self) -> None:
        super().__init__()
        self.pending: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = n = len(self)
        self.pending.append(chunk)
        return n


class ChunkEncoder:
    """Ids of sequences of chunks.

    ``encode`` returns the ids of some chunks in one array, and the number of ids of each. The first ``most``
    chunks are kept, and frequent ones are among the first; later ones are kept until the call ends.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = 250_000) -> None:
        self._encode = encode
        self._most = most
        self._codes = _Codes()
        self._starts = np.zeros(0, dtype=np.int64)
        self._sizes = np.zeros(0, dtype=np.int64)
        self._flat = np.zeros(0, dtype=np.int32)

    def ids(self, documents: list[list[str]]) -> list[np.ndarray]:
        """The ids of each document's chunks, one after another."""
        counts = np.array([len(d) for d in documents], dtype=np.int64)
        return self._runs(self._numbers(chain.from_iterable(documents), int(counts.sum())), counts)

    def ids_of(self, chunks: Sequence[Hashable], places: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
        """The same for documents of ``counts`` chunks each, given by their ``places`` among different ``chunks``."""
        return self._runs(self._numbers(chunks, len(chunks)), counts, places)

    def _numbers(self, chunks: Iterable[Hashable], n: int) -> np.ndarray:
        return np.fromiter(map(self._codes.__getitem__, chunks), dtype=np.int64, count=n)

    def _runs(self, codes: np.ndarray, counts: np.ndarray, places: np.ndarray | None = None) -> list[np.ndarray]:
        new = self._codes.pending
        starts, all_sizes, flat = self._starts, self._sizes, self._flat
        if new:
            kept = len(self._codes) - len(new)
            ids, sizes = self._encode(new)
            starts = np.concatenate((starts, len(flat) + np.cumsum(sizes) - sizes))
            all_sizes = np.concatenate((all_sizes, sizes))
            flat = np.concatenate((flat, ids))
            self._codes.pending = []
            room = max(0, self._most - kept)
            for chunk in new[room:]:
                del self._codes[chunk]
            if room:
                end = kept + min(room, len(new))
                last = int(starts[end - 1] + all_sizes[end - 1])
                self._starts, self._sizes, self._flat = starts[:end].copy(), all_sizes[:end].copy(), flat[:last].copy()
        if places is not None:
            codes = codes[places]
        sizes = all_sizes[codes]
        cuts = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(counts)))]
        out = gather(flat, starts[codes], sizes)
        return [out[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
