"""Hashes of the words of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

#: Odd, so that it has an inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def randoms(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept between calls up to a size of two million."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1), base, dtype=np.uint64)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        if n <= 1 << 21:
            _powers[base] = known
    return known[:n]


def separators(word: str) -> np.ndarray:
    """Which bytes separate words: ``space`` for ASCII white space, ``other`` for every ASCII byte but letters and digits."""
    out = np.zeros(256, dtype=bool)
    if word == "space":
        out[[0x20, *range(0x09, 0x0E)]] = True
    else:
        out[:128] = True
        out[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False
    return out


_CODES = randoms(256, 7)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def word_spans(texts: list[str], separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts as lower-cased bytes, where each word begins and ends, and where each text's words start.

    Words are runs of bytes that are no separators; of letters only A-Z are lower-cased. The last array has
    one more entry than there are texts.
    """
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([0] + [len(p) + 1 for p in parts], dtype=np.int64)
    data = _LOWER[np.frombuffer(b"\n".join([*parts, b""]), dtype=np.uint8)]
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~separator[data]
    edge = np.flatnonzero(np.diff(inside))
    first, last = edge[0::2], edge[1::2]
    return data, first, last, np.searchsorted(first, ends).astype(np.int64)


def span_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of each of the given runs of bytes; equal runs have equal hashes."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_CODES[data] * powers(_BASE, len(data)), out=total[1:])
    here = (total[last] - total[first]) * powers(_BASE_INVERSE, len(data) + 1)[first]
    return mix(here + (last - first).astype(np.uint64))


def word_hashes(texts: list[str], separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of all texts, and where each text's words start (one more entry than texts)."""
    data, first, last, at = word_spans(texts, separator)
    return span_hashes(data, first, last), at


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words; the whole sequence as one if it is shorter; of none if it is empty."""
    if len(words) == 0:
        return words
    n_here = min(n, len(words))
    factors = randoms(n_here, 11)
    out = np.full(len(words) - n_here + 1, n_here, dtype=np.uint64)
    for i in range(n_here):
        out += words[i : i + len(out)] * factors[i]
    return mix(out)


def batches(texts: list[str], size: int = 1 << 20):
    """Ranges of rows of about ``size`` characters; a longer text is a range by itself."""
    start = used = 0
    for i, t in enumerate(texts):
        if used and used + len(t) > size:
            yield start, i
            start, used = i, 0
        used += len(t)
    if start < len(texts):
        yield start, len(texts)
