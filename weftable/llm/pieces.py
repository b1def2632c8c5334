"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

A text is cut before each run of white space marks and around line breaks, which no piece crosses. Distinct words of equal length
advance together: hashes of all their substrings that end at a place probe the sorted keys of the pieces,
the best of them is a maximum over an array, and its start is the backpointer. A character that no
piece covers becomes its UTF-8 bytes. A word of more than ``LONG`` characters, such as a text without spaces, goes alone: all its substrings
that are pieces are found first, a block of places at once, and one walk over them keeps the best. Hashes have 64 bits and differ between all pieces; ``exact`` in the result
would show a text that a chance equality has changed.

The best segmentation is the one of largest total score, ties to the longer last piece, in the 32-bit arithmetic
that the format's own unigram search uses. A unigram model's scores are log-probabilities. A model trained by merges
stores the negative rank of each merge instead; ``scores="zipf"`` takes -ln(1 + rank), the log-probability up to
a constant if frequency falls with rank, ``scores="model"`` takes what is stored.

Defined cases: a null text is empty, an empty text has no ids; U+2581 counts as a space, as the format has no
other way to write it, so it decodes as a space; all other texts come back unchanged; equal rows give equal rows;
an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import batches, mix, powers
from .interning import ChunkEncoder, gather
from .workers import kept, tasks_of

SPACE = "▁"
BREAK = "\n"
CHUNK = re.compile(f"{SPACE}+[^{SPACE}{BREAK}]*|{BREAK}|[^{SPACE}{BREAK}]+")
UNKNOWN_PENALTY = 10.0
CELLS = 1 << 17
LONG, PLACES = 256, 1 << 15

_BASE = 0xD6E8FEB86659FD93
_LIKELY_BITS = 20
_LIKELY_SHIFT = np.uint64(64 - _LIKELY_BITS)
_INVERSE = pow(_BASE, -1, 1 << 64)


def _points(words: list[str], length: int) -> np.ndarray:
    data = "".join(words).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(data, dtype=np.uint32).reshape(len(words), length)


class Pieces:
    """The pieces of a model file, sorted by hash."""

    def __init__(self, path: str, scores: str = "zipf") -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(size)]
        normal = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.byte = np.full(256, -1, dtype=np.int32)
        spelt = [b""] * size
        for i in range(size):
            if model.is_byte(i):
                value = int(self.text[i][1:-1], 16)
                self.byte[value] = i
                spelt[i] = bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i)):
                spelt[i] = self.text[i].encode("utf-8")
        self.spelt = np.frombuffer(b"".join(spelt), dtype=np.uint8)
        self.spelt_sizes = np.array([len(x) for x in spelt], dtype=np.int64)
        self.spelt_starts = np.cumsum(self.spelt_sizes) - self.spelt_sizes
        if self.byte.min() < 0:
            raise ValueError("the model has no byte pieces")
        self.longest = max(len(self.text[i]) for i in normal)
        if any(SPACE in self.text[i].lstrip(SPACE) for i in normal):
            raise ValueError("a piece has a space after another character")
        if any(BREAK in self.text[i] for i in normal):
            raise ValueError("a piece has a line break")
        stored = np.array([model.get_score(i) for i in normal], dtype=np.float32)
        value = stored if scores == "model" else -np.log1p(-stored.astype(np.float64)).astype(np.float32)
        keys = np.zeros(len(normal), dtype=np.uint64)
        sizes = np.array([len(self.text[i]) for i in normal])
        for n in np.unique(sizes):
            at = np.flatnonzero(sizes == n)
            points = _points([self.text[normal[i]] for i in at], int(n))
            keys[at] = _substring_hashes(_prefix_sums(points), 0, int(n))
        order = np.argsort(keys)
        self.keys = keys[order]
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two pieces have the same hash")
        self.ids = np.array(normal, dtype=np.int32)[order]
        self.scores = value[order]
        self.likely = np.zeros(1 << _LIKELY_BITS, dtype=bool)
        self.likely[self.keys >> _LIKELY_SHIFT] = True
        self.unknown = np.float32(value.min()) - np.float32(UNKNOWN_PENALTY)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and the number of ids of each."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        counts = np.zeros(len(words), dtype=np.int64)
        parts: list[np.ndarray] = []
        places: list[np.ndarray] = []
        for n in np.unique(lengths[lengths > 0]):
            at = np.flatnonzero(lengths == n)
            if n > LONG:
                for i in at:
                    parts.append(self._viterbi_long(words[i]))
                    counts[i] = len(parts[-1])
                    places.append(np.array([i]))
                continue
            step = max(1, CELLS // int(n))
            for lo in range(0, len(at), step):
                part = at[lo : lo + step]
                ids, counts[part] = self._viterbi([words[i] for i in part], int(n))
                parts.append(ids)
                places.append(part)
        if not parts:
            return np.zeros(0, np.int32), counts
        order = np.concatenate(places)
        flat, sizes = np.concatenate(parts), counts[order]
        starts = np.zeros(len(words), dtype=np.int64)
        starts[order] = np.cumsum(sizes) - sizes
        return gather(flat, starts, counts), counts

    def _viterbi(self, words: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of ``n`` characters; arrays have a row for each place and a column for each word."""
        points = _points(words, n)
        sums = _prefix_sums(points)
        best = np.full((n + 1, len(words)), -np.inf, dtype=np.float32)
        best[0] = 0
        back = np.zeros((n + 1, len(words)), dtype=np.int32)
        piece = np.full((n + 1, len(words)), -1, dtype=np.int32)
        for end in range(1, n + 1):
            for start in range(max(0, end - self.longest), end):
                h = _substring_hashes(sums, start, end)
                found = np.flatnonzero(self.likely[h >> _LIKELY_SHIFT])
                at = np.minimum(np.searchsorted(self.keys, h[found]), len(self.keys) - 1)
                hit = self.keys[at] == h[found]
                found, at = found[hit], at[hit]
                if start == end - 1:
                    rare = np.ones(len(words), dtype=bool)
                    rare[found] = False
                    rare &= best[start] + self.unknown > best[end]
                    best[end, rare], back[end, rare], piece[end, rare] = best[start, rare] + self.unknown, start, -1
                score = best[start, found] + self.scores[at]
                better = score > best[end, found]
                found, at = found[better], at[better]
                best[end, found], back[end, found], piece[end, found] = score[better], start, self.ids[at]
        return self._trace(words, n, back, piece)

    def _found(self, sums: np.ndarray, inverse: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, ...]:
        """The pieces that end at the places from ``lo`` to ``hi`` of a word: end, start and row of each, by end, longer ones first."""
        ends, starts, rows = [], [], []
        for size in range(min(self.longest, hi - 1), 0, -1):
            end = np.arange(max(lo, size), hi)
            start = end - size
            h = (sums[end] - sums[start]) * inverse[start] + np.uint64(size * _BASE & (1 << 64) - 1)
            some = np.flatnonzero(self.likely[h >> _LIKELY_SHIFT])
            at = np.minimum(np.searchsorted(self.keys, h[some]), len(self.keys) - 1)
            hit = self.keys[at] == h[some]
            ends.append(end[some[hit]])
            starts.append(start[some[hit]])
            rows.append(at[hit])
        end, start, row = (np.concatenate(x) for x in (ends, starts, rows))
        order = np.lexsort((start, end))
        return end[order], start[order], row[order]

    def _viterbi_long(self, word: str) -> np.ndarray:
        """Ids of one long word; the same sums and ties as for short ones."""
        n = len(word)
        sums, inverse = _prefix_sums(_points([word], n))[:, 0], powers(_INVERSE, n + 1)
        least = np.float32(-np.inf)
        best, back, piece = [np.float32(0)], np.zeros(n + 1, dtype=np.int64), np.full(n + 1, -1, dtype=np.int64)
        for lo in range(1, n + 1, PLACES):
            hi = min(lo + PLACES, n + 1)
            end, start, row = self._found(sums, inverse, lo, hi)
            cuts = np.searchsorted(end, np.arange(lo, hi + 1)).tolist()
            starts, scores, ids = start.tolist(), list(self.scores[row]), self.ids[row].tolist()
            for place in range(lo, hi):
                top, first, which, alone = least, place - 1, -1, True
                for i in range(cuts[place - lo], cuts[place - lo + 1]):
                    value = best[starts[i]] + scores[i]
                    alone = alone and starts[i] != place - 1
                    if value > top:
                        top, first, which = value, starts[i], ids[i]
                if alone and best[place - 1] + self.unknown > top:
                    top, first, which = best[place - 1] + self.unknown, place - 1, -1
                best.append(top)
                back[place], piece[place] = first, which
        out: list[int] = []
        place = n
        while place:
            first = int(back[place])
            raw = word[first:place].encode("utf-8", "surrogatepass") if piece[place] < 0 else b""
            out += [int(self.byte[b]) for b in reversed(raw)] if raw else [int(piece[place])]
            place = first
        return np.array(out[::-1], dtype=np.int32)

    def _trace(self, words: list[str], n: int, back: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Follows all backpointers at once, from the last character to the first."""
        out = np.full((len(words), n), -1, dtype=np.int32)
        counts = np.zeros(len(words), dtype=np.int64)
        live, end = np.arange(len(words)), np.full(len(words), n)
        while len(live):
            counts[live] += 1
            out[live, n - counts[live]] = piece[end, live]
            end = back[end, live]
            live, end = live[end > 0], end[end > 0]
        within = np.arange(n)[None, :] >= (n - counts)[:, None]
        unknown = np.flatnonzero(((out < 0) & within).any(axis=1))
        flat, starts = out[within], np.cumsum(counts) - counts
        runs, total = [flat], len(flat)
        for w in unknown:
            spelt: list[int] = []
            place = n
            while place:
                start = int(back[place, w])
                raw = words[w][start:place].encode("utf-8", "surrogatepass")
                spelt += [int(piece[place, w])] if piece[place, w] >= 0 else [int(self.byte[b]) for b in reversed(raw)]
                place = start
            starts[w], counts[w] = total, len(spelt)
            total += len(spelt)
            runs.append(np.array(spelt[::-1], dtype=np.int32))
        return (gather(np.concatenate(runs), starts, counts) if len(unknown) else flat), counts

    def decode(self, documents: list[np.ndarray]) -> list[str]:
        """The texts of the ids, without the space that encoding puts first."""
        ids = np.concatenate([np.zeros(0, np.int64), *documents]).astype(np.int64)
        sizes = self.spelt_sizes[ids]
        data = gather(self.spelt, self.spelt_starts[ids], sizes).tobytes()
        ends = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum([len(d) for d in documents]))).astype(np.int64)]
        return [data[a:b].decode("utf-8", "replace").replace(SPACE, " ")[1:] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _prefix_sums(points: np.ndarray) -> np.ndarray:
    """Running sums of codes times powers, a row for each place; a difference of two is a substring's hash."""
    n = points.shape[1]
    sums = np.zeros((n + 1, points.shape[0]), dtype=np.uint64)
    codes = mix(points.T.astype(np.uint64) + np.uint64(0x51ED270B))
    np.cumsum(codes * powers(_BASE, n)[:, None], axis=0, out=sums[1:])
    return sums


def _substring_hashes(sums: np.ndarray, start: int, end: int) -> np.ndarray:
    factor = powers(_INVERSE, end)[start]
    return (sums[end] - sums[start]) * factor + np.uint64((end - start) * _BASE & (1 << 64) - 1)


def chunks(text: str) -> list[str]:
    return CHUNK.findall(SPACE + text.replace(" ", SPACE)) if text else []


def _tools(path: str, scores: str) -> tuple[Pieces, ChunkEncoder]:
    """One model and one bounded store of words per Python worker."""
    loaded = kept("pieces")
    if (path, scores) not in loaded:
        pieces = Pieces(path, scores)
        loaded[path, scores] = pieces, ChunkEncoder(pieces.encode_words)
    return loaded[path, scores]


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", scores: str = "zipf") -> DataFrame:
    """``key, n_tokens, ids, exact`` for each row; ``exact`` tells whether the ids decode to the text."""

    @tasks_of("pieces")
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces, encoder = _tools(path, scores)
        for frame in frames:
            texts = frame["text"].tolist()
            for lo, hi in batches(texts):
                ids = encoder.ids([chunks(t) for t in texts[lo:hi]])
                back = [x == t.replace(SPACE, " ") for x, t in zip(pieces.decode(ids), texts[lo:hi], strict=True)]
                yield pd.DataFrame(
                    {"key": frame["key"].iloc[lo:hi], "n_tokens": [len(x) for x in ids], "ids": ids, "exact": back}
                )

    own = docs.select(F.col(key).cast("string").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = own.mapInPandas(work, "key string, n_tokens long, ids array<int>, exact boolean")
    return found.select(F.col("key").cast(docs.schema[key].dataType).alias(key), "n_tokens", "ids", "exact")


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids", scores: str = "zipf") -> DataFrame:
    """``key, text`` from the ids; null ids give an empty text."""

    @tasks_of("pieces")
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces, _ = _tools(path, scores)
        for frame in frames:
            yield pd.DataFrame({"key": frame["key"], "text": pieces.decode([np.asarray(x) for x in frame["ids"]])})

    own = encoded.select(F.col(key).cast("string").alias("key"), F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("ids"))
    found = own.mapInPandas(work, "key string, text string")
    return found.select(F.col("key").cast(encoded.schema[key].dataType).alias(key), "text")
