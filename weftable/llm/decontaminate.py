"""Benchmark decontamination: passages within an edit distance of a benchmark item.

Symbols are words (runs of letters, digits and other than ASCII characters, A-Z as a-z), so a changed, added or lost word is one
edit; punctuation and white space do not count. A passage matches an item of ``n`` words at up to ``n * EDITS // 100`` edits.

1. An item is cut into nearly equal segments of at most ``SEGMENT`` words: of a passage at up to the limit of edits, one segment
   at least has no more than its own share of them. A segment that matches shares a run of consecutive words with the passage, at
   the least as long as edits can leave. Only windows placed around such runs are looked at; none that can match is left out.
2. CGK embedding: a window of a segment's size is walked with random bits that depend on step and word, which repeats a word or
   moves to the next; few edits become few differing steps. Windows are hashed by the words at a few sampled steps, in
   tables that are added, with new walks, until the recall measured on segments edited at the limit reaches ``RECALL``, for short and
   long ones alike and on a second set of edits too; if it cannot, every window is taken to share a bucket with the segments
   of its runs, which loses nothing.
3. Around windows that share a bucket with a segment, its item is verified by exact edit distance, with all starts there are.

The items are read in blocks of bounded size, each a pass over all documents.

Defined cases: null and empty texts match nothing; items of fewer than ``LEAST`` words name no passage and match nothing, those
of fewer than ten words match only as they are; equal items match each by its own id; a text matches an item once, at its
least distance, the first place; an item as long as a book is found by its segments; equal rows match each; rows without id are reported without id; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .hashing import batches, mix, randoms, separators, shingles, word_hashes
from .store import written
from .workers import tasks_of

EDITS = 20
LEAST = 4
SEGMENT = 60
RUN = 4
RECALL = 0.99
SAMPLED = (5, 4, 3, 2)
TABLES_PER_WALK, MOST_TABLES = 4, 96
TRIALS, LENGTHS = 1600, 4
ITEMS_AT_ONCE = 20_000
WINDOWS_AT_ONCE = 1 << 13
CELLS_AT_ONCE = 1 << 18
STEPS_AT_ONCE = 1 << 22
BLOOM_BITS = 22


def allowed(n: int) -> int:
    return 0 if n < 10 else n * EDITS // 100


def run_length(n: int) -> int:
    """Words in a row that a match of an item of ``n`` words must share with it: edits cut it into at most d + 1 runs."""
    d = allowed(n)
    return min(RUN, -(-(n - d) // (d + 1)))


@dataclass
class Tables:
    """How windows are hashed: walks, and the sampled steps of each table by window size; without tables all are compared."""

    sampled: int
    count: int

    def keys(self, words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One key per table and window; words from ``ends`` on are padding. All windows walk together."""
        out = np.zeros((self.count, len(starts)), dtype=np.uint64)
        kinds, kind = np.unique(sizes, return_inverse=True)
        columns = np.arange(len(starts))
        stop = np.minimum(starts + sizes, ends)
        for walk in range(-(-self.count // TABLES_PER_WALK)):
            seen = np.zeros((2 * int(kinds[-1]), len(starts)), dtype=np.uint64)
            place = starts.copy()
            for step in range(len(seen)):
                inside = place < stop
                word = np.where(inside, words[np.minimum(place, len(words) - 1)], np.uint64(0))
                seen[step] = word
                bits = mix(word + _walk_seed(walk, step // 64)) >> np.uint64(step % 64)
                place = place + (inside & (bits & np.uint64(1)).astype(bool))
            for t in range(walk * TABLES_PER_WALK, min(self.count, (walk + 1) * TABLES_PER_WALK)):
                steps = np.stack([_steps(self.sampled, int(n), t) for n in kinds])[kind]
                key = sizes.astype(np.uint64) * np.uint64(1_000_003) + np.uint64(t)
                for k in range(self.sampled):
                    key = mix(key ^ seen[steps[:, k], columns]) + steps[:, k].astype(np.uint64)
                out[t] = key
        return out


def _walk_seed(walk: int, part: int) -> np.uint64:
    return np.uint64((walk * 1009 + part + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)


@lru_cache(maxsize=1 << 16)
def _steps(sampled: int, n: int, table: int) -> np.ndarray:
    """Sampled steps in ascending order, among those a walk takes before it nears the end."""
    return np.sort((randoms(sampled, 7919 * n + 31 * table) % np.uint64(2 * n)).astype(np.int64))


@dataclass
class Index:
    """Items by id and words; their segments by item and first word; runs of segments, and the segments in buckets or by runs."""

    ids: list
    words: list[np.ndarray]
    owner: np.ndarray
    offset: np.ndarray
    slack: np.ndarray
    runs: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    tables: Tables
    keys: np.ndarray
    segments: np.ndarray


def cut_points(n: int) -> list[int]:
    """First words of the segments of an item of ``n`` words, and ``n``."""
    parts = -(-n // SEGMENT)
    return [i * n // parts for i in range(parts + 1)]


def edited(words: np.ndarray, edits: int, random: np.random.Generator) -> np.ndarray:
    """A copy with that many words changed, added or lost."""
    out = list(words)
    for _ in range(edits):
        kind, at = random.integers(3), int(random.integers(max(len(out), 1)))
        new = np.uint64(random.integers(1 << 63))
        if kind == 0 and out:
            out[at] = new
        elif kind == 1:
            out.insert(at, new)
        elif out:
            del out[at]
    return np.array(out, dtype=np.uint64)


def _recalls(words: list[np.ndarray], sampled: int, random: np.random.Generator) -> np.ndarray:
    """Recall of the first 1, 2, ... tables on items edited at the limit, other words around them, for each of some groups of lengths."""
    groups = [g for g in np.array_split(np.argsort([len(w) for w in words], kind="stable"), LENGTHS) if len(g)]
    picked = [words[i] for g in groups for i in g[random.integers(len(g), size=TRIALS // LENGTHS)]]
    slack = np.array([allowed(len(w)) for w in picked])
    parts = [part for w, d in zip(picked, slack, strict=True) for part in (_other(len(w), random), edited(w, int(d), random), _other(len(w), random))]
    own_at, part_at = (np.cumsum([0] + [len(w) for w in ws]) for ws in (picked, parts))
    first, last = part_at[:-1][0::3], part_at[1:][2::3]
    inside, behind = part_at[:-1][1::3], part_at[1:][1::3]
    trial, start = _expand(np.maximum(inside - slack, first), np.minimum(inside + slack, np.maximum(behind - 1, inside)) + 1)
    sizes, most = np.diff(own_at), Tables(sampled, MOST_TABLES)
    a = most.keys(np.concatenate(picked), own_at[:-1], sizes, own_at[1:])
    text, met = np.concatenate(parts), np.zeros((MOST_TABLES, len(picked)), dtype=bool)
    step = max(1, STEPS_AT_ONCE // int(2 * sizes.max()))
    for lo in range(0, len(start), step):
        of = trial[lo : lo + step]
        table, window = np.nonzero(a[:, of] == most.keys(text, start[lo : lo + step], sizes[of], last[of]))
        met[table, of[window]] = True
    return np.maximum.accumulate(met, axis=0).reshape(MOST_TABLES, len(groups), -1).mean(axis=2)


def _other(n: int, random: np.random.Generator) -> np.ndarray:
    return random.integers(1 << 63, size=n).astype(np.uint64)


def choose_tables(words: list[np.ndarray], target: float, seed: int = 1) -> Tables:
    """The most selective tables that reach the recall, for each group of lengths, on one set of edited items and on a second one.

    Each has to reach it by two standard errors more, as the tables are chosen on them.
    """
    random = np.random.default_rng(seed)
    if not words:
        return Tables(SAMPLED[0], TABLES_PER_WALK)
    for sampled in SAMPLED:
        recall = np.minimum(_recalls(words, sampled, random), _recalls(words, sampled, random))
        recall = (recall - 2 * np.sqrt(recall * (1 - recall) / (TRIALS // LENGTHS))).min(axis=1)
        if recall[-1] >= target:
            return Tables(sampled, int(np.argmax(recall >= target)) + 1)
    return Tables(0, 0)


def build(ids: list, texts: list[str], target: float = RECALL) -> Index:
    hashes, at = word_hashes(texts, separators("other"))
    kept = [(k, hashes[at[i] : at[i + 1]]) for i, k in enumerate(ids) if at[i + 1] - at[i] >= LEAST]
    cut = [(i, a, w[a:b]) for i, (_, w) in enumerate(kept) for c in [cut_points(len(w))] for a, b in zip(c[:-1], c[1:])]
    words = [w for _, _, w in cut]
    tables = choose_tables(words, target)
    runs: dict[int, list[tuple[np.ndarray, ...]]] = {}
    for segment, w in enumerate(words):
        q = run_length(len(w))
        h = shingles(w, q)
        # which segment a run is of matters only where all of them are compared
        runs.setdefault(q, []).append((h, np.arange(len(h)), np.full(len(h), len(w)), np.full(len(h), 0 if tables.count else segment)))
    table = {}
    for q, parts in runs.items():
        rows = np.unique(np.stack([np.concatenate([p[k].astype(np.uint64) for p in parts]) for k in range(4)], axis=1), axis=0)
        bloom = np.zeros(1 << BLOOM_BITS, dtype=bool)
        bloom[rows[:, 0] >> np.uint64(64 - BLOOM_BITS)] = True
        table[q] = (rows[:, 0].copy(), *(rows[:, k].astype(np.int64) for k in (1, 2, 3)), bloom)
    key, segment = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if words and tables.count:
        ends = np.cumsum([len(w) for w in words])
        sizes = np.diff(ends, prepend=0)
        key = tables.keys(np.concatenate(words), ends - sizes, sizes, ends).reshape(-1)
        segment = np.tile(np.arange(len(words)), tables.count)
    order = np.argsort(key, kind="stable")
    owner, offset = (np.array([c[k] for c in cut], dtype=np.int64) for k in (0, 1))
    slack = np.array([allowed(len(kept[i][1])) + (allowed(len(w)) if len(w) < len(kept[i][1]) else 0) for i, _, w in cut], dtype=np.int64)
    return Index([k for k, _ in kept], [w for _, w in kept], owner, offset, slack, table, tables, key[order], segment[order])


def _expand(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which range, and which place, for every place of the ranges."""
    counts = hi - lo
    owner = np.repeat(np.arange(len(lo)), counts)
    return owner, lo[owner] + np.arange(int(counts.sum())) - (np.cumsum(counts) - counts)[owner]


def _windows(index: Index, words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, size and text of the windows in which a segment can lie, and the segment where there are no tables."""
    found = []
    for q, (hashes, offsets, sizes, segments, bloom) in index.runs.items():
        if len(words) < q:
            continue
        h = shingles(words, q)
        place = np.flatnonzero(bloom[h >> np.uint64(64 - BLOOM_BITS)])
        text = np.searchsorted(at, place, side="right") - 1
        within = place + q <= at[text + 1]
        place, text = place[within], text[within]
        lo = np.searchsorted(hashes, h[place], side="left")
        hi = np.searchsorted(hashes, h[place], side="right")
        owner, row = _expand(lo, hi)
        n = sizes[row]
        slack = np.where(n < 10, 0, n * EDITS // 100)
        middle = place[owner] - offsets[row]
        first = np.maximum(middle - slack, at[text[owner]])
        last = np.minimum(middle + slack, at[text[owner] + 1] - 1)
        owner2, start = _expand(first, np.maximum(last + 1, first))
        found.append(np.stack((start, n[owner2], text[owner][owner2], segments[row][owner2]), axis=1))
    rows = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 4), np.int64)
    return rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3]


def distances(item: np.ndarray, words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Least edit distance of the item to a passage that begins at each start, whatever its length; exact up to the limit.

    Starts near each other share a region of their text. Read backwards, with any beginning, one table over a region
    gives the distances of all its starts; regions of like size are worked on together.
    """
    n = len(item)
    wide = n + allowed(n)
    order = np.argsort(starts, kind="stable")
    place, end = starts[order], ends[order]
    new = np.ones(len(place), dtype=bool)
    new[1:] = (end[1:] != end[:-1]) | (np.diff(place) > wide)
    region = np.cumsum(new) - 1
    first = place[new]
    last = place[np.append(np.flatnonzero(new)[1:] - 1, len(place) - 1)]
    behind = np.minimum(last + wide, end[new])
    sizes = behind - first
    best = np.zeros(len(place), dtype=np.int64)
    by_size = np.argsort(sizes, kind="stable")
    at = 0
    while at < len(by_size):
        some = by_size[at : at + max(1, CELLS_AT_ONCE // int(sizes[by_size[min(at + 63, len(by_size) - 1)]]))][:64]
        at += len(some)
        size = int(sizes[some].max())
        back = behind[some][:, None] - 1 - np.arange(size)[None, :]
        inside = back >= first[some][:, None]
        text = words[np.maximum(back, 0)]
        steps = np.arange(size + 1, dtype=np.int32)
        row = np.zeros((len(some), size + 1), dtype=np.int32)
        for i, word in enumerate(item[::-1]):
            other = np.minimum(row[:, 1:] + 1, row[:, :-1] + ((text != word) | ~inside))
            other = np.concatenate((np.full((len(some), 1), i + 1, dtype=np.int32), other), axis=1)
            row = np.minimum.accumulate(other - steps, axis=1) + steps
        number = np.full(len(sizes), -1)
        number[some] = np.arange(len(some))
        mine = np.flatnonzero(number[region] >= 0)
        best[mine] = row[number[region[mine]], behind[region[mine]] - place[mine]]
    out = np.empty(len(place), dtype=np.int64)
    out[order] = best
    return out


def _around(starts: np.ndarray, text: np.ndarray, at: np.ndarray, slack: int) -> np.ndarray:
    """All starts, with their texts, within ``slack`` words of the given ones."""
    place = starts[:, None] + np.arange(-slack, slack + 1)[None, :]
    where = np.broadcast_to(text[:, None], place.shape)
    inside = (place >= at[where]) & (place < at[where + 1])
    return np.unique(np.stack((place[inside], where[inside]), axis=1), axis=0)


def matches(index: Index, texts: list[str]) -> list[tuple[int, int, int, int]]:
    """Text, item, distance and first word of the best match of each text and item."""
    words, at = word_hashes(texts, separators("other"))
    start, size, text, segment = _windows(index, words, at)
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for lo in range(0, len(start), WINDOWS_AT_ONCE):
        part = slice(lo, lo + WINDOWS_AT_ONCE)
        first, n, of = start[part], size[part], text[part]
        pairs = [] if index.tables.count else [np.stack((segment[part], np.arange(len(first))), axis=1)]
        for table in index.tables.keys(words, first, n, at[of + 1]) if index.tables.count else ():
            owner, row = _expand(np.searchsorted(index.keys, table, side="left"), np.searchsorted(index.keys, table, side="right"))
            pairs.append(np.stack((index.segments[row], owner), axis=1))
        met = np.unique(np.concatenate(pairs), axis=0)
        cuts = np.append(np.flatnonzero(np.diff(met[:, 0], prepend=-1)), len(met))
        around: dict[int, list[np.ndarray]] = {}
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            found, window = int(met[a, 0]), met[a:b, 1]
            near = _around(first[window] - index.offset[found], of[window], at, int(index.slack[found]))
            around.setdefault(int(index.owner[found]), []).append(near)
        for item, parts in around.items():
            place, where = (np.unique(np.concatenate(parts), axis=0) if len(parts) > 1 else parts[0]).T
            if not len(place):
                continue
            d = distances(index.words[item], words, place, at[where + 1])
            good = np.flatnonzero(d <= allowed(len(index.words[item])))
            for x, t, p in zip(d[good].tolist(), where[good].tolist(), (place - at[where])[good].tolist(), strict=True):
                best[t, item] = min(best.get((t, item), (x, p)), (x, p))
    return [(t, i, *v) for (t, i), v in sorted(best.items())]


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    by_text: bool = False,
) -> DataFrame:
    """``key, item, distance, word, n_words`` for each row and item that match; ``word`` is where the passage begins.

    With ``by_text`` also ``text_hash``, of the row's text.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item).cast("string").alias("id"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    blocks = -(-items.count() // ITEMS_AT_ONCE)
    own = docs.select(F.col(key).cast("string").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    own = own.withColumn("text_hash", F.xxhash64("text"))
    schema = "key string, text_hash long, item string, distance int, word long, n_words int"
    # no rows without a Python task: rows from the driver, even none, would start workers of another kind on every executor
    found = own.filter(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema)])
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()
        rows.sort(key=lambda r: (str(r["id"]), r["text"]))
        index = spark.sparkContext.broadcast(build([r["id"] for r in rows], [r["text"] for r in rows]))

        @tasks_of("decontaminate")
        def work(frames: Iterator[pd.DataFrame], index=index) -> Iterator[pd.DataFrame]:
            known = index.value
            for frame in frames:
                texts, keys, marks = (frame[c].tolist() for c in ("text", "key", "text_hash"))
                for lo, hi in batches(texts):
                    hits = matches(known, texts[lo:hi])
                    yield pd.DataFrame(
                        [(keys[lo + t], marks[lo + t], known.ids[i], d, w, len(known.words[i])) for t, i, d, w in hits],
                        columns=["key", "text_hash", "item", "distance", "word", "n_words"],
                    )

        found = found.unionByName(own.mapInPandas(work, schema))
    return found.select(
        F.col("key").cast(docs.schema[key].dataType).alias(key),
        F.col("item").cast(benchmark.schema[item].dataType).alias(item),
        "distance",
        "word",
        "n_words",
        *(["text_hash"] if by_text else []),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` that match no item, each judged by its own text; rows without id stay."""
    found = find_passages(docs, benchmark, key, text, by_text=True)
    hit = written(found.select(F.col(key).alias("__hit"), F.col("text_hash").alias("__of")).distinct(), "contaminated")
    own = F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    return docs.join(hit, (F.col(f"`{key}`") == F.col("__hit")) & (own == F.col("__of")), "left_anti")
