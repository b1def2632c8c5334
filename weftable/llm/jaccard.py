"""N-gram Jaccard join: documents whose sets of word shingles overlap enough are linked.

1. Each document becomes the sorted array of the 64-bit hashes of its distinct shingles. Equal sets are one
   set from here on, named by a 64-bit hash. Arrays are made anew from the texts in each pass that needs them; what
   is shuffled or written are single hashes, bitmaps of candidates, and arrays of pairs that bitmaps let through.
2. Two sets that link share one of their first (1 - threshold) shares of shingles in any common order. The
   order is by how often a shingle's bucket occurs in the corpus, rare ones first. Sets that share such a
   shingle are candidates; a shingle that only one set has is dropped at once.
3. Each candidate is first compared with one hub, the set with most shared shingles in its groups, and linked
   sets are merged. What is left of the groups, sets of different components, is cut into tiles: bands of
   sizes that can still link, in blocks. Pairs of a tile are bounded by sizes and places, and from above by the bit counts
   of their hashed bitmaps; only those that can still link are compared exactly, by intersection of their arrays. Rows of a large tile
   carry their bitmaps; tiles of few sets, most of which repeat the same pairs, give their pairs, and each different pair
   meets its bitmaps once.

For components, links between sets of one component are not looked for again: no component changes by them. What links
merged components joins them as single nodes: most of these few links take no further round.
``jaccard_links`` leaves step 3's hubs out and finds every pair of sets that link.

Defined cases: A-Z count as a-z; words are runs of other than ASCII white space; with fewer than ``n`` words the
sequence is one shingle; null and blank texts have no shingles and link with nothing; rows with equal ids
are labelled each by its own text; a null id is never a component's smallest, unless it has no other; an
empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .hashing import batches, mix, separators, shingles, word_hashes
from .store import written
from .workers import tasks_of

N = 4
PERCENT = 85
ORDER_BUCKETS, ORDER_PART = 1 << 22, 1 << 16
FEW = 100_000
MOST_FILTER_BITS = 1 << 27
BLOCK = 1024
SMALL = 32  # sets of a tile whose pairs meet their bitmaps afterwards
PAIRS_AT_ONCE, WORDS_AT_ONCE = 1 << 16, 1 << 18


def _sets(frames: Iterator[pd.DataFrame], n: int) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of few million characters, their sorted distinct shingle hashes one after another, where each row's begin, and all shingles."""
    space = separators("space")
    for frame in frames:
        texts = frame["text"].tolist()
        for lo, hi in batches(texts):
            words, at = word_hashes(texts[lo:hi], space)
            counts = np.diff(at)
            sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
            starts = np.concatenate(([0], np.cumsum(sizes)))
            items = np.zeros(starts[-1], dtype=np.uint64)
            if len(words) >= n:
                row = np.repeat(np.arange(hi - lo), sizes)
                place = at[row] + np.arange(len(items)) - starts[row]
                items = shingles(words, n)[np.minimum(place, len(words) - n)]
            for i in np.flatnonzero((counts > 0) & (counts < n)):
                items[starts[i]] = shingles(words[at[i] : at[i + 1]], n)[0]
            every = items.copy()
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                items[a:b].sort()
            new = np.ones(len(items), dtype=bool)
            new[1:] = items[1:] != items[:-1]
            new[starts[:-1][sizes > 0]] = True
            yield frame.iloc[lo:hi], items[new], np.concatenate(([0], np.cumsum(new)))[starts], every


def _names(items: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit names of the sets, each from its size and two sums over its mixed items."""
    def sums(values: np.ndarray) -> np.ndarray:
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
        return total[starts[1:]] - total[starts[:-1]]

    out = mix(np.diff(starts).astype(np.uint64))
    out = mix(out ^ sums(mix(items)))
    return mix(out ^ sums(mix(items ^ np.uint64(0xA5A5A5A5A5A5A5A5)))).view(np.int64)


def bitmap(items: np.ndarray) -> bytes:
    """A bit for each item, in four to eight times as many bits; a power of two, so that longer bitmaps fold onto shorter."""
    bits = max(64, 1 << int(4 * max(len(items), 1) - 1).bit_length())
    marks = np.zeros(bits, dtype=np.uint8)
    marks[(items & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(marks, bitorder="little").tobytes()


def fold(maps: np.ndarray, words: int) -> np.ndarray:
    while maps.shape[-1] > words:
        half = maps.shape[-1] // 2
        maps = maps[..., :half] | maps[..., half:]
    return maps


def can_link(maps_a: np.ndarray, n_a: np.ndarray, maps_b: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether the overlap, bounded by bit counts, can reach the threshold; shapes broadcast."""
    words = min(maps_a.shape[-1], maps_b.shape[-1])
    maps_a, maps_b = fold(maps_a, words), fold(maps_b, words)
    only_a = np.bitwise_count(maps_a & ~maps_b).sum(axis=-1, dtype=np.int64)
    only_b = np.bitwise_count(maps_b & ~maps_a).sum(axis=-1, dtype=np.int64)
    most = np.minimum(n_a - only_a, n_b - only_b)
    return 100 * most >= percent * (n_a + n_b - most)


def bands(percent: int) -> np.ndarray:
    """First sizes of the bands: a set links only within its own or a neighbouring band."""
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(starts[-1] * 100 // percent + 1)
    return np.array(starts, dtype=np.int64)


def _describe(own: DataFrame, n: int) -> tuple[DataFrame, np.ndarray]:
    """``id, text_hash, n, sid`` of each row, and how many shingles of the corpus fall in each bucket, from one pass.

    Each task adds its table of buckets, of fixed size, to the rows it writes.
    """

    @tasks_of("jaccard")
    def describe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(ORDER_BUCKETS, dtype=np.uint32)
        for f, items, starts, every in _sets(frames, n):
            bucket, often = np.unique((every % np.uint64(ORDER_BUCKETS)).astype(np.uint32), return_counts=True)
            counts[bucket] += often.astype(np.uint32)
            yield pd.DataFrame({"id": f["id"], "text_hash": f["text_hash"], "n": np.diff(starts), "sid": _names(items, starts), "part": -1, "counts": None})
        parts = counts.reshape(-1, ORDER_PART)
        used = np.flatnonzero(parts.any(axis=1))
        packed = [zlib.compress(p.tobytes(), 1) for p in parts[used]]
        yield pd.DataFrame({"id": None, "text_hash": 0, "n": 0, "sid": 0, "part": used, "counts": packed})

    def add(parts: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(c), dtype=np.uint32).astype(np.uint64) for c in parts["counts"])
        capped = np.minimum(total, np.uint64(np.iinfo(np.uint32).max)).astype(np.uint32)
        return pd.DataFrame({"part": parts["part"].iloc[:1], "counts": [zlib.compress(capped.tobytes(), 1)]})

    both = written(own.mapInPandas(describe, "id string, text_hash long, n long, sid long, part long, counts binary"), "named-sets")
    parts = both.filter("part >= 0").select("part", "counts").groupBy("part").applyInPandas(add, "part long, counts binary").toPandas()
    out = np.zeros((ORDER_BUCKETS // ORDER_PART, ORDER_PART), dtype=np.uint32)
    for part, counts in zip(parts["part"], parts["counts"], strict=True):
        out[part] = np.frombuffer(zlib.decompress(counts), dtype=np.uint32)
    return both.filter("part < 0").select("id", "text_hash", "n", "sid"), out.reshape(-1)


def _filter_bits(wanted: DataFrame) -> np.ndarray:
    """Bits by name of the given sets, so that most others need not be shuffled; at most 16 MB."""
    bits = min(MOST_FILTER_BITS, max(1 << 12, 1 << (16 * wanted.count()).bit_length()))
    place = F.col("sid").bitwiseAND(F.lit(bits - 1))
    words = wanted.select(F.shiftright(place, 6).alias("w"), place.bitwiseAND(F.lit(63)).cast("int").alias("b"))
    ored = words.groupBy("w").agg(F.expr("bit_or(shiftleft(1L, b))").alias("x")).toPandas()
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[ored["w"].to_numpy(dtype=np.int64)] = ored["x"].to_numpy(dtype=np.int64).view(np.uint64)
    return out


def _among(names: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether each name's bit is set."""
    place = names.view(np.uint64) & np.uint64(len(bits) * 64 - 1)
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) > 0


def _of_sets(own: DataFrame, wanted: DataFrame, n: int, percent: int, exact: bool) -> DataFrame:
    """``sid, items`` or ``sid, n, band, map`` of the wanted sets, one row each, from a pass over the texts, and what columns ``wanted`` has."""
    bits = own.sparkSession.sparkContext.broadcast(_filter_bits(wanted))
    firsts = bands(percent)

    @tasks_of("jaccard")
    def describe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, items, starts, _ in _sets(frames, n):
            names = _names(items, starts)
            rows = np.flatnonzero(_among(names, bits.value) & (np.diff(starts) > 0))
            if not len(rows):  # no column of arrays comes from no rows
                continue
            sets = [items[starts[i] : starts[i + 1]] for i in rows]
            if exact:
                yield pd.DataFrame({"sid": names[rows], "items": [x.view(np.int64) for x in sets]})
                continue
            sizes = np.diff(starts)[rows]
            band = np.searchsorted(firsts, sizes, side="right")
            yield pd.DataFrame({"sid": names[rows], "n": sizes, "band": band, "map": [bitmap(x) for x in sets]})

    schema = "sid long, items array<long>" if exact else "sid long, n long, band int, map binary"
    found = own.select("text").mapInPandas(describe, schema)
    once = found.groupBy("sid").agg(*[F.any_value(c).alias(c) for c in found.columns[1:]])
    return written(once.join(wanted, "sid"), "arrays" if exact else "bitmaps")


def _exact(pairs: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` that link, by exact intersection of their arrays."""
    a = items.select(F.col("sid").alias("a"), F.col("items").alias("xa"))
    b = items.select(F.col("sid").alias("b"), F.col("items").alias("xb"))
    shared = F.size(F.array_intersect("xa", "xb")).cast("long")
    linked = (100 + percent) * shared >= percent * (F.size("xa").cast("long") + F.size("xb"))
    return pairs.join(a, "a").join(b, "b").filter(linked).select("a", "b")


def _bounded(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` that can link by their bitmaps."""

    @tasks_of("jaccard")
    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            sizes = f["ma"].str.len().to_numpy() * (1 << 32) + f["mb"].str.len().to_numpy()
            keep = np.zeros(len(f), dtype=bool)
            for s in np.unique(sizes):
                at = np.flatnonzero(sizes == s)
                part = f.iloc[at]
                step = max(1, 8 * WORDS_AT_ONCE // int(max(s >> 32, s & (1 << 32) - 1)))
                for lo in range(0, len(at), step):
                    some = part.iloc[lo : lo + step]
                    ma, mb = (np.frombuffer(b"".join(some[m]), dtype=np.uint64).reshape(len(some), -1) for m in ("ma", "mb"))
                    keep[at[lo : lo + step]] = can_link(ma, some["na"].to_numpy(), mb, some["nb"].to_numpy(), percent)
            yield f.loc[keep, ["a", "b"]]

    a = maps.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("map").alias("ma"))
    b = maps.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("map").alias("mb"))
    joined = pairs.join(a, "a").join(b, "b").select("a", "b", "na", "nb", "ma", "mb")
    return joined.mapInPandas(compare, "a long, b long")


def _links(own: DataFrame, pairs: DataFrame, sets: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs that link: bounded by bitmaps, then compared as arrays of the sets that are left."""
    can = written(_bounded(pairs, sets, percent), "can-link")
    ends = written(can.select(F.explode(F.array("a", "b")).alias("sid")).distinct(), "can-link-sets")
    return written(_exact(can, _of_sets(own, ends, n, percent, exact=True), percent), "links")


def _tile_pairs(tiles: DataFrame, percent: int) -> DataFrame:
    """Pairs that can link within each tile, by sizes, places and, where its rows have them, bitmaps.

    Rows of a tile come together. Several tiles are compared at once: every row with the first, second, ...
    row after it, as long as some of these pairs lie within a tile.
    """
    keys = ["key", "tile", "one", "two"]

    def compare_tiles(f: pd.DataFrame, group: np.ndarray) -> Iterator[pd.DataFrame]:
        sid, comp, band, block, tile, n, pos = (f[c].to_numpy() for c in ("sid", "component", "band", "block", "tile", "n", "pos"))
        mixed = (f["one"] != f["two"]).to_numpy()
        maps = f["map"].tolist()
        words = np.array([len(m) // 8 if m is not None else 0 for m in maps])
        stacks = {w: np.stack([np.frombuffer(maps[i], dtype=np.uint64) for i in np.flatnonzero(words == w)]) for w in np.unique(words[words > 0])}
        place = np.zeros(len(words), dtype=np.int64)
        for w in stacks:
            place[words == w] = np.arange((words == w).sum())
        found, held = [], 0
        for step in range(1, len(f)):
            a = np.flatnonzero(group[step:] == group[:-step])
            if not len(a):
                break
            b = a + step
            small, large = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
            # overlap that a link needs; the first shared key leaves at least that many items behind it in both
            least = -(-percent * (small + large) // (100 + percent))
            ok = (comp[a] != comp[b]) & (100 * small >= percent * large) & ((band[a] == tile[a]) | (band[b] == tile[a]))
            ok &= (n[a] - pos[a] >= least) & (n[b] - pos[b] >= least) & (~mixed[a] | (block[a] != block[b]))
            if ok.any():
                found.append(np.stack((a[ok], b[ok]), axis=1))
                held += int(ok.sum())
            if held >= PAIRS_AT_ONCE:
                yield from fits(np.concatenate(found), sid, n, words, stacks, place)
                found, held = [], 0
        if found:
            yield from fits(np.concatenate(found), sid, n, words, stacks, place)

    def fits(pairs: np.ndarray, sid, n, words, stacks, place) -> Iterator[pd.DataFrame]:
        without = words[pairs[:, 0]] == 0
        if without.any():
            names = np.unique(np.sort(sid[pairs[without]], axis=1), axis=0)
            yield pd.DataFrame({"a": names[:, 0], "b": names[:, 1]})
            pairs = pairs[~without]
        _, once = np.unique(np.sort(sid[pairs], axis=1), axis=0, return_index=True)
        pairs = pairs[once]
        kind = words[pairs[:, 0]] * (1 << 32) + words[pairs[:, 1]]
        for k in np.unique(kind):
            some = pairs[kind == k]
            step = max(1, WORDS_AT_ONCE // int(max(words[some[0, 0]], words[some[0, 1]])))
            for lo in range(0, len(some), step):
                a, b = some[lo : lo + step].T
                can = can_link(stacks[words[a[0]]][place[a]], n[a], stacks[words[b[0]]][place[b]], n[b], percent)
                if can.any():
                    x, y = sid[a[can]], sid[b[can]]
                    yield pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y)})

    @tasks_of("jaccard")
    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for f in frames:
            f = f if rest is None else pd.concat([rest, f], ignore_index=True)
            group = np.cumsum((f[keys] != f[keys].shift()).any(axis=1).to_numpy())
            last = int(np.searchsorted(group, group[-1])) if len(f) else 0
            if last:
                yield from compare_tiles(f.iloc[:last], group[:last])
            rest = f.iloc[last:]
        if rest is not None and len(rest):
            yield from compare_tiles(rest, np.zeros(len(rest)))

    dealt = tiles.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInPandas(compare, "a long, b long")


def _tiles(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows of each group by tile, those of large tiles by block and with their bitmaps.

    A tile has a band and the next one, a block about ``BLOCK`` sets.
    """
    tiled = groups.withColumn("tile", F.explode(F.array(F.col("band"), F.col("band") - 1)))
    stats = tiled.groupBy("key", "tile").agg(
        F.count("*").alias("rows"), F.min("component").alias("c1"), F.max("component").alias("c2"), F.max((F.col("band") == F.col("tile")).cast("int")).alias("own")
    )
    live = stats.filter("c1 != c2 and own = 1").select("key", "tile", "rows")
    dealt = written(tiled.join(live, ["key", "tile"]).select("key", "tile", "rows", "sid", "component", "band", "pos", "n"), "tiles")
    small = dealt.filter(F.col("rows") <= SMALL).drop("rows").withColumns({c: F.lit(0) for c in ("one", "two", "block")})
    blocks = F.ceil(F.col("rows") / BLOCK).cast("int")
    large = dealt.filter(F.col("rows") > SMALL).withColumn("block", F.pmod(F.xxhash64("sid"), blocks).cast("int"))
    spread = large.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    mapped = spread.select(
        "key", "tile", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
        "block", "sid", "component", "band", "pos", "n",
    ).join(sets.select("sid", "map"), "sid")
    return mapped.unionByName(small.withColumn("map", F.lit(None).cast("binary")))


def _open_pairs(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Different pairs of sets of a group that may link."""
    return _tile_pairs(_tiles(groups, sets), percent).distinct()


def _groups(own: DataFrame, counts: np.ndarray, n: int, percent: int) -> DataFrame:
    """``key, sid, pos`` of the sets that share a prefix shingle with another set; ``pos`` is its place in the prefix.

    Keys whose bucket proves that they are few are counted where they come together, in one shuffle; others are counted
    before they are shuffled, and joined.
    """
    shared_counts = own.sparkSession.sparkContext.broadcast(counts)

    @tasks_of("jaccard")
    def prefixes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        order = shared_counts.value
        for _, items, starts, _ in _sets(frames, n):
            count = order[(items % np.uint64(ORDER_BUCKETS)).astype(np.int64)]
            sizes = np.diff(starts)
            takes = np.where(sizes > 0, sizes + (-percent * sizes) // 100 + 1, 0)
            first = [a + np.argsort(count[a:b], kind="stable")[:t] for a, b, t in zip(starts[:-1], starts[1:], takes, strict=True) if t]
            if first:
                at = np.concatenate(first)
                pos = np.arange(len(at)) - np.repeat(np.cumsum(takes) - takes, takes)
                yield pd.DataFrame(
                    {"key": items[at].view(np.int64), "often": count[at] > FEW, "sid": np.repeat(_names(items, starts), takes), "pos": pos}
                )

    postings = own.select("text").mapInPandas(prefixes, "key long, often boolean, sid long, pos int")
    alike = Window.partitionBy("key")
    columns = ["key", "sid", "pos"]
    few = (
        postings.filter("not often")
        .select(*columns, F.min("sid").over(alike).alias("least"), F.max("sid").over(alike).alias("most"))
        .filter("least != most")
        .select(*columns)
    )
    if not bool((counts > FEW).any()):
        return written(few.distinct(), "groups")
    many = postings.filter("often").select(*columns).distinct()
    shared = many.groupBy("key").agg(F.min("sid").alias("least"), F.max("sid").alias("most")).filter("least != most")
    return written(few.distinct().unionByName(many.join(shared.select("key"), "key")), "groups")


def _candidates(
    docs: DataFrame, key: str, text: str, n: int, percent: int
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The texts, ``id, text_hash, n, sid`` of each row, the groups, and their sets: size, band, bitmap and how many keys each shares."""
    own = docs.select(F.col(key).cast("string").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    own = own.withColumn("text_hash", F.xxhash64("text"))
    described, counts = _describe(own, n)
    described = described.withColumn("id", F.col("id").cast(docs.schema[key].dataType))
    groups = _groups(own, counts, n, percent)
    candidates = written(groups.groupBy("sid").agg(F.count("*").alias("shared")), "candidates")
    return own, described, groups, _of_sets(own, candidates, n, percent, exact=False)


def jaccard_links(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT
) -> tuple[DataFrame, DataFrame]:
    """``key, n_shingles, sid, n_links`` for each row, and the pairs ``a, b`` (a < b) of different sets that link.

    A row links with the other rows of its set and with all rows of the sets its set links with. Rows name their set
    by ``sid``, null without shingles; pairs of rows are not unfolded, as a group of equal texts has a square of them.
    """
    own, described, groups, sets = _candidates(docs, key, text, n, percent)
    alone = groups.join(sets.select("sid", "n", "band"), "sid").withColumn("component", F.col("sid"))
    pairs = _links(own, _open_pairs(alone, sets, percent), sets, n, percent)
    rows = described.filter("n > 0").groupBy("sid").agg(F.count("*").alias("rows"))
    ends = pairs.select(F.col("a").alias("sid"), F.col("b").alias("other"))
    ends = ends.unionByName(pairs.select(F.col("b").alias("sid"), F.col("a").alias("other")))
    others = ends.join(rows.withColumnRenamed("sid", "other"), "other").groupBy("sid").agg(F.sum("rows").alias("linked"))
    links = rows.join(others, "sid", "left").select("sid", (F.col("rows") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    of_row = described.withColumn("sid", F.when(F.col("n") > 0, F.col("sid"))).join(links, "sid", "left")
    return of_row.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), "sid", F.coalesce("n_links", F.lit(0)).alias("n_links")), pairs


def jaccard_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT, by_text: bool = False
) -> DataFrame:
    """``key, n_shingles, component_id`` for each row: documents are linked at Jaccard >= ``percent`` / 100.

    With ``by_text`` also ``text_hash`` and ``component``, a name that no other component has, null without shingles.
    """
    own, described, groups, sets = _candidates(docs, key, text, n, percent)

    # a set whose whole prefix is shared is likelier the original of copies that each lost a little
    scored = groups.join(sets.select("sid", "n", (F.col("shared") / F.col("n")).alias("score")), "sid")
    hubs = scored.groupBy("key").agg(F.max(F.struct("score", "n", "sid")).alias("hub"))
    near = (F.col("n") * 100 >= F.col("hub.n") * percent) & (F.col("hub.n") * 100 >= F.col("n") * percent)
    own_hub = scored.join(hubs, "key").filter((F.col("sid") != F.col("hub.sid")) & near).groupBy("sid").agg(F.max("hub").alias("hub"))
    stars = own_hub.select(F.least("sid", "hub.sid").alias("a"), F.greatest("sid", "hub.sid").alias("b")).distinct()
    merged = components(_links(own, stars, sets, n, percent), "a", "b").withColumnRenamed("node", "sid")
    merged = sets.select("sid", "n", "band").join(merged, "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    merged = written(merged, "merged")
    labelled = groups.join(merged, "sid")
    rest = labelled.groupBy("key").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).filter("c1 != c2")
    open_groups = written(labelled.join(rest.select("key"), "key", "left_semi"), "open-groups")
    more = _links(own, _open_pairs(open_groups, sets, percent), sets, n, percent)
    # from here on a merged component is one node
    of = merged.select("sid", "component")
    joins = more.join(of.toDF("a", "ca"), "a").join(of.toDF("b", "cb"), "b").select("ca", "cb")
    whole = components(written(joins.distinct(), "joins"), "ca", "cb").toDF("component", "whole")
    label = written(of.join(whole, "component", "left").select("sid", F.coalesce("whole", "component").alias("component")), "components")

    of_set = described.filter("n > 0").groupBy("sid").agg(F.min("id").alias("first"))
    of_set = of_set.join(label, "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    smallest = of_set.groupBy("component").agg(F.min("first").alias("component_id"))
    named = of_set.join(smallest, "component").select("sid", "component", "component_id")
    return (
        described.join(named, "sid", "left")
        .select(
            F.col("id").alias(key),
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
            *([F.col("text_hash"), F.when(F.col("n") > 0, F.col("component")).alias("component")] if by_text else []),
        )
    )


def _marked(rows: DataFrame, names: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that are surely none of ``names``, and the others, few more than those that are: these alone need a join."""
    name = F.xxhash64(*columns)
    bits = rows.sparkSession.sparkContext.broadcast(_filter_bits(names.select(name.alias("sid"))))

    @F.pandas_udf("boolean")
    @tasks_of("jaccard")
    def may(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for hashes in parts:
            yield pd.Series(_among(hashes.to_numpy(dtype=np.int64), bits.value))

    return rows.filter(~may(name)), rows.filter(may(name))


def keep_one(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` but those that are not the smallest id of their component; rows without id stay.

    Labels made with ``by_text`` decide for each row: an id with several texts stays with those that are no copies, and
    of equal rows, or texts of the smallest id in one component, one stays. Other labels decide by id alone.
    """
    body = F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{key}`").alias("key"), body.alias("hash")
    )
    if "text_hash" not in labels.columns:
        gone = labels.filter(F.col(key) != F.col("component_id")).select(F.col(key).alias("key")).distinct()
        gone = written(gone, "gone")
        left, marked = _marked(rows, gone, ["key"])
        left = left.unionByName(marked.join(gone, "key", "left_anti"))
    else:
        own = labels.filter(F.col(key).isNotNull() & F.col("component").isNotNull())
        own = written(own.select(F.col(key).alias("key"), "component_id", F.col("text_hash").alias("hash"), "component"), "labels")
        first = own.filter("key = component_id")
        several = first.groupBy("component").agg(F.min("hash").alias("least"), F.max("hash").alias("most")).filter("least != most")
        others = first.join(several, "component").filter("hash != least").select("key", "hash")
        gone = written(own.filter("key != component_id").select("key", "hash").unionByName(others).distinct(), "gone")
        repeated = written(first.groupBy("key", "hash").agg(F.count("*").alias("n")).filter("n > 1").select("key", "hash"), "repeated")
        left, marked = _marked(rows, gone.unionByName(repeated), ["key", "hash"])
        marked = marked.join(gone, ["key", "hash"], "left_anti")
        if not repeated.isEmpty():
            once = marked.join(repeated, ["key", "hash"], "left_semi").dropDuplicates(["key", "hash"])
            marked = marked.join(repeated, ["key", "hash"], "left_anti").unionByName(once.select(*marked.columns))
        left = left.unionByName(marked.select(*left.columns))
    return left.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
