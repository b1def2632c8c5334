"""Source divergence audit: how unlike the term frequencies of the sources of a language are.

Counting is that of a count vectorizer for each language, with a least document frequency and no bound on the vocabulary: every
document is an exact sparse vector of counts. The vectors of a (language, source) group are added, first in the task that
counted them, then in Spark, and the vocabulary is cut from the sums, which is the same as cutting it from each vector: it
is a written table and never lies on the driver. ``document_vectors`` gives the vectors themselves.

Every group gives each kept term of its language p = 1 + floor(UNIT (count + 2) / (N + 2 V)), N its counted terms, V the vocabulary's
size; all arithmetic is in integers and decimals. Two such numbers differ by f = floor((p - q)^2 / (p + q)).

Pairs are evaluated sparsely. With p0 the number of a term that a group lacks, the sum of f over all terms is V f(p0, q0), more for
each term of either side f(p, q0) - f(p0, q0), and more for each term of both f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0). The second
part needs only how many terms of a group have each count; the third only terms shared by two groups, whose partial
sums are formed in numpy within the task that holds a part of the terms, so that no pairs of a term are shuffled.

Defined cases: null text, language and source are empty strings; groups without terms are groups; a language without kept terms
has V = 0 and differences 0; equal values rank by the UTF-8 order of the item; repeated rows count as documents each; an empty
table gives no rows. Other columns of the table, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import written

MIN_DOCUMENTS = 10
TOP = 10
UNIT = 1_000_000_000
#: ASCII letters and all bytes of characters beyond ASCII, after ``bytes.lower``, which changes A-Z only.
TERM = re.compile(rb"[a-z\x80-\xff]+")

BATCH = 1 << 20  # bytes of text counted at once
ENTRIES = 1 << 21  # entries of group sums that a task holds, four for each term that it numbers
ROWS = 1 << 16  # rows of a batch that a task gives out
_CODE = (1 << 32) - 1


class _Vocabulary(dict):
    """Numbers the terms of a task as they come."""

    def __missing__(self, term: bytes) -> int:
        self[term] = n = len(self)
        return n


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the sums of each of the values over them."""
    if not len(keys):
        return keys, *values
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], *(np.add.reduceat(v[order], first) for v in values)


def document_codes(texts: list[bytes], vocabulary: _Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sparse vectors of some texts as (text, term number, count), by text and number."""
    codes, sizes = [], []
    found: list[list[bytes]] = []

    def number() -> None:
        codes.append(np.fromiter(map(vocabulary.__getitem__, chain.from_iterable(found)), dtype=np.int64))
        found.clear()

    for text in texts:
        if len(text) < BATCH:
            found.append(TERM.findall(text.lower()))
            sizes.append(len(found[-1]))
        else:  # the terms of a long text are numbered as they are found
            number()
            codes.append(np.fromiter((vocabulary[m.group()] for m in TERM.finditer(text.lower())), dtype=np.int64))
            sizes.append(len(codes[-1]))
    number()
    code = np.concatenate(codes)
    at = np.repeat(np.arange(len(texts), dtype=np.int64), sizes)
    keys, counts = _summed(at << 32 | code, np.ones(len(code), dtype=np.int64))
    return keys >> 32, keys & _CODE, counts


def _pieces(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``BATCH`` bytes; a longer text is a range by itself."""
    start = used = 0
    for i, text in enumerate(texts):
        if used and used + len(text) > BATCH:
            yield start, i
            start, used = i, 0
        used += len(text)
    if start < len(texts):
        yield start, len(texts)


def _group_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the vectors of each group in a task, with the number of documents of each term; given out as they grow."""
    vocabulary, groups = _Vocabulary(), {}
    none = np.zeros(0, dtype=np.int64)
    parts = [(none, none, none)]

    def merged() -> tuple[np.ndarray, ...]:
        parts[:] = [_summed(*(np.concatenate(x) for x in zip(*parts)))]
        return parts[0]

    def out() -> Iterator[pa.RecordBatch]:
        keys, n, documents = merged()
        terms = pa.array(vocabulary, pa.binary()).cast(pa.string())
        langs, sources = (pa.array([g[i] for g in groups], pa.string()) for i in range(2))
        for lo in range(0, len(keys), ROWS):
            group, code = pa.array(keys[lo : lo + ROWS] >> 32), pa.array(keys[lo : lo + ROWS] & _CODE)
            columns = [langs.take(group), sources.take(group), terms.take(code), pa.array(n[lo : lo + ROWS]), pa.array(documents[lo : lo + ROWS])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "documents"])

    for batch in batches:
        named = [groups.setdefault(g, len(groups)) for g in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())]
        of = np.array(named, dtype=np.int64)
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for lo, hi in _pieces(texts):
            text, code, n = document_codes(texts[lo:hi], vocabulary)
            parts.append(_summed(of[lo:hi][text] << 32 | code, n, np.ones(len(n), dtype=np.int64)))
            if sum(len(p[0]) for p in parts) > 2 * ENTRIES:
                merged()
            if len(parts[0][0]) > ENTRIES or 4 * len(vocabulary) > ENTRIES:
                yield from out()
                vocabulary.clear()
                parts[:] = [(none, none, none)]
    yield from out()


def _read(docs: DataFrame, lang: str, source: str, text: str, *more: Column) -> DataFrame:
    names = {"lang": lang, "source": source, "text": text}
    return docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a) for a, c in names.items()], *more)


def group_sums(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``lang, source, term, n, documents``: occurrences and documents of every term of every group."""
    counted = _read(docs, lang, source, text).mapInArrow(_group_counts, "lang string, source string, term string, n long, documents long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))


def vocabulary(sums: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``lang, term, total``: the terms that enough documents of their language have, with all their occurrences."""
    all_of = sums.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("documents").alias("documents"))
    return all_of.filter(F.col("documents") >= min_documents).drop("documents")


def document_vectors(docs: DataFrame, kept: DataFrame, key: str = "doc_id", lang: str = "lang", text: str = "text") -> DataFrame:
    """``key, lang, term, n``: the entries of each document's sparse vector over the vocabulary ``kept``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for lo, hi in _pieces(texts):
                words = _Vocabulary()
                at, code, n = document_codes(texts[lo:hi], words)
                terms = pa.array(words, pa.binary()).cast(pa.string())
                rows = pa.array(at + lo)
                columns = [batch.column("key").take(rows), batch.column("lang").take(rows), terms.take(pa.array(code)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "lang", "term", "n"])

    own = _read(docs, lang, lang, text, F.col(f"`{key}`").cast("string").alias("key")).select("key", "lang", "text")
    entries = own.mapInArrow(work, "key string, lang string, term string, n long")
    found = entries.join(kept.select("lang", "term"), ["lang", "term"])
    return found.select(F.col("key").cast(docs.schema[key].dataType).alias(key), "lang", "term", "n")


def scaled(n: Column, total: Column, size: Column) -> Column:
    """1 + floor(UNIT (n + 2) / (total + 2 size)), exact beyond 64 bits; null for an empty vocabulary."""
    above = F.lit(UNIT).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")
    below = (total + 2 * size).cast("decimal(20,0)")
    return F.when(size > 0, F.call_function("div", above, below) + 1)


def difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _block_pairs(term: np.ndarray, gid: np.ndarray, p: np.ndarray, p0: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums over the shared terms of a block by pair of groups, (a, b, more); rows come by term and group.

    All pairs of rows of a term that lie ``step`` rows apart are formed at once.
    """
    names, group = np.unique(gid, return_inverse=True)
    keys, values = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for step in range(1, len(term)):
        i = np.flatnonzero(term[:-step] == term[step:])
        if not len(i):
            break
        j = i + step
        more = _f(p[i], p[j]) - _f(p[i], p0[j]) - _f(p0[i], p[j]) + _f(p0[i], p0[j])
        key, more = _summed(group[i] * len(names) + group[j], more)
        keys.append(key)
        values.append(more)
    key, more = _summed(np.concatenate(keys), np.concatenate(values))
    return names[key // len(names)], names[key % len(names)], more


def _shared_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial sums over the terms of a task, for each two groups that share them; rows come sorted by term and group."""
    rest = [np.zeros(0, dtype=np.int64)] * 4
    held: list[tuple[np.ndarray, ...]] = []

    def out() -> Iterator[pa.RecordBatch]:
        if held:
            a, b, more = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.lexsort((b, a))
            a, b, more = a[order], b[order], more[order]
            first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
            yield pa.RecordBatch.from_arrays([pa.array(a[first]), pa.array(b[first]), pa.array(np.add.reduceat(more, first))], ["a", "b", "more"])

    def add(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        pairs = _block_pairs(*rows)
        if len(pairs[0]):
            held.append(pairs)
        if sum(len(x[0]) for x in held) > ENTRIES:
            yield from out()

    for batch in batches:
        rows = [np.concatenate((r, batch.column(c).to_numpy(zero_copy_only=False))) for r, c in zip(rest, ("tid", "gid", "p", "p0"))]
        whole = int(np.searchsorted(rows[0], rows[0][-1])) if len(rows[0]) else 0  # more rows of the last term may follow
        rest = [r[whole:] for r in rows]
        yield from add([r[:whole] for r in rows])
    yield from add(rest)
    yield from out()


def _groups(docs: DataFrame, kept: DataFrame, words: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    """``lang, source, gid, total, size, of_lang, p0`` of every group that occurs."""
    occurring = _read(docs, lang, source, text).select("lang", "source").distinct()
    counted = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = words.groupBy("lang").agg(F.count("*").alias("size"), F.sum("total").alias("of_lang"))
    groups = occurring.join(counted, ["lang", "source"], "left").join(sizes, ["lang"], "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "size", "of_lang")])
    return written(
        groups.select(
            "*", F.monotonically_increasing_id().alias("gid"), scaled(F.lit(0), F.col("total"), F.col("size")).alias("p0")
        ),
        "groups",
    )


def _pair_values(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``a, b, value`` for each two groups of a language, a < b."""
    sides = groups.select("lang", F.col("gid").alias("a"), F.col("p0").alias("a0"), "size")
    other = groups.select("lang", F.col("gid").alias("b"), F.col("p0").alias("b0"))
    both = difference(F.col("a0"), F.col("b0"))
    absent = sides.join(other, "lang").filter("a < b").select("a", "b", F.coalesce(F.col("size") * both, F.lit(0)).alias("more"))
    alike = kept.groupBy("lang", F.col("gid").alias("a"), F.col("p0").alias("a0"), "p").agg(F.count("*").alias("terms"))
    one_sided = (
        alike.join(other, "lang")
        .filter("a != b")
        .select(
            F.least("a", "b").alias("a"),
            F.greatest("a", "b").alias("b"),
            (F.col("terms") * (difference(F.col("p"), F.col("b0")) - both)).alias("more"),
        )
    )
    rows = kept.select("tid", "gid", "p", "p0").repartition("tid").sortWithinPartitions("tid", "gid")
    shared = rows.mapInArrow(_shared_pairs, "a long, b long, more long")
    parts = absent.unionByName(one_sided).unionByName(shared)
    return parts.groupBy("a", "b").agg(F.sum("more").alias("value"))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def audit(
    docs: DataFrame,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
    min_documents: int = MIN_DOCUMENTS,
    top: int = TOP,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: of every group its difference to each other source of the language
    (``pair``) and the ``top`` terms that it has more often than its language (``term``)."""
    sums = written(group_sums(docs, lang, source, text), "group-sums")
    numbered = vocabulary(sums, min_documents).withColumn("tid", F.monotonically_increasing_id())
    words = written(numbered, "vocabulary")
    counts = sums.join(words, ["lang", "term"]).select("lang", "source", "term", "tid", "n", F.col("total").alias("everywhere"))
    groups = _groups(docs, counts, words, lang, source, text)
    kept = written(
        counts.join(groups, ["lang", "source"]).select(
            "lang",
            "source",
            "term",
            "tid",
            "gid",
            "p0",
            scaled(F.col("n"), F.col("total"), F.col("size")).alias("p"),
            scaled(F.col("everywhere"), F.col("of_lang"), F.col("size")).alias("q"),
        ),
        "kept-terms",
    )
    typical = kept.filter("p > q").select("lang", "source", F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value"))
    names = groups.select("lang", "source", "gid")
    values = _pair_values(kept, groups)
    directed = values.unionByName(values.select(F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    items = names.select(F.col("gid").alias("b"), F.col("source").alias("item"))
    pairs = directed.join(names.withColumnRenamed("gid", "a"), "a").join(items, "b")
    terms = _ranked(typical, "term").filter(F.col("rank") <= top)
    return _ranked(pairs.select("lang", "source", "item", "value"), "pair").unionByName(terms)
