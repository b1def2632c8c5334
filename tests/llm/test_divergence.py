"""The source divergence audit against dense counting, a count vectorizer and itself with small bounds."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from helpers import CLASHING, LONG
from weftable.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string"


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def documents():
    random = np.random.default_rng(3)
    names = [f"t{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["été", "梦", "\U0001f600", "straße"]
    rows = []
    for i in range(400):
        lang = ["en", "en", "en", "de", None][i % 5]
        source = ["hot", "hot", f"s{i % 7}", None][i % 4]
        words = random.choice(names, size=random.integers(0, 30), p=np.arange(1, 65) / (64 * 65 / 2))
        rows.append((i, " ".join(w.upper() if i % 3 else w for w in words), lang, source))
    rows += [(1, None, "fr", "alone"), (2, "", "fr", "b"), (3, "one two", "fr", "c"), (3, "one two", "fr", "c"), (None, LONG, "en", "long")]
    rows += [(500 + i, "same words in ten documents", "it", "x" if i < 5 else "y") for i in range(10)]
    rows += [(600 + i, "5 7 8", "nl", f"n{i}") for i in range(3)]
    return rows


def plain_audit(rows, least=10, top=10):
    docs, total, sums = Counter(), Counter(), defaultdict(Counter)
    groups = set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        counts = Counter(terms(text))
        sums[lang, source].update(counts)
        for t, n in counts.items():
            docs[lang, t] += 1
            total[lang, t] += n
    kept = defaultdict(list)
    for (lang, t), n in docs.items():
        if n >= least:
            kept[lang].append(t)

    def numbers(counts, lang):
        n, v = sum(counts[t] for t in kept[lang]), len(kept[lang])
        return {t: 1 + 1000000000 * (counts[t] + 2) // (n + 2 * v) for t in kept[lang]}

    def f(p, q):
        return (p - q) ** 2 // (p + q)

    out = []
    for lang, source in groups:
        p = numbers(sums[lang, source], lang)
        pairs = []
        for other in {s for of, s in groups if of == lang} - {source}:
            q = numbers(sums[lang, other], lang)
            pairs.append((sum(f(p[t], q[t]) for t in p), other))
        q = numbers(Counter({t: total[lang, t] for t in kept[lang]}), lang)
        found = [(f(p[t], q[t]), t) for t in p if sums[lang, source][t] and p[t] > q[t]]
        for part, items, most in (("pair", pairs, None), ("term", found, top)):
            items = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
            out += [(lang, source, part, item, value, r + 1) for r, (value, item) in enumerate(items)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("other") for c in (*CLASHING, "term", "gid", "p", "value", "rank")})


def test_against_plain(spark):
    rows = documents()
    assert found(divergence.audit(frame(spark, rows))) == plain_audit(rows)
    assert found(divergence.audit(frame(spark, rows), min_documents=1, top=3)) == plain_audit(rows, 1, 3)


def test_small_bounds(monkeypatch):
    """Sums flushed at every step, long texts counted as found, terms split over batches: the same sums."""
    import pandas as pd
    import pyarrow as pa

    def batches(frame, size):
        return iter([pa.RecordBatch.from_pandas(frame.iloc[i : i + size], preserve_index=False) for i in range(0, len(frame), size)])

    def table(parts):
        return pa.Table.from_batches(list(parts)).to_pandas()

    rows = [(lang or "", source or "", text or "") for _, text, lang, source in documents()]
    frame = pd.DataFrame(rows, columns=["lang", "source", "text"])

    def sums():
        return table(divergence._group_counts(batches(frame, 50))).groupby(["lang", "source", "term"]).sum().sort_index()

    whole = sums()
    random = np.random.default_rng(1)
    block = pd.DataFrame([(t, g, p, 3 + g) for t in range(20) for g, p in enumerate(random.integers(5, 99, 12))], columns=["tid", "gid", "p", "p0"])

    def pairs(size):
        return table(divergence._shared_pairs(batches(block, size))).groupby(["a", "b"])["more"].sum().sort_index()

    many = pairs(1000)
    monkeypatch.setattr(divergence, "ENTRIES", 8)
    monkeypatch.setattr(divergence, "BATCH", 16)
    monkeypatch.setattr(divergence, "ROWS", 3)
    assert sums().equals(whole)
    assert pairs(7).equals(many) and len(many) == 66
    f = divergence._f
    a, b = (block[block.gid == g].set_index("tid") for g in (2, 9))
    by_hand = (f(a.p, b.p) - f(a.p, b.p0) - f(a.p0, b.p) + f(a.p0, b.p0)).sum()
    assert many[2, 9] == by_hand


def test_vocabulary_and_vectors_of_a_count_vectorizer(spark):
    rows = [r for r in documents() if r[2] == "en" and r[0] is not None]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = divergence.vocabulary(divergence.group_sums(docs))
    listed = spark.createDataFrame([(i, terms(t)) for i, t, _, _ in rows], "doc_id long, terms array<string>")
    model = CountVectorizer(inputCol="terms", outputCol="v", minDF=10, vocabSize=2**31 - 1).fit(listed)
    assert sorted(r.term for r in kept.collect()) == sorted(model.vocabulary)
    vectors = {(r.doc_id, model.vocabulary[i], int(n)) for r in model.transform(listed).collect() for i, n in zip(r.v.indices, r.v.values)}
    assert {(r.doc_id, r.term, r.n) for r in divergence.document_vectors(docs, kept).collect()} == vectors


def test_empty_and_exact(spark):
    assert divergence.audit(frame(spark, [])).collect() == []
    big = spark.range(1).select(divergence.scaled(F.lit(9 * 10**17), F.lit(9 * 10**17 + 5), F.lit(3)).alias("p")).first()[0]
    assert big == 1 + 10**9 * (9 * 10**17 + 2) // (9 * 10**17 + 11)


@pytest.mark.parametrize("text", ["", "A B-c a1b ÉtÉ \x80x\x7fy", "x" * 50, "\U0001f600\U0001f600 z"])
def test_counts(text):
    words = divergence._Vocabulary()
    at, code, n = divergence.document_codes([b"other a", text.encode(), b""], words)
    names = [t.decode() for t in words]
    assert {names[c]: int(k) for i, c, k in zip(at, code, n) if i == 1} == Counter(terms(text))
