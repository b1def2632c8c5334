"""The Jaccard join and the components against plain Python."""

import random
import re

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import weftable.llm.components as stars
from weftable.llm import jaccard
from weftable.llm.components import components
from weftable.llm.hashing import separators, word_hashes
from weftable.llm.store import BATCH_BYTES, bounded_batches, written

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_sets(docs, n):
    out = {}
    for key, text in docs:
        words = WORD.findall((text or "").translate(LOWER))
        runs = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
        out[key] = runs or ({tuple(words)} if words else set())
    return out


def smallest(nodes, links):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def copies(seed, count=160):
    """Families of near copies around the threshold, chains, exact copies, common passages, short texts."""
    rng = random.Random(seed)
    words = [f"v{i}" for i in range(400)]
    common = " ".join(rng.choices(words, k=30))
    docs = []
    while len(docs) < count:
        base = rng.choices(words, k=rng.choice([3, 8, 20, 40, 80]))
        if rng.random() < 0.4:
            base += common.split()
        for _ in range(rng.choice([1, 1, 3, 8])):
            docs.append(" ".join(base))
            if rng.random() < 0.8:
                base = list(base)
                at = rng.randrange(len(base))
                base[at : at + rng.randrange(2)] = rng.choices(words, k=rng.randrange(2))
    return list(enumerate(docs))


def tables_written(monkeypatch):
    """Names of the tables that are written from here on."""
    names = []
    for module in (jaccard, stars):
        monkeypatch.setattr(module, "written", lambda df, name, outer=0: names.append(name) or written(df, name, outer))
    return names


@pytest.mark.parametrize("n, percent, block, small", [(4, 85, 1024, 32), (5, 80, 2, 0), (4, 50, 3, 0), (4, 50, 3, 3)])
def test_components_of_random_copies(spark, monkeypatch, n, percent, block, small):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "SMALL", small)
    docs = copies(n * percent)
    sets = plain_sets(docs, n)
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    expected = smallest(sets, links)
    found = jaccard.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"), n=n, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {k: (len(sets[k]), expected[k]) for k in sets}
    assert len(links) > 20


@pytest.mark.parametrize("n, percent, block, small", [(4, 85, 1024, 32), (4, 50, 3, 0)])
def test_links_within_components(spark, monkeypatch, n, percent, block, small):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "SMALL", small)
    docs = copies(n * percent) + [(1000, None), (1001, "  ")]
    sets = plain_sets(docs, n)
    links = {(a, b) for a in sets for b in sets if a != b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}
    rows, pairs = jaccard.jaccard_links(spark.createDataFrame(docs, "doc_id long, text string"), n=n, percent=percent)
    rows, pairs = {r.doc_id: r for r in rows.collect()}, [tuple(r) for r in pairs.collect()]
    assert {k: r.n_links for k, r in rows.items()} == {k: sum(a == k for a, _ in links) for k in sets}
    assert {tuple(sorted((rows[a].sid, rows[b].sid))) for a, b in links if sets[a] != sets[b]} == set(pairs)
    assert len(pairs) == len(set(pairs)) > 20


def test_frequent_keys_take_the_other_way(spark, monkeypatch):
    docs = copies(9, 80)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    before = sorted(jaccard.jaccard_components(df).collect())
    monkeypatch.setattr(jaccard, "FEW", 2)
    assert sorted(jaccard.jaccard_components(df).collect()) == before


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=60), st.sets(st.integers(0, 2**64 - 1), max_size=30), st.integers(0, 60))
def test_bound_never_loses_a_link(a, extra, drop):
    b = set(sorted(a)[drop:]) | extra
    if not b:
        return
    maps = [np.frombuffer(jaccard.bitmap(np.array(sorted(x), dtype=np.uint64)), dtype=np.uint64) for x in (a, b)]
    shared = len(a & b)
    for percent in (50, 80, 85):
        linked = 100 * shared >= percent * (len(a) + len(b) - shared)
        fits = jaccard.can_link(maps[0][None], np.array([len(a)]), maps[1][None], np.array([len(b)]), percent)[0]
        assert fits or not linked


def test_bands_reach_every_link():
    starts = jaccard.bands(85)
    for n in [*range(1, 3000), 99_991, 10**7 + 3]:
        band = np.searchsorted(starts, n, side="right")
        assert np.searchsorted(starts, n * 100 // 85, side="right") - band <= 1


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aAbéZ \t\n\x0b\x1c\xa0", max_size=30), max_size=6))
def test_words(texts):
    hashes, at = word_hashes(texts, separators("space"))
    known = {}
    for i, text in enumerate(texts):
        words = WORD.findall(text.translate(LOWER))
        assert at[i + 1] - at[i] == len(words)
        for word, h in zip(words, hashes[at[i] : at[i + 1]].tolist(), strict=True):
            assert known.setdefault(word, h) == h
    assert len(set(known.values())) == len(known)


def test_components_of_a_random_graph(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 440)] + [(7, 7)]
    links += [(500, i) for i in range(501, 560)]
    found = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert {r.node: r.component for r in found} == smallest(nodes, [x for x in links if x[0] != x[1]])
    assert len(found) == len(nodes)


def test_links_that_are_stars_take_no_round(spark, monkeypatch):
    names = tables_written(monkeypatch)
    for links, rounds in [
        ([], 0),
        ([(1, 2), (3, 1), (1, 9), (5, 6), (4, 4)], 0),
        ([(1, 2), (2, 3)], 1),
        ([(1, 3), (2, 3)], 1),
        ([(1, 2), (2, 1)], 1),
        ([(None, 1), (2, 3)], 0),
    ]:
        names.clear()
        found = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
        links = [x for x in links if None not in x and x[0] != x[1]]
        assert sorted(tuple(r) for r in found) == sorted(smallest({x for link in links for x in link}, links).items())
        assert names == ["stars"] * rounds


def test_merged_components_are_joined_without_their_links(spark, monkeypatch):
    """Copies are merged with their hubs in a round, and what links two merged components joins these as single nodes in another."""
    names = tables_written(monkeypatch)
    rng = random.Random(5)
    docs = []
    for family in range(30):
        base = [f"f{family}w{i}" for i in range(60)]
        docs += [" ".join(base)] + [" ".join([*base[:at], "new", *base[at + 1 :]]) for at in rng.sample(range(60), 4)]
    docs = list(enumerate(docs))
    found = jaccard.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: i // 5 * 5 for i, _ in docs}
    assert names.count("stars") <= 2 and len(names) <= 20


@pytest.mark.parametrize("percent", [50, 80, 85])
def test_pairs_at_the_threshold(spark, percent):
    """The pair links from the first number of shared items on that reaches the share of the union."""
    rows, pairs, expected = [], [], set()
    for i, (size, shared) in enumerate((n, s) for n in (1, 20, 37) for s in range(n + 1)):
        a = [x * 2**57 for x in range(1 - size, 1)]
        b = a[:shared] + list(range(1, size - shared + 1))
        rows += [(2 * i, a), (2 * i + 1, b)]
        pairs.append((2 * i, 2 * i + 1))
        if 100 * shared >= percent * (2 * size - shared):
            expected.add(pairs[-1])
    found = jaccard._exact(spark.createDataFrame(pairs, "a long, b long"), spark.createDataFrame(rows, "sid long, items array<long>"), percent)
    assert {tuple(r) for r in found.collect()} == expected


def test_wide_rows_reach_python_in_bounded_batches(spark):
    """Batches of whole texts are bounded by bytes, not by rows alone, and the session keeps its own settings."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"

    def sizes(frames):
        for f in frames:
            yield pd.DataFrame({"rows": [len(f)], "bytes": [int(f["text"].str.len().sum())]})

    docs = spark.range(0, 3000, 1, 1).select(F.concat(F.col("id").cast("string"), F.lit(" word" * 1000)).alias("text"))
    before = spark.conf.get(setting, None)
    found = written(docs.mapInPandas(sizes, "rows long, bytes long"), "sizes").collect()
    assert sum(r["rows"] for r in found) == 3000
    assert max(r["bytes"] for r in found) <= 1.5 * BATCH_BYTES
    assert spark.conf.get(setting, None) == before


def test_a_bound_of_the_session_stays(spark):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(setting, "1m")
    try:
        with bounded_batches(spark):
            assert spark.conf.get(setting) == "1m"
        assert spark.conf.get(setting) == "1m"
    finally:
        spark.conf.unset(setting)


def test_kept_rows_are_not_shuffled(spark):
    """Only rows that may be copies meet the labels: texts of the others stay where they are, whatever their number."""
    docs = spark.range(0, 400, 1, 4).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    rows, names = docs.select(F.col("doc_id").alias("key"), "text"), docs.filter("doc_id % 10 = 0").select(F.col("doc_id").alias("key"))
    left, marked = jaccard._marked(rows, names, ["key"])
    left, marked = {r["key"] for r in left.collect()}, {r["key"] for r in marked.collect()}
    assert not left & marked and left | marked == set(range(400))
    assert marked >= set(range(0, 400, 10)) and len(left) >= 300

    labels = docs.select("doc_id", F.when(F.col("doc_id") % 10 == 1, F.col("doc_id") - 1).otherwise(F.col("doc_id")).alias("component_id"))
    kept = jaccard.keep_one(docs, labels)
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i in range(400) if i % 10 != 1]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = jaccard.keep_one(docs, labels)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    union = plan.index("Union")
    assert "LeftAnti" in plan[union:] and "Join" not in plan[:union]
