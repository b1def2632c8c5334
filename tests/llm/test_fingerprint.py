"""Fingerprints against plain Python."""

import hashlib

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weftable.llm import fingerprint


def shingle_hash(words):
    seed = 42
    for w in words:
        seed = xxhash.xxh64_intdigest(w.encode(), seed=seed)
    return seed - (1 << 64) if seed >> 63 else seed


def plain_sketch(text, k=fingerprint.K):
    words = [w for w in (text or "").lower().replace("\n", " ").split(" ") if w]
    return sorted({shingle_hash(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set())[:k]


def likeness(a, b, k=fingerprint.K):
    both = sorted(set(a) | set(b))[:k]
    return len([h for h in both if h in set(a) and h in set(b)]) / len(both) if both else 1.0


def hexadecimal(sketch):
    return "".join(f"{h & (1 << 64) - 1:016X}" for h in sketch)


@pytest.mark.parametrize("ids", [lambda i: i, lambda i: i * 1_000_003 - 5_000, lambda i: (i * i * i * 977) - 10**12, lambda i: 2**62 * (i % 2) + i])
def test_whole_table_against_plain(spark, ids):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 150").collect()
    rows = [(ids(r.doc_id), r.text) for r in docs] + [(ids(200), ""), (ids(201), "a b"), (ids(202), None)]
    found = {r.doc_id: r for r in fingerprint.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    ordered = sorted((k, t or "") for k, t in rows)
    assert len(found) == len(ordered)
    for (key, text), (_, follower) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        take = len(text) // 4
        edited = text[: len(text) - take] + follower[:take]
        own, other, after = plain_sketch(text), plain_sketch(edited), plain_sketch(follower)
        r = found[key]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == hexadecimal(own) and r.edited_fingerprint == hexadecimal(other)
        assert (r.near_edited, r.near_next) == (pytest.approx(likeness(own, other)), pytest.approx(likeness(own, after)))


def test_a_single_document_follows_itself(spark):
    r = fingerprint.fingerprints(spark.createDataFrame([(5, "abcdefgh")], "doc_id long, text string")).first()
    assert r.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and r.near_next == 1.0


@settings(max_examples=25, deadline=None)
@given(st.lists(st.sets(st.integers(-(2**63), 2**63 - 1), max_size=40), min_size=2, max_size=4))
def test_sketches_of_parts_merge(spark, parts):
    k = 16
    rows = [("g", sorted(p)[:k]) for p in parts]
    merged = fingerprint.merge_sketches(spark.createDataFrame(rows, "g string, s array<long>"), ["g"], "s", k).collect()
    whole = sorted(set().union(*parts))[:k]
    assert [r.s for r in merged] == ([whole] if whole else [])


def test_estimates(spark):
    import random

    rng = random.Random(1)
    hashes = [rng.randrange(-(2**63), 2**63) for _ in range(30_000)]
    a, b = sorted(hashes[:20_000])[:128], sorted(hashes[10_000:])[:128]
    df = spark.createDataFrame([(a, b, a[:5])], "a array<long>, b array<long>, c array<long>")
    r = df.select(
        fingerprint.distinct_shingles(F.col("a")), fingerprint.resemblance(F.col("a"), F.col("b")),
        fingerprint.containment(F.col("a"), F.col("b")), fingerprint.distinct_shingles(F.col("c")),
    ).first()
    assert abs(r[0] - 20_000) < 5_000 and abs(r[1] - 1 / 3) < 0.13 and abs(r[2] - 0.5) < 0.2 and r[3] == 5.0
