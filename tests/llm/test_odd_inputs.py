"""Every operator and stage on nulls, empty and very long texts, ties, repeated rows, clashing columns and no rows."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from helpers import CLASHING, LONG, ODD, frame
from weftable.llm import boilerplate, decontaminate, fingerprint, jaccard, pieces, pii, preference, quality, tokenbin, toxicity
from weftable.llm.license import scan_licenses
from weftable.llm.middle import fill_in_middle

PIECES, BYTES = (public_tokenizers.path(f) for f in ("piece_bpe_32k.model", "byte_bpe_50k.json"))
LABELS = "doc_id long, quality int, toxic int"
ITEMS = "item_id long, text string"


def labels(spark, rows=((4, 1, 0), (5, 1, 0), (6, None, 1), (None, 1, 1), (99, 0, 1))):
    return spark.createDataFrame(list(rows), LABELS)


def toxic(df):
    return toxicity.score(df, toxicity.train(df, labels(df.sparkSession)))


def good(df):
    return quality.score(df, quality.train(df, labels(df.sparkSession)))


PER_ROW = {
    "quality": good,
    "toxicity": toxic,
    "pieces": lambda df: pieces.encode(df, PIECES),
    "jaccard": jaccard.jaccard_components,
    "fingerprint": fingerprint.fingerprints,
    "tokenbin": lambda df: tokenbin.token_table(df, BYTES),
    "boilerplate": boilerplate.drop_boilerplate,
    "pii": pii.personal_data,
    "license": scan_licenses,
    "middle": fill_in_middle,
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_for_each_row(spark, name):
    found = PER_ROW[name](frame(spark)).select("doc_id").collect()
    assert sorted(str(r[0]) for r in found) == sorted(str(i) for i, _ in ODD)


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(spark, name):
    assert PER_ROW[name](frame(spark, [])).collect() == []


@pytest.mark.parametrize("name", PER_ROW)
def test_equal_rows_get_equal_results(spark, name):
    if name in ("tokenbin", "fingerprint"):
        return  # places and neighbours differ
    rows = PER_ROW[name](frame(spark)).where("doc_id = 6").drop("doc_id").collect()
    assert len(rows) == 2 and rows[0] == rows[1]


def test_defined_results(spark):
    df = frame(spark)
    components = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df).collect()}
    assert components[1] == (0, 1) and components[2] == (0, 2) and components[3] == (0, 3)
    assert components[5] == components[6] == (3, 5) and components[10] == components[11] == (1, 10)
    assert components[None] == (4, None)
    scores = {r.doc_id: r.score for r in toxic(df).collect()}
    assert scores[1] == scores[2] == scores[3] and all(0 <= s <= 1 for s in scores.values())
    tokens = {r.doc_id: r for r in pieces.encode(df, PIECES).collect()}
    assert tokens[1].ids == [] and all(r.exact for r in tokens.values())
    back = {r.doc_id: r.text for r in pieces.decode(pieces.encode(df, PIECES), PIECES).collect()}
    assert back[7] == LONG and back[9] == "é😀  梦\x00  ok"
    prints = {r.doc_id: r for r in fingerprint.fingerprints(df).collect()}
    assert prints[1].fingerprint == "" and prints[1].near_edited == 1.0 and prints[3].near_next == 0.0
    spans = {r.doc_id: r for r in pii.personal_data(df).collect()}
    assert spans[7].spans == "" and spans[1].n_email == 0
    counts = {r.doc_id: r.n_tokens for r in tokenbin.token_table(df, BYTES).collect()}
    assert counts[1] == counts[2] == 1


def test_all_columns_come_through(spark):
    df = frame(spark)
    kept = boilerplate.drop_boilerplate(df)
    assert kept.columns == df.columns
    for c in CLASHING:
        assert [r[0] for r in kept.select(f"`{c}`").distinct().collect()] == ["other"]
    model = toxicity.train(df, labels(spark))
    assert toxicity.keep_below(df, model, 2.0).columns == df.columns
    items = spark.createDataFrame([(1, "a text without any id")], ITEMS)
    assert decontaminate.drop_contaminated(df, items).columns == df.columns
    one = jaccard.keep_one(df, jaccard.jaccard_components(df))
    assert one.columns == df.columns and sorted(str(r.doc_id) for r in one.collect()) == sorted(
        str(i) for i in (1, 2, 3, 4, 5, None, 7, 8, 9, 10)
    )


def test_repeated_ids_are_judged_by_row(spark):
    copied, other, third = ("some words that are said here once more", "quite another text of seven or eight words", "a third text which nobody else has written down")
    rows = [(1, copied), (2, copied), (2, other), (3, third), (3, third), (4, copied), (4, copied), (5, None), (5, None)]
    rows += [(6, other + " x"), (6, other + " X"), (6, other + "\tx")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one = jaccard.keep_one(df, jaccard.jaccard_components(df, n=2, percent=60, by_text=True)).collect()
    assert sorted((r.doc_id, r.text or "") for r in one) == [(1, copied), (2, other), (3, third), (5, ""), (5, "")]
    clean = decontaminate.drop_contaminated(df, spark.createDataFrame([(1, copied)], ITEMS)).collect()
    assert sorted(str(tuple(r)) for r in clean) == sorted(str(r) for r in rows if r[1] != copied)
    same = df.where("doc_id = 6")
    assert jaccard.keep_one(same, jaccard.jaccard_components(same, n=2, by_text=True)).count() == 1


def test_no_labels(spark):
    df = frame(spark)
    none = labels(spark, [])
    assert {r.score for r in toxicity.score(df, toxicity.train(df, none)).collect()} == {0.5}
    assert {r.score for r in quality.score(df, quality.train(df, none)).collect()} == {0.5}


def test_passages(spark):
    df = frame(spark)
    items = [(1, "a text without any id at all"), (1, "a text without any id at all"), (2, None), (3, ""), (4, "one"), (5, "THE SAME, words here!")]
    found = decontaminate.find_passages(df, spark.createDataFrame(items, ITEMS))
    assert sorted({(r.doc_id or 0, r.item_id, r.distance, r.word) for r in found.collect()}) == [(0, 1, 0, 0), (5, 5, 0, 0), (6, 5, 0, 0)]
    assert decontaminate.find_passages(df, spark.createDataFrame([], ITEMS)).collect() == []
    assert decontaminate.find_passages(frame(spark, []), spark.createDataFrame(items, ITEMS)).collect() == []


def test_preferences(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert preference.preference_pairs(preference.swapped_answers(spark.createDataFrame([], schema)), "conv_id", "side", "turn", "role", "text").collect() == []
    rows = [
        (0, 0, "user", "q"), (0, 1, "assistant", "a0"), (1, 0, None, None), (1, 5, "assistant", "a1"), (2, 0, "user", "alone"),
        (2, 1, "assistant", "x"), (4, 0, "user", "u"), (4, 0, "user", "u"), (None, 0, "user", "lost"),
    ]
    df = spark.createDataFrame(rows, schema).withColumn("side_", F.lit(1)).withColumn("place", F.lit(2))
    pairs = {r.pair_id: r for r in preference.preference_pairs(preference.swapped_answers(df), "conv_id", "side", "turn", "role", "text").collect()}
    assert set(pairs) == {0, 1, 2, 4}
    assert pairs[0].common_turns == 1 and pairs[0].prompt == "<|im_start|>user\nq<|im_end|>\n"
    assert pairs[0].chosen_text == "<|im_start|>assistant\na0<|im_end|>\n" and "a1" in pairs[0].rejected_text
    a, b = map(int, pairs[0].chosen_spans.split(":"))
    assert pairs[0].chosen_text[a:b] == "a0<|im_end|>"
    assert pairs[2].rejected_text == "" and pairs[2].rejected_spans == ""
    assert pairs[4].common_turns == 2 and pairs[4].chosen_text == pairs[4].rejected_text == ""


def test_stages_on_odd_documents(spark, tmp_path):
    df = frame(spark, extra=False).selectExpr("doc_id", "text", "'en' lang", "'s' source", "length(text) n_chars")
    labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "a text without any id at all")], ITEMS).write.parquet(str(tmp_path / "benchmark.parquet"))
    for docs in (df, df.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == df.columns and out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()
