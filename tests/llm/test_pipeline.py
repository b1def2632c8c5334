"""The pipeline's stages against plain versions, each on its own input."""

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from test_jaccard import plain_sets, smallest
from test_text_filters import hashed
from weftable.llm import decontaminate, toxicity
from weftable.llm.pieces import Pieces
from weftable.llm.store import written

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """What went into and came out of each stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = written(stage(spark, docs, SF), name)
        out[name] = ({r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in result.collect()})
        docs = result
    return out


def test_stages_and_columns(kept):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "sentencepiece"]
    for name, (before, after) in list(kept.items())[:-1]:
        assert after and set(after) <= set(before), name


def test_toxicity(spark, kept):
    before, after = kept["toxicity"]
    model = toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    scores = dict(zip(before, model.scores([r.text for r in before.values()]), strict=True))
    assert {k for k, s in scores.items() if s < 0.3} == set(after)
    assert all(after[k] == before[k] for k in after)


def test_line_dedup_keeps_every_document(kept):
    before, after = kept["line_dedup"]
    assert set(before) == set(after)
    for key, row in after.items():
        lines = iter(before[key].text.split("\n"))
        assert not row.text or all(any(x == y for y in lines) for x in row.text.split("\n"))


def test_one_of_each_group_stays(kept):
    before, after = kept["near_duplicates"]
    sets = plain_sets([(k, r.text) for k, r in before.items()], 5)
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert set(after) == {k for k, c in smallest(sets, links).items() if k == c}


def test_passages_are_gone(spark, kept):
    before, after = kept["decontamination"]
    items = [hashed(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    def holds(text):
        words = hashed(text)
        return any(len(i) >= decontaminate.LEAST and any(words[j : j + len(i)] == i for j in range(len(words))) for i in items)
    assert not [k for k, r in after.items() if holds(r.text)]
    assert len([k for k, r in before.items() if k not in after and not holds(r.text)]) == 0


def test_tokens_are_those_of_the_kept_texts(kept):
    before, after = kept["sentencepiece"]
    model = Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    assert set(before) == set(after)
    for key, row in after.items():
        assert row.exact and row.n_tokens == len(row.ids)
        assert model.decode([np.array(row.ids, dtype=np.int64)])[0] == before[key].text.replace("▁", " ")


def test_run_gives_the_last_stage(spark, kept):
    found = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, SF).collect()}
    assert found == {k: r.n_tokens for k, r in kept["sentencepiece"][1].items()}


def test_only_the_last_result_stays(spark, tmp_path, monkeypatch):
    """Tables that stages write, and the results of all but the last, are deleted with the run."""
    import os

    from weftable.llm.store import written

    made = []

    def stage(_, docs, __):
        inner = written(docs, "inner")
        made.append(inner.inputFiles()[0].removeprefix("file://"))
        return inner.selectExpr("doc_id + 1 doc_id")

    spark.range(3).toDF("doc_id").write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("a", stage), ("b", stage), ("c", stage)])
    last = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r.doc_id for r in last.collect()) == [3, 4, 5]
    assert len(made) == 3 and not any(os.path.exists(p) for p in made)
