"""The corpus pipeline: stages over ``documents``, each written and read again by the next.

The first four keep or change documents and return the columns of ``documents``; the last gives the kept
documents' token ids.

Defined cases: a null or empty text is scored, has no lines to drop, is no copy, holds no passage and has no tokens, so it
stays unless its score rejects it; texts are read whole, however long; of equal rows one stays; rows without an id stay, as no
row can be named after them; columns beyond those of ``documents`` come through the first four stages, whatever their names; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weftable.llm import toxicity
from weftable.llm.boilerplate import drop_boilerplate
from weftable.llm.decontaminate import drop_contaminated
from weftable.llm.jaccard import jaccard_components, keep_one
from weftable.llm.pieces import encode
from weftable.llm.queries import TOXIC_FROM, tokenizer_path
from weftable.llm.store import staged_tables, table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the decision threshold; the labels are only learned from."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_below(docs, model, TOXIC_FROM)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source."""
    return drop_boilerplate(docs, host="source", text="text")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of smallest id."""
    return keep_one(docs, jaccard_components(docs, n=5, percent=80, by_text=True))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, exact`` of each document."""
    return encode(docs, tokenizer_path("pieces"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("sentencepiece", tokenize),
]

#: SQL cannot express the network, the edit distance search or the segmentation.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after another. Only the last result stays: the others go with the end of the run, and
    what a stage writes on its way goes with the end of the stage."""
    docs = table(spark, sf_dir, "documents")
    last = STAGES[-1][0]
    with staged_tables(spark):
        for name, stage in STAGES:
            with staged_tables(spark):
                docs = written(stage(spark, docs, sf_dir), name, outer=2 if name == last else 1)
    return docs
