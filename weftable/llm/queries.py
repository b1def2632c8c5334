"""Registered queries of the operators. Their SQL is in ``oracle``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import quality, toxicity
from .boilerplate import drop_boilerplate
from .decontaminate import find_passages
from .divergence import audit
from .fingerprint import fingerprints
from .jaccard import jaccard_components
from .learning import held_out
from .license import scan_licenses
from .middle import fill_in_middle, restore
from .oracle import oracle_sql
from .pieces import encode
from .pii import personal_data
from .preference import preference_pairs, swapped_answers
from .store import table
from .tokenbin import token_table


#: Files of public tokenizers; other places are given by the operators' parameter.
TOKENIZERS = {"pieces": "piece_bpe_32k.model", "bytes": "byte_bpe_50k.json"}


def tokenizer_path(kind: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZERS[kind])


TOXIC_FROM = 0.3
GOOD_FROM = 0.7


def _with_decision(scores: DataFrame, threshold: float) -> DataFrame:
    return scores.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.train(docs, table(spark, folder, "labels"), threshold=GOOD_FROM)
    return _with_decision(quality.score(docs, model), GOOD_FROM)


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return encode(table(spark, folder, "documents"), tokenizer_path("pieces"))


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(table(spark, folder, "documents"))


def op5_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints(table(spark, folder, "documents"))


def op6_token_binary(spark: SparkSession, folder: str) -> DataFrame:
    return token_table(table(spark, folder, "documents"), tokenizer_path("bytes"))


def op7_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    pairs = swapped_answers(table(spark, folder, "conversations"))
    return preference_pairs(pairs, "conv_id", "side", "turn", "role", "text")


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    return _with_decision(toxicity.score(docs, model), TOXIC_FROM)


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return drop_boilerplate(docs, host="source", text="text", counts=True)


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(table(spark, folder, "documents"))


def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return audit(table(spark, folder, "documents"))


def op12_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_licenses(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").alias("first_word"),
        F.array_max("base.start").alias("last_word"),
        "base_labels",
        "labels",
        "score",
    )


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    formed = fill_in_middle(table(spark, folder, "documents"))
    back = restore(F.col("output"), F.col("form"))
    return formed.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_quality,
        op2_sentencepiece,
        op3_decontamination,
        op4_ngram_jaccard_join,
        op5_fingerprints,
        op6_token_binary,
        op7_chat_formatting,
        op8_toxicity,
        op9_line_dedup,
        op10_pii,
        op11_source_divergence,
        op12_license_scan,
        op13_fill_in_middle,
    )
    return {f.__name__: f for f in every}


__all__ = ["oracle_sql", "queries", "tokenizer_path"]
