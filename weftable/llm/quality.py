"""Quality scores by positive-unlabelled learning.

Small networks with one hidden layer are trained in numpy on trusted positives and unlabelled web text alone. They minimise the
non-negative unbiased risk: the positives' loss times the class prior, plus the unlabelled texts' loss as negatives less
the part of it that positives among them account for; where that difference falls below zero, its gradient is reversed.
The prior is estimated first, on texts left out of training: the least ratio, over all thresholds, of the shares of
unlabelled and of positive texts above a threshold, bounded by the sampling error of both.

Logits are shifted so that the score from which a text counts as good is the cut of least estimated error on the left-out texts:
positives below it, and unlabelled texts above it beyond the positives that the prior puts there. No text labelled as bad is used.

Inputs of a text: shares of pairs of byte classes, repetition of words and lines, lengths. Nothing else is read.

The samples are bounded (``POSITIVES`` and ``UNLABELLED`` documents of up to ``LONGEST`` characters, chosen by hash, outside
the held-out fold); scoring covers all rows and whole texts.

Defined cases: null, empty and blank texts are scored like others, from zero inputs; words are runs of other than ASCII
white space; without positives or without unlabelled texts every score is one half; equal texts get equal
scores; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import batches, separators, span_hashes, word_spans
from .learning import Adam, chosen, held_out, sigmoid

POSITIVES, UNLABELLED, LONGEST = 4000, 8000, 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY, MEMBERS = 16, 25, 256, 0.01, 1e-3, 5

CLASSES = (
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "0123456789",
    " \t",
    "\n\r\v\f",
    ".",
    ",;:",
    "!?",
    "\"'()-",
    "#$%&*+<=>@[\\]^_`{|}~/",
)


def _classes() -> np.ndarray:
    out = np.full(256, len(CLASSES), dtype=np.int64)  # control characters
    out[128:] = len(CLASSES) + 1
    for i, members in enumerate(CLASSES):
        out[list(members.encode())] = i
    return out


_CLASS = _classes()
_KINDS = len(CLASSES) + 2
FEATURES = _KINDS * _KINDS + 8


def features(texts: list[str]) -> np.ndarray:
    """One row of inputs for each text."""
    out = np.zeros((len(texts), FEATURES))
    lower, first, last, at = word_spans(texts, separators("space"))
    hashes = span_hashes(lower, first, last)
    for i, text in enumerate(texts):
        data = _CLASS[np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)]
        if len(data) > 1:
            pairs = np.bincount(data[:-1] * _KINDS + data[1:], minlength=_KINDS * _KINDS)
            out[i, : _KINDS * _KINDS] = np.sqrt(pairs / (len(data) - 1))
        words = hashes[at[i] : at[i + 1]]
        if len(words):
            counts = np.unique(words, return_counts=True)[1]
            lines = text.split("\n")
            out[i, _KINDS * _KINDS :] = (
                (words[1:] == words[:-1]).mean() if len(words) > 1 else 0.0,
                counts.max() / len(words) if len(words) >= 10 else 0.0,
                np.log(len(counts)) / max(np.log(len(words)), 1.0),
                (counts * (counts - 1)).sum() / max(len(words) * (len(words) - 1), 1) if len(words) >= 10 else 0.0,
                (last[at[i] : at[i + 1]] - first[at[i] : at[i + 1]]).mean() / 10,
                np.log1p(len(words)) / 10,
                len(set(lines)) / len(lines),
                np.log1p(len(data) / len(lines)) / 10,
            )
    return out


@dataclass
class Model:
    centre: np.ndarray
    scale: np.ndarray
    parameters: dict[str, np.ndarray]
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        p = self.parameters
        return (np.tanh(self.scaled(x) @ p["in"] + p["bias"]) @ p["out"])[:, 0] + p["offset"][0]

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -5, 5)


@dataclass
class Committee:
    """Networks from different starts; the mean of their logits is steadier than any of them."""

    members: list[Model]
    prior: float
    shift: float = 0.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.mean([m.logits(x) for m in self.members], axis=0) + self.shift

    def scores(self, texts: list[str]) -> np.ndarray:
        return sigmoid(self.logits(features(texts))) if self.members else np.full(len(texts), 0.5)


def _loss_gradient(model: Model, x: np.ndarray, outer: np.ndarray, hidden: np.ndarray) -> dict[str, np.ndarray]:
    p = model.parameters
    back = outer[:, None] @ p["out"].T * (1 - hidden * hidden)
    return {"in": x.T @ back + DECAY * p["in"], "bias": back.sum(axis=0), "out": hidden.T @ outer[:, None], "offset": outer.sum(keepdims=True)}


def minimise(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 1) -> Model:
    """Network of least non-negative risk with the logistic loss, given inputs and the class prior."""
    random = np.random.default_rng(seed)
    inputs = unlabelled.shape[1]
    parameters = {
        "in": random.standard_normal((inputs, HIDDEN)) / np.sqrt(inputs),
        "bias": np.zeros(HIDDEN),
        "out": random.standard_normal((HIDDEN, 1)) / np.sqrt(HIDDEN),
        "offset": np.zeros(1),
    }
    model = Model(unlabelled.mean(axis=0), np.maximum(unlabelled.std(axis=0), 0.01), parameters, prior)
    xp, xu = model.scaled(positive), model.scaled(unlabelled)
    optimizer = Adam(parameters, RATE)
    for _ in range(EPOCHS):
        order = random.permutation(len(xu))
        for lo in range(0, len(order), BATCH):
            u = xu[order[lo : lo + BATCH]]
            p = xp[random.integers(len(xp), size=min(BATCH, len(xp)))]
            hp = np.tanh(p @ parameters["in"] + parameters["bias"])
            hu = np.tanh(u @ parameters["in"] + parameters["bias"])
            fp = (hp @ parameters["out"])[:, 0] + parameters["offset"]
            fu = (hu @ parameters["out"])[:, 0] + parameters["offset"]
            as_negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
            g_negative_u = sigmoid(fu) / len(fu)
            g_negative_p = -prior * sigmoid(fp) / len(fp)
            g_positive = -prior * sigmoid(-fp) / len(fp)
            sign = 1.0 if as_negative >= 0 else -1.0
            g_p = sign * g_negative_p + (g_positive if sign > 0 else 0.0)
            gu = _loss_gradient(model, u, sign * g_negative_u, hu)
            gp = _loss_gradient(model, p, g_p, hp)
            optimizer.update({k: gu[k] + gp[k] for k in gu})
    return model


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, delta: float = 0.1) -> float:
    """Class prior from scores of left-out positives and unlabelled texts."""
    cuts = np.unique(np.quantile(positive, np.linspace(0, 0.95, 96)))
    share_p = 1 - np.searchsorted(np.sort(positive), cuts, side="left") / len(positive)
    share_u = 1 - np.searchsorted(np.sort(unlabelled), cuts, side="left") / len(unlabelled)
    error = np.sqrt(np.log(4 / delta) / (2 * len(positive))) + np.sqrt(np.log(4 / delta) / (2 * len(unlabelled)))
    bounds = (share_u + error) / share_p
    best = int(np.argmin(bounds))
    return float(np.clip(share_u[best] / share_p[best], 0.05, 0.99))


def estimate_cut(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> float:
    """Logit of least estimated share of errors, from logits of left-out positives and unlabelled texts.

    The share of errors at a cut is the prior times the positives below it, plus the negatives above it, which are the
    unlabelled texts above it less the prior times the positives above it. The middle of the best run of cuts is taken.
    """
    cuts = np.unique(np.concatenate((positive, unlabelled)))
    below = np.searchsorted(np.sort(positive), cuts, side="left") / len(positive)
    above = 1 - np.searchsorted(np.sort(unlabelled), cuts, side="left") / len(unlabelled)
    errors = prior * below + np.maximum(above - prior * (1 - below), 0.0)
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    last = best[0]
    while last + 1 < len(cuts) and errors[last + 1] <= errors.min() + 1e-12:
        last += 1
    low = cuts[best[0] - 1] if best[0] else cuts[0] - 1.0
    return float((low + cuts[last]) / 2)


def fit(positive: np.ndarray, unlabelled: np.ndarray, threshold: float = 0.7, seed: int = 1) -> Committee:
    """Networks trained on three quarters of both samples; prior, and the cut that scores ``threshold``, from the rest."""
    half_p, half_u = max(1, len(positive) * 3 // 4), max(1, len(unlabelled) * 3 // 4)
    first = minimise(positive[:half_p], unlabelled[:half_u], 0.5, seed)
    left_p, left_u = positive[half_p:], unlabelled[half_u:]
    if not (len(left_p) and len(left_u)):
        return Committee([minimise(positive, unlabelled, 0.5, seed + k) for k in range(MEMBERS)], 0.5)
    prior = estimate_prior(first.logits(left_p), first.logits(left_u))
    members = Committee([minimise(positive[:half_p], unlabelled[:half_u], prior, seed + k) for k in range(MEMBERS)], prior)
    cut = estimate_cut(members.logits(left_p), members.logits(left_u), prior)
    members.shift = float(np.log(threshold / (1 - threshold)) - cut)
    return members


def _sample(docs: DataFrame, ids: DataFrame, key: str, text: str) -> np.ndarray:
    """Inputs of the texts of a bounded set of ids, computed where the texts lie; in an order that a seed fixes."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lo, hi in batches(texts := frame["text"].tolist()):
                yield pd.DataFrame({"key": frame["key"].iloc[lo:hi], "x": list(features(texts[lo:hi]).astype(np.float32))})

    own = docs.select(F.col(key).alias("own"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    own = own.filter(F.length("text").between(1, LONGEST)).join(F.broadcast(ids.select(F.col(key).alias("id"))), F.col("own") == F.col("id"))
    rows = own.select(F.col("own").cast("string").alias("key"), "text").mapInPandas(work, "key string, x array<float>").collect()
    rows.sort(key=lambda r: (r["key"], r["x"]))
    x = np.array([r["x"] for r in rows], dtype=np.float64).reshape(-1, FEATURES)
    return x[np.random.default_rng(5).permutation(len(x))]


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", threshold: float = 0.7
) -> Committee:
    """Model from bounded samples of the rows outside the held-out fold; ``threshold`` is the score from which a text is good."""
    outside = F.col(key).isNotNull() & ~held_out(F.col(key))
    trusted = labels.filter(outside & (F.col(label) == 1)).select(F.col(key)).distinct()
    web = docs.filter(outside).select(F.col(key)).distinct()
    positive, unlabelled = (
        _sample(docs, chosen(ids, key, most, 3), key, text) for ids, most in ((trusted, POSITIVES), (web, UNLABELLED))
    )
    if not (len(positive) and len(unlabelled)):
        return Committee([], 0.5)
    return fit(positive, unlabelled, threshold)


def score(docs: DataFrame, model: Committee, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score`` for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame["text"].tolist()
            for lo, hi in batches(texts):
                yield pd.DataFrame({"key": frame["key"].iloc[lo:hi], "score": shared.value.scores(texts[lo:hi])})

    own = docs.select(F.col(key).cast("string").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = own.mapInPandas(work, "key string, score double")
    return found.select(F.col("key").cast(docs.schema[key].dataType).alias(key), "score")
