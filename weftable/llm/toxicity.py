"""Toxicity scores of a bidirectional gated recurrent network with attention pooling, trained in numpy.

Each word enters by a hashed word embedding and by embeddings of its hashed runs of
four bytes and beginnings of four to six, each with a fixed input that
tells how much more often toxic sample documents contain it. The network reads windows of ``WINDOW`` words that overlap by
``WINDOW - STRIDE``, in both directions; attention weighs the states of a window into one vector and a logit.
A document's logit is the largest of all its windows, which cover the whole text, and becomes a probability by a
logistic fit.

The sample is bounded (``PER_CLASS`` labelled documents of each class, of up to ``LONGEST`` characters); everything
else covers all rows. In training, the fixed inputs of a document leave that document out.

Defined cases: null, empty and blank texts have no windows and get the score of an empty window; words are runs of
letters, digits and other than ASCII characters, A-Z as a-z; without labelled rows of both classes every score
is the share of positive labels (one half without labels); equal texts get equal scores; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import batches, mix, separators, span_hashes, word_spans
from .learning import Adam, calibrated, chosen, held_out, sigmoid, texts_of
from .workers import tasks_of

WINDOW, STRIDE = 64, 48
PER_CLASS, LONGEST = 2000, 20_000
STATE, EMBED, ATTEND = 8, 8, 8
COUNT_BITS, EMBED_BITS = 18, 15
SMOOTH = 1.0
EPOCHS, BATCH, RATE = 9, 128, 0.01
STEPS = 160  # of the optimizer at the least, in more epochs if the sample is small
#: Share of word and gram embeddings set to zero in each step of training, so that none is relied on alone.
DROPPED = 0.9
AT_ONCE = 2048
#: Grams are the runs of four bytes of a word, and its beginnings of these sizes.
PREFIXES = (4, 5, 6)


@dataclass
class Words:
    """Distinct words of a batch of texts, the grams of each, and the texts as sequences of them."""

    hashes: np.ndarray
    grams: np.ndarray
    gram_at: np.ndarray
    sequence: np.ndarray
    starts: np.ndarray


def read_words(texts: list[str]) -> Words:
    data, first, last, at = word_spans(texts, separators("other"))
    hashes, one, sequence = np.unique(span_hashes(data, first, last), return_index=True, return_inverse=True)
    first, last = first[one], last[one]
    padded = np.concatenate((data, np.zeros(PREFIXES[-1], np.uint8))).astype(np.uint64)
    counts = np.maximum(last - first - 3, 1) + len(PREFIXES)
    gram_at = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(first)), counts)
    place = np.arange(int(counts.sum())) - gram_at[owner]
    begin = first[owner] + np.maximum(place - len(PREFIXES), 0)
    size = np.where(place < len(PREFIXES), np.array(PREFIXES)[np.minimum(place, len(PREFIXES) - 1)], 4)
    end = np.minimum(begin + size, last[owner])
    value = (np.minimum(place, len(PREFIXES)) + 1).astype(np.uint64) << np.uint64(56)
    for i in range(PREFIXES[-1]):
        value |= np.where(begin + i < end, padded[begin + i], 0).astype(np.uint64) << np.uint64(8 * i)
    return Words(hashes, mix(value), gram_at, sequence.reshape(-1), at)


def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def windows(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, size and text of every window."""
    sizes = np.diff(starts)
    counts = np.where(sizes > 0, np.maximum(-(-(sizes - WINDOW) // STRIDE), 0) + 1, 0)
    text = np.repeat(np.arange(len(sizes)), counts)
    place = np.arange(int(counts.sum())) - (np.cumsum(counts) - counts)[text]
    first = starts[:-1][text] + place * STRIDE
    return first, np.minimum(WINDOW, starts[1:][text] - first), text


@dataclass
class Model:
    parameters: dict[str, np.ndarray]
    word_odds: np.ndarray
    gram_odds: np.ndarray
    slope: float = 1.0
    offset: float = 0.0
    constant: float | None = None

    def inputs(self, w: Words, word_odds: np.ndarray | None = None, gram_odds: np.ndarray | None = None) -> np.ndarray:
        """One vector for each distinct word."""
        p = self.parameters
        odds = (self.word_odds if word_odds is None else word_odds)[_bucket(w.hashes, COUNT_BITS)]
        gram = (self.gram_odds if gram_odds is None else gram_odds)[_bucket(w.grams, COUNT_BITS)]
        if not len(w.hashes):
            return np.zeros((0, 2 * EMBED + 2), dtype=np.float32)
        sums = np.add.reduceat(p["gram"][_bucket(w.grams, EMBED_BITS)], w.gram_at, axis=0)
        counts = np.diff(np.append(w.gram_at, len(w.grams)))[:, None]
        top = np.maximum.reduceat(gram, w.gram_at)
        return np.concatenate(
            (p["word"][_bucket(w.hashes, EMBED_BITS)], odds[:, None], sums / counts, top[:, None]), axis=1, dtype=np.float32
        )

    def logits(self, x: np.ndarray, sequence: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Logits of windows over ``sequence``, whose entries are rows of ``x``."""
        p = self.parameters
        gates = {d: np.concatenate((x @ p[f"in_{d}"] + p[f"bias_{d}"], np.zeros((1, 3 * STATE), np.float32))) for d in "fb"}
        padded = np.append(sequence, len(x)).astype(np.int32)
        out = np.zeros(len(first), dtype=np.float32)
        order = np.argsort(-size, kind="stable")
        for lo in range(0, len(order), AT_ONCE):
            at = order[lo : lo + AT_ONCE]
            steps = int(size[at].max())
            place = np.arange(steps)[:, None]
            inside = place < size[at][None, :]
            rows = np.where(inside, padded[np.minimum(first[at][None, :] + place, len(sequence))], len(x))
            mask = inside.astype(np.float32)[:, :, None]
            ahead = np.zeros((steps, len(at), STATE), dtype=np.float32)
            h = np.zeros((len(at), STATE), dtype=np.float32)
            for t in range(steps):
                h = _step(gates["f"][rows[t]], h, p["rec_f"], mask[t])
                ahead[t] = h
            h = np.zeros_like(h)
            weight = np.zeros((len(at), 1), dtype=np.float32)
            pooled = np.zeros((len(at), 2 * STATE), dtype=np.float32)
            for t in range(steps - 1, -1, -1):
                h = _step(gates["b"][rows[t]], h, p["rec_b"], mask[t])
                both = np.concatenate((ahead[t], h), axis=1)
                e = np.exp(np.tanh(both @ p["attend"] + p["attend_bias"]) @ p["attend_out"]) * mask[t]
                weight += e
                pooled += e * both
            out[at] = (pooled / np.maximum(weight, 1e-9)) @ p["out"][:, 0] + p["out_bias"][0]
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        w = read_words(texts)
        first, size, text = windows(w.starts)
        best = np.full(len(texts), -np.inf, dtype=np.float64)
        np.maximum.at(best, text, self.logits(self.inputs(w), w.sequence, first, size))
        best[np.isinf(best)] = float(self.parameters["out_bias"][0])
        return sigmoid(self.slope * best + self.offset)


def _step(gate: np.ndarray, h: np.ndarray, rec: np.ndarray, mask: np.ndarray) -> np.ndarray:
    r = h @ rec
    zr = sigmoid(gate[:, : 2 * STATE] + r[:, : 2 * STATE])
    z = zr[:, :STATE]
    n = np.tanh(gate[:, 2 * STATE :] + zr[:, STATE:] * r[:, 2 * STATE :])
    return h + mask * (1 - z) * (n - h)


def _run(gates: np.ndarray, rec: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, list]:
    """States of one direction for training, with what the way back needs."""
    h = np.zeros((gates.shape[1], STATE), dtype=np.float32)
    states, kept = [], []
    for g, m in zip(gates, mask, strict=True):
        r = h @ rec
        zr = sigmoid(g[:, : 2 * STATE] + r[:, : 2 * STATE])
        z, reset = zr[:, :STATE], zr[:, STATE:]
        n = np.tanh(g[:, 2 * STATE :] + reset * r[:, 2 * STATE :])
        kept.append((h, z, reset, n, r[:, 2 * STATE :], m))
        h = h + m * (1 - z) * (n - h)
        states.append(h)
    return np.stack(states), kept


def _back(d_states: np.ndarray, rec: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the gates' inputs and of the recurrent weights."""
    d_rec = np.zeros_like(rec)
    d_gates = np.zeros((len(kept), d_states.shape[1], 3 * STATE), dtype=np.float32)
    d_h = np.zeros_like(d_states[0])
    for t in range(len(kept) - 1, -1, -1):
        h, z, reset, n, rn, m = kept[t]
        d = d_h + d_states[t]
        d_n = d * m * (1 - z) * (1 - n * n)
        d_z = -d * m * (n - h) * z * (1 - z)
        d_r = d_n * rn * reset * (1 - reset)
        d_gates[t] = np.concatenate((d_z, d_r, d_n), axis=1)
        through = np.concatenate((d_z, d_r, d_n * reset), axis=1)
        d_rec += h.T @ through
        d_h = d * (1 - m * (1 - z)) + through @ rec.T
    return d_gates, d_rec


def gradients(p: dict[str, np.ndarray], x: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> tuple[float, dict, np.ndarray]:
    """Loss, gradients of the weights and of the inputs; ``x`` is steps x windows x inputs."""
    f, kept_f = _run(x @ p["in_f"] + p["bias_f"], p["rec_f"], mask)
    b, kept_b = _run((x @ p["in_b"] + p["bias_b"])[::-1], p["rec_b"], mask[::-1])
    both = np.concatenate((f, b[::-1]), axis=2)
    u = np.tanh(both @ p["attend"] + p["attend_bias"])
    e = np.exp(u @ p["attend_out"]) * mask
    weight = e / np.maximum(e.sum(axis=0), 1e-9)
    pooled = (weight * both).sum(axis=0)
    y = sigmoid(pooled @ p["out"] + p["out_bias"])[:, 0]
    loss = -float(np.mean(labels * np.log(y + 1e-9) + (1 - labels) * np.log(1 - y + 1e-9)))
    d_y = ((y - labels) / len(labels)).astype(np.float32)[:, None]
    g = {"out": pooled.T @ d_y, "out_bias": d_y.sum(axis=0)}
    d_pooled = d_y @ p["out"].T
    d_weight = (both * d_pooled).sum(axis=2, keepdims=True)
    d_e = weight * (d_weight - (weight * d_weight).sum(axis=0))
    d_u = (d_e @ p["attend_out"].T) * (1 - u * u)
    g["attend_out"] = np.einsum("tba,tbo->ao", u, d_e)
    g["attend"] = np.einsum("tbh,tba->ha", both, d_u)
    g["attend_bias"] = d_u.sum(axis=(0, 1))
    d_both = weight * d_pooled + d_u @ p["attend"].T
    d_f, g["rec_f"] = _back(d_both[:, :, :STATE], p["rec_f"], kept_f)
    d_b, g["rec_b"] = _back(d_both[::-1, :, STATE:], p["rec_b"], kept_b)
    d_b = d_b[::-1]
    d_x = d_f @ p["in_f"].T + d_b @ p["in_b"].T
    for name, d in (("f", d_f), ("b", d_b)):
        g[f"in_{name}"] = np.einsum("tbi,tbg->ig", x, d)
        g[f"bias_{name}"] = d.sum(axis=(0, 1))
    return loss, g, d_x


def _parameters(random: np.random.Generator) -> dict[str, np.ndarray]:
    inputs = 2 * EMBED + 2

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (random.standard_normal(shape) * scale).astype(np.float32)

    p = {"word": normal(1 << EMBED_BITS, EMBED, scale=0.05), "gram": normal(1 << EMBED_BITS, EMBED, scale=0.05)}
    for d in "fb":
        p[f"in_{d}"] = normal(inputs, 3 * STATE, scale=0.3)
        p[f"rec_{d}"] = normal(STATE, 3 * STATE, scale=0.2)
        p[f"bias_{d}"] = np.zeros(3 * STATE, dtype=np.float32)
    p["attend"], p["attend_bias"] = normal(2 * STATE, ATTEND, scale=0.3), np.zeros(ATTEND, np.float32)
    p["attend_out"] = normal(ATTEND, 1, scale=0.3)
    p["out"], p["out_bias"] = normal(2 * STATE, 1, scale=0.3), np.zeros(1, np.float32)
    return p


def _counts(w: Words, hashes: np.ndarray, owner_word: np.ndarray, text_of: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Documents of each class that contain each bucket, 2 x buckets."""
    bucket = _bucket(hashes, COUNT_BITS)
    order = np.argsort(owner_word, kind="stable")
    counts = np.bincount(owner_word, minlength=len(w.hashes))
    at = np.cumsum(counts) - counts
    out = np.zeros((2, 1 << COUNT_BITS))
    for lo in range(0, len(w.starts) - 1, 256):  # some documents at a time
        hi = min(lo + 256, len(w.starts) - 1)
        span = slice(w.starts[lo], w.starts[hi])
        words, text = w.sequence[span], text_of[span]
        n = counts[words]
        place = np.repeat(at[words] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        pair = np.unique(np.repeat(text, n) << COUNT_BITS | bucket[order[place]])
        for c in (0, 1):
            of = pair[labels[pair >> COUNT_BITS] == c] & (1 << COUNT_BITS) - 1
            out[c] += np.bincount(of, minlength=1 << COUNT_BITS)
    return out


def _odds(counts: np.ndarray, sizes: np.ndarray, without: int | None = None) -> np.ndarray:
    """Log odds by bucket; ``without`` leaves one document of that class out."""
    c = [np.maximum(counts[k] - (without == k), 0) for k in (0, 1)]
    n = [sizes[k] - (without == k) for k in (0, 1)]
    odds = np.log((c[1] + SMOOTH) / (n[1] + 2 * SMOOTH)) - np.log((c[0] + SMOOTH) / (n[0] + 2 * SMOOTH))
    return np.clip(odds, -3, 3).astype(np.float32)


def fit(texts: list[str], labels: np.ndarray, share: float, seed: int = 1) -> Model:
    """Trains on whole texts with labels 0 and 1; ``share`` is that of label 1 among all labelled rows."""
    random = np.random.default_rng(seed)
    w = read_words(texts)
    text_of = np.repeat(np.arange(len(texts)), np.diff(w.starts))
    gram_count = np.diff(np.append(w.gram_at, len(w.grams)))
    owner = np.repeat(np.arange(len(w.hashes)), gram_count)
    sizes = np.array([(labels == 0).sum(), (labels == 1).sum()])
    word_counts = _counts(w, w.hashes, np.arange(len(w.hashes)), text_of, labels)
    gram_counts = _counts(w, w.grams, owner, text_of, labels)
    model = Model(_parameters(random), _odds(word_counts, sizes), _odds(gram_counts, sizes))
    p = model.parameters
    without = [(_odds(word_counts, sizes, c), _odds(gram_counts, sizes, c)) for c in (0, 1)]
    word_odds = [o[_bucket(w.hashes, COUNT_BITS)] for o, _ in without]
    gram_odds = [np.maximum.reduceat(o[_bucket(w.grams, COUNT_BITS)], w.gram_at) for _, o in without]
    first, size, text = windows(w.starts)
    bag = np.searchsorted(text, np.arange(len(texts) + 1))
    label_of = labels[text]

    def all_logits() -> np.ndarray:
        out = np.zeros(len(first), dtype=np.float32)
        for c in (0, 1):
            x = model.inputs(w, without[c][0], without[c][1])
            out[label_of == c] = model.logits(x, w.sequence, first[label_of == c], size[label_of == c])
        return out

    def tops(values: np.ndarray) -> np.ndarray:
        return np.array([a + int(np.argmax(values[a:b])) for a, b in zip(bag[:-1], bag[1:], strict=True) if b > a])

    strength = np.where(labels[text_of] == 1, np.maximum(word_odds[1], gram_odds[1])[w.sequence], np.maximum(word_odds[0], gram_odds[0])[w.sequence])
    strongest = np.array([strength[a : a + n].max() for a, n in zip(first, size, strict=True)])
    optimizer = Adam(p, RATE)
    epochs = max(EPOCHS, -(-STEPS // max(1, len(texts) * 5 // (4 * BATCH))))
    for epoch in range(epochs):
        if epoch % max(1, epochs // 3) == 0:
            picked = tops(strongest if epoch == 0 else all_logits())
        order = random.permutation(np.concatenate((picked, random.choice(np.flatnonzero(label_of == 0), len(picked) // 4))))
        for lo in range(0, len(order), BATCH):
            at = order[lo : lo + BATCH]
            steps = int(size[at].max())
            place = np.arange(steps)[:, None]
            inside = place < size[at][None, :]
            rows = w.sequence[np.minimum(first[at][None, :] + place, len(w.sequence) - 1)]
            flat, back = np.unique(rows, return_inverse=True)
            back = back.reshape(rows.shape)
            n = gram_count[flat]
            gram_rows = np.repeat(w.gram_at[flat] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            gram_bucket = _bucket(w.grams[gram_rows], EMBED_BITS)
            gram_mean = np.add.reduceat(p["gram"][gram_bucket], np.cumsum(n) - n, axis=0) / n[:, None]
            word_bucket = _bucket(w.hashes[flat], EMBED_BITS)
            positive = (labels[text[at]] == 1)[None, :]
            odds = np.where(positive, word_odds[1][rows], word_odds[0][rows])
            top = np.where(positive, gram_odds[1][rows], gram_odds[0][rows])
            x = np.concatenate((p["word"][word_bucket][back], odds[..., None], gram_mean[back], top[..., None]), axis=2, dtype=np.float32)
            mask = inside.astype(np.float32)[:, :, None]
            kept = (random.random((*rows.shape, 2)) >= DROPPED).astype(np.float32) / (1 - DROPPED)
            x[..., :EMBED] *= kept[..., :1]
            x[..., EMBED + 1 : 2 * EMBED + 1] *= kept[..., 1:]
            x *= mask
            _, g, d_x = gradients(p, x, mask, label_of[at].astype(np.float32))
            d_x[..., :EMBED] *= kept[..., :1]
            d_x[..., EMBED + 1 : 2 * EMBED + 1] *= kept[..., 1:]
            d_x = (d_x * mask).reshape(-1, d_x.shape[2])
            per_word = np.zeros((len(flat), d_x.shape[1]), dtype=np.float32)
            np.add.at(per_word, back.reshape(-1), d_x)
            g["word"], g["gram"] = np.zeros_like(p["word"]), np.zeros_like(p["gram"])
            np.add.at(g["word"], word_bucket, per_word[:, :EMBED])
            np.add.at(g["gram"], gram_bucket, np.repeat(per_word[:, EMBED + 1 : 2 * EMBED + 1] / n[:, None], n, axis=0))
            optimizer.update(g)
    values = all_logits()
    top = tops(values)
    y = label_of[top].astype(np.float64)
    weights = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    model.slope, model.offset = calibrated(values[top].astype(np.float64), y, weights)
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text") -> Model:
    """Model from a bounded sample of labelled rows outside the held-out fold."""
    known = labels.select(F.col(key), F.col(label).cast("int").alias("label")).filter(
        F.col(key).isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col(key))
    )
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.5
    if len(counts) == 2:
        ids = chosen(known.filter("label = 1"), key, PER_CLASS, 8).unionByName(chosen(known.filter("label = 0"), key, PER_CLASS, 8))
        rows = texts_of(docs, ids.dropDuplicates([key]), key, text, LONGEST)
        y = np.array([r[1] for r in rows], dtype=np.int64)
        if len(set(y.tolist())) == 2:
            return fit([r[2] for r in rows], y, share)
    return Model({}, np.zeros(0), np.zeros(0), constant=share)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score`` for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @tasks_of("toxicity")
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame["text"].tolist()
            for lo, hi in batches(texts):
                yield pd.DataFrame({"key": frame["key"].iloc[lo:hi], "score": shared.value.scores(texts[lo:hi])})

    own = docs.select(F.col(key).cast("string").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = own.mapInPandas(work, "key string, score double")
    return found.select(F.col("key").cast(docs.schema[key].dataType).alias(key), "score")


def keep_below(docs: DataFrame, model: Model, threshold: float, text: str = "text") -> DataFrame:
    """Rows of ``docs`` that score below ``threshold``, with all their columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    @tasks_of("toxicity")
    def scored(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in series:
            values = texts.fillna("").tolist()
            parts = [shared.value.scores(values[lo:hi]) for lo, hi in batches(values)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.filter(scored(F.col(f"`{text}`")) < threshold)
