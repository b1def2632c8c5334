"""What the learned operators share: folds, bounded samples, the optimizer, calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 4
HELD_OUT = 2


def fold(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % FOLDS


def held_out(key: Column) -> Column:
    return F.coalesce(fold(key) == HELD_OUT, F.lit(False))


def chosen(rows: DataFrame, key: str, most: int, seed: int) -> DataFrame:
    """At most ``most`` rows, those of smallest hash of the key."""
    return rows.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(most)


def texts_of(docs: DataFrame, ids: DataFrame, key: str, text: str, longest: int) -> list[tuple]:
    """Rows of ``ids`` with their texts, in a fixed order; ``ids`` is a bounded sample, texts over ``longest`` characters are left out."""
    own = docs.select(F.col(key).alias("__key"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    own = own.filter(F.length("__text").between(1, longest))
    few = F.broadcast(ids)
    rows = own.join(few, F.col("__key") == few[key]).select(*ids.columns, "__text").collect()
    return sorted((tuple(r) for r in rows), key=lambda r: tuple(str(x) for x in r))


class Adam:
    def __init__(self, parameters: dict[str, np.ndarray], rate: float) -> None:
        self.parameters, self.rate, self.step = parameters, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in parameters.items()}
        self.v = {k: np.zeros_like(v) for k, v in parameters.items()}

    def update(self, gradients: dict[str, np.ndarray]) -> None:
        self.step += 1
        for k, g in gradients.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            m = self.m[k] / (1 - 0.9**self.step)
            v = self.v[k] / (1 - 0.999**self.step)
            self.parameters[k] -= (self.rate * m / (np.sqrt(v) + 1e-8)).astype(self.parameters[k].dtype)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def calibrated(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic fit of ``labels`` by ``logits``, by Newton steps with a small ridge."""
    x = np.stack([logits, np.ones_like(logits)], axis=1).astype(np.float64)
    t = np.zeros(2)
    for _ in range(rounds):
        p = sigmoid(x @ t)
        slope = x.T @ (weights * (p - labels)) + 1e-3 * t
        curve = (x * (weights * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        t -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(t[0], 1e-3)), float(t[1])
