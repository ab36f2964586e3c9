"""Quality scores by a linear SVM on n-gram indicators scaled by class log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from etlkit.runtime import require

# Byte n-grams of 1 to 3 bytes fall in this many slots.
SLOTS_LOG2 = 17
MULTIPLIERS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)


def indicators(text: str | None, chunk: int = 1 << 20) -> np.ndarray:
    """Slots of the byte n-grams (1 to 3) that a whole text holds, ascending. Case is kept."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    seen = np.zeros(1 << SLOTS_LOG2, dtype=bool)
    shift = np.uint32(32 - SLOTS_LOG2)
    for at in range(0, len(data), chunk):
        x = data[max(0, at - 2) : at + chunk].astype(np.uint32) + np.uint32(1)
        h = np.zeros(len(x), dtype=np.uint32)
        for n, m in enumerate(MULTIPLIERS):
            if len(x) <= n:
                break
            h = (h[: len(x) - n] if n == 0 else h[:-1]) * np.uint32(31) + x[n:] * np.uint32(m)
            seen[(h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> shift] = True
    return np.flatnonzero(seen).astype(np.int32)


@dataclass(frozen=True)
class Model:
    """Slot weights (log-count ratio times SVM weight), bias, and the slope and shift of the score."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, text: str | None) -> float:
        slots = indicators(text)
        margin = self.weights[slots].sum() / np.sqrt(max(1, len(slots))) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30))))


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, dim: int, cost: np.ndarray, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Hinge-loss SVM with a bias feature of value 1: one dual variable a row, boxed by its cost."""
    w, bias, alpha = np.zeros(dim), 0.0, np.zeros(len(rows))
    square = np.array([v @ v + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            gradient = y[i] * (w[rows[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[rows[i]] += step * values[i]
                bias += step
                alpha[i], moved = new, max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, bias


def fit(rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0, smooth: float = 1.0, folds: int = 4, epochs: int = 12, seed: int = 5) -> Model:
    """Fit on indicator rows. The score's logistic curve is fitted on margins of held-out folds."""
    dim, y = 1 << SLOTS_LOG2, np.where(labels > 0, 1.0, -1.0)
    if len(rows) == 0 or abs(y.sum()) == len(y):
        # One class only, or no rows: a constant score.
        return Model(np.zeros(dim), 0.0, 0.0, 0.0 if len(rows) == 0 else 4.0 * y[0])

    def train(pick: np.ndarray) -> tuple[np.ndarray, float]:
        counts = np.full((2, dim), smooth)
        for i in pick:
            counts[int(y[i] > 0)][rows[i]] += 1
        ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
        values = [ratio[rows[i]] / np.sqrt(max(1, len(rows[i]))) for i in pick]
        w, bias = dual_coordinate_descent([rows[i] for i in pick], values, y[pick], dim, np.full(len(pick), cost), epochs, seed)
        return w * ratio, bias

    def margins(model: tuple[np.ndarray, float], pick: np.ndarray) -> np.ndarray:
        return np.array([model[0][rows[i]].sum() / np.sqrt(max(1, len(rows[i]))) + model[1] for i in pick])

    fold = np.random.default_rng(seed).integers(0, folds, len(rows))
    held = np.zeros(len(rows))
    for k in range(folds):
        inside, outside = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        if len(outside) and len(inside):
            held[outside] = margins(train(inside), outside)
    slope, shift = _logistic(held, (y > 0).astype(float))
    weights, bias = train(np.arange(len(rows)))
    return Model(weights, float(bias), slope, shift)


def _logistic(x: np.ndarray, t: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Newton steps for ``P(t = 1) = 1 / (1 + exp(-(a x + b)))``, lightly regularised."""
    a = b = 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([((p - t) * x).sum() + 1e-3 * a, (p - t).sum() + 1e-3 * b])
        s = p * (1 - p)
        h = np.array([[(s * x * x).sum() + 1e-3, (s * x).sum()], [(s * x).sum(), s.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, usable: Column, doc_id: str, text: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled texts, picked by a hash of their id: ``(doc_id, label, text)``.

    The ids are picked from the labels alone, so their number bounds the side that is broadcast.
    """
    picked = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("label"))
    picked = picked.filter(usable).distinct().orderBy(F.xxhash64("__id"), "__id", "label").limit(rows)
    found = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(picked), F.col("doc_id") == F.col("__id"))
    # An id that many rows carry gives one text.
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def fit_quality(docs: DataFrame, labels: DataFrame, label: str, usable: Column, doc_id: str = "doc_id", text: str = "text", rows: int = 6_000) -> Model:
    """A model from at most ``rows`` labelled rows for which ``usable`` (of column ``__id``) holds.

    Indicators are made on the executors; what reaches the driver is at most ``rows`` lists of at
    most 2^17 slots. A null text counts as empty. Rows are fitted in the order of their ids, so the
    model does not depend on the layout of the table.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = [indicators(t.as_py()).tobytes() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(slots, pa.binary())], names=["doc_id", "label", "slots"])

    chosen = training_rows(docs, labels, label, usable, doc_id, text, rows)
    kind = docs.schema[doc_id].dataType.simpleString()
    got = sorted((r.doc_id, r.label, bytes(r.slots)) for r in chosen.mapInArrow(run, f"doc_id {kind}, label int, slots binary").toLocalIterator())
    return fit([np.frombuffer(s, dtype=np.int32) for _, _, s in got], np.array([y for _, y, _ in got]))


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, score, predicted)`` of every whole text; an empty or null text has the model's base score."""
    require(docs, doc_id, text)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^17 weights whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array([shared.value.score(t.as_py()) for t in batch.column(1)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), values], names=["doc_id", "score"])

    kind = docs.schema[doc_id].dataType.simpleString()
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return picked.mapInArrow(run, f"doc_id {kind}, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
