"""Fitting a linear classifier on hashed n-grams by shards.

The labelled sample is dealt to a fixed number of shards, every shard makes its
features and runs its own FTRL-proximal learner; the averaged weights are the
model.  What reaches the driver is the model, bounded by the
number of hash buckets times classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import slices, stored
from seriesloom.llm.ngrams import counts, follow_regularised_leader, hashed, mean_weight


@dataclass(frozen=True)
class Shape:
    """Orders of the n-grams, hash bits, and the learner's parameters."""

    orders: tuple[int, ...]
    bits: int
    shards: int = 8
    epochs: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.0
    l2: float = 0.0

    @property
    def buckets(self) -> int:
        return 1 << self.bits


@dataclass(frozen=True)
class Model:
    """Weights by bucket and class with the features' scale already in them, biases, and a final slope and shift on the logits."""

    shape: Shape
    weights: np.ndarray
    bias: np.ndarray
    slope: float = 1.0
    shift: float | np.ndarray = 0.0

    def logits(self, text: str) -> np.ndarray:
        return self.slope * (mean_weight(text, self.shape.orders, self.shape.bits, self.weights) + self.bias) + self.shift


def quotas(sizes: dict[int, int], rows: int) -> dict[int, float]:
    """The share of each label's texts to draw, so that about ``rows`` are drawn and none of the labels crowds out the others."""
    left, out = rows, {}
    for k, (label, n) in enumerate(sorted(sizes.items(), key=lambda x: (x[1], x[0]))):
        take = min(n, left // (len(sizes) - k))
        out[label], left = take / max(n, 1), left - take
    return out


def distinct_texts(rows: DataFrame, label: str = "label") -> dict:
    """How many different texts each label has, to about 2 %."""
    return {r[0]: r[1] for r in rows.groupBy(label).agg(F.approx_count_distinct(F.xxhash64("text"), 0.02)).collect()}


def sampled(rows: DataFrame, shape: Shape, sample_rows: int, sizes: dict[int, int]) -> tuple[DataFrame, dict[int, float]]:
    """(shard, label, text, unseen) of a bounded sample of the distinct rows (text, label), stored; and the share drawn of each label.

    ``sizes``: the labels' numbers of texts.  Texts are drawn by their hash, the same text once per label, so repeated
    rows or ids don't widen the bound; a label rarer than its part of
    ``sample_rows`` is taken whole.  A tenth is ``unseen``, for the calibration.
    Features are made where they are used, as they take several times the room.
    """
    rows = rows.select("text", F.col("label").cast("int").alias("label"))
    share = quotas(sizes, sample_rows)
    rate = F.lit(0.0)
    for label, s in share.items():
        rate = F.when(F.col("label") == label, F.lit(s)).otherwise(rate)
    drawn = rows.filter(F.pmod(F.xxhash64(F.lit("sample"), F.col("text")), F.lit(1 << 30)) < rate * (1 << 30)).dropDuplicates(["text", "label"])
    shard = F.pmod(F.xxhash64("text", "label"), F.lit(shape.shards)).cast("int")
    unseen = F.pmod(F.xxhash64(F.lit("unseen"), F.col("text")), F.lit(10)) == 0
    return stored(drawn.withColumns({"shard": shard, "unseen": unseen})), share


def fit(examples: DataFrame, shape: Shape, classes: int, scale: np.ndarray) -> Model:
    """The averaged model of all shards; ``scale`` multiplies each bucket's share."""

    def train(frame: pd.DataFrame) -> pd.DataFrame:
        # The learner depends on the order of its rows, a shuffle's is arbitrary.
        frame = frame.sort_values(["text", "label"], kind="stable")
        labels = frame["label"].to_numpy()
        found = [counts(t, shape.orders, shape.bits) for t in frame["text"]]
        found = [(i.astype(np.uint32), v) for i, v in found]

        def example(k: int) -> tuple[np.ndarray, np.ndarray, int]:
            i, v = found[k]
            return i, v * scale[i], int(labels[k])

        w, bias = follow_regularised_leader(example, len(found), classes, shape.buckets, alpha=shape.alpha, beta=shape.beta, l1=shape.l1, l2=shape.l2, epochs=shape.epochs)
        return pd.DataFrame({"w": [w.astype("<f4").tobytes()], "bias": [bias.astype("<f8").tobytes()]})

    # One row per shard, of the model's size; stored, so that the shards are fitted side by side and once.
    trained = stored(examples.groupBy("shard").applyInPandas(train, "w binary, bias binary")).collect()
    weights, bias = np.zeros((shape.buckets, classes)), np.zeros(classes)
    for row in trained:
        weights += np.frombuffer(bytes(row["w"]), "<f4").reshape(weights.shape) / len(trained)
        bias += np.frombuffer(bytes(row["bias"]), "<f8") / len(trained)
    return Model(shape, (weights * scale[:, None]).astype(np.float32), bias)


def sample_logits(examples: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Labels and logits of the bounded sample, for the calibration."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = [model.logits(t).tolist() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(out, pa.list_(pa.float64()))], ["label", "logits"])

    got = examples.select("label", "text").mapInArrow(run, "label int, logits array<double>").collect()
    return np.array([r[0] for r in got], np.int64), np.array([r[1] for r in got], np.float64).reshape(len(got), -1)


def document_frequencies(rows: DataFrame, shape: Shape) -> tuple[np.ndarray, int]:
    """In how many of all rows (text) each bucket occurs, and the number of rows.

    Every task counts its own rows into one array, and Spark adds these up by
    bucket; the result is bounded by the number of buckets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = np.zeros(shape.buckets, np.int64), 0
        seen = np.zeros(shape.buckets, bool)
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                n += 1
                seen[:] = False
                for ids in hashed(text or "", shape.orders, shape.bits):
                    seen[ids] = True
                found += seen
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1), pa.int32()), pa.array(np.append(found[used], n), pa.int64())], ["bucket", "n"])

    sums = rows.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out, total = np.zeros(shape.buckets, np.int64), 0
    for bucket, n in sums:
        if bucket < 0:
            total = n
        else:
            out[bucket] = n
    return out, total


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(labels: np.ndarray, logits: np.ndarray) -> float:
    """The slope on the logits with the least log loss: a search by golden section over its logarithm."""
    if len(labels) == 0:
        return 1.0

    def loss(x: float) -> float:
        p = softmax(np.exp(x) * logits)[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    a, b, g = -5.0, 5.0, (5**0.5 - 1) / 2
    for _ in range(60):
        c, d = b - g * (b - a), a + g * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def slope_and_shift(labels: np.ndarray, margins: np.ndarray, weights: np.ndarray, prior: tuple[float, float], strength: float = 0.02, steps: int = 100) -> tuple[float, float]:
    """Weighted logistic calibration of a binary margin by damped Newton steps, held near ``prior`` where there are few rows."""
    start = np.array(prior)
    theta, x = start.copy(), np.column_stack([margins, np.ones(len(margins))])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -500, 500)))
        gradient = x.T @ (weights * (p - labels)) + strength * (theta - start)
        hessian = (x * (weights * p * (1 - p))[:, None]).T @ x + strength * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        theta -= step * min(1.0, 5.0 / max(1e-9, float(np.abs(step).max())))
    return float(theta[0]), float(theta[1])


def replaced(model: Model, **changes) -> Model:
    return replace(model, **changes)
