"""Hashed character n-grams and a sharded linear learner, shared by the classifiers of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

from seriesloom.llm.common import code_points

#: Code points hashed at once; a longer text is taken in pieces that overlap by the longest n-gram.
PIECE = 1 << 18

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def hashed(text: str, orders: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    """Bucket numbers of every character n-gram of the lower-cased whole text, an array per order and piece."""
    points = code_points(text.lower()).astype(np.uint64)
    longest, shift = max(orders), np.uint64(64 - bits)
    with np.errstate(over="ignore"):
        for at in range(0, max(len(points), 1), PIECE):
            piece = points[at : at + PIECE + longest - 1]
            value = np.zeros(len(piece), np.uint64)
            for n in range(1, longest + 1):
                if len(piece) < n:
                    break
                value = value[: len(piece) - n + 1] * np.uint64(1_000_003) + piece[n - 1 :] + np.uint64(n)
                if n in orders:
                    yield ((value[:PIECE] * _MULTIPLIER) >> shift).astype(np.int64)


def counts(text: str, orders: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a text and each one's share of the text's n-grams."""
    found = list(hashed(text, orders, bits))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    ids, n = np.unique(np.concatenate(found), return_counts=True)
    return ids, (n / n.sum()).astype(np.float32)


def mean_weight(text: str, orders: tuple[int, ...], bits: int, weights: np.ndarray) -> np.ndarray:
    """The sum of ``weights`` rows over the text's n-grams, each weighted by its share."""
    total, n = np.zeros(weights.shape[1], np.float64), 0
    for ids in hashed(text, orders, bits):
        total += np.add.reduce(weights[ids], axis=0, dtype=np.float64)
        n += len(ids)
    return total / max(n, 1)


def follow_regularised_leader(
    example: Callable[[int], tuple[np.ndarray, np.ndarray, int]], rows: int, classes: int, features: int, *, alpha: float, beta: float, l1: float, l2: float, epochs: int
) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial logistic regression by per-coordinate FTRL-proximal with elastic-net penalties.

    ``example``: (feature ids, values, class) of a row number.  Returns weights (features x
    classes) and biases; the biases aren't penalised.
    """
    z = np.zeros((features, classes))
    n = np.zeros((features, classes))
    bias, bias_n = np.zeros(classes), np.zeros(classes)

    def solve(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    order = np.arange(rows)
    for epoch in range(epochs):
        np.random.default_rng(epoch).shuffle(order)
        for k in order:
            ids, values, label = example(int(k))
            zi, ni = z[ids], n[ids]
            w = solve(zi, ni)
            logits = values @ w + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1.0
            g = values[:, None] * p
            grown = ni + g * g
            z[ids] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / alpha * w
            n[ids] = grown
            bias_n += p * p
            bias -= alpha * p / (beta + np.sqrt(bias_n))
    return solve(z, n), bias
