"""Marginal likelihood of words over all segmentations into the pieces of an existing vocabulary.

A word stands with the vocabulary's word-start mark before it.  Every way to
split that into pieces is a path through a lattice; the forward recursion adds
up the paths' probabilities in log space.  Characters that no piece covers are
spelled with the vocabulary's byte pieces.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np

from seriesloom.llm.common import code_points

#: The vocabulary's mark for the start of a word; a fixed value.
WORD_START = "▁"
#: Words up to this length are taken together; longer ones one at a time.
TOGETHER = 40
#: Words of one step of the recursion.
STEP = 4096
_BASE = np.uint64(1_000_003)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS = 20


class Pieces:
    """The pieces of a vocabulary, found by hash.  ``order``: best first, as the vocabulary scores them."""

    def __init__(self, names: Sequence[str], byte_of: Sequence[int]):
        #: ``names`` without the byte pieces, which follow as 256 more; ``byte_of`` isn't used beyond its length.
        self.names = list(names)
        self.longest = max(map(len, self.names), default=1)
        self.size = len(self.names) + 256
        hashes = np.array([self._hash(n) for n in self.names], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], order.astype(np.int64)
        self.present = np.zeros(1 << _FILTER_BITS, bool)
        self.present[self._slot(hashes)] = True

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((h * _MULTIPLIER) >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)

    @staticmethod
    def _hash(name: str) -> int:
        h = 0
        for c in name:
            h = (h * int(_BASE) + ord(c) + 1) & (1 << 64) - 1
        return h

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece numbers of the hashes, -1 where there is none."""
        out = np.full(len(h), -1, np.int64)
        maybe = np.flatnonzero(self.present[self._slot(h)])
        at = np.searchsorted(self.hashes, h[maybe])
        at[at == len(self.hashes)] = 0
        same = self.hashes[at] == h[maybe] if len(self.hashes) else np.zeros(0, bool)
        out[maybe[same]] = self.ids[at[same]]
        return out


def existing_pieces(model_path: str) -> tuple[Pieces, np.ndarray]:
    """The pieces of a sentencepiece file and start values of their log probabilities.

    The file scores its pieces by rank; a rank r becomes a probability in
    proportion to 1 / (r + 2), by Zipf's law.  Byte pieces share one thousandth.
    """
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=model_path)
    plain = [k for k in range(processor.get_piece_size()) if not (processor.is_control(k) or processor.is_unknown(k) or processor.is_byte(k) or processor.is_unused(k))]
    pieces = Pieces([processor.id_to_piece(k) for k in plain], range(256))
    weight = 1.0 / (2.0 - np.array([processor.get_score(k) for k in plain]))
    p = np.concatenate([0.999 * weight / weight.sum(), np.full(256, 0.001 / 256)])
    return pieces, np.log(p)


def _edges(words: list[str], pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, list[int]]]:
    """Lengths; code points by position and word; piece numbers by (piece length, start, word), or -1; bytes of uncovered characters."""
    marked = [WORD_START + w for w in words]
    lengths = np.array([len(w) for w in marked])
    width, n = int(lengths.max()), len(words)
    points = np.zeros((width, n), np.uint64)
    for k, w in enumerate(marked):
        points[: len(w), k] = code_points(w)
    longest = min(pieces.longest, width)
    ids = np.full((longest, width, n), -1, np.int64)
    h = np.zeros((width, n), np.uint64)
    inside = np.arange(width)[:, None] < lengths[None, :]
    with np.errstate(over="ignore"):
        for size in range(1, longest + 1):
            stop = width - size + 1
            h = h[:stop] * _BASE + points[size - 1 :] + np.uint64(1)
            valid = np.flatnonzero(inside[size - 1 :].ravel())
            found = np.full(stop * n, -1, np.int64)
            found[valid] = pieces.find(h.ravel()[valid])
            ids[size - 1, :stop] = found.reshape(stop, n)
    uncovered = np.unique(points[(ids[0] < 0) & inside])
    spelled = {int(c): [len(pieces.names) + b for b in chr(int(c)).encode("utf-8", "surrogatepass")] for c in uncovered}
    return lengths, points, ids, spelled


def _weights(points: np.ndarray, lengths: np.ndarray, ids: np.ndarray, spelled: dict[int, list[int]], logp: np.ndarray) -> np.ndarray:
    w = np.where(ids >= 0, logp[ids], -np.inf)
    for c, by in spelled.items():
        w[0][points == c] = logp[by].sum()
    return w


def _forward(lengths: np.ndarray, w: np.ndarray) -> np.ndarray:
    """alpha[t, word]: log probability of all ways to the first t characters."""
    longest, width, n = w.shape
    alpha = np.full((width + 1, n), -np.inf)
    alpha[0] = 0.0
    for t in range(1, width + 1):
        sizes = np.arange(1, min(longest, t) + 1)
        ways = alpha[t - sizes] + w[sizes - 1, t - sizes]
        top = ways.max(axis=0)
        safe = np.where(np.isfinite(top), top, 0.0)
        with np.errstate(divide="ignore"):
            alpha[t] = safe + np.log(np.exp(ways - safe).sum(axis=0))
    return alpha


def _batches(words: Iterable[str]) -> Iterable[tuple[list[int], list[str]]]:
    """Words of like length together, with their places; a long word alone."""
    order = sorted(range(len(words)), key=lambda k: len(words[k]))
    some: list[int] = []
    for k in order:
        size = len(words[k]) + 1
        if some and (len(some) * (size + 1) > STEP * 12 or size > TOGETHER):
            yield some, [words[i] for i in some]
            some = []
        some.append(k)
    if some:
        yield some, [words[i] for i in some]


def log10_marginals(words: list[str], pieces: Pieces, logp: np.ndarray) -> np.ndarray:
    """log10 of each word's probability, the sum over all its segmentations."""
    out = np.zeros(len(words))
    for places, some in _batches(words):
        lengths, points, ids, spelled = _edges(some, pieces)
        alpha = _forward(lengths, _weights(points, lengths, ids, spelled, logp))
        out[places] = alpha[lengths, np.arange(len(some))] / np.log(10)
    return out


def expected_counts(words: list[str], times: np.ndarray, pieces: Pieces, logp: np.ndarray) -> np.ndarray:
    """How often each piece is expected in the words, each taken ``times`` times: one step of expectation maximisation."""
    out = np.zeros(pieces.size)
    for places, some in _batches(words):
        lengths, points, ids, spelled = _edges(some, pieces)
        w = _weights(points, lengths, ids, spelled, logp)
        alpha = _forward(lengths, w)
        longest, width, n = w.shape
        beta = np.full((width + 1, n), -np.inf)
        beta[lengths, np.arange(n)] = 0.0
        for t in range(width - 1, -1, -1):
            sizes = np.arange(1, min(longest, width - t) + 1)
            ways = beta[t + sizes] + w[sizes - 1, t]
            top = ways.max(axis=0)
            safe = np.where(np.isfinite(top), top, 0.0)
            with np.errstate(divide="ignore"):
                beta[t] = np.logaddexp(beta[t], safe + np.log(np.exp(ways - safe).sum(axis=0)))
        total, often = beta[0], times[places]
        for size in range(1, longest + 1):
            stop = width - size + 1
            share = np.exp(alpha[:stop] + w[size - 1, :stop] + beta[size:] - total) * often
            known = ids[size - 1, :stop] >= 0
            np.add.at(out, ids[size - 1, :stop][known], share[known])
            if size == 1:
                for c, by in spelled.items():
                    np.add.at(out, by, share[points[:stop] == c].sum())
    return out
