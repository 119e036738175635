"""Scoring documents by the marginal likelihood of their words' subword lattices.

Learning counts every word of every learning document.  A word's probability
is the sum over all paths of its lattice: one edge per known word that spans
it whole, weighted by its discounted count, and all segmentations into the
pieces of an existing vocabulary, weighted by what the discounts left.  The
pieces' start scores come from the vocabulary and are fitted by expectation
maximisation over the known words.  Whole-word counts are kept for the corpus
and for each class of documents (by a label of the learning documents, which a
scored document needn't have); a document's probability is the sum over the
classes, each with a Dirichlet prior around its word probabilities, so that
repetition within a document is expected.

A word here is a run of anything but ASCII white space, A-Z in lower case; a
document is its words and one end.

Cases: a null text counts as empty, i.e. its end alone; repeated rows are
scored one by one; without learning documents every base score is 0 known of
N = 0 tokens and words have their lattice alone; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.llm import lattice
from seriesloom.llm.common import slices, stored

#: Words held in a task's counter before they are handed on.
COUNTER_WORDS = 150_000
#: Strength of the Dirichlet prior, in tokens.
STRENGTH = 2000.0
#: Steps of expectation maximisation over the known words.
STEPS = 2
#: Words that make up over 1/FREQUENT of all tokens are broadcast; they number fewer than FREQUENT.
FREQUENT = 1 << 17
#: Classes with counts of their own; rarer labels share one more.
CLASSES = 6


@dataclass(frozen=True)
class Totals:
    """Of the whole learning corpus (first) and each class: tokens with ends, distinct tokens with the end, documents, discount."""

    tokens: list[int]
    types: list[int]
    documents: list[int]
    discount: list[float]

    def base(self, count: int) -> float:
        """log10 of a token's probability in the add-0.1 word model."""
        n = self.tokens[0] + 0.1 * (self.types[0] + 1)
        return math.log10((count + 0.1) / n)

    def class_logs(self, counts: np.ndarray, whole: np.ndarray, marginal: np.ndarray) -> np.ndarray:
        """ln of the probabilities by word and class; ``counts`` by word and class, ``whole`` in the corpus, ``marginal``: ln of that of the lattice's pieces."""

        def interpolate(k: int, c: np.ndarray, below: np.ndarray) -> np.ndarray:
            if not self.tokens[k]:
                return below
            with np.errstate(divide="ignore"):
                own = np.log(np.maximum(c - self.discount[k], 0) / self.tokens[k])
            return np.logaddexp(own, math.log(self.discount[k] * self.types[k] / self.tokens[k]) + below)

        corpus = interpolate(0, whole, marginal)
        return np.column_stack([interpolate(k + 1, counts[:, k], corpus) for k in range(counts.shape[1])])

    def class_ends(self) -> list[float]:
        """ln of each class's weight times what the end, once it is drawn, brings to the urn's numerator."""
        every = max(sum(self.documents[1:]), 1)
        return [math.log(max(d, 0.01) / every) + math.log(STRENGTH) + math.log(max(d - q, 0.01) / max(t, 1)) for d, q, t in zip(self.documents[1:], self.discount[1:], self.tokens[1:], strict=True)]


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def count_words(docs: DataFrame, classes: int) -> DataFrame:
    """(word, times, c0, c1, ...) of rows (text, cls): occurrences in all documents, and in learning documents by class; cls is null for others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Counter[bytes]] = [Counter() for _ in range(classes + 1)]

        def out() -> Iterator[pa.RecordBatch]:
            for k, counter in enumerate(held):
                words = pa.array(list(counter), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([words, pa.array([k] * len(counter), pa.int32()), pa.array(list(counter.values()), pa.int64())], ["word", "cls", "n"])
                counter.clear()

        for batch in slices(batches):
            for text, cls in zip(batch.column("text").to_pylist(), batch.column("cls").to_pylist(), strict=True):
                held[classes if cls is None else cls].update(_words(text))
            if sum(map(len, held)) >= COUNTER_WORDS:
                yield from out()
        yield from out()

    found = docs.select("text", "cls").mapInArrow(run, "word string, cls int, n long")
    return found.groupBy("word").agg(F.sum("n").alias("times"), *(F.sum(F.when(F.col("cls") == k, F.col("n")).otherwise(0)).alias(f"c{k}") for k in range(classes)))


def _totals(words: DataFrame, documents: dict[int, int], classes: int) -> Totals:
    def stats(c: Column) -> list[Column]:
        return [F.sum(c), F.count_if(c > 0), F.count_if(c == 1), F.count_if(c == 2)]

    each = [F.col("c"), *(F.col(f"c{k}") for k in range(classes))]
    row = words.agg(*(s.alias(f"s{i}_{j}") for i, c in enumerate(each) for j, s in enumerate(stats(c)))).first()
    docs = [sum(documents.values()), *(documents.get(k, 0) for k in range(classes))]
    tokens, types, discount = [], [], []
    for i, d in enumerate(docs):
        total, seen, once, twice = (row[4 * i + j] or 0 for j in range(4))
        tokens.append(total + d)
        types.append(seen + (d > 0))
        discount.append(once / (once + 2 * twice) if once else 0.5)
    return Totals(tokens, types, docs, discount)


def _fit_pieces(known: DataFrame, pieces: lattice.Pieces, logp: np.ndarray) -> np.ndarray:
    """Expectation maximisation over every known word; Spark adds up the tasks' counts by piece."""
    for _ in range(STEPS):
        shared = known.sparkSession.sparkContext.broadcast((pieces, logp))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own, scores = shared.value
            found = np.zeros(own.size)
            for batch in batches:
                words = batch.column(0).to_pylist()
                found += lattice.expected_counts(words, np.ones(len(words)), own, scores)
            used = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(found[used])], ["piece", "n"])

        counts = np.full(pieces.size, 0.01)
        for piece, n in known.select("word").mapInArrow(run, "piece int, n double").groupBy("piece").agg(F.sum("n")).collect():
            counts[piece] += n
        logp = np.log(counts / counts.sum())
    return logp


def _scored_words(words: DataFrame, pieces: lattice.Pieces, logp: np.ndarray, totals: Totals, classes: int) -> DataFrame:
    """(word, times, c, log_p): each distinct word with the ln of its probability by class; long words have none that a double could hold."""
    shared = words.sparkSession.sparkContext.broadcast((pieces, logp))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, scores = shared.value
        for batch in batches:
            marginal = math.log(10) * lattice.log10_marginals(batch.column("word").to_pylist(), own, scores)
            counts = np.column_stack([batch.column(f"c{k}").to_numpy() for k in range(classes)])
            log_p = totals.class_logs(counts, counts.sum(axis=1), marginal)
            flat = pa.FixedSizeListArray.from_arrays(pa.array(log_p.ravel()), classes).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("times"), pa.array(counts.sum(axis=1)), flat], ["word", "times", "c", "log_p"])

    return words.mapInArrow(run, "word string, times long, c long, log_p array<double>")


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function of positive numbers: eight steps up, then Stirling's series."""
    shift = x * (x + 1) * (x + 2) * (x + 3) * ((x + 4) * (x + 5) * (x + 6) * (x + 7))
    y = x + 8
    z = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y - np.log(shift)


def _rising(log_x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """ln of x (x + 1) ... (x + n - 1), for an x that may be too small for a double."""
    x = np.exp(log_x)
    return log_x + _log_gamma(x + n) - _log_gamma(x + 1)


def score(docs: DataFrame, learn_from: Column, model_path: str, *, id_col: str = "doc_id", text_col: str = "text", class_col: str | None = "lang") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every whole text.

    ``model_path``: a sentencepiece file with the existing vocabulary.
    ``base_score`` is the add-0.1 word model's log10 probability, ``score``
    this module's.
    """
    learns = F.coalesce(learn_from, F.lit(False))
    label = F.col(class_col).cast("string") if class_col else F.lit("")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.when(learns, F.coalesce(label, F.lit(""))).alias("label"))
    labels = rows.filter("label IS NOT NULL").groupBy("label").count()
    largest = labels.orderBy(F.desc("count"), F.desc("label")).limit(CLASSES).collect()
    named = [r["label"] for r in largest]
    documents = {k: r["count"] for k, r in enumerate(largest)}
    # The other labels, however many, are one class.
    others = (labels.agg(F.sum("count")).first()[0] or 0) - sum(documents.values())
    classes = max(1, len(named) + (others > 0))
    if others:
        documents[classes - 1] = others
    number = F.lit(classes - 1)
    for k, name in enumerate(named):
        number = F.when(F.col("label") == name, F.lit(k)).otherwise(number)
    rows = rows.select("id", "text", F.when(F.col("label").isNotNull(), number).cast("int").alias("cls"))

    words = stored(count_words(rows, classes).withColumn("c", sum((F.col(f"c{k}") for k in range(1, classes)), F.col("c0"))))
    totals = _totals(words, documents, classes)
    pieces, logp = lattice.existing_pieces(model_path)
    logp = _fit_pieces(words.filter("c > 0"), pieces, logp)
    table = stored(_scored_words(words, pieces, logp, totals, classes))

    tokens = table.agg(F.sum("times")).first()[0] or 0
    frequent = F.col("times") > max(16, tokens // FREQUENT)
    hot = table.filter(frequent).select("word", "c", "log_p").collect()
    shared = docs.sparkSession.sparkContext.broadcast(
        ({w.encode("utf-8", "surrogatepass"): k for k, (w, _, _) in enumerate(hot)}, np.array([c for _, c, _ in hot], np.int64), np.array([p for _, _, p in hot]).reshape(len(hot), classes))
    )
    sums = [f"s{k}" for k in range(classes)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, counts, logs = shared.value
        base, scaled = np.array([totals.base(int(c)) for c in counts]), math.log(STRENGTH) + logs
        key = TaskContext.get().partitionId() << 33
        for batch in slices(batches):
            out: dict[str, list] = {k: [] for k in ("key", "n_tokens", "n_known", "base", *sums, "words", "times")}
            for text in batch.column("text").to_pylist():
                listed = _words(text)
                found = Counter(listed)
                times = np.fromiter(found.values(), np.int64, len(found))
                at = np.fromiter(map(places.get, found, repeat(-1)), np.int64, len(found))
                known = at >= 0
                ids, n = at[known], times[known]
                rest = [w for w, i in zip(found, at.tolist(), strict=True) if i < 0]
                more = n > 1
                own = scaled[ids[~more]].sum(axis=0) + _rising(scaled[ids[more]], n[more, None]).sum(axis=0)
                # The end is the last draw of the urn.
                own = own - (math.lgamma(STRENGTH + len(listed) + 1) - math.lgamma(STRENGTH))
                ends = totals.documents[0]
                out["key"].append(key)
                out["n_tokens"].append(len(listed) + 1)
                out["n_known"].append(int(n[counts[ids] > 0].sum()) + (ends > 0))
                out["base"].append(float((base[ids] * n).sum()) + totals.base(ends))
                for name, v in zip(sums, own, strict=True):
                    out[name].append(float(v))
                out["words"].append(rest)
                out["times"].append(times[~known])
                key += 1
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), *[pa.float64()] * classes, pa.list_(pa.binary()), pa.list_(pa.int32())]
            made = dict(zip(out, (pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)), strict=True))
            made["words"] = made["words"].cast(pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *made.values()], ["id", *made])

    parts = stored(rows.select("id", "text").mapInArrow(run, "id long, key long, n_tokens long, n_known long, base double, " + ", ".join(f"{s} double" for s in sums) + ", words array<string>, times array<int>"))
    rest = parts.select("key", F.explode(F.arrays_zip("words", "times")).alias("w")).select("key", F.col("w.words").alias("word"), F.col("w.times").alias("n"))
    total = totals.tokens[0] + 0.1 * (totals.types[0] + 1)

    def rising(log_p: Column) -> Column:
        log_x = log_p + math.log(STRENGTH)
        more = F.aggregate(F.sequence(F.lit(1), F.col("n") - 1), log_x, lambda so_far, k: so_far + F.log(F.exp(log_x) + k))
        return F.when(F.col("n") == 1, log_x).otherwise(more)

    looked_up = rest.join(table.filter(~frequent).select("word", "c", "log_p"), "word").select(
        F.lit(None).cast("long").alias("id"),
        "key",
        F.lit(None).cast("long").alias("n_tokens"),
        F.when(F.col("c") > 0, F.col("n")).otherwise(0).cast("long").alias("n_known"),
        (F.col("n") * F.log10((F.col("c") + 0.1) / total)).alias("base"),
        *(rising(F.col("log_p")[k]).alias(s) for k, s in enumerate(sums)),
    )
    every = parts.drop("words", "times").unionByName(looked_up).groupBy("key").agg(F.max("id").alias("id"), *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", *sums)))
    by_class = F.array(*(F.col(s) + float(e) for s, e in zip(sums, totals.class_ends(), strict=True)))
    top = F.array_max(by_class)
    marginal = top + F.log(F.aggregate(F.transform(by_class, lambda x: F.exp(x - top)), F.lit(0.0), lambda a, x: a + x))
    return every.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(totals.tokens[0]).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), (marginal / math.log(10)).alias("score"))
