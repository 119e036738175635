"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Each n-gram bucket's share of the whole text is multiplied by the log ratio of
its smoothed shares among toxic and other labelled texts; a logistic model is
learnt on these features.  Ratios and weights come from a bounded sample of the
labelled texts (``sample_rows``), as many of each label where there are enough;
the margin is calibrated on a tenth of it that the learner didn't see, weighted
back to the labels' shares.

Cases: a null text counts as empty, and an empty text has the score of the
bias alone; a document labelled more than once is toxic if any label says so;
null labels aren't learnt from; with labels of one kind only, or none, every
score is that kind's share (0 for none); repeated rows are answered one by
one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm import linear
from seriesloom.llm.common import slices, stored
from seriesloom.llm.ngrams import counts

SHAPE = linear.Shape(orders=(3, 4, 5), bits=18, shards=8, epochs=6, alpha=0.3, beta=0.01, l1=0.0, l2=0.0)
#: Shares are small; this constant brings the learner's steps to a useful size.
GAIN = 100.0


def _log_count_ratios(examples: DataFrame, shape: linear.Shape, smoothing: float) -> np.ndarray:
    """By bucket; Spark adds up the tasks' sums, at most one row per bucket reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, shape.buckets))
        for batch in slices(batches):
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids, shares = counts(text, shape.orders, shape.bits)
                sums[label][ids] += shares
        used = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(sums[0][used]), pa.array(sums[1][used])], ["bucket", "other", "toxic"])

    found = examples.select("label", "text").mapInArrow(run, "bucket int, other double, toxic double")
    sums = np.full((2, shape.buckets), smoothing)
    by_bucket = found.groupBy("bucket").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic")).toArrow()
    for k, kind in enumerate(("other", "toxic")):
        sums[k][by_bucket["bucket"].to_numpy()] += by_bucket[kind].to_numpy()
    return np.log(sums[1] / sums[1].sum()) - np.log(sums[0] / sums[0].sum())


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = 16000, smoothing: float = 0.001, shape: linear.Shape = SHAPE) -> linear.Model:
    """Learn from the documents that ``labels`` (id, label) marks."""
    marked = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max((F.col(label_col) != 0).cast("int")).alias("label"))
    by_id = linear.quotas(dict(marked.groupBy("label").count().collect()), sample_rows)
    rate = F.lit(0.0)
    for label, s in by_id.items():
        rate = F.when(F.col("label") == label, F.lit(s)).otherwise(rate)
    # About sample_rows ids, whatever the number of labels; an id that stands on many rows is thinned out by text.
    some = F.broadcast(marked.filter(F.pmod(F.xxhash64(F.lit("id"), F.col(id_col)), F.lit(1 << 30)) < rate * (1 << 30)))
    rows = stored(docs.select(id_col, F.col(text_col).cast("string").alias("text")).filter(F.col("text").isNotNull()).join(some, id_col).select("text", "label"))
    examples, by_text = linear.sampled(rows, shape, sample_rows, linear.distinct_texts(rows))
    share = {k: by_id[k] * s for k, s in by_text.items()}
    if len(share) < 2:
        certain = 50.0 if 1 in share else -50.0
        return linear.Model(shape, np.zeros((shape.buckets, 1), np.float32), np.zeros(1), shift=certain)
    seen = examples.filter("NOT unseen")
    scale = GAIN * _log_count_ratios(seen, shape, smoothing)
    model = linear.fit(seen, shape, 2, scale)
    y, logits = linear.sample_logits(examples.filter("unseen"), model)
    # A label drawn at a lower rate stands for more rows.
    weights = np.array([1 / max(share[k], 1e-9) for k in (0, 1)])
    weights /= weights.min()
    slope, shift = linear.slope_and_shift(y, logits[:, 1] - logits[:, 0], weights[y], (1.0, float(np.log(weights[1] / weights[0]))))
    # Only the margin between the two classes matters from here on.
    return linear.replaced(model, weights=model.weights[:, 1:] - model.weights[:, :1], bias=model.bias[1:] - model.bias[:1], slope=slope, shift=shift)


def probability(model: linear.Model, text: str | None) -> float:
    """The calibrated probability that the whole text is toxic."""
    return float(1 / (1 + np.exp(-np.clip(model.logits(text or "")[0], -500, 500))))


def score(docs: DataFrame, model: linear.Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every whole text, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([probability(shared.value, t) for t in batch.column(1).to_pylist()], pa.float64())], ["id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, score double").withColumnRenamed("id", id_col)


def keep_below(docs: DataFrame, model: linear.Model, *, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The same rows and columns without the texts that score ``threshold`` or more."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept = [probability(shared.value, t) < threshold for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
