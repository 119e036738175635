"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Term frequency is an n-gram's share of the whole text's n-grams.  Document
frequencies count all learning rows.  The weights are learnt by
follow-the-regularised-leader with elastic-net penalties on a bounded sample
(``sample_rows``), a temperature is then fitted on rows of the sample that the
learner didn't see.

Cases: a null text or one without letters is ``und`` with score 0; so is every
text where no language could be learnt; rows without a language aren't learnt
from; repeated rows are answered one by one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.llm import linear
from seriesloom.llm.common import slices

UNDETERMINED = "und"
SHAPE = linear.Shape(orders=(1, 2, 3), bits=16, shards=8, epochs=3, alpha=0.5, beta=1.0, l1=0.02, l2=0.01)
#: TF-IDF shares are small; this constant brings the learner's steps to a useful size.
GAIN = 20.0

def has_letter(text: str) -> bool:
    """Whether a character of a letter category (L) is there; digits, fractions and number letters are none."""
    return any(map(str.isalpha, text))


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    model: linear.Model


def train(rows: DataFrame, *, text_col: str = "text", lang_col: str = "lang", sample_rows: int = 6000, shape: linear.Shape = SHAPE) -> LanguageModel:
    """Learn from ``rows``: document frequencies from all of them, weights from about ``sample_rows`` distinct texts, as many of each language where there are enough."""
    known = rows.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = linear.distinct_texts(known, "lang")
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], linear.Model(shape, np.zeros((shape.buckets, 1), np.float32), np.zeros(1)))
    seen, n = linear.document_frequencies(known, shape)
    scale = GAIN * (np.log((1 + n) / (1 + seen)) + 1)
    number = F.array_position(F.array(*map(F.lit, languages)), F.col("lang")) - 1
    examples, share = linear.sampled(known.select("text", number.alias("label")), shape, sample_rows, {k: sizes[name] for k, name in enumerate(languages)})
    model = linear.fit(examples.filter("NOT unseen"), shape, len(languages), scale)
    slope = linear.temperature(*linear.sample_logits(examples.filter("unseen"), model))
    # Languages were drawn at different rates; their shares of the corpus come back as a shift.
    drawn = np.array([share[k] for k in range(len(languages))])
    return LanguageModel(languages, linear.replaced(model, slope=slope, shift=-np.log(np.maximum(drawn, 1e-9))))


def predict(docs: DataFrame, learnt: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(learnt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, model = shared.value.languages, shared.value.model
        for batch in slices(batches):
            names, scores = [], []
            for text in batch.column(1).to_pylist():
                if not languages or not text or not has_letter(text):
                    names.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                p = linear.softmax(model.logits(text))
                best = int(p.argmax())
                names.append(languages[best])
                scores.append(float(p[best]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, lang_pred string, score double").withColumnRenamed("id", id_col)


def identify(docs: DataFrame, learn_from: Column, **how) -> DataFrame:
    """Train on the rows where ``learn_from`` holds, then predict all rows."""
    return predict(docs, train(docs.filter(learn_from), **how))
