"""Removing passages that repeat across documents, by hashing the clauses of lines.

A unit is a clause, i.e. a stretch of a line up to a mark that ends it;
paragraphs, lines and sentences are runs of units, and a passage that was cut
inside a sentence loses no more than a clause at its edges.  Units are normalised (case folded,
only letters and digits, single blanks) and digested; per digest the earliest
occurrence by (id, place) stays and all others are marked.  Marked units that
follow one another in a document form a run, and runs of ``min_words`` words
or more are removed: a whole repeated line or paragraph, or a passage inside
one, but not a phrase that happens to recur.  Offsets are those of the source,
in code points, ends exclusive.

Cases: null, empty and blank texts have no unit; units without letters or
digits are never removed alone and don't part a run; a null id ranks after all
others; rows with the same id and text count as one document; rows with the
same id and different texts are different documents; an empty table gives no
rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.llm.common import slices, stored
from seriesloom.llm.heavy import lookup

#: Fewer words repeat by chance or are mere boilerplate.
MIN_WORDS = 25

# A unit ends with its line, or with a mark before white space.
_MARKS = ".!?。！？,;:，；："
_UNIT = re.compile(rf"[^\n{_MARKS}]*(?:[{_MARKS}]+(?=\s|$)[^\S\n]*|[{_MARKS}]+|\n|$)")
_SEPARATORS = re.compile(r"[\W_]+")


def units(text: str) -> list[tuple[int, int, str]]:
    """(start, end, normalised) of each unit with letters or digits; white space around it is left out."""
    out, start = [], 0
    length = len(text)
    while start < length:
        m = _UNIT.match(text, start)
        end = m.end()
        # A mark inside a word ("3.14", "1,000") doesn't end the unit.
        while end < length and not text[end - 1].isspace() and text[end - 1] in ".!?,;:" and not text[end].isspace():
            end = _UNIT.match(text, end).end()
        piece = text[start:end]
        plain = _SEPARATORS.sub(" ", piece.casefold()).strip()
        if plain:
            left = len(piece) - len(piece.lstrip())
            out.append((start + left, start + len(piece.rstrip()), plain))
        start = end
    return out


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        out: dict[str, list] = {k: [] for k in ("id", "doc", "unit", "span", "d1", "d2")}
        for doc_id, text, doc in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if not text:
                continue
            for k, (start, end, plain) in enumerate(units(text)):
                digest = xxhash.xxh3_128_intdigest(plain.encode("utf-8", "surrogatepass"))
                for name, v in zip(out, (doc_id, doc, k << 32 | plain.count(" ") + 1, start << 32 | end - start, digest >> 64, digest & (1 << 64) - 1), strict=True):
                    out[name].append(v)
        kinds = {k: pa.int64() for k in ("id", "doc", "unit", "span")}
        arrays = [pa.array(v, kinds[k]) if k in kinds else pa.array(np.array(v, np.uint64).view(np.int64)) for k, v in out.items()]
        yield pa.RecordBatch.from_arrays(arrays, list(out))


def repeated(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, start, end, words, units, first_id): the runs to remove, with the id of the earliest document that keeps the run's first unit."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("doc"))
    # Two numbers share a long: the unit's place over its words, and its start over its length.
    every = stored(rows.mapInArrow(_digested, "id long, doc long, unit long, span long, d1 long, d2 long"))
    key = ["d1", "d2"]
    place = F.struct(F.col("id").isNull().alias("nameless"), "id", "doc", "unit")
    firsts = every.groupBy(*key).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    firsts = stored(firsts.select(*key, "n", "first"))
    marked = lookup(every, firsts, key, "n").filter(place != F.col("first"))
    in_doc = Window.partitionBy("id", "doc").orderBy("unit")
    start, low = F.shiftright("span", 32), F.lit((1 << 32) - 1)
    parts = [F.shiftright("unit", 32).alias("unit"), start.alias("start"), (start + F.col("span").bitwiseAND(low)).alias("end"), F.col("unit").bitwiseAND(low).alias("words")]
    once = marked.select("id", "doc", "unit", "span", F.col("first.id").alias("first_id")).dropDuplicates(["id", "doc", "unit"])
    runs = once.select("id", "doc", *parts, "first_id").withColumn("run", F.col("unit") - F.row_number().over(in_doc))
    return (
        runs.groupBy("id", "doc", "run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("words"), F.count(F.lit(1)).alias("units"), F.min_by("first_id", "unit").alias("first_id"))
        .filter(F.col("words") >= min_words)
        .select(F.col("id").alias(id_col), "start", "end", "words", "units", "first_id", F.col("doc").alias("text_hash"))
    )


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans; a line left blank by that goes with them."""
    at, out = 0, []
    for start, end in sorted(spans):
        if start < at:
            start = at
        out.append(text[at:start])
        if (not "".join(out[-1:]) or out[-1].endswith("\n")) and text[end : end + 1] == "\n":
            end += 1
        at = max(at, end)
    return "".join([*out, text[at:]])


def remove(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The same rows and columns with all repeats of ``repeated`` cut out of the texts; the earliest occurrence of each stays."""
    runs = repeated(docs, id_col=id_col, text_col=text_col, min_words=min_words)
    spans = runs.groupBy(F.col(id_col).alias("id"), F.col("text_hash").alias("hash")).agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("hash"))
    met = rows.alias("r").join(spans.alias("s"), F.col("r.id").eqNullSafe(F.col("s.id")) & (F.col("r.hash") == F.col("s.hash")), "left").select("doc", "spans", F.col(f"doc.{text_col}").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            given = zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True)
            texts = [cut_spans(t, [(x["start"], x["end"]) for x in spans]) if spans else t for t, spans in given]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(texts, pa.string())], ["doc", "text"])

    cut = met.mapInArrow(run, T.StructType([met.schema["doc"], T.StructField("text", T.StringType())]))
    return cut.select(*(F.col("text").cast(docs.schema[c].dataType).alias(c) if c == text_col else F.col("doc")[c].alias(c) for c in docs.columns))
