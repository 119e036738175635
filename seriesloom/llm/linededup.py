"""Removing lines that many documents repeat, as keep bitmaps.

A line's key is the line without ASCII white space at its ends and with A-Z in
lower case.  Keys of ``min_chars`` code points or more are hashed (two 64-bit
hashes) and range-partitioned by hash, document (largest id first) and place,
so that a line that a third of all documents hold is cut over many tasks like
any other range.  Each task streams its sorted rows: the first document of a
hash keeps its lines, those of the others go once ``min_docs`` documents were
seen.  Lines of the first and last hash of a task may belong to a hash that
other tasks hold as well; they are decided in a second step from a summary of
at most ``min_docs`` ids per task and end.

What is returned is no text but a row per document with a compressed bitmap of
the lines to keep; ``apply`` cuts texts by it.

Cases: null and empty texts are one empty line; a null id ranks below all
others; rows that share an id count as one document, and each has a bitmap of
its own; rows that share id and text are one row of bitmaps; blank and short
lines stay; a line repeated inside one document goes or stays as a whole;
an empty table gives no rows; extra columns of any name pass through ``apply``.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.llm.common import slices, stored

BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FIELDS = ["h1", "h2", "nameless", "id", "text_hash", "line"]


def line_keys(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20) -> DataFrame:
    """(h1, h2, id, text_hash, line) of every line whose key is long enough; ``text_hash`` tells rows of one id apart."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("text_hash"), F.posexplode(F.split(text, "\n", -1)).alias("line", "key"))
    keyed = lines.withColumn("key", F.translate(F.btrim("key", F.lit(BLANKS)), _UPPER, _LOWER)).filter(F.char_length("key") >= min_chars)
    return keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "id", "text_hash", "line")


def _streamed(min_docs: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows in order of hash and document: (state, h1, h2, nameless, id, text_hash, line).

    State 0: the line goes.  1: the line may go, but its hash is the first or
    last of the task.  2: one of the first documents of such a hash.
    """

    def told(state: int, rows: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(rows.shape[1], state)), *(pa.array(x) for x in rows)], ["state", *_FIELDS])

    def ranks(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per row the number of its hash, whether its document begins there, and the document's rank in the hash."""
        changed = rows[:, 1:] != rows[:, :-1]
        new_hash = np.append(True, changed[:2].any(axis=0))
        new_doc = np.append(True, changed[:4].any(axis=0))
        docs = np.cumsum(new_doc)
        return np.cumsum(new_hash) - 1, new_doc, docs - np.maximum.accumulate(np.where(new_hash, docs, 0)) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of the open hash are held: a row of each of its first documents, and the rows that aren't decided.
        held, done, first = np.zeros((len(_FIELDS), 0), np.int64), np.zeros(0, bool), True
        for batch in batches:
            fresh = np.stack([batch.column(k).cast(pa.int64()).fill_null(0).to_numpy() for k in _FIELDS])
            if not fresh.shape[1]:
                continue
            rows, done = np.concatenate([held, fresh], axis=1), np.append(done, np.zeros(fresh.shape[1], bool))
            group, new_doc, rank = ranks(rows)
            count = np.zeros(group[-1] + 1, np.int64)
            np.maximum.at(count, group, rank)
            leads = new_doc & (rank <= min_docs)
            begins = (group == 0) & first & ~done
            yield told(1, rows[:, begins])
            yield told(2, rows[:, begins & leads])
            goes = (rank > 1) & (count[group] >= min_docs) & ~done & ~begins
            yield told(0, rows[:, goes])
            done |= goes | begins
            kept = (group == group[-1]) & (leads | (rank > 1) & ~done)
            held, done, first = rows[:, kept], done[kept], first and group[-1] == 0
        if not first:
            rank = ranks(held)[2]
            yield told(1, held[:, (rank > 1) & ~done])
            yield told(2, held[:, ranks(held)[1] & (rank <= min_docs)])

    return run


def dropped_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(id, text_hash, line): the lines that go, perhaps repeated."""
    # ``part`` only lets the range shuffle cut equal rows.
    keys = stored(line_keys(docs, id_col=id_col, text_col=text_col, min_chars=min_chars).withColumn("part", F.spark_partition_id()))
    order = [F.col("h1"), F.col("h2"), F.col("id").desc_nulls_last(), F.col("text_hash"), F.col("line"), F.col("part")]
    spread = keys if keys.isEmpty() else keys.repartitionByRange(*order).sortWithinPartitions(*order)
    longs = ", ".join(f"{k} long" for k in ["state", *_FIELDS])
    told = stored(spread.withColumn("nameless", F.col("id").isNull().cast("long")).mapInArrow(_streamed(min_docs), longs))
    doc = F.struct((-F.col("nameless")).alias("named"), "id")
    # At most two hashes of each task are here, each with min_docs documents.
    ends = told.filter("state = 2").groupBy("h1", "h2").agg(F.count_distinct(doc).alias("docs"), F.max(doc).alias("first")).filter(F.col("docs") >= min_docs)
    later = told.filter("state = 1").join(F.broadcast(ends), ["h1", "h2"]).filter(doc != F.col("first"))
    gone = [t.select(F.when(F.col("nameless") == 0, F.col("id")).alias("id"), "text_hash", "line") for t in (told.filter("state = 0"), later)]
    return gone[0].unionByName(gone[1])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        n_dropped, keep = [], []
        for n, gone in zip(batch.column("n_lines").to_pylist(), batch.column("gone"), strict=True):
            bits = np.ones(n, np.uint8)
            if gone.is_valid:
                bits[gone.values.to_numpy()] = 0
            n_dropped.append(int(n - bits.sum()))
            keep.append(zlib.compress(np.packbits(bits).tobytes(), 6))
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("id", "text_hash", "n_lines")), pa.array(n_dropped, pa.int64()), pa.array(keep, pa.binary())], ["id", "text_hash", "n_lines", "n_dropped", "keep"])


def kept_lines(bitmap: bytes, n_lines: int) -> np.ndarray:
    """The bitmap as a flag per line."""
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).astype(bool)


def keep_bitmaps(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(id, text_hash, n_lines, n_dropped, keep) of every document: ``keep`` has a bit per line, compressed."""
    gone = dropped_lines(docs, id_col=id_col, text_col=text_col, min_chars=min_chars, min_docs=min_docs)
    lists = gone.groupBy("id", "text_hash").agg(F.collect_set("line").alias("gone"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    every = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("text_hash"), (F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1).cast("long").alias("n_lines")).distinct()
    met = every.alias("a").join(lists.alias("b"), _same("a", "b"), "left").select("a.*", "b.gone")
    return met.mapInArrow(_packed, "id long, text_hash long, n_lines long, n_dropped long, keep binary")


def _same(left: str, right: str) -> Column:
    return F.col(f"{left}.id").eqNullSafe(F.col(f"{right}.id")) & (F.col(f"{left}.text_hash") == F.col(f"{right}.text_hash"))


def apply(docs: DataFrame, bitmaps: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, kept, n_lines, n_dropped): each row of ``docs`` as a struct, and its text without the lines that go."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"))
    met = rows.alias("a").join(bitmaps.alias("b"), _same("a", "b")).select("a.doc", F.coalesce(F.col(f"a.doc.{text_col}").cast("string"), F.lit("")).alias("kept"), "b.n_lines", "b.n_dropped", "b.keep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("kept").to_pylist()
            for k, (n, dropped) in enumerate(zip(batch.column("n_lines").to_pylist(), batch.column("n_dropped").to_pylist(), strict=True)):
                if dropped:
                    keep = kept_lines(batch.column("keep")[k].as_py(), n).tolist()
                    texts[k] = "\n".join(line for line, stays in zip(texts[k].split("\n"), keep, strict=True) if stays)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(texts, pa.string()), batch.column("n_lines"), batch.column("n_dropped")], ["doc", "kept", "n_lines", "n_dropped"])

    schema = T.StructType([met.schema["doc"], T.StructField("kept", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return met.mapInArrow(run, schema)


def remove(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """The same rows and columns with repeated lines cut out of the texts; a null text stays null."""
    bitmaps = keep_bitmaps(docs, id_col=id_col, text_col=text_col, min_chars=min_chars, min_docs=min_docs)
    cut = apply(docs, bitmaps, id_col=id_col, text_col=text_col)
    kept = F.when(F.col("doc")[text_col].isNotNull(), F.col("kept")).cast(docs.schema[text_col].dataType)
    return cut.select(*(kept.alias(c) if c == text_col else F.col("doc")[c].alias(c) for c in docs.columns))
