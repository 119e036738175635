"""Packing documents into fixed token windows by concatenating and cutting.

Pass one encodes every document once and stores its ids with the running
offset inside its partition.  A prefix sum over the partitions' token totals
turns these into global offsets; pass two cuts the one global stream every
``seq_len`` tokens.  A document that crosses a cut yields a boundary record,
i.e. one piece per window it touches.

Cases: a null text counts as empty, an empty document is its end id alone, an
empty table gives no pieces, repeated rows are packed as often as they stand
there, columns other than ``id_col`` and ``text_col`` are ignored, a null id
stays null.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.llm.common import slices, stored

#: The pre-tokenizer's pattern and the special token of the vocabulary; fixed values of the public file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPECIAL = {"<|endoftext|>": 50256}


@cache
def encoder(json_path: str, ranks_path: str | None) -> Callable[[str], np.ndarray]:
    """Text to ids, as ``tokenizers`` gives them for the file ``json_path``.

    With ``ranks_path``, the same vocabulary as ranks, ``tiktoken`` does the
    work in about a quarter of the time; a test holds both against each other.
    What its regex engine refuses (over a million blanks in a row) goes to
    ``tokenizers``.
    """
    from tokenizers import Tokenizer

    whole = cache(lambda: Tokenizer.from_file(json_path))

    def exact(text: str) -> np.ndarray:
        return np.array(whole().encode(text, add_special_tokens=False).ids, np.uint32)

    if ranks_path is None:
        return exact
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
    fast = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)

    def ids(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            return exact(text)

    return ids


def _encode(json_path: str, ranks_path: str | None, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, at, part = encoder(json_path, ranks_path), 0, TaskContext.get().partitionId()
        for batch in slices(batches):
            rows, starts, lengths = [], [], []
            for text in batch.column(1).to_pylist():
                ids = encode(text or "")
                rows.append(np.append(ids, end_id).astype("<u4" if end_id > 0xFFFF or (len(ids) and ids.max() > 0xFFFF) else "<u2").tobytes())
                starts.append(at)
                lengths.append(len(ids) + 1)
                at += len(ids) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(rows), pa.int32()), pa.array(starts, pa.int64()), batch.column(0), pa.array(lengths, pa.int64()), pa.array(rows, pa.binary())],
                ["part", "at", "id", "n", "ids"],
            )

    return run


def _cut(seq_len: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: dict[str, list] = {k: [] for k in ("id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "padded_to")}
            for doc, n, begin, total, raw in zip(*(batch.column(k).to_pylist() for k in ("id", "n", "begin", "total", "ids")), strict=True):
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4")
                start = 0
                while start < n:
                    sequence, offset = divmod(begin + start, seq_len)
                    length = min(n - start, seq_len - offset)
                    filled = min(seq_len, total - sequence * seq_len)
                    padded = filled if filled & (filled - 1) == 0 else seq_len
                    for k, v in zip(out, (doc, start, length, ids[start : start + length].tobytes(), n, sequence, offset, padded), strict=True):
                        out[k].append(v)
                    start += length
            kinds = [batch.schema.field("id").type, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], list(out))

    return run


def pack(docs: DataFrame, json_path: str, ranks_path: str | None = None, *, id_col: str = "doc_id", text_col: str = "text", seq_len: int = 1024, end_id: int = 0) -> DataFrame:
    """Pieces of sequences of ``seq_len`` tokens: (id, start, length, ids, doc_tokens, sequence_id, offset, padded_to).

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers.
    Every sequence but the last is full; ``padded_to`` is ``seq_len``, or the
    length itself where the last one's is a power of two.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    encoded = stored(rows.mapInArrow(_encode(json_path, ranks_path, end_id), "part int, at long, id long, n long, ids binary"))
    # One row per task of pass one, whatever the number of documents: small enough for one window and a broadcast.
    sums = encoded.groupBy("part").agg(F.sum("n").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"), F.sum("tokens").over(Window.partitionBy()).alias("total"))
    placed = encoded.join(F.broadcast(bases), "part").select("id", "n", (F.col("base") + F.col("at")).alias("begin"), "total", "ids")
    pieces = placed.mapInArrow(_cut(seq_len), "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, padded_to long")
    return pieces.withColumnRenamed("id", id_col)
