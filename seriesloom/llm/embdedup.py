"""Near-duplicate embeddings by random-hyperplane sign hashing in several tables.

In each table a vector's bucket is the signs of its products with a few random
hyperplanes.  Vectors that share a bucket in some table are compared by
exact cosine in double precision, in blocks of bounded size: a bucket of any
size is split into blocks, and every pair of its blocks is one small product of
matrices.  A pair that meets in several tables counts in the first only, so
links are counted, not listed; each block hands on a spanning forest of its
links, and components come from those.

Equal vectors are one class: they are hashed once and counted with their
number.

At cosine 0.9 two vectors agree in a bit with probability 1 - acos(0.9) / pi,
about 0.856.  The number of bits follows the number of different vectors, so
that a bucket of unrelated vectors stays small, and the number of tables
follows the bits, so that a pair at the threshold is found with probability
``RECALL``: 10 bits and 20 tables up to about 10^5 vectors, 14 and 39 at 10^6.

Cases: vectors that are null, zero, or hold null or non-finite components have
no links and are components of their own; vectors of different lengths never
link; a null id keeps its row and never names a component; repeated ids are
different vectors; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from seriesloom.llm.common import slices, stored
from seriesloom.llm.components import connected_components
from seriesloom.llm.heavy import lookup

#: Chance that a pair at the threshold meets in some table.
RECALL = 0.99
#: Unrelated vectors of one bucket, as a power of two, and the bits at least and at most.
BUCKET_BITS, LEAST_BITS, MOST_BITS = 6, 10, 30
#: Vectors of one block; a task holds two blocks at a time.
BLOCK = 512
#: Up to so many buckets of all tables, their sizes are broadcast.
BROADCAST_BUCKETS = 1 << 17


class Tables(NamedTuple):
    """How many hyperplanes a bucket number has, and how many tables there are."""

    bits: int
    tables: int


def tables_for(vectors: int, least: float) -> Tables:
    """Bits by the number of different vectors, tables to reach ``RECALL`` at cosine ``least``."""
    bits = min(MOST_BITS, max(LEAST_BITS, round(math.log2(max(vectors, 1))) - BUCKET_BITS))
    agree = (1 - math.acos(min(1.0, max(-1.0, least))) / math.pi) ** bits
    return Tables(bits, 1 if agree >= RECALL else math.ceil(math.log(1 - RECALL) / math.log(1 - agree)))


@cache
def hyperplanes(dim: int, shape: Tables, seed: int = 7) -> np.ndarray:
    """The planes' normals: dim x (tables * bits)."""
    return np.random.default_rng([seed, dim]).standard_normal((dim, shape.tables * shape.bits))


def signatures(unit: np.ndarray, shape: Tables) -> np.ndarray:
    """Bucket numbers by vector and table."""
    signs = (unit @ hyperplanes(unit.shape[1], shape) > 0).reshape(len(unit), *shape[::-1])
    return signs @ (1 << np.arange(shape.bits))


def _unit(raw: np.ndarray) -> np.ndarray | None:
    """The vector at length one in double precision, or None if it links with nothing."""
    x = raw.astype(np.float64)
    if not len(x) or not np.isfinite(x).all() or not x.any():
        return None
    x = x / np.abs(x).max()  # squares of very large or small components stay finite
    return x / np.sqrt(x @ x)


def _marked(kind: str):
    """(id, raw): the vector's bytes, null for vectors that link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raws = []
            for v in batch.column(1).to_pylist():
                raw = None if v is None or any(c is None for c in v) else np.array(v, kind) + 0
                raws.append(None if raw is None or _unit(raw) is None else raw.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raws, pa.binary())], ["id", "raw"])

    return run


def _tables(kind: str, shape: Tables, light: bool):
    """A row per vector and table: (tab, bucket), and unless ``light`` also (cls, raw, copies)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raws = [np.frombuffer(b, kind) for b in batch.column("raw").to_pylist()]
            sigs = np.zeros((len(raws), shape.tables), np.int64)
            for dim in {len(r) for r in raws}:
                at = [k for k, r in enumerate(raws) if len(r) == dim]
                sigs[at] = signatures(np.stack([_unit(raws[k]) for k in at]), shape) | dim << 32
            columns = [pa.array(np.tile(np.arange(shape.tables), len(raws)), pa.int32()), pa.array(sigs.ravel())]
            names = ["tab", "bucket"]
            if not light:
                each = pa.array(np.repeat(np.arange(len(raws)), shape.tables))
                columns += [batch.column(c).take(each) for c in ("cls", "raw", "copies")]
                names += ["cls", "raw", "copies"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Links that span the same components as all links (i, j) among n rows."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def _compared(kind: str, shape: Tables, least: float):
    """Per pair of blocks: partial link counts by class, and a spanning forest of the links."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        tab = int(frame["tab"].iloc[0])
        frame = frame.sort_values(["block", "cls"], kind="stable")
        block, cls = frame["block"].to_numpy(), frame["cls"].to_numpy()
        copies = frame["copies"].to_numpy()
        x = np.stack([_unit(np.frombuffer(b, kind)) for b in frame["raw"]])
        low, high = int(frame["low"].iloc[0]), int(frame["high"].iloc[0])
        a, b = np.flatnonzero(block == low), np.flatnonzero(block == high)
        i, j = np.nonzero(x[a] @ x[b].T >= least)
        i, j = a[i], b[j]
        if low == high:
            i, j = i[i < j], j[i < j]
        if tab and len(i):
            sigs = signatures(x, shape)
            fresh = ~(sigs[i, :tab] == sigs[j, :tab]).any(axis=1)
            i, j = i[fresh], j[fresh]
        n = len(frame)
        links = np.bincount(i, copies[j], n) + np.bincount(j, copies[i], n)
        used = np.flatnonzero(links)
        tree = _forest(n, i, j)
        ends = np.array(tree, np.int64).reshape(-1, 2)
        # A row of counts names its class twice; class names are 64-bit numbers, so no column may turn to floats for a null.
        return pd.DataFrame({"a": np.append(cls[used], cls[ends[:, 0]]), "b": np.append(cls[used], cls[ends[:, 1]]), "n": np.append(links[used].astype(np.int64), np.zeros(len(ends), np.int64))})

    return run


def group(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.9) -> DataFrame:
    """(id, n_links, component_id) of every vector: vectors linked directly, and the smallest id reachable."""
    element = vectors.schema[vector_col].dataType.elementType
    kind, sql = ("<f4", "float") if isinstance(element, FloatType) else ("<f8", "double")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{sql}>").alias("v"))
    # Written once, so the numbers given to the rows stay; a class of equal vectors is named by its first row.
    marked = stored(rows.mapInArrow(_marked(kind), "id long, raw binary").withColumn("row", F.monotonically_increasing_id()))
    classes = stored(marked.filter("raw IS NOT NULL").groupBy("raw").agg(F.min("row").alias("cls"), F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")))
    shape = tables_for(classes.count(), least)
    sizes = classes.select("raw").mapInArrow(_tables(kind, shape, light=True), "tab int, bucket long").groupBy("tab", "bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    hashed = classes.select("raw", "cls", "copies").mapInArrow(_tables(kind, shape, light=False), "tab int, bucket long, cls long, raw binary, copies long")
    few = shape.tables << shape.bits <= BROADCAST_BUCKETS
    dealt = hashed.join(F.broadcast(sizes), ["tab", "bucket"]) if few else lookup(hashed, stored(sizes), ["tab", "bucket"], "n")
    # Every member joins each pair of blocks that its own block is in; a small bucket is one block.
    dealt = dealt.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).drop("other", "blocks", "n")
    found = stored(pairs.groupBy("tab", "bucket", "low", "high").applyInPandas(_compared(kind, shape, least), "a long, b long, n long"))
    joined = connected_components(found.filter("a <> b").select("a", "b"))
    counts = found.filter("a = b").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("others"))
    whole = classes.join(joined.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("component", "cls"))
    smallest = whole.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("n"))
    named = lookup(whole, smallest, ["root"], "n").join(counts, "cls", "left")
    named = stored(named.select("raw", "copies", "component_id", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    linked = lookup(marked.filter("raw IS NOT NULL").select("id", "raw"), named, ["raw"], "copies").select("id", "n_links", "component_id")
    alone = marked.filter("raw IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).withColumnRenamed("id", id_col)
