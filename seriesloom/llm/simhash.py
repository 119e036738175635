"""SimHash near-duplicates with pigeonring filtering.

A document's fingerprint has a bit set where over half of its word shingles'
hashes have it set.  Two fingerprints link at ``max_bits`` or fewer differing
bits.

Candidates come from the pigeonring principle.  Lay the 64 bits out as a ring
of ``SEGMENTS`` segments.  If two fingerprints differ in at most k bits, there
is a segment from which every chain of l consecutive segments holds at most
l * k / SEGMENTS differences.  For small l that budget is below one, so the
first segments of the chain agree exactly: they are the join key.  Along the
rest of the chain the cumulative budgets prune candidates before the full
Hamming distance is taken.

A bucket with many different fingerprints (a large group of near copies) would
make pairs by the square.  The fingerprints of such buckets leave the pair
join and are linked through neighbourhoods instead, which is exact and linear:
two fingerprints are within 2 bits if and only if some 64-bit word is within
one bit of both, and no word has more than 65 such fingerprints.  All links
between two fingerprints of one full bucket are found that way, so none is lost.

Cases: a null or blank text has no shingle and the fingerprint zero, which
links like any other; fewer words than ``shingle_words`` make one shingle of
them all; equal texts share a fingerprint and a component; a null id keeps its
row and never names a component; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import slices, stored
from seriesloom.llm.components import connected_components
from seriesloom.llm.heavy import lookup

#: Segments of four bits on the ring.
SEGMENTS = 16
SEGMENT_BITS = 64 // SEGMENTS
#: Different fingerprints of one bucket that are still paired; fuller buckets go the linear way.
PAIRED = 48
SEED = 42


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """The unsigned 64-bit fingerprint of a whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    shingles = zip(*(words[k:] for k in range(shingle_words)), strict=False) if len(words) > shingle_words else [words]
    return majority(np.fromiter((digest(b" ".join(s), SEED) for s in shingles), np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The word whose bits are set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[at : at + 8192].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.uint16)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3) -> DataFrame:
    """(id, fp): the fingerprint of every document as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([fingerprint(t, shingle_words) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, fp long").withColumnRenamed("id", id_col)


def _rotated(fp: Column, segment: int) -> Column:
    """The ring read from a segment on."""
    by = segment * SEGMENT_BITS
    return fp if by == 0 else F.shiftrightunsigned(fp, by).bitwiseOR(F.shiftleft(fp, 64 - by))


def _low(bits: int) -> Column:
    return F.lit((1 << bits) - 1 if bits < 64 else -1).cast("long")


def exact_segments(max_bits: int) -> int:
    """The longest chain whose budget l * max_bits / SEGMENTS is below one."""
    return min(SEGMENTS, -(-SEGMENTS // max_bits) - 1) if max_bits else SEGMENTS


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b): links among distinct fingerprints (``fps`` has one column fp) whose components are those of all links.

    Below full buckets these are all links; there, each fingerprint is linked
    to the smallest of its neighbourhood.  ``max_bits`` is at most 2.
    """
    if not 0 < max_bits <= 2:
        raise ValueError("max_bits must be 1 or 2")
    chain = exact_segments(max_bits)
    ring = F.array(*(F.struct(F.lit(k).cast("byte").alias("segment"), _rotated(F.col("fp"), k).bitwiseAND(_low(chain * SEGMENT_BITS)).alias("head")) for k in range(SEGMENTS)))
    rows = fps.select("fp", F.explode(ring).alias("k")).select("k.segment", "k.head", "fp")
    key = ["segment", "head"]
    full = stored(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > PAIRED).select(*key))
    crowded = rows.join(full, key, "left_semi").select("fp").distinct()
    # Dealt anew after the anti join, so that Spark may split its full buckets over tasks.
    single = rows.join(full, key, "left_anti").repartition(*key)
    pairs = single.select(*key, F.col("fp").alias("a")).join(single.select(*key, F.col("fp").alias("b")), key)
    apart = F.col("a").bitwiseXOR(F.col("b"))
    turned = F.lit(None).cast("long")
    for k in reversed(range(SEGMENTS)):
        turned = F.when(F.col("segment") == k, _rotated(apart, k)).otherwise(turned)
    pairs = pairs.filter("a < b")
    for length in range(chain + 1, SEGMENTS):
        budget = length * max_bits // SEGMENTS
        # A budget met by a longer chain is met by all its beginnings with the same budget.
        if (length + 1) * max_bits // SEGMENTS > budget:
            pairs = pairs.filter(F.bit_count(turned.bitwiseAND(_low(length * SEGMENT_BITS))) <= budget)
    pairs = pairs.filter(F.bit_count(apart) <= max_bits)
    near = F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit((1 << k) - (1 << 64) * (k == 63)).cast("long")) for k in range(64)))
    words = crowded.select("fp", F.explode(near).alias("word")) if max_bits == 2 else crowded.select("fp", F.explode(F.slice(near, 1, 65)).alias("word"))
    if max_bits == 1:
        words = words.select("fp", "word").join(crowded.select(F.col("fp").alias("word")), "word", "left_semi")
    # At most 65 fingerprints share a word, so these groups can't be unbalanced.
    groups = words.groupBy("word").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("all")).filter(F.size("all") > 1)
    around = groups.select("a", F.explode("all").alias("b")).filter("a <> b")
    return pairs.select("a", "b").unionByName(around).distinct()


def group(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, max_bits: int = 2) -> DataFrame:
    """(id, fp, component_id): every document with the smallest id reachable by links, its own included."""
    marked = stored(fingerprints(docs, id_col=id_col, text_col=text_col, shingle_words=shingle_words))
    classes = stored(marked.groupBy("fp").agg(F.min(id_col).alias("first"), F.count(F.lit(1)).alias("copies")))
    joined = connected_components(links(classes.select("fp"), max_bits))
    roots = classes.join(joined.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    smallest = roots.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("n"))
    named = stored(lookup(roots.select("fp", "copies", "root"), smallest, ["root"], "n").select("fp", "copies", "component_id"))
    return lookup(marked, named, ["fp"], "copies").select(id_col, "fp", "component_id")
