"""Near-duplicates at a Jaccard similarity: SimHash groups first, then banded candidates with an exact check.

Fingerprints within ``max_bits`` bits are linked by ``simhash``, which finds
copies that differ in next to nothing.  At a similarity of 0.8 two 64-bit
fingerprints differ in about ten bits, and a pigeonring over 64 bits has no
selective key for that.  So further candidates are texts that agree in one of
``BANDS`` bands of ``ROWS`` minimum hashes each (at 0.8 with probability 0.996,
at 0.85 with 0.9999), and a candidate links only if the exact Jaccard
similarity of the two shingle sets is at least ``similarity``.

A band's bucket may hold any share of the corpus.  Links are needed only
between texts that aren't in one component yet, so a bucket is taken in
rounds.  It has an anchor, a member of its largest component.  In each round
some of the members outside the anchor's component lead: they are compared
with all members of other components, and what is linked is merged before the
next round.  A bucket is finished once every member that isn't in the anchor's
component has led, i.e. when no pair across components is left uncompared.
The outcome is that of comparing all pairs of every bucket.  Members and
leaders of a large bucket are both dealt out, and every lot of leaders meets
every lot of members in a task of its own: it holds some ``CHUNK`` leaders,
whatever the bucket, and streams as many members.  Pairs are never listed.
While a round has no more leaders than one lot, rows are as many as members,
plus the leaders once per lot of members.  In a bucket of mutually unlike texts
all members lead in the end, so that its rows, though not what a task holds,
grow with the square of its size over ``CHUNK``.

Cases: null, empty and blank texts have no shingle and are one group; texts of
fewer words than a shingle have one shingle of them all; texts equal after
lower-casing A-Z and blank folding are one class, told apart by 128 bits; rows
that share an id but not a group stay apart; null ids rank last; a group
without any id keeps one row; an empty table gives no rows; extra columns of
any name pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.llm import simhash
from seriesloom.llm.common import slices, stored
from seriesloom.llm.components import connected_components
from seriesloom.llm.heavy import lookup

BANDS, ROWS = 24, 7
#: Expected leaders of a bucket in the first round; each later round takes eight times as many.
LEADERS = 2
#: Expected members and leaders of a bucket that meet in one task.
CHUNK = 1024
#: Tables of up to so many rows, each of a few numbers, are broadcast.
BROADCAST_ROWS = 1 << 20


@cache
def _functions() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of the minimum hashes, and multipliers that fold a band into one key."""
    rng = np.random.default_rng(11)
    draw = [rng.integers(0, 1 << 64, size, np.uint64, endpoint=False) for size in (BANDS * ROWS, BANDS * ROWS, BANDS * ROWS)]
    return draw[0] | np.uint64(1), draw[1], (draw[2] | np.uint64(1)).reshape(BANDS, ROWS)


def shingle_hashes(text: str | None, shingle_words: int) -> tuple[np.ndarray, bytes]:
    """The hashes of all shingles, repeats included, and the words that make them up."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64), b""
    shingles = zip(*(words[k:] for k in range(shingle_words)), strict=False) if len(words) > shingle_words else [words]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(b" ".join(s), simhash.SEED) for s in shingles), np.uint64), b" ".join(words)


def band_keys(distinct: np.ndarray) -> np.ndarray:
    """The bucket of each band for a set of shingle hashes; none without shingles."""
    if not len(distinct):
        return np.zeros(0, np.int64)
    times, plus, fold = _functions()
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(distinct), 2048):
            mixed = distinct[at : at + 2048, None] * times + plus
            mixed ^= mixed >> np.uint64(32)
            least = np.minimum(least, (mixed * times[::-1]).min(axis=0))
        keys = (least.reshape(BANDS, ROWS) * fold).sum(axis=1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.arange(BANDS, dtype=np.uint64)
    return keys.view(np.int64)


def _signed(shingle_words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            digests, fps, keys = [], [], []
            for text in batch.column("text").to_pylist():
                hashes, words = shingle_hashes(text, shingle_words)
                digests.append(xxhash.xxh3_128_digest(words))
                fps.append(simhash.majority(hashes) if len(hashes) else 0)
                keys.append(band_keys(np.unique(hashes)))
            made = [pa.array(digests, pa.binary()), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("place"), *made], ["place", "digest", "fp", "bands"])

    return run


def _sets(shingle_words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The shingles of each text as sorted 32-bit hashes without repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [np.unique(shingle_hashes(t, shingle_words)[0].astype(np.uint32)).view(np.int32) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("cls"), pa.array(found, pa.list_(pa.int32()))], ["cls", "shingles"])

    return run


class _Leaders:
    """A lot of leaders of one bucket, with their shingles in one sorted list."""

    def __init__(self, comps: list[int], sets: list[np.ndarray], similarity: float):
        self.comps, self.similarity = np.array(comps, np.int64), similarity
        self.lengths = np.array([len(x) for x in sets])
        every, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.lengths)
        order = np.argsort(every, kind="stable")
        self.every, self.owner = every[order], owner[order]

    def linked(self, comp: int, shingles: np.ndarray) -> set[int]:
        """The other components that have a leader which is similar enough."""
        low, high = (np.searchsorted(self.every, shingles, side) for side in ("left", "right"))
        n = high - low
        at = np.repeat(low - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        shared = np.bincount(self.owner[at], minlength=len(self.comps))
        close = shared >= self.similarity * (self.lengths + len(shingles) - shared) - 1e-9
        return set(self.comps[close & (self.comps != comp)].tolist())


def _compared(similarity: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(comp_a, comp_b) linked by rows (key, lot, chunk, lead, comp, shingles) that come by bucket, lot and chunk, leaders first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, index = None, None
        comps: list[int] = []
        sets: list[np.ndarray] = []
        for batch in slices(batches):
            links: set[tuple[int, int]] = set()
            given = [batch.column(c).to_pylist() for c in ("key", "lot", "chunk", "lead", "comp")]
            for key, lot, chunk, lead, comp, shingles in zip(*given, batch.column("shingles"), strict=True):
                if (key, lot, chunk) != met:
                    met, index, comps, sets = (key, lot, chunk), None, [], []
                values = shingles.values.to_numpy()
                if lead:
                    comps.append(comp)
                    sets.append(values)
                elif comps:
                    index = index or _Leaders(comps, sets, similarity)
                    links.update((comp, other) for other in index.linked(comp, values))
            yield pa.RecordBatch.from_arrays([pa.array([f(x) for x in links], pa.int64()) for f in (min, max)], ["comp_a", "comp_b"])

    return run


def dealt(rows: DataFrame) -> DataFrame:
    """(key, cls, comp, lot, chunk, lead): where the members of a round meet its leaders.

    ``rows``: (key, cls, comp, lead, n, leading), with the bucket's members and
    expected leaders.  A leader goes with its lot to every chunk of members,
    and each member, leaders too, with its chunk to every lot.
    """
    lots, chunks = (F.greatest(F.ceil(F.col(c) / CHUNK), F.lit(1)).cast("int") for c in ("leading", "n"))
    lot, chunk = F.pmod(F.xxhash64("cls", F.lit("lot")), lots).cast("int"), F.pmod(F.xxhash64("cls"), chunks).cast("int")

    def cell(lot: Column, chunk: Column, lead: bool) -> Column:
        return F.struct(lot.alias("lot"), chunk.alias("chunk"), F.lit(lead).alias("lead"))

    leads = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: cell(F.col("own_lot"), c, True))
    follows = F.transform(F.sequence(F.lit(0), F.col("lots") - 1), lambda k: cell(k, F.col("own_chunk"), False))
    placed = rows.select("key", "cls", "comp", F.col("lead").alias("leads"), lots.alias("lots"), chunks.alias("chunks"), lot.alias("own_lot"), chunk.alias("own_chunk"))
    return placed.select("key", "cls", "comp", F.inline(F.when(F.col("leads"), F.concat(leads, follows)).otherwise(follows)))


def _small(table: DataFrame) -> DataFrame:
    """``table``, to be broadcast if its rows are few enough; else Spark joins by a shuffle."""
    return F.broadcast(table) if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else table


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (cls, comp) after linked components (comp_a, comp_b) became one."""
    found = connected_components(links.select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")))
    step = found.select(F.col("node").alias("comp"), "component")
    return stored(labels.join(step, "comp", "left").select("cls", F.coalesce("component", "comp").alias("comp")))


def similar_groups(bands: DataFrame, labels: DataFrame, sets_of: Callable[[DataFrame], DataFrame], similarity: float) -> DataFrame:
    """``labels`` (cls, comp) after all texts that share a bucket and are similar were joined.

    ``bands``: (cls, bands); ``sets_of`` gives (cls, shingles) of the classes (cls) that need them.
    """
    every = stored(bands.join(labels, "cls").select("cls", "comp", F.explode("bands").alias("key")))
    by_comp = every.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"), F.min("cls").alias("anchor"))
    keys = by_comp.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "anchor")).alias("top"), F.count(F.lit(1)).alias("comps")).filter("comps > 1")
    keys = stored(keys.select("key", "n", F.col("top.anchor").alias("anchor"), F.lit(0.0).alias("low")))
    members = stored(lookup(every.select("key", "cls"), keys, ["key"], "n").select("key", "cls"))
    sets = stored(sets_of(members.select("cls").distinct()))
    share = F.pmod(F.xxhash64("cls", "key"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    leaders = LEADERS
    while True:
        total = members.count()
        anchored = stored(keys.join(labels.select(F.col("cls").alias("anchor"), F.col("comp").alias("home")), "anchor"))
        now = stored(lookup(members.join(labels, "cls"), anchored, ["key"], "n", total=total).withColumn("waits", (F.col("comp") != F.col("home")) & (share >= F.col("low"))))
        waiting = now.filter("waits").groupBy("key").agg(F.count(F.lit(1)).alias("m"))
        high = F.when(F.col("m") <= leaders, 1.0).otherwise(F.col("low") + (1 - F.col("low")) * leaders / F.col("m"))
        leading = F.least(F.col("m"), F.lit(leaders))
        sizes = stored(anchored.join(waiting, "key").select("key", "n", "anchor", "m", leading.alias("leading"), high.alias("high")))
        if sizes.isEmpty():
            return labels
        rows = lookup(now.select("key", "cls", "comp", "waits"), sizes.select("key", "n", "leading", "high"), ["key"], "n", total=total).withColumn("lead", F.col("waits") & (share < F.col("high")))
        rows = dealt(rows).join(sets, "cls").repartition("key", "lot", "chunk").sortWithinPartitions("key", "lot", "chunk", F.col("lead").desc())
        links = rows.select("key", "lot", "chunk", "lead", "comp", "shingles").mapInArrow(_compared(similarity), "comp_a long, comp_b long").distinct()
        labels = _joined(labels, links)
        keys = stored(sizes.filter(F.col("m") > leaders).select("key", "n", "anchor", F.col("high").alias("low")))
        if keys.isEmpty():
            return labels
        members = stored(lookup(members, keys, ["key"], "n", total=total).select("key", "cls"))
        leaders *= 8


def _fingerprint_groups(classes: DataFrame, max_bits: int) -> DataFrame:
    """(cls, comp) of ``classes`` (cls, fp) linked by their fingerprints; comp: the group's smallest class."""
    fps = stored(classes.groupBy("fp").agg(F.min("cls").alias("least"), F.count(F.lit(1)).alias("n")))
    found = connected_components(simhash.links(fps.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    rooted = fps.join(found, "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    comps = rooted.groupBy("root").agg(F.min("least").alias("comp"))
    named = stored(rooted.select("fp", "n", "root").join(comps, "root").select("fp", "n", "comp"))
    return stored(lookup(classes.select("cls", "fp"), named, ["fp"], "n").select("cls", "comp"))


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, max_bits: int = 2, similarity: float | None = 0.8) -> DataFrame:
    """The same columns with one document of each group: that with the smallest id.

    Groups are the components of fingerprint links and, unless ``similarity``
    is None, of similar texts.  Of rows with one id and text the one with the
    smallest hash over its columns stays.
    """
    text = F.col(text_col).cast("string")
    # A row is known by two hashes, of its text and of all its columns; rows that agree in both are copies.
    by_text, by_row = F.xxhash64(text), F.xxhash64(*(c for c, kind in docs.dtypes if "map<" not in kind))
    place = F.struct(F.col(id_col).isNull().alias("nameless"), F.col(id_col).cast("long").alias("id"), by_text.alias("h1"), by_row.alias("h2"))
    rows = docs.select(place.alias("place"), text.alias("text"))
    made = T.StructType.fromDDL("digest binary, fp long, bands array<long>")
    signed = rows.mapInArrow(_signed(shingle_words), T.StructType([rows.schema["place"], *made]))
    # Written once, so the numbers given to the rows stay.
    marked = stored(signed.withColumn("row", F.monotonically_increasing_id()))
    by_place = marked.groupBy("digest", "place").agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("same"), F.first("fp").alias("fp"))
    classes = by_place.groupBy("digest").agg(F.min(F.struct("place", "row", "same")).alias("first"), F.first("fp").alias("fp"))
    classes = stored(classes.select(F.col("first.row").alias("cls"), "fp", "first"))
    labels = _fingerprint_groups(classes.select("cls", "fp"), max_bits)
    whole = docs.select(F.struct(*docs.columns).alias("doc"), by_text.alias("h1"), by_row.alias("h2"))
    key = ["h1", "h2"]

    def sets_of(needed: DataFrame) -> DataFrame:
        wanted = stored(classes.join(needed, "cls").select("cls", "first.place.h1", "first.place.h2"))
        texts = docs.select(text.alias("text"), by_text.alias("h1"), by_row.alias("h2")).join(_small(wanted), key)
        return texts.groupBy("cls").agg(F.first("text").alias("text")).mapInArrow(_sets(shingle_words), "cls long, shingles array<int>")

    if similarity is not None:
        labels = similar_groups(marked.select(F.col("row").alias("cls"), "bands"), labels, sets_of, similarity)
    chosen = stored(classes.join(labels, "cls").groupBy("comp").agg(F.min("first").alias("first")).select("first.place.h1", "first.place.h2", "first.same"))
    # All rows but the chosen go; of a chosen row's copies one stays.
    gone = stored(by_place.select("place.h1", "place.h2").join(chosen.filter("same = 1"), key, "left_anti"))
    once = whole.join(_small(gone), key, "left_anti").select("doc.*")
    again = chosen.filter("same > 1").select("h1", "h2", "same")
    copies = lookup(whole, again, key, "same").groupBy(*key).agg(F.first("doc").alias("doc")).select("doc.*")
    return once.unionByName(copies)
