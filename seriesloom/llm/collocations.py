"""Frequent phrases and their cohesion, by Rabin-Karp fingerprints over prefix polynomials.

Texts are lower-cased (A-Z), cut at ``.,;:!?`` and line breaks into pieces, and
these at blanks into words.  NumPy lays the words of many texts out in one byte
array with single blanks between them; a prefix polynomial over it, modulo a
Mersenne prime and with two bases, gives the fingerprint of every n-gram as a
difference of two prefixes.  Inside a task equal fingerprints become one row
with a count and a pointer to one occurrence, after every occurrence was
compared with that one (by word numbers, which come from comparing bytes).

A shuffle brings the rows of a fingerprint together; those of fingerprints
below ``min_count`` go.  The pointers of the others are resolved against their
documents, so phrases are materialised only there, and counts are added up by
language and text: two phrases of one fingerprint stay apart.

Phrases of three words and more are hashed in a second pass, where a bit table
of the first pass's fingerprints (8 MB, whatever the data) rules out most
n-grams that hold a pair of words below ``min_count``; a bit that is set for
another pair costs a row in the shuffle and never a phrase.

Cases: null and empty texts have no word; a null language is ``und``; rows
with the same id or text are occurrences of their own; a text without blanks
is one word; ties are ordered by the phrase; an empty table gives no rows;
other columns of the table play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.llm.common import slices, stored
from seriesloom.llm.heavy import lookup

BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
MERSENNE = (1 << 31) - 1
BASES = (1_103_515_245, 362_437_069)
#: Bytes of text whose n-grams a task combines before it hands rows on, and words whose prefixes are held at once.
BUFFER_BYTES, WINDOW_WORDS = 8 << 20, 1 << 18
#: Bits of the second pass's table, as a power of two, and the blocks that it is put together in.
TABLE_BITS, TABLE_BLOCKS = 26, 64
#: Bits of a span in a pointer; the rest is the byte it starts at.
SPAN_BITS = 31

_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)], _KIND[list(BREAKS)] = 1, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_U = np.uint64


class Fingerprints:
    """Polynomial fingerprints of byte spans; ``modulus`` is a parameter for tests that want collisions."""

    def __init__(self, modulus: int = MERSENNE):
        self.modulus = modulus
        self.powers = [np.ones(1, np.uint32)] * (2 * len(BASES))

    def _table(self, which: int, length: int) -> np.ndarray:
        """The powers of a base, or of its inverse, up to a length."""
        known, base = self.powers[which], BASES[which // 2] % self.modulus
        base = pow(base, -1, self.modulus) if which % 2 else base
        while len(known) < length:
            step = _U(pow(base, len(known), self.modulus))
            known = np.append(known, (known.astype(_U) * step % _U(self.modulus)).astype(np.uint32))
        self.powers[which] = known
        return known[:length]

    def prefixes(self, flat: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per base the prefix polynomial of ``flat``, and the powers that shift a span to the origin."""
        out, m = [], _U(self.modulus)
        for k in range(len(BASES)):
            sums = np.zeros(len(flat) + 1, _U)
            np.cumsum((flat + _U(1)) * self._table(2 * k, len(flat)) % m, out=sums[1:])
            sums %= m
            out.append((sums, self._table(2 * k + 1, len(flat) + 1)))
        return out

    def of(self, prefixes: list[tuple[np.ndarray, np.ndarray]], start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The fingerprints of the spans from ``start`` to ``end``."""
        found, m = np.zeros(len(start), _U), _U(self.modulus)
        for sums, back in prefixes:
            found = found << _U(31) | (sums[end] + m - sums[start]) % m * back[start] % m
        return found


class Words(NamedTuple):
    """The words of several texts: normalised bytes with a blank after each word, where words lie there and in the source, piece and text of each."""

    flat: np.ndarray
    at: np.ndarray
    length: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    text: np.ndarray


def words_of(texts: list[np.ndarray]) -> Words:
    """The words of texts given as UTF-8 bytes; ``start`` and ``end`` count from the beginning of the word's text."""
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    data = np.full(begins[-1], 10, np.uint8)  # a line break ends each text
    for t, b in zip(texts, begins, strict=False):
        data[b : b + len(t)] = t
    kind = _KIND[data]
    inside = kind == 0
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0))
    start, end = (np.flatnonzero(edge == k).astype(np.int64 if len(data) >> 31 else np.int32) for k in (1, -1))
    data = np.where(inside, _LOWER[data], np.uint8(32))
    inside[end] = True
    length = end - start
    at = np.zeros_like(start)
    np.cumsum(length[:-1] + 1, out=at[1:])
    text = (np.searchsorted(begins, start, "right") - 1).astype(np.int32)
    piece = np.cumsum(kind == 2, dtype=start.dtype)[start]
    begins = begins.astype(start.dtype)
    return Words(data[inside], at, length, start - begins[text], end - begins[text], piece, text)


def _slots(fps: np.ndarray) -> np.ndarray:
    """The bit of each fingerprint in the table."""
    return fps * _U(0x9E3779B97F4A7C15) >> _U(64 - TABLE_BITS)


def ngrams(words: Words, seeds: np.ndarray, orders: tuple[int, ...], hasher: Fingerprints, table: np.ndarray | None = None) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per order the n-grams' first words and fingerprints; single words are always there.

    ``seeds``: a number per word that tells languages apart.  With ``table``,
    only n-grams all of whose pairs of words are set there.
    """
    count, reach = len(words.at), max(orders)
    single = np.zeros(count, _U)
    found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {n: [] for n in orders if n > 1}
    for a in range(0, count, WINDOW_WORDS):
        # The window's own words, and as many more as its last n-grams reach.
        own, size = min(WINDOW_WORDS, count - a), min(WINDOW_WORDS + reach - 1, count - a)
        at, length, piece, seed = (x[a : a + size] for x in (words.at, words.length, words.piece, seeds))
        start, end = at - at[0], at + length - at[0]
        prefixes = hasher.prefixes(words.flat[at[0] : at[0] + end[-1]])
        single[a : a + own] = (hasher.of(prefixes, start, end) ^ seed)[:own]
        paired = np.ones(size, bool)
        if table is not None:
            here = np.flatnonzero(piece[:-1] == piece[1:])
            slot = _slots(hasher.of(prefixes, start[here], end[here + 1]) ^ seed[here])
            paired[here] = table[slot >> _U(3)] >> (slot & _U(7)).astype(np.uint8) & 1
        for n, parts in found.items():
            fits = piece[: max(0, size - n + 1)] == piece[n - 1 :]
            for k in range(n - 1):
                fits = fits & paired[k : k + len(fits)]
            here = np.flatnonzero(fits[:own])
            parts.append(((a + here).astype(np.int32), hasher.of(prefixes, start[here], end[here + n - 1]) ^ seed[here]))
    return {1: (np.arange(count, dtype=np.int32), single), **{n: tuple(np.concatenate(x) for x in zip(*parts, strict=True)) for n, parts in found.items()}}


Groups = tuple[np.ndarray, np.ndarray]


def _same_words(words: Words, lang: np.ndarray, single: np.ndarray) -> tuple[np.ndarray, Groups]:
    """A number per word, equal for equal words of one language only, and each one's first word and count: words of one fingerprint are compared with their first."""
    _, first, inverse, count = np.unique(single, return_index=True, return_inverse=True, return_counts=True)
    rep = first[inverse]
    same = np.array_equal(lang[rep], lang) and np.array_equal(words.length[rep], words.length)
    if same:
        ahead = np.repeat(words.at[rep] - words.at, words.length + 1)
        ahead += np.arange(len(words.flat), dtype=ahead.dtype)
        same = np.array_equal(words.flat[ahead], words.flat)
    if same:
        return inverse.astype(np.int32), (first, count)
    known: dict[tuple[int, bytes], int] = {}
    texts = (words.flat[a : a + n].tobytes() for a, n in zip(words.at.tolist(), words.length.tolist(), strict=True))
    numbers = np.array([known.setdefault(k, len(known)) for k in zip(lang.tolist(), texts, strict=True)], np.int32)
    return numbers, np.unique(numbers, return_index=True, return_counts=True)[1:]


def _same_phrases(numbers: np.ndarray, order: int, head: np.ndarray, fps: np.ndarray) -> Groups:
    """The first and the count of each distinct n-gram: those of one fingerprint are compared with their first, word by word."""
    _, first, inverse, count = np.unique(fps, return_index=True, return_inverse=True, return_counts=True)
    rep = head[first][inverse]
    if all(np.array_equal(numbers[rep + k], numbers[head + k]) for k in range(order)):
        return first, count
    return np.unique(np.stack([numbers[head + k] for k in range(order)]), axis=1, return_index=True, return_counts=True)[1:]


def combined(words: Words, lang: np.ndarray, seeds: np.ndarray, orders: tuple[int, ...], hasher: Fingerprints, table: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(fingerprint, count, first word, order) of every distinct n-gram, order by order."""
    found = ngrams(words, seeds, orders, hasher, table)
    numbers, groups = _same_words(words, lang, found[1][1])
    for n in orders:
        head, fps = found.pop(n)
        if len(head):
            first, count = groups if n == 1 else _same_phrases(numbers, n, head, fps)
            yield fps[first], count, head[first], n


class Buffer(NamedTuple):
    """Some documents' words, each word's language by its number, each language's seed, and each text's row."""

    words: Words
    lang: np.ndarray
    seed: np.ndarray
    rows: np.ndarray


def _buffers(batches: Iterator[pa.RecordBatch]) -> Iterator[Buffer]:
    """Documents (row, lang, text) in buffers of ``BUFFER_BYTES`` or one long text."""
    rows: list[int] = []
    langs: list[str] = []
    texts: list[np.ndarray] = []
    held = 0

    def made() -> Iterator[Buffer]:
        words = words_of(texts)
        if len(words.at):
            names, number = np.unique(np.array(langs, object), return_inverse=True)
            seed = np.array([xxhash.xxh64_intdigest(x.encode()) for x in names.tolist()], _U)
            yield Buffer(words, number.astype(np.int32)[words.text], seed, np.array(rows, np.int64))

    for batch in slices(batches):
        text = batch.column("text").cast(pa.large_binary())
        data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
        ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1].tolist()
        for k, (row, lang) in enumerate(zip(batch.column("row").to_pylist(), batch.column("lang").to_pylist(), strict=True)):
            rows.append(row)
            langs.append(lang)
            texts.append(data[ends[k] : ends[k + 1]].copy())
            held += len(texts[-1])
            if held >= BUFFER_BYTES:
                yield from made()
                rows, langs, texts, held = [], [], [], 0
    if rows:
        yield from made()


def _hashed(orders: tuple[int, ...], modulus: int, table: Broadcast | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (fp, count, row, span); with single words, also the number of words of a language, as the count of the empty span."""

    def told(fp: np.ndarray, count: np.ndarray, row: np.ndarray, span: np.ndarray) -> Iterator[pa.RecordBatch]:
        made = [pa.array(x) for x in (fp.view(np.int64), count.astype(np.int64), row, span)]
        for at in range(0, len(fp), 1 << 16):
            yield pa.RecordBatch.from_arrays([x.slice(at, 1 << 16) for x in made], ["fp", "count", "row", "span"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, bits = Fingerprints(modulus), None if table is None else np.frombuffer(table.value, np.uint8)
        for words, lang, seed, rows in _buffers(batches):
            if 1 in orders:
                present, one, total = np.unique(lang, return_index=True, return_counts=True)
                yield from told(seed[present], total, rows[words.text[one]], np.zeros(len(one), np.int64))
            for fp, count, head, n in combined(words, lang, seed[lang], orders, hasher, bits):
                start = words.start[head].astype(np.int64)
                yield from told(fp, count, rows[words.text[head]], start << SPAN_BITS | words.end[head + n - 1] - start)

    return run


def _frequent(min_count: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of rows sorted by fingerprint, those of fingerprints counted ``min_count`` times or more; fewer rows than that are held back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, passed = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if waiting is not None:
                batch = pa.Table.from_batches([waiting, batch]).combine_chunks().to_batches()[0]
            fp, count = batch.column("fp").to_numpy(), batch.column("count").to_numpy()
            starts = np.flatnonzero(np.append(True, fp[1:] != fp[:-1]))
            enough = np.add.reduceat(count, starts) >= min_count
            if passed is not None and fp[0] == passed:
                enough[0] = True
            keep = np.repeat(enough, np.diff(np.append(starts, len(fp))))
            passed = fp[-1] if enough[-1] else None
            waiting = None if enough[-1] else batch.slice(starts[-1])
            yield batch.filter(pa.array(keep))

    return run


def _bit_table(fps: DataFrame) -> bytes:
    """A bit table of the fingerprints, put together block by block in tasks."""
    block_bits = (1 << TABLE_BITS) // TABLE_BLOCKS

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = np.unique(_slots(batch.column("fp").to_numpy().view(_U)).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(slot // block_bits), pa.array(slot % block_bits)], ["block", "bit"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            block, bit = batch.column("block").to_numpy(), batch.column("bit").to_numpy()
            for k in np.unique(block).tolist():
                made.setdefault(k, np.zeros(block_bits, bool))[bit[block == k]] = True
        bits = [np.packbits(b, bitorder="little").tobytes() for b in made.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(made), pa.int64()), pa.array(bits, pa.binary())], ["block", "bits"])

    table = np.zeros((1 << TABLE_BITS) // 8, np.uint8)
    dealt = fps.select("fp").mapInArrow(slots, "block long, bit long").distinct().repartition(TABLE_BLOCKS, "block")
    for k, bits in dealt.mapInArrow(blocks, "block long, bits binary").collect():
        table[k * (block_bits // 8) : (k + 1) * (block_bits // 8)] = np.frombuffer(bytes(bits), np.uint8)
    return table.tobytes()


def _resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, count) of the pointers (count, span) into documents (lang, text)."""
    low, lower = (1 << SPAN_BITS) - 1, bytes(_LOWER)
    for batch in slices(batches):
        langs: list[str] = []
        phrases: list[bytes] = []
        counts: list[int] = []
        for k, lang in enumerate(batch.column("lang").to_pylist()):
            data = batch.column("text")[k].as_py().encode().translate(lower)
            count, span = batch.column("found")[k].values.flatten()
            start = span.to_numpy() >> SPAN_BITS
            for a, b in zip(start.tolist(), (start + (span.to_numpy() & low)).tolist(), strict=True):
                phrase = data[a:b]
                phrases.append(b" ".join(phrase.split()) if b"\t" in phrase or b"  " in phrase else phrase)
            langs += [lang] * len(start)
            counts += count.to_pylist()
        arrays = [pa.array(langs, pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["lang", "phrase", "count"])


def frequent_phrases(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", min_count: int = 30, max_words: int = 4, modulus: int = MERSENNE) -> DataFrame:
    """(lang, phrase, f): every phrase of up to ``max_words`` words found ``min_count`` times or more in a language.

    The empty phrase's f is the number of all words of the language.
    """
    if not 2 <= max_words <= 16 or min_count < 1:
        raise ValueError("max_words must be from 2 to 16, min_count at least 1")
    spark = docs.sparkSession
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    text = F.col(text_col).cast("string")
    # Written once, so that a row's number points to the same text in every later step.
    rows = stored(docs.select(F.monotonically_increasing_id().alias("row"), lang.alias("lang"), text.alias("text")).filter("text <> ''"))


    def counted(orders: tuple[int, ...], table: bytes | None) -> DataFrame:
        shared = None if table is None else spark.sparkContext.broadcast(table)
        hashed = rows.mapInArrow(_hashed(orders, modulus, shared), "fp long, count long, row long, span long")
        return stored(hashed.repartition("fp").sortWithinPartitions("fp").mapInArrow(_frequent(min_count), hashed.schema))

    found = counted((1, 2), None)
    if max_words > 2:
        found = found.unionByName(counted(tuple(range(3, max_words + 1)), _bit_table(found)))
    pointers = found.groupBy("row").agg(F.collect_list(F.struct("count", "span")).alias("found"))
    told = rows.join(pointers, "row").select("lang", "text", "found").mapInArrow(_resolved, "lang string, phrase string, count long")
    return told.groupBy("lang", "phrase").agg(F.sum("count").alias("f")).filter(F.col("f") >= min_count)


def collocations(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", min_count: int = 30, max_words: int = 4, cover: float = 0.8, top: int = 2000, modulus: int = MERSENNE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases by their least cohesive cut.

    A phrase of a words' frequency that is cut into parts of frequencies l and
    r scores floor(2,000,000 a / (l + r)); its worst cut counts, the first of
    equals.  A phrase that lies in a longer one of at least ``cover`` times
    its frequency is left out.
    """
    freq = stored(frequent_phrases(docs, text_col=text_col, lang_col=lang_col, min_count=min_count, max_words=max_words, modulus=modulus).withColumn("words", F.when(F.col("phrase") == "", F.array().cast("array<string>")).otherwise(F.split("phrase", " "))))
    size = F.size("words")
    phrases = freq.filter(size > 1).select("lang", "phrase", "words", F.col("f").alias("a"))

    def part(begin: Column | int, length: Column | int) -> Column:
        return F.array_join(F.slice("words", begin, length), " ")

    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(1, F.col("k")).alias("first"), part(F.col("k") + 1, size - F.col("k")).alias("rest"))
    # Phrases of one length that begin (or end) with a part don't outnumber the part's occurrences by min_count.
    parts = freq.filter((size > 0) & (size < max_words)).select("lang", "phrase", "f", F.ceil(F.col("f") * (max_words - 1) / min_count).alias("uses"))
    total = parts.agg(F.sum("uses")).first()[0] or 0
    for name, f in (("first", "l"), ("rest", "r")):
        cuts = lookup(cuts, parts.select("lang", F.col("phrase").alias(name), F.col("f").alias(f), "uses"), ["lang", name], "uses", total=total).drop("uses", name)
    score = F.expr("(CAST(a AS DECIMAL(20,0)) * 2000000BD) DIV (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))").cast("long")
    worst = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut")).select("lang", "phrase", "cut.*")
    inner = [(n, at) for n in range(2, max_words) for at in range(1, max_words - n + 2)]
    held = F.array(*(F.when(size >= F.lit(at + n - 1), part(at, n)) for n, at in inner)) if inner else F.array().cast("array<string>")
    own = phrases.select("lang", "a", F.col("phrase").alias("longer"), F.explode(F.array_distinct(held)).alias("phrase")).filter("phrase IS NOT NULL AND phrase <> longer")
    longest = own.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    share = F.lit(round(cover * 100)).cast("decimal(20,0)")
    free = worst.join(longest, ["lang", "phrase"], "left").filter(F.col("around").isNull() | (F.lit(100).cast("decimal(20,0)") * F.col("around").cast("decimal(18,0)") < share * F.col("a").cast("decimal(18,0)")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language may hold most phrases: its first ``top`` are among the first ``top`` of each share.
    salted = free.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    near = salted.withColumn("place", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).filter(F.col("place") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    totals = freq.filter("phrase = ''").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
