"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts are compared as letters and digits in lower case with single blanks
between words.  A benchmark item is cut into overlapping windows of at most
``WINDOW`` characters.  A document holds a window if some stretch of it is
within an edit distance of ``ERRORS`` times the window's length.

By the q-gram lemma such a stretch shares at least w - q + 1 - q * e of the
window's q-grams, all within a band of e diagonals.  First, per document, only
stretches with that many benchmark q-grams of any item are retained; in these,
shared q-grams are counted per window in overlapping diagonal bands, and bands
that reach the bound are verified by an alignment confined to them.

A benchmark of up to ``BROADCAST_CHARS`` characters, which is counted first, is
broadcast as one index.  Beyond that Spark keeps it as a table of windows: tasks
cut the retained stretches out of the documents by a bit table of the
benchmark's q-grams (16 MB whatever its size), stretches meet windows in a join,
and each pair is counted and aligned as before.  A window cut into one piece
more than its budget has a piece that every match holds unchanged, so the join
is on pieces and loses nothing.  Both ways give the same rows.

The length of the q-grams follows the window's length, so that the lemma still
asks for enough of them at the full budget.  An item of under ``MIN_CHARS``
characters says too little inside a text; it is found where it is the whole
text.

Cases: a null text or one without letters and digits (document or item)
matches nothing; items with one text are reported one by one, those with one id
as one; repeated documents one by one; an empty benchmark gives no rows, and
leaves all documents; a null document id stays null.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import code_points, slices, stored

LONGEST_Q = 9
WINDOW = 100
#: Edits allowed per character of a window.
ERRORS = 0.08
MIN_CHARS = 16
#: Shared q-grams that the lemma asks for at least, in windows of 48 characters or more; in shorter ones a third of their length.
SHARED = 16
#: Characters of benchmark text that are broadcast as one index at most (about 60 bytes each).
BROADCAST_CHARS = 1 << 20
#: Bits of the table of q-grams of a larger benchmark, as a power of two.
TABLE_BITS = 27
_FILTER_BITS = 20
#: q-grams of which a match must share so many that windows with no more than a common phrase fall short.
SHORT_Q = 3
#: Half bands of diagonals that are counted at once, entries that are expanded at once, and pairs that are aligned at once.
CHUNK_BANDS, CHUNK_ENTRIES, ALIGNED = 32, 1 << 22, 1 << 10
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@cache
def _folding() -> np.ndarray:
    """By code point: its lower-case form, or 0 if it is neither letter, mark nor digit."""
    table = np.zeros(sys.maxunicode + 1, np.uint32)
    for k in range(sys.maxunicode + 1):
        c = chr(k)
        if unicodedata.category(c)[0] in "LMN":
            low = c.lower()
            table[k] = ord(low) if len(low) == 1 else k
    return table


def normalised(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points with single blanks, and each one's place in the source."""
    points = _folding()[code_points(text)]
    word = points != 0
    keep = word.copy()
    keep[1:] |= word[:-1]  # the first separator after a word stays, as a blank
    places = np.flatnonzero(keep)
    out = points[places]
    out[out == 0] = 32
    return out, places


def grams(points: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of every q-gram."""
    if len(points) < q:
        return np.zeros(0, np.uint64)
    n = len(points) - q + 1
    value = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(q):
            value = value * np.uint64(1_000_003) + points[k : k + n]
        return value * _MULTIPLIER


def budget(length: int) -> int:
    """Edits allowed in a window of this length."""
    return int(length * ERRORS)


@cache
def gram_length(length: int) -> int:
    """The longest q-grams of which a stretch within the budget still shares enough with the window."""
    return next(q for q in range(LONGEST_Q, 0, -1) if q == 1 or length - q + 1 - q * budget(length) >= min(SHARED, length / 3))


def bound(length: int) -> int:
    """q-grams that a stretch within the budget shares with the window at least."""
    q = gram_length(length)
    return length - q + 1 - q * budget(length)


@dataclass(frozen=True)
class Grams:
    """The q-grams of one length, sorted by hash, of the windows that are searched with them."""

    q: int
    hashes: np.ndarray
    window_of: np.ndarray
    place_of: np.ndarray
    present: np.ndarray
    least: int
    longest: int
    #: The known short q-grams, sorted, and each window's by number (one row per window of ``numbers``; past its end the number after the last).
    known: np.ndarray
    short: np.ndarray
    row_of: dict[int, int]


@dataclass(frozen=True)
class Index:
    """The windows of a block of items, with the least number of shared q-grams of each; and the items that must be a whole text."""

    items: list[int]
    windows: list[tuple[int, np.ndarray]]
    bounds: np.ndarray
    grams: list[Grams]
    whole: dict[bytes, list[int]]


def _stripped(points: np.ndarray) -> np.ndarray:
    return points[:-1] if len(points) and points[-1] == 32 else points


def _grams_of(q: int, numbers: list[int], windows: list[tuple[int, np.ndarray]]) -> Grams:
    each = [grams(windows[k][1], q) for k in numbers]
    hashes = np.concatenate(each)
    order = np.argsort(hashes, kind="stable")
    present = np.zeros(1 << _FILTER_BITS, bool)
    present[hashes >> np.uint64(64 - _FILTER_BITS)] = True
    lengths = [len(windows[k][1]) for k in numbers]
    shorts = [grams(windows[k][1], SHORT_Q) for k in numbers]
    known = np.unique(np.concatenate(shorts))
    short = np.full((len(numbers), max(map(len, shorts))), len(known), np.int32)
    for row, found in zip(short, shorts, strict=True):
        row[: len(found)] = np.searchsorted(known, found)
    return Grams(
        q,
        hashes[order],
        np.repeat(np.array(numbers), [len(e) for e in each])[order].astype(np.int32),
        np.concatenate([np.arange(len(e)) for e in each])[order].astype(np.int32),
        present,
        min(map(bound, lengths)),
        max(n + budget(n) for n in lengths),
        known,
        short,
        {k: row for row, k in enumerate(numbers)},
    )


def _cut(points: np.ndarray) -> list[np.ndarray]:
    """An item's windows, each overlapping the next by half."""
    stops = list(range(min(WINDOW, len(points)), len(points) + 1, WINDOW // 2))
    return [points[max(0, stop - WINDOW) : stop] for stop in dict.fromkeys([*stops, len(points)])]


def build_index(items: list[tuple[int, str]]) -> Index | None:
    windows: list[tuple[int, np.ndarray]] = []
    whole: dict[bytes, list[int]] = {}
    for k, (_, text) in enumerate(items):
        points = _stripped(normalised(text or "")[0])
        if 0 < len(points) < MIN_CHARS:
            whole.setdefault(points.tobytes(), []).append(k)
        if len(points) < MIN_CHARS:
            continue
        windows += [(k, w) for w in _cut(points)]
    if not windows and not whole:
        return None
    by_q: dict[int, list[int]] = {}
    for k, (_, p) in enumerate(windows):
        by_q.setdefault(gram_length(len(p)), []).append(k)
    return Index([i for i, _ in items], windows, np.array([bound(len(p)) for _, p in windows], np.int64), [_grams_of(q, ks, windows) for q, ks in sorted(by_q.items())], whole)


def _retained(hits: np.ndarray, least: int, reach: int) -> np.ndarray:
    """Those sorted places that lie with at least ``least`` of them in a stretch of ``reach``."""
    if len(hits) < least:
        return hits[:0]
    close = hits[least - 1 :] - hits[: len(hits) - least + 1] < reach
    keep = np.zeros(len(hits) + 1, np.int32)
    np.add.at(keep, np.flatnonzero(close), 1)
    np.add.at(keep, np.flatnonzero(close) + least, -1)
    return hits[np.cumsum(keep[:-1]) > 0]


def banded_distances(windows: np.ndarray, text: np.ndarray, diagonals: np.ndarray, width: int, most: int) -> list[tuple[int, int, int] | None]:
    """The best match of each whole window (rows of one length) in ``text`` along diagonals within ``width`` of its own.

    Each is (edits, start, end), or None beyond ``most`` edits.  The start in
    the text is free: each alignment cell carries the start it came from.
    """
    span, far = 2 * width + 1, most + 1
    cells = np.arange(span)
    pair = np.arange(len(windows))
    at = diagonals[:, None] - width + cells  # text place of each cell in row 0
    inside = (at >= 0) & (at <= len(text))
    cost, begin = np.where(inside, 0, far), np.where(inside, at, 0)
    padded = np.append(text, 0)
    length = windows.shape[1]
    for i in range(length):
        place = at + i  # a cell's text characters used so far, before this row's step on the diagonal
        usable = (place >= 0) & (place < len(text))
        same = padded[np.clip(place, 0, len(text))] == windows[:, i, None]
        step, step_begin = np.where(usable, cost + ~same, far), begin
        # The window's letter without one in the text: comes from the next diagonal.
        over = np.full_like(cost, far)
        over[:, :-1] = cost[:, 1:] + 1
        better = over < step
        step = np.where(better, over, step)
        step_begin = np.where(better, np.append(begin[:, 1:], np.zeros((len(begin), 1), begin.dtype), axis=1), step_begin)
        # A text character without one in the window: along the row, cheapest run of insertions.
        shifted = step - cells
        lowest = np.minimum.accumulate(shifted, axis=1)
        came = np.maximum.accumulate(np.where(shifted == lowest, cells, 0), axis=1)
        usable_end = (place + 1 >= 0) & (place + 1 <= len(text))
        cost = np.where(usable_end, np.minimum(lowest + cells, far), far)
        begin = np.take_along_axis(step_begin, came, axis=1)
        alive = cost.min(axis=1) <= most
        if not alive.all():
            pair, at, cost, begin, windows = (x[alive] for x in (pair, at, cost, begin, windows))
            if not len(pair):
                break
    out: list[tuple[int, int, int] | None] = [None] * len(diagonals)
    if len(pair):
        k = cost.argmin(axis=1)
        for n, row, best in zip(pair.tolist(), range(len(pair)), k.tolist(), strict=True):
            out[n] = (int(cost[row, best]), int(begin[row, best]), int(at[row, best] + length))
    return out


def banded_distance(window: np.ndarray, text: np.ndarray, diagonal: int, width: int, most: int) -> tuple[int, int, int] | None:
    """``banded_distances`` of one window."""
    return banded_distances(window[None, :], text, np.array([diagonal]), width, most)[0]


Region = tuple[int, int, int, int, int]


def _preferred(region: Region) -> tuple[int, int]:
    """Of the regions of an item that are the same stretch, the one with the fewest edits, then the longest window, is kept."""
    return region[3], -region[4]


def find_regions(text: str, index: Index) -> list[Region]:
    """(item number, start, end, edits, window characters) of every window found; offsets in the source's code points."""
    if not text:
        return []
    points, places = normalised(text)
    out: dict[tuple[int, int, int], Region] = {}
    if len(points) <= MIN_CHARS and index.whole:
        own = _stripped(points)
        for item in index.whole.get(own.tobytes(), []):
            out[item, 0, 0] = (item, int(places[0]), int(places[len(own) - 1]) + 1, 0, len(own))
    for part in index.grams:
        _search(points, places, index, part, out)
    return sorted(out.values())


def _search(points: np.ndarray, places: np.ndarray, index: Index, part: Grams, out: dict[tuple[int, int, int], Region]) -> None:
    """Adds the windows found by q-grams of one length."""
    values = grams(points, part.q)
    hits = np.flatnonzero(part.present[(values >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
    hits = _retained(hits, part.least, part.longest)
    if not len(hits):
        return
    low = np.searchsorted(part.hashes, values[hits], "left")
    high = np.searchsorted(part.hashes, values[hits], "right")
    hits, low, high = (x[high > low] for x in (hits, low, high))
    # Common q-grams that pass the filter by chance are dropped by the exact lookup above; what is left is retained again.
    stay = np.isin(hits, _retained(hits, part.least, part.longest))
    hits, low, n = hits[stay], low[stay], (high - low)[stay]
    if not len(hits):
        return
    # Each chunk of diagonals is counted by itself: what is held at once doesn't grow with the text.
    width = int(WINDOW * ERRORS)
    stretch = CHUNK_BANDS * width
    longest = part.longest + 2 * width
    first, last = (int(hits[0]) - WINDOW) // stretch, int(hits[-1]) // stretch
    for chunk in range(first, last + 1):
        a, b = np.searchsorted(hits, [chunk * stretch, (chunk + 1) * stretch + longest])
        if b - a >= part.least:
            for k, middle in _reached(hits[a:b], low[a:b], n[a:b], index, part, chunk, width):
                _align(points, places, index, part, k, middle, width, out)


def _reached(hits: np.ndarray, low: np.ndarray, n: np.ndarray, index: Index, part: Grams, chunk: int, width: int) -> Iterator[tuple[np.ndarray, int]]:
    """(windows, diagonal) for every band of the chunk with enough shared q-grams; the diagonal is the one most of them lie on.

    A band is two neighbouring half bands of ``width`` diagonals, so bands
    overlap by half, and any ``width`` neighbouring diagonals lie in one.
    """
    zero, halves = chunk * CHUNK_BANDS * width, CHUNK_BANDS + 1
    ends = np.cumsum(n)
    cuts = np.unique(np.append(np.searchsorted(ends, np.arange(CHUNK_ENTRIES, ends[-1], CHUNK_ENTRIES)), len(hits)))

    def entries() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, diagonal from the chunk's first) of the shared q-grams, so many at a time."""
        begin = 0
        for cut in cuts.tolist():
            if cut > begin:
                h, lo, m = hits[begin:cut], low[begin:cut], n[begin:cut]
                entry = np.repeat(lo - np.append(0, np.cumsum(m)[:-1]), m) + np.arange(m.sum())
                diagonal = np.repeat((h - zero).astype(np.int32), m) - part.place_of[entry]
                own = (diagonal >= 0) & (diagonal < halves * width)
                yield part.window_of[entry][own], diagonal[own]
            begin = cut

    again: Callable[[], Iterable[tuple[np.ndarray, np.ndarray]]] = entries
    if len(cuts) <= 2:
        once = list(entries())
        again = lambda: once
    seen = np.zeros(len(index.windows), bool)
    for w, _ in again():
        seen[w] = True
    present = np.flatnonzero(seen)
    if not len(present):
        return
    row_of = np.cumsum(seen, dtype=np.int32) - np.int32(1)
    counts = np.zeros(len(present) * halves, np.int64)
    for w, d in again():
        counts += np.bincount(row_of[w] * np.int32(halves) + d // np.int32(width), minlength=len(counts))
    counts = counts.reshape(-1, halves)
    full = counts[:, :-1] + counts[:, 1:] >= index.bounds[present][:, None]
    rows, bands = np.nonzero(full)
    if not len(rows):
        return
    some = np.unique(rows)
    chosen, place = present[some], np.full(len(present), -1, np.int32)
    place[some] = np.arange(len(some), dtype=np.int32)
    each = np.zeros(len(some) * halves * width, np.int32)
    for w, d in again():
        row = place[row_of[w]]
        kept = row >= 0
        each += np.bincount(row[kept].astype(np.int64) * (halves * width) + d[kept], minlength=len(each)).astype(np.int32)
    each = each.reshape(len(some), -1)
    rows = place[rows]
    middle = bands * width + each[rows[:, None], bands[:, None] * width + np.arange(2 * width)].argmax(axis=1)
    pairs = np.unique(np.stack([middle, rows]), axis=1)
    for m in np.unique(pairs[0]).tolist():
        yield chosen[pairs[1][pairs[0] == m]], m + zero


def _align(points: np.ndarray, places: np.ndarray, index: Index, part: Grams, windows: np.ndarray, middle: int, width: int, out: dict[tuple[int, int, int], Region]) -> None:
    """Adds those of ``windows`` that match along diagonals around ``middle``."""
    reach = 2 * width
    around = points[max(0, middle - reach) : max(0, middle + WINDOW + reach)]
    has = np.zeros(len(part.known) + 1, bool)
    short = grams(around, SHORT_Q)
    at = np.minimum(np.searchsorted(part.known, short), len(part.known) - 1)
    has[at[part.known[at] == short]] = True
    lengths = np.array([len(index.windows[k][1]) for k in windows.tolist()])
    shared = has[part.short[[part.row_of[k] for k in windows.tolist()]]].sum(axis=1)
    # The q-gram lemma once more: what shares only a common phrase with the text mostly ends here.
    enough = shared >= np.array([n - SHORT_Q + 1 - SHORT_Q * budget(n) for n in lengths.tolist()])
    windows, lengths = windows[enough], lengths[enough]
    for length in np.unique(lengths).tolist():
        same = windows[lengths == length]
        for begin in range(0, len(same), ALIGNED):
            own = same[begin : begin + ALIGNED].tolist()
            letters = np.stack([index.windows[k][1] for k in own])
            stop = middle + length
            equal = (letters == points[middle:stop]).all(axis=1) if middle >= 0 and stop <= len(points) else np.zeros(len(own), bool)
            # A match without edits on this diagonal: no alignment is cheaper.
            found: list[tuple[int, int, int] | None] = [(0, middle, stop) if e else None for e in equal.tolist()]
            rest = np.flatnonzero(~equal)
            if len(rest):
                for k, got in zip(rest.tolist(), banded_distances(letters[rest], points, np.full(len(rest), middle), reach, budget(length)), strict=True):
                    found[k] = got
            for k, got in zip(own, found, strict=True):
                if got:
                    edits, s, e = got
                    e = max(e, s + 1)
                    region = (index.windows[k][0], int(places[s]), int(places[min(e, len(places)) - 1]) + 1, edits, length)
                    out[region[:3]] = min(out.get(region[:3], region), region, key=_preferred)


def _small(benchmark: DataFrame, item_col: str, text_col: str) -> list[tuple[int, str]] | None:
    """The items with a text, sorted, if they may be broadcast."""
    some = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).cast("string").alias("text")).filter("text <> ''")
    if (some.agg(F.sum(F.char_length("text"))).first()[0] or 0) > BROADCAST_CHARS:
        return None
    return sorted(((r[0], r[1]) for r in some.collect()), key=lambda x: (x[0] is None, x))


_REGIONS = "array<struct<item_id:long,start:long,end:long,edits:int,window_chars:int>>"


def _matcher(shared, at: int) -> Callable[[pa.RecordBatch], list[list[dict]]]:
    def run(batch: pa.RecordBatch) -> list[list[dict]]:
        index = shared.value
        names = ("item_id", "start", "end", "edits", "window_chars")
        out = []
        for text in batch.column(at).to_pylist():
            found: dict[tuple, Region] = {}
            for number, *rest in find_regions(text or "", index):
                region = (index.items[number], *rest)
                found[region[:3]] = min(found.get(region[:3], region), region, key=_preferred)
            out.append([dict(zip(names, region, strict=True)) for region in found.values()])
        return out

    return run


# --- large benchmarks ------------------------------------------------------------------

#: Diagonals of a band; stretches begin at a multiple of it, so that bands are the same in a stretch and in its text.
_WIDTH = int(WINDOW * ERRORS)


def _per_row(f: Callable[..., Iterator[tuple]], schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Maps each row's values to any number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [out for row in zip(*(c.to_pylist() for c in batch.columns), strict=True) for out in f(*row)]
            columns = zip(*found, strict=True) if found else ([] for _ in schema)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(columns, schema, strict=True)], schema=schema)

    return run


def _letters(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint32)


def _windows_of(item: int | None, text: str | None) -> Iterator[tuple[int | None, bytes]]:
    points = _stripped(normalised(text or "")[0])
    if len(points) >= MIN_CHARS:
        yield from ((item, w.tobytes()) for w in _cut(points))
    elif len(points):
        yield item, points.tobytes()


def _piece_length(length: int) -> int:
    return length // (budget(length) + 1)


def _pieces_of(number: int, data: bytes) -> Iterator[tuple[int, int]]:
    """Hashes of the pieces of which every match holds one unchanged; a short item is its own piece."""
    points = _letters(data)
    size = _piece_length(len(points)) if len(points) >= MIN_CHARS else len(points)
    for at in range(0, len(points) - size + 1, size):
        yield number, int(grams(points[at : at + size], size).view(np.int64)[0])


def _slots(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _slots_of(data: bytes) -> Iterator[tuple[int, int]]:
    """(byte, bit) of each q-gram in the table of bits."""
    points = _letters(data)
    if len(points) >= MIN_CHARS:
        for slot in np.unique(_slots(grams(points, gram_length(len(points))))).tolist():
            yield slot >> 3, 1 << (slot & 7)


def _stretches(points: np.ndarray, table: np.ndarray, reaches: dict[int, tuple[int, int]]) -> list[tuple[int, int]]:
    """(from, to) of what may hold a window, merged; with so much around that an alignment isn't cut off."""
    spans = []
    for q, (least, reach) in reaches.items():
        slots = _slots(grams(points, q))
        hits = np.flatnonzero(table[slots >> 3] >> (slots & 7).astype(np.uint8) & 1)
        spans += [(max(0, h - 2 * reach) // _WIDTH * _WIDTH, h + 2 * reach) for h in _retained(hits, least, reach).tolist()]
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


@lru_cache(maxsize=16)
def _index_of(data: bytes) -> Index:
    points = _letters(data)
    if len(points) < MIN_CHARS:
        return Index([0], [], np.zeros(0, np.int64), [], {data: [0]})
    windows = [(0, points)]
    return Index([0], windows, np.array([bound(len(points))]), [_grams_of(gram_length(len(points)), [0], windows)], {})


def _large(rows: DataFrame, benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(id, key, item_id, start, end, edits, window_chars) of every window of a large benchmark in ``rows`` (id, key, text)."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).cast("string").alias("text"))
    cut = stored(items.mapInArrow(_per_row(_windows_of, pa.schema([("item_id", pa.int64()), ("window", pa.binary())])), "item_id long, window binary"))
    windows = stored(cut.select("window").distinct().select(F.monotonically_increasing_id().alias("w"), "window"))
    # As many numbers as a window has lengths.
    lengths = sorted(r[0] // 4 for r in windows.select(F.octet_length("window")).distinct().collect())
    reaches: dict[int, tuple[int, int]] = {}
    for n in (n for n in lengths if n >= MIN_CHARS):
        least, reach = reaches.get(gram_length(n), (n, 0))
        reaches[gram_length(n)] = (min(least, bound(n)), max(reach, n + budget(n)))
    sizes = sorted({_piece_length(n) for n in lengths if n >= MIN_CHARS})
    short = any(n < MIN_CHARS for n in lengths)

    slots = windows.select("window").mapInArrow(_per_row(_slots_of, pa.schema([("byte", pa.int64()), ("bit", pa.int64())])), "byte long, bit long")
    known = slots.groupBy("byte").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(1 << (TABLE_BITS - 3), np.uint8)
    table[known.column("byte").to_numpy()] = known.column("bits").to_numpy().astype(np.uint8)
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def stretches_of(number: int | None, key: bytes, text: str | None) -> Iterator[tuple]:
        points, places = normalised(text or "")
        if short and 0 < len(points) <= MIN_CHARS:
            yield number, key, 0, points.tobytes(), places.astype(np.int32).tobytes(), True
        for a, b in _stretches(points, shared.value, reaches):
            yield number, key, a, points[a:b].tobytes(), places[a:b].astype(np.int32).tobytes(), False

    kind = pa.schema([("id", pa.int64()), ("key", pa.binary()), ("begin", pa.int64()), ("points", pa.binary()), ("places", pa.binary()), ("whole", pa.bool_())])
    found = rows.mapInArrow(_per_row(stretches_of, kind), "id long, key binary, begin long, points binary, places binary, whole boolean")
    stretches = stored(found.withColumn("s", F.monotonically_increasing_id()))

    def hashes_of(number: int, data: bytes, whole: bool) -> Iterator[tuple[int, int]]:
        points = _letters(data)
        for size in [len(_stripped(points))] if whole else sizes:
            yield from ((number, v) for v in np.unique(grams(_stripped(points) if whole else points, size).view(np.int64)).tolist())

    def pair(name: str) -> tuple[pa.Schema, str]:
        return pa.schema([(name, pa.int64()), ("hash", pa.int64())]), f"{name} long, hash long"

    kind, names = pair("s")
    left = stretches.select("s", "points", "whole").mapInArrow(_per_row(hashes_of, kind), names)
    kind, names = pair("w")
    right = windows.mapInArrow(_per_row(_pieces_of, kind), names)
    candidates = left.join(right, "hash").select("s", "w").distinct()

    def regions_of(number: int | None, key: bytes, stretch: int, w: int, points: bytes, places: bytes, whole: bool, window: bytes) -> Iterator[tuple]:
        index, out = _index_of(window), {}
        if whole != (len(index.windows) == 0):
            return
        letters, at = _letters(points), np.frombuffer(places, np.int32)
        if whole:
            own = _stripped(letters)
            if own.tobytes() == window:
                yield number, key, stretch, w, int(at[0]), int(at[len(own) - 1]) + 1, 0, len(own)
            return
        _search(letters, at, index, index.grams[0], out)
        yield from ((number, key, stretch, w, *region[1:]) for region in out.values())

    names = ["id", "key", "s", "w", "start", "end", "edits", "window_chars"]
    types = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    both = candidates.join(stretches, "s").join(windows, "w").select("id", "key", "s", "w", "points", "places", "whole", "window")
    matched = both.mapInArrow(_per_row(regions_of, pa.schema(list(zip(names, types, strict=True)))), "id long, key binary, s long, w long, start long, end long, edits int, window_chars int")
    named = matched.join(cut.join(windows, "window").select("w", "item_id").distinct(), "w")
    best = F.min(F.struct("edits", (-F.col("window_chars")).alias("shorter"))).alias("best")
    once = named.groupBy("id", "key", "s", "item_id", "start", "end").agg(best)
    return once.select("id", "key", "item_id", "start", "end", "best.edits", (-F.col("best.shorter")).alias("window_chars"))


# --- whole tables ------------------------------------------------------------------------


def find(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, item_id, start, end, edits, window_chars): every benchmark window found in a document."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    items = _small(benchmark, item_col, item_text_col)
    if items is None:
        keyed = rows.select("id", F.lit(b"").alias("key"), "text")
        return _large(keyed, benchmark, item_col, item_text_col).select(F.col("id").alias(id_col), "item_id", "start", "end", "edits", "window_chars")
    index = build_index(items)
    if index is None:
        return docs.sparkSession.createDataFrame([], f"{id_col} long, item_id long, start long, end long, edits int, window_chars int")
    match = _matcher(docs.sparkSession.sparkContext.broadcast(index), 1)
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32()), ("window_chars", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = match(batch)
            some = pa.array([bool(f) for f in found], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["id", "regions"]).filter(some)

    return rows.mapInArrow(run, f"id long, regions {_REGIONS}").select(F.col("id").alias(id_col), F.explode("regions").alias("r")).select(id_col, "r.*")


def remove(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The same rows and columns without the documents that hold a window of the benchmark."""
    items = _small(benchmark, item_col, item_text_col)
    if items is None:
        # Whether a document goes depends on its text alone.
        digest = F.unhex(F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256))
        keyed = docs.select(F.lit(None).cast("long").alias("id"), digest.alias("key"), F.col(text_col).cast("string").alias("text"))
        gone = _large(keyed, benchmark, item_col, item_text_col).select("key").distinct()
        return docs.join(gone, digest == gone["key"], "left_anti")
    index = build_index(items)
    if index is None:
        return docs
    match = _matcher(docs.sparkSession.sparkContext.broadcast(index), docs.columns.index(text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array([not f for f in match(batch)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
