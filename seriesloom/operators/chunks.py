"""Windows in time over series of any length: a long series is cut into runs of time that separate tasks sort.

A plain window puts a series into one task.  ``split`` deals rows to ranges of
series and time, so that a series with a third of all rows lies in a third of
the ranges, and gives each range's share of a series a number, its chunk.
Windows then run by series and chunk.  What a chunk needs of those before it
is small: its predecessors' last rows (``with_rows_before``) or their totals
(``with_totals_before``).  A range continues at most one series from the range
before, so there are no more such entries than ranges, and they are broadcast.

The number of ranges follows that of the rows, and a task sorts one range: so
its memory stays the same when the table grows.  Ranges hashed to tasks, or
joined by Spark because they are small, would give some tasks several.

Series are told apart by ``indicator_id``, which may be null (one series).
Rows of one series are in the order of the given columns, which must be
unique in a series for a result that doesn't depend on chance, as with a plain
window; equal rows stay in one chunk.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from seriesloom.shared import written

KEY = "indicator_id"


#: Rows of a range: at most (on average), and at least where that leaves fewer ranges than ``spark.sql.shuffle.partitions``.
MOST, LEAST = 250_000, 10_000


def ranges_of(rows: DataFrame) -> int:
    """As many as ``spark.sql.shuffle.partitions``, but fewer for few rows and more where a range would have over ``MOST``."""
    n = rows.count()
    return max(1, ceil(n / MOST), min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), ceil(n / LEAST)))


def split(rows: DataFrame, order: tuple[str, ...] = ("timestamp",), ranges: int | None = None, within: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The rows with ``chunk``, written once so that the numbers stay; chunks of a series ascend with ``order``.

    ``ranges``: how many (default: by the number of rows, which are counted for it).
    ``within``: made of the dealt rows before they are numbered; it must leave
    rows in their partition, as an aggregate by series and ``order`` does, which
    needs no shuffle of its own here.
    """
    dealt = rows.repartitionByRange(ranges or ranges_of(rows), KEY, *order)
    if within:
        dealt = within(dealt)
    if "chunk" in dealt.columns:
        raise ValueError("a column named chunk is taken")
    return written(dealt.withColumn("chunk", F.spark_partition_id()))


def _apart(chunked: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A function that deals rows, given chunks of ``chunked``, to tasks: each range to one of its own."""
    last = chunked.agg(F.max("chunk")).first()[0]
    return lambda rows: rows.repartitionById((last or 0) + 1, F.col("chunk"))


def in_chunk(order: tuple[str, ...] = ("timestamp",)) -> WindowSpec:
    return Window.partitionBy(KEY, "chunk").orderBy(*order)


def with_rows_before(chunked: DataFrame, n: int, columns: dict[str, Callable[[WindowSpec], Column]], order: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """``chunked`` with ``columns``, made from functions of a window that looks back ``n`` rows at most.

    The rows are those of a plain window by series.  A chunk gets copies of the
    ``n`` rows before its first, out of as many chunks as hold them; the copies
    are left out of the result.
    """
    apart = _apart(chunked)
    late = Window.partitionBy(KEY, "chunk").orderBy(*(F.desc(c) for c in order))
    sizes = chunked.groupBy(KEY, "chunk").agg(F.count(F.lit(1)).alias("own"))
    # The chunks of each series that is in several, with the rows before them: no more than there are ranges, twice over.
    series = Window.partitionBy(KEY)
    starts = sizes.withColumn("chunks", F.count(F.lit(1)).over(series)).filter("chunks > 1")
    starts = starts.withColumn("start", F.sum("own").over(series.orderBy("chunk")) - F.col("own"))
    # A chunk has a row at least, so its rows go no further than into the n chunks after it.
    heads = F.collect_list(F.struct("chunk", "start")).over(series.orderBy("chunk").rowsBetween(1, max(n, 1)))
    ends = written(starts.select(F.col(KEY).alias("_id"), F.col("chunk").alias("_chunk"), (F.col("start") + F.col("own")).alias("end"), heads.alias("heads")))
    ended = chunked.join(F.broadcast(ends.select("_id", "_chunk")), F.col(KEY).eqNullSafe(F.col("_id")) & (F.col("chunk") == F.col("_chunk")), "left_semi")
    last = apart(ended).withColumn("_back", F.row_number().over(late)).filter(F.col("_back") <= n)
    placed = last.join(F.broadcast(ends), F.col(KEY).eqNullSafe(F.col("_id")) & (F.col("chunk") == F.col("_chunk"))).withColumn("_at", F.col("end") - F.col("_back"))
    into = F.filter("heads", lambda h: h["start"] - F.col("_at") <= n)
    copies = placed.withColumn("_into", F.explode(into)).select(*(F.col("_into.chunk").alias("chunk") if c == "chunk" else c for c in chunked.columns), F.lit(True).alias("_copy"))
    whole = apart(chunked.withColumn("_copy", F.lit(False)).unionByName(copies))
    return whole.withColumns({name: made(in_chunk(order)) for name, made in columns.items()}).filter(~F.col("_copy")).drop("_copy")


_ADDING = {"sum": (F.sum, lambda a, b: a + b), "count": (F.count, lambda a, b: a + b), "min": (F.min, F.least), "max": (F.max, F.greatest)}


def with_totals_before(chunked: DataFrame, columns: dict[str, tuple[str, str]], order: tuple[str, ...] = ("timestamp",), onto: DataFrame | None = None) -> DataFrame:
    """``chunked`` with running aggregates, named with (kind, column): from a series' first row to the current one.

    Kinds: sum, count, min, max; nulls are passed over, and a row with only
    nulls so far has null (count: 0).  Each chunk's own total is added up over
    the chunks before, and each row's over its chunk.  ``onto``: what
    ``with_rows_before`` made of ``chunked``; it gets the columns without
    another shuffle or sort.
    """
    unknown = {kind for kind, _ in columns.values()} - set(_ADDING)
    if unknown:
        raise ValueError(f"kinds that can't run: {sorted(unknown)}")
    own = chunked.groupBy(KEY, "chunk").agg(*(_ADDING[kind][0](column).alias(name) for name, (kind, column) in columns.items()))
    earlier = Window.partitionBy(KEY).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    folded = {name: (F.sum if kind == "count" else _ADDING[kind][0])(name).over(earlier) for name, (kind, _) in columns.items()}
    carried = own.select(F.col(KEY).alias("_id"), F.col("chunk").alias("_chunk"), F.row_number().over(Window.partitionBy(KEY).orderBy("chunk")).alias("_nth"), *(c.alias(f"_before_{name}") for name, c in folded.items())).filter("_nth > 1")
    # Only chunks that continue a series: one a range at most.
    rows = _apart(chunked)(chunked) if onto is None else onto
    met = rows.join(F.broadcast(written(carried)), F.col(KEY).eqNullSafe(F.col("_id")) & (F.col("chunk") == F.col("_chunk")), "left")
    running = in_chunk(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    made = {}
    for name, (kind, column) in columns.items():
        total, add = _ADDING[kind]
        here, before = total(column).over(running), F.col(f"_before_{name}")
        made[name] = F.coalesce(add(here, before), here, before)
    return met.withColumns(made).select(*rows.columns, *columns)
