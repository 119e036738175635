"""Series at other frequencies, and across series."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.functions.expr import is_finite
from seriesloom.operators.growth import change, normalised
from seriesloom.shared import written


def downsample(series: DataFrame, period: str = "month") -> DataFrame:
    """(indicator_id, timestamp, mean_value, closing, volatility) by calendar period."""
    known = normalised(series).withColumn("start", F.date_trunc(period, "timestamp").cast("timestamp_ntz"))
    return known.groupBy("indicator_id", "start").agg(F.avg("value").alias("mean_value"), F.max_by("value", "timestamp").alias("closing"), F.stddev_samp("value").alias("volatility")).withColumnRenamed("start", "timestamp")


def upsample_days(series: DataFrame) -> DataFrame:
    """A row for every day between a series' first and last, carrying the last known value forward."""
    days = normalised(series).groupBy("indicator_id", F.to_date("timestamp").alias("day")).agg(F.max_by("value", "timestamp").alias("value"))
    spine = days.groupBy("indicator_id").agg(F.min("day").alias("lo"), F.max("day").alias("hi")).select("indicator_id", F.explode(F.sequence("lo", "hi")).alias("day"))
    so_far = Window.partitionBy("indicator_id").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return spine.join(days, ["indicator_id", "day"], "left").withColumn("value", F.last("value", ignorenulls=True).over(so_far))


def moving_average(series: DataFrame, periods: int) -> DataFrame:
    """The mean of each observation and the ones before it, ``periods`` in all."""
    frame = Window.partitionBy("indicator_id").orderBy("timestamp").rowsBetween(1 - periods, 0)
    return normalised(series).select("indicator_id", "timestamp", F.avg("value").over(frame).alias("moving_average"))


def calendar_average(series: DataFrame, days: int) -> DataFrame:
    """The mean of each observation and those of the ``days`` days that end with its own, however many there are."""
    day = F.datediff(F.to_date("timestamp"), F.lit("1970-01-01").cast("date"))
    known = normalised(series).select("indicator_id", "timestamp", "value", day.alias("day"))
    frame = Window.partitionBy("indicator_id").orderBy("day").rangeBetween(1 - days, 0)
    return known.select("indicator_id", "timestamp", F.avg("value").over(frame).alias("moving_average"), F.count("value").over(frame).alias("observations"))


def _period_number(frequency: str) -> Column:
    """The calendar period of a timestamp, counted from year 0."""
    year, month = F.year("timestamp"), F.month("timestamp")
    numbers = {
        "daily": F.datediff(F.to_date("timestamp"), F.lit("1970-01-01").cast("date")),
        "monthly": year * 12 + month - 1,
        "quarterly": year * 4 + F.quarter("timestamp") - 1,
        "annual": year,
    }
    if frequency not in numbers:
        raise ValueError(f"frequency must be one of {sorted(numbers)}")
    return numbers[frequency].cast("int")


#: Periods back for each view of a frequency's series.
VIEWS = {"daily": {"dod": 1}, "monthly": {"mom": 1, "qoq": 3, "yoy": 12}, "quarterly": {"qoq": 1, "yoy": 4}, "annual": {"yoy": 1}}


def period_change(series: DataFrame, frequency: str, view: str) -> DataFrame:
    """(indicator_id, timestamp, value, change): percent change against the same calendar period so far back, null over a gap.

    Of several observations in one period the last one counts; ``view``: see
    ``VIEWS``.  A change from zero or one that isn't finite is null.
    """
    back = VIEWS[frequency][view]
    closing = normalised(series).groupBy("indicator_id", _period_number(frequency).alias("period")).agg(F.max_by(F.struct("timestamp", "value"), "timestamp").alias("last"))
    exactly = Window.partitionBy("indicator_id").orderBy("period").rangeBetween(-back, -back)
    rows = closing.select("indicator_id", F.col("last.timestamp").alias("timestamp"), F.col("last.value").alias("value"), F.first("last.value").over(exactly).alias("before"))
    rate = 100 * (F.try_divide("value", "before") - 1)
    return rows.select("indicator_id", "timestamp", "value", F.when(is_finite(rate), rate).alias("change"))


def daily_returns(series: DataFrame) -> DataFrame:
    """(indicator_id, timestamp, value, change): each day's closing value against the day before, null where that day has none."""
    return period_change(series, "daily", "dod")


#: Series and periods of a block of the correlation matrix.
BLOCK_SERIES, BLOCK_PERIODS = 64, 512
_SUMS = ("n", "x", "y", "xx", "yy", "xy")


def _gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the shared periods of every pair of series of two blocks (rows, columns: lists of series with their places and values)."""

    def matrix(cells: pa.ListScalar, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        flat = cells.values
        ids, at, values = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("id", "at", "value"))
        names, row = np.unique(ids, return_inverse=True)
        known, x = np.zeros((len(names), width)), np.zeros((len(names), width))
        known[row, at], x[row, at] = 1.0, values
        return names, known, x

    for batch in batches:
        for k in range(batch.num_rows):
            a, ka, x = matrix(batch.column("rows")[k], BLOCK_PERIODS)
            b, kb, y = matrix(batch.column("columns")[k], BLOCK_PERIODS)
            sums = [ka @ kb.T, x @ kb.T, ka @ y.T, (x * x) @ kb.T, ka @ (y * y).T, x @ y.T]
            pair = (a[:, None] < b[None, :]) & (sums[0] > 0)
            left, right = np.nonzero(pair)
            yield pa.RecordBatch.from_arrays([pa.array(a[left]), pa.array(b[right]), *(pa.array(s[pair]) for s in sums)], ["a", "b", *_SUMS])


def correlations(series: DataFrame) -> DataFrame:
    """(a, b, correlation, periods): growth of each pair of series over the periods they share.

    Series and periods are numbered and cut into blocks.  A task takes two
    blocks of series over one block of periods as matrices, whose products
    hold the sums of every pair; these add up over the blocks of periods.  So
    a value is sent once for each block of series, and not once for each
    series.  Values are taken from their series' mean first, which the
    correlation doesn't see and which keeps the sums exact.  Pairs still grow
    with the square of the number of series.
    """
    rates = normalised(series).select("indicator_id", "timestamp", change("value").alias("rate")).filter(is_finite(F.col("rate")))
    means = rates.groupBy("indicator_id").agg(F.avg("rate").alias("mean"))
    known = written(rates.join(means, "indicator_id").select("indicator_id", "timestamp", (F.col("rate") - F.col("mean")).alias("value")))
    # Series and periods have one row each here; their numbers come in the order of names and of time.
    ids = written(numbered(known.select("indicator_id").distinct(), "indicator_id", "number"))
    times = numbered(known.select("timestamp").distinct(), "timestamp", "place")
    cells = known.join(ids, "indicator_id").join(times, "timestamp")
    cell = F.struct(F.col("number").alias("id"), (F.col("place") % BLOCK_PERIODS).cast("int").alias("at"), "value")
    blocks = written(
        cells.groupBy(F.floor(F.col("number") / BLOCK_SERIES).alias("block"), F.floor(F.col("place") / BLOCK_PERIODS).alias("span")).agg(F.collect_list(cell).alias("cells"))
    )
    a = blocks.select("span", F.col("block").alias("i"), F.col("cells").alias("rows"))
    b = blocks.select("span", F.col("block").alias("j"), F.col("cells").alias("columns"))
    pairs = a.join(b, "span").filter("i <= j").select("rows", "columns")
    sums = pairs.mapInArrow(_gram, "a long, b long, " + ", ".join(f"{s} double" for s in _SUMS)).groupBy("a", "b").agg(*(F.sum(s).alias(s) for s in _SUMS))
    n = F.col("n")
    up = n * F.col("xy") - F.col("x") * F.col("y")
    down = F.sqrt(n * F.col("xx") - F.col("x") * F.col("x")) * F.sqrt(n * F.col("yy") - F.col("y") * F.col("y"))
    told = sums.select("a", "b", F.when(n > 1, F.try_divide(up, down)).alias("correlation"), n.cast("long").alias("periods"))
    for end in ("a", "b"):
        told = told.join(ids.select(F.col("number").alias(end), F.col("indicator_id").alias(f"{end}_id")), end)
    return told.select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), "correlation", "periods")


def numbered(rows: DataFrame, order: str, name: str) -> DataFrame:
    """``rows`` with their place in an order, from 0: sorted in ranges, with what the tasks before hold added."""
    lined = written(rows.repartitionByRange(order).sortWithinPartitions(order).withColumn("_line", F.monotonically_increasing_id()))
    task, low = F.shiftright("_line", 33), F.lit((1 << 33) - 1)
    # One row per task.
    counts = lined.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_own"))
    before = counts.select("_task", F.coalesce(F.sum("_own").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    placed = lined.withColumn("_task", task).join(F.broadcast(before), "_task")
    return placed.withColumn(name, F.col("_base") + F.col("_line").bitwiseAND(low)).drop("_task", "_line", "_base")
