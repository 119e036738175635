"""Windows over series cut into chunks give the rows of plain windows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from seriesloom.operators import chunks, growth

SCHEMA = "indicator_id string, timestamp timestamp_ntz, value double"


def table(spark, n, seed=3):
    """A third of all rows in one series, the rest in many short ones, one of them without a name."""
    r, start = random.Random(seed), datetime(2000, 1, 1)
    rows = []
    for k in range(n):
        name = "hot" if k % 3 == 0 else r.choice([None, *(f"s{j}" for j in range(40))])
        rows.append((name, start + timedelta(hours=k), None if r.random() < 0.1 else float(r.randrange(-50, 50))))
    r.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def same(a, b):
    order = lambda rows: sorted(map(tuple, rows), key=str)
    return order(a.select(*b.columns).collect()) == order(b.collect())


@pytest.mark.parametrize(("rows", "ranges", "back"), [(600, 16, 1), (600, 97, 40), (7, 5, 3), (0, 4, 2)])
def test_looking_back_over_chunks(spark, rows, ranges, back):
    """97 ranges: a chunk's 40 rows before come out of several chunks."""
    series = table(spark, rows)
    made = {"before": lambda w: F.lag("value", back).over(w), "mean": lambda w: F.avg("value").over(w.rowsBetween(-back, 0))}
    chunked = chunks.split(series, ranges=ranges)
    got = chunks.with_rows_before(chunked, back, made)
    assert got.columns == [*chunked.columns, *made]
    assert same(got, series.withColumns({name: f(growth.in_time()) for name, f in made.items()}))


@pytest.mark.parametrize(("rows", "ranges"), [(600, 16), (600, 97), (7, 5), (0, 4)])
def test_running_totals_over_chunks(spark, rows, ranges):
    series = table(spark, rows, seed=4)
    kinds = {"total": ("sum", "value"), "n": ("count", "value"), "low": ("min", "value"), "high": ("max", "value")}
    got = chunks.with_totals_before(chunks.split(series, ranges=ranges), kinds)
    w = growth.in_time().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    assert same(got, series.withColumns({name: getattr(F, kind)(column).over(w) for name, (kind, column) in kinds.items()}))


def test_a_hot_series_is_shared_out(spark):
    chunked = chunks.split(table(spark, 3000), ranges=12)
    sizes = [x["n"] for x in chunked.groupBy("indicator_id", "chunk").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) <= 2 * 3000 / 12
    assert chunked.filter("indicator_id = 'hot'").select("chunk").distinct().count() >= 4


def test_a_task_sorts_one_range(spark):
    """Hashed to tasks, or joined because they are small, ranges would meet in one."""
    chunked = chunks.split(table(spark, 3000), ranges=12)
    kinds = {"total": ("sum", "value")}

    def apart(got):
        met = got.select(F.spark_partition_id().alias("task"), "chunk").distinct().collect()
        return len(met) == len({x["task"] for x in met}) == 12

    backward = chunks.with_rows_before(chunked, 2, {"before": lambda w: F.lag("value", 2).over(w)})
    assert apart(backward)
    assert apart(chunks.with_totals_before(chunked, kinds))
    assert apart(chunks.with_totals_before(chunked, kinds, onto=backward))


def test_ranges_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(chunks, "MOST", 100, raising=False)
    monkeypatch.setattr(chunks, "LEAST", 10, raising=False)
    sizes = [x["count"] for x in chunks.split(table(spark, 3000)).groupBy("chunk").count().collect()]
    assert max(sizes) <= 200
    assert [chunks.ranges_of(table(spark, n)) for n in (0, 15, 300, 3000)] == [1, 2, 4, 30]


def test_rows_made_within_their_range(spark):
    """An aggregate of the dealt rows, then totals onto the rows that look back: all as by plain windows."""
    rows = table(spark, 600).unionByName(table(spark, 600, seed=5))
    added = lambda df: df.groupBy("indicator_id", "timestamp").agg(F.sum("value").alias("value"))
    chunked = chunks.split(rows, ranges=20, within=added)
    backward = chunks.with_rows_before(chunked, 3, {"before": lambda w: F.lag("value", 3).over(w)})
    got = chunks.with_totals_before(chunked, {"total": ("sum", "value")}, onto=backward)
    assert got.columns == [*chunked.columns, "before", "total"]
    w = growth.in_time()
    assert same(got, added(rows).withColumns({"before": F.lag("value", 3).over(w), "total": F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))}))


def test_what_chunks_refuse(spark):
    series = table(spark, 5)
    with pytest.raises(ValueError):
        chunks.split(series.withColumn("chunk", F.lit(1)))
    with pytest.raises(ValueError):
        chunks.with_totals_before(chunks.split(series), {"x": ("median", "value")})
