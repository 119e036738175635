"""As-of joins, exact quantiles, calendar periods and reading of series sets."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from seriesloom.operators import linking, quality, resampling
from seriesloom.operators.asof import asof_join
from seriesloom.sinks import tables, versioned
from seriesloom.sources import scan

START = datetime(2020, 1, 1)


def day(k):
    return START + timedelta(days=k)


@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_asof_join(spark, direction, exact):
    r = random.Random(1)
    left = [(r.choice(["A", "B", None]), r.choice([None, *range(12)]), k) for k in range(60)]
    right = [(r.choice(["A", "B", "C", None]), r.choice([None, *range(12)]), float(k)) for k in range(25)]
    frames = [spark.createDataFrame(rows, f"indicator_id string, t int, {last}") for rows, last in ((left, "n int"), (right, "v double"))]
    got = {x["n"]: x["matched"] and (x["matched"]["t"], x["matched"]["v"]) for x in asof_join(*frames, on="t", direction=direction, exact=exact).collect()}
    assert len(got) == len(left)
    for key, at, n in left:
        near = []
        if key is not None and at is not None:
            near = [(t, v) for k, t, v in right if k == key and t is not None and (t < at or exact and t == at if direction == "backward" else t > at or exact and t == at)]
        assert got[n] == ((max(near) if direction == "backward" else min(near)) if near else None)
    with pytest.raises(ValueError):
        asof_join(*frames, on="t", direction="nearest")
    with pytest.raises(ValueError):
        asof_join(frames[0].withColumn("matched", F.lit(1)), frames[1], on="t")
    assert asof_join(frames[0].limit(0), frames[1], on="t").count() == 0


def test_a_base_year_begins_with_its_first_day(spark):
    rows = [("A", datetime(1999, 12, 31), 1.0), ("A", datetime(2000, 1, 1), 2.0), ("A", datetime(2005, 6, 1), 6.0), ("B", datetime(2001, 1, 1), 5.0)]
    series = spark.createDataFrame(rows, "indicator_id string, timestamp timestamp_ntz, value double")
    years = spark.createDataFrame([("A", [1990, 2000, 2002, 2004, 2010]), ("B", [1990, 2000])], "indicator_id string, base_years array<int>")
    got = {(x["timestamp"], x["base_year_from"], x["base_year_to"], x["level_ratio"]) for x in linking.breaks_from_base_years(series, years).collect()}
    # Two base years on one observation are one break; a break at a series' first observation is none.
    assert got == {(datetime(2000, 1, 1), 1990, 2000, 2.0), (datetime(2005, 6, 1), 2000, 2004, 3.0)}


@pytest.mark.parametrize("rows", [1, 2, 7, 5000])
def test_exact_quantiles(spark, rows):
    r = random.Random(rows)
    values = [r.choice([r.gauss(0, 1), 1.0, math.inf, -math.inf, None, math.nan]) if r.random() < 0.2 else r.gauss(0, 5) for _ in range(rows)]
    given = spark.createDataFrame([("A", v) for v in values] + [("B", None)], "indicator_id string, value double")
    names = {"least": 0.0, "low": 0.03, "near": 0.033, "middle": 0.5, "high": 0.97, "most": 1.0}
    got = quality.exact_quantiles(given, names).collect()
    known = sorted(v for v in values if v is not None and not math.isnan(v))
    assert len(got) == bool(known)
    for name, p in names.items() if known else ():
        place = (len(known) - 1) * p
        lo, hi = known[math.floor(place)], known[math.ceil(place)]
        want = lo if lo == hi else (math.ceil(place) - place) * lo + (place - math.floor(place)) * hi
        assert got[0][name] == want or math.isnan(want) and math.isnan(got[0][name])
    with pytest.raises(ValueError):
        quality.exact_quantiles(given, {"x": 1.5})


def test_calendar_frames_see_gaps(spark):
    rows = [("A", day(k), v) for k, v in ((0, 1.0), (1, 2.0), (2, None), (3, 4.0), (40, 5.0), (41, 0.0), (42, 1.0))] + [("B", day(1), 9.0)]
    series = spark.createDataFrame(rows, "indicator_id string, timestamp timestamp_ntz, value double")
    got = {(x["indicator_id"], (x["timestamp"] - START).days): (x["moving_average"], x["observations"]) for x in resampling.calendar_average(series, 30).collect()}
    assert got == {("A", 0): (1.0, 1), ("A", 1): (1.5, 2), ("A", 3): (7 / 3, 3), ("A", 40): (5.0, 1), ("A", 41): (2.5, 2), ("A", 42): (2.0, 3), ("B", 1): (9.0, 1)}
    returns = {(x["timestamp"] - START).days: x["change"] for x in resampling.daily_returns(series.filter("indicator_id = 'A'")).collect()}
    assert returns == {0: None, 1: 100.0, 3: None, 40: None, 41: -100.0, 42: None}


def test_changes_against_calendar_periods(spark):
    months = [(2019, 1, 10.0), (2019, 12, 20.0), (2020, 1, 30.0), (2020, 3, 60.0), (2020, 4, 45.0), (2021, 1, 15.0)]
    rows = [("A", datetime(y, m, 28), v) for y, m, v in months] + [("A", datetime(2020, 1, 5), 999.0)]
    series = spark.createDataFrame(rows, "indicator_id string, timestamp timestamp_ntz, value double")

    def told(frequency, view):
        return {(x["timestamp"].year, x["timestamp"].month): x["change"] and round(x["change"], 6) for x in resampling.period_change(series, frequency, view).collect()}

    assert told("monthly", "mom") == {(2019, 1): None, (2019, 12): None, (2020, 1): 50.0, (2020, 3): None, (2020, 4): -25.0, (2021, 1): None}
    assert told("monthly", "qoq") == {(2019, 1): None, (2019, 12): None, (2020, 1): None, (2020, 3): 200.0, (2020, 4): 50.0, (2021, 1): None}
    assert told("monthly", "yoy")[2020, 1] == 200.0 and told("monthly", "yoy")[2021, 1] == -50.0
    assert told("quarterly", "qoq") == {(2019, 1): None, (2019, 12): None, (2020, 3): 200.0, (2020, 4): -25.0, (2021, 1): None}
    assert told("annual", "yoy") == {(2019, 12): None, (2020, 4): 125.0, (2021, 1): round(100 * (15 / 45 - 1), 6)}
    with pytest.raises(ValueError):
        resampling.period_change(series, "weekly", "yoy") if "weekly" in resampling.VIEWS else resampling._period_number("weekly")


def test_a_set_of_series_is_read_from_its_buckets(spark, tmp_path):
    rows = spark.range(200).select(F.concat(F.lit("S"), (F.col("id") % 40).cast("string")).alias("indicator_id"), F.timestamp_seconds(F.col("id") * 86400).cast("timestamp_ntz").alias("timestamp"), F.col("id").cast("double").alias("value"))
    rows = rows.withColumn("series_bucket", tables.bucket())
    path = str(tmp_path / "t")
    versioned.commit(rows, path, rows)
    wanted = spark.createDataFrame([("S3",), ("S5",), ("none",), (None,)], "indicator_id string")
    chosen = scan.series_set(versioned.read(spark, path), wanted, datetime(1970, 1, 10), datetime(1970, 4, 30))
    first, last = (x - datetime(1970, 1, 1) for x in (datetime(1970, 1, 10), datetime(1970, 4, 30)))
    assert sorted(x["value"] for x in chosen.collect()) == [v for v in map(float, range(200)) if v % 40 in (3, 5) and first.days <= v <= last.days]
    plan = chosen._jdf.queryExecution().toString()
    assert "PartitionFilters: [series_bucket" in plan and "GreaterThanOrEqual(timestamp" in plan
    for _ in range(2):
        scan.export_csv(chosen, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.columns == ["indicator_id", "timestamp", "value"] and back.count() == chosen.count()
    assert back.filter("timestamp = '1970-02-13 00:00:00'").first()["indicator_id"] == "S3"
