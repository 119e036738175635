"""What several results share is worked out once."""

from datetime import datetime

from pyspark.sql import functions as F

from seriesloom.plans import inputs
from seriesloom.sources import payload


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_payload_is_parsed_once(spark):
    df = spark.createDataFrame([("A", 1, '[{"pages":1},[{"date":"1999"}]]'), ("B", 1, "[]"), ("C", 1, "{}"), ("D", 1, "42"), ("E", 1, None)], "indicator_id string, page int, payload string").repartition(2)
    parts = payload.split_envelopes(df)
    assert plan(parts.good).count("parseJson") == 1 and plan(parts.violations).count("parseJson") == 1
    assert {r["indicator_id"]: r["n"] for r in parts.good.select("indicator_id", F.size("rows").alias("n")).collect()} == {"A": 1, "B": 0, "C": 0}
    assert {r["indicator_id"] for r in parts.violations.collect()} == {"D", "E"}
    assert plan(payload.within_pages(parts.good)[0]).count("parseJson") == 1


def test_raw_rows_come_from_one_reading(spark):
    rows = spark.createDataFrame([("PART.143", 143, y, datetime(y, 12, 31), 10.0) for y in (1996, 1997)], "indicator_id string, k long, y int, timestamp timestamp_ntz, value double")
    series = rows.repartition(2)
    got = inputs.raw(series)
    assert plan(got).count("LogicalRDD") == 1
    assert sorted((r["y"], r["code"], r["value"], r["copy"]) for r in got.collect()) == [(1996, "OTHER", 10.0, 2), (1996, "PART.143", 10.0, 0), (1997, "PART.143", 10.0, 0), (1997, "PART.143", 11.0, 1)]
