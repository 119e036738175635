"""Series and payloads derived from the order tables, for the registered queries.

Annual series are parts' yearly sales, daily ones events by type and user
group; defects (missing values, duplicates, future periods, rebases) come from
fixed rules on their keys.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The clock of the annual and of the event queries.
NOW = datetime(2000, 6, 30)
EVENTS_NOW = datetime(2024, 1, 25)


def annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(indicator_id, k, y, timestamp, value): each part's sales by year, in whole units."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    sums = lines.groupBy(F.col("l_partkey").alias("k"), F.year("l_shipdate").alias("y")).agg(F.floor(F.sum("l_extendedprice") + 0.001).cast("double").alias("value"))
    return sums.select(F.concat(F.lit("PART."), F.col("k").cast("string")).alias("indicator_id"), "k", "y", F.make_timestamp_ntz("y", F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0)).alias("timestamp"), "value")


ANNUAL = """annual AS (SELECT 'PART.' || CAST(l_partkey AS VARCHAR) AS indicator_id, l_partkey AS k, CAST(year(l_shipdate) AS INTEGER) AS y,
    make_timestamp(year(l_shipdate), 12, 31, 0, 0, 0.0) AS ts, floor(sum(l_extendedprice) + 0.001) AS value FROM lineitem GROUP BY ALL)"""


def rebased(series: DataFrame) -> DataFrame:
    """The series with a third of them on a new base from 1998, a third from 2000."""
    factor = F.when((F.col("k") % 3 == 0) & (F.col("y") >= 1998), 2.0).when((F.col("k") % 3 == 1) & (F.col("y") >= 2000), 3.0).otherwise(1.0)
    return series.withColumn("value", F.round(F.col("value") * factor, 2))


REBASED = """rebased AS (SELECT indicator_id, k, y, ts, round(value * CASE WHEN k % 3 = 0 AND y >= 1998 THEN 2.0 WHEN k % 3 = 1 AND y >= 2000 THEN 3.0 ELSE 1.0 END, 2) AS value FROM annual)"""


def _years(k: Column) -> Column:
    return F.when(k % 3 == 0, F.array(F.lit(1995), F.lit(1998))).when(k % 3 == 1, F.array(F.lit(1996), F.lit(1998), F.lit(2000))).otherwise(F.array().cast("array<int>"))


def catalog(series: DataFrame) -> DataFrame:
    """Catalog rows of the annual series."""
    ids = series.select("indicator_id", "k").distinct()
    return ids.select(
        "indicator_id",
        F.concat(F.lit("Part "), F.col("k").cast("string")).alias("name"),
        F.when(F.col("k") % 4 != 0, "USD").alias("unit"),
        F.when(F.col("k") % 5 != 0, F.concat(F.lit("domain"), (F.col("k") % 3).cast("string"))).alias("domain"),
        _years(F.col("k")).alias("base_years"),
        F.lit(None).cast("timestamp_ntz").alias("availability_start"),
        F.lit(None).cast("timestamp_ntz").alias("availability_end"),
    )


def raw(series: DataFrame) -> DataFrame:
    """Raw rows: a missing value in one of 17, later duplicates, rows of another series, and rows without a code."""
    value = F.when((F.col("k") + F.col("y")) % 17 != 0, F.col("value"))
    code = F.when(F.col("k") % 7 != 0, F.col("indicator_id"))
    copies = F.array_compact(F.array(F.lit(0), F.when((F.col("k") % 11 == 0) & (F.col("y") == 1997), 1), F.when((F.col("k") % 13 == 0) & (F.col("y") == 1996), 2)))
    # The copies come out of one reading of the series.
    each = series.select("indicator_id", "k", "y", code.alias("code"), value.alias("value"), F.explode(copies).alias("copy"))
    return each.withColumns({"code": F.when(F.col("copy") == 2, "OTHER").otherwise(F.col("code")), "value": F.when(F.col("copy") == 1, F.col("value") + 1).otherwise(F.col("value"))})


RAW = """raw0 AS (SELECT indicator_id, k, y, ts, CASE WHEN k % 7 <> 0 THEN indicator_id END AS code, CASE WHEN (k + y) % 17 <> 0 THEN value END AS value, 0 AS copy FROM annual),
raw AS (SELECT * FROM raw0 UNION ALL SELECT indicator_id, k, y, ts, code, value + 1, 1 FROM raw0 WHERE k % 11 = 0 AND y = 1997
    UNION ALL SELECT indicator_id, k, y, ts, 'OTHER', value, 2 FROM raw0 WHERE k % 13 = 0 AND y = 1996),
own AS (SELECT * FROM raw WHERE code IS NULL OR code = indicator_id),
silver0 AS (SELECT * FROM own WHERE value IS NOT NULL AND ts <= TIMESTAMP '2000-06-30' QUALIFY row_number() OVER (PARTITION BY indicator_id, ts ORDER BY copy DESC) = 1),
fences AS (SELECT indicator_id, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM silver0 GROUP BY 1),
silver AS (SELECT s.*, value < q1 - 1.5 * (q3 - q1) - 1e-6 OR value > q3 + 1.5 * (q3 - q1) + 1e-6 AS is_outlier FROM silver0 s JOIN fences USING (indicator_id))"""


def payloads(series: DataFrame) -> DataFrame:
    """(indicator_id, page, payload): raw rows as JSON, newest first, from 1998 on page one and the rest on page two; some series are error payloads."""
    page = F.when(F.col("y") >= 1998, 1).otherwise(2)
    row = F.struct(
        F.struct(F.col("code").alias("id"), F.concat(F.lit("Sales of "), F.col("indicator_id"), F.lit(" (USD)")).alias("value")).alias("indicator"),
        F.col("y").cast("string").alias("date"),
        F.col("value").alias("value"),
        F.lit("").alias("unit"),
        F.when(F.col("copy") == 1, "R").otherwise("").alias("obs_status"),
    )
    # Rows become text before they meet, and meet in one shuffle of rows, not of lists.
    texts = raw(series).select("indicator_id", "k", page.alias("page"), (-F.col("y")).alias("o"), F.col("copy").alias("c"), F.to_json(row).alias("row")).repartition("k")
    pages = texts.groupBy("indicator_id", "k", "page").agg(F.sort_array(F.collect_list(F.struct("o", "c", "row"))).alias("rows"))
    meta = F.to_json(F.struct(F.col("page"), F.lit(2).alias("pages"), F.concat(F.lit("2000-01-"), F.lpad((F.col("k") % 28 + 1).cast("string"), 2, "0")).alias("lastupdated")))
    body = F.concat(F.lit("["), meta, F.lit(",["), F.array_join(F.col("rows.row"), ","), F.lit("]]"))
    error = F.lit('[{"message":[{"id":"120","key":"Invalid value","value":"The parameter is not valid"}]}]')
    return pages.select("indicator_id", "page", F.when(F.col("k") % 29 == 0, error).when(F.col("k") % 31 == 0, "42").otherwise(body).alias("payload"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(indicator_id, event_id, timestamp, value): events by type and user group; one value in 17 is null, one in 19 not a number.  A small part by id keeps values off the fences."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    value = F.when(F.col("event_id") % 17 == 0, F.lit(None)).when(F.col("event_id") % 19 == 0, F.lit(float("nan"))).otherwise(F.col("value") + (F.col("event_id") % 97) / F.lit(10000.0))
    return e.select(F.concat("event_type", F.lit("."), (F.col("user_id") % 20).cast("string")).alias("indicator_id"), "event_id", F.col("ts").alias("timestamp"), value.alias("value"))


EVENTS = """ev AS (SELECT event_type || '.' || CAST(user_id % 20 AS VARCHAR) AS indicator_id, event_id, ts, CASE WHEN event_id % 17 = 0 OR event_id % 19 = 0 THEN NULL ELSE value + (event_id % 97) / 10000.0::DOUBLE END AS value FROM events),
evq AS (SELECT indicator_id, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM ev GROUP BY 1),
evo AS (SELECT ev.*, coalesce(value < q1 - 1.5 * (q3 - q1) - 1e-9 OR value > q3 + 1.5 * (q3 - q1) + 1e-9, FALSE) AS is_outlier FROM ev JOIN evq USING (indicator_id))"""
