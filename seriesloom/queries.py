"""Registered queries over the provided tables, each with the same result as SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.functions.expr import stable_id
from seriesloom.operators import asof, chunks, growth, linking, publish, quality, resampling
from seriesloom.operators.cleaning import clean
from seriesloom.plans import inputs, journal, medallion, reports
from seriesloom.plans.inputs import ANNUAL, EVENTS, EVENTS_NOW, NOW, RAW, REBASED
from seriesloom.shared import scratch, written
from seriesloom.sinks import dimension, tables, versioned
from seriesloom.sources import payload, scan
from seriesloom.sources.payload import split_envelopes, within_pages
from seriesloom.streaming import pages
from seriesloom.streaming.ingest import SCHEMA

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def registered(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__], _SQL[f.__name__] = f, sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _r(name: str, digits: int = 4) -> object:
    return F.round(name, digits).alias(name)


# --- growth and quality ----------------------------------------------------------


@registered(f"""WITH {ANNUAL}, g AS (SELECT indicator_id, ts, lag(ts) OVER w AS previous_timestamp, value, 100 * (value / nullif(lag(value) OVER w, 0) - 1) AS growth FROM annual WINDOW w AS (PARTITION BY indicator_id ORDER BY ts))
SELECT indicator_id, ts AS "timestamp", previous_timestamp, value, round(growth, 4) AS growth FROM g WHERE growth IS NOT NULL""")
def yoy_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return growth.growth_rates(inputs.annual(spark, sf_dir)).withColumn("growth", F.round("growth", 4))


@registered(f"WITH {EVENTS} SELECT indicator_id, round(100.0 * count(*) FILTER (value IS NULL) / count(*), 6) AS null_percentage FROM ev GROUP BY 1")
def null_percentage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_percentage(inputs.events(spark, sf_dir)).withColumn("null_percentage", F.round("null_percentage", 6))


@registered(f"WITH {EVENTS} SELECT indicator_id, event_id, value FROM evo WHERE is_outlier")
def iqr_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.flag_outliers(inputs.events(spark, sf_dir)).filter("is_outlier").select("indicator_id", "event_id", "value")


@registered(f"""WITH {EVENTS}, m AS (SELECT indicator_id, 100.0 * count(*) FILTER (value IS NULL) / count(*) AS np, count(*) FILTER (is_outlier) AS oc, count(*) AS n, count(*) FILTER (ts > TIMESTAMP '2024-01-25') AS nf FROM evo GROUP BY 1)
SELECT indicator_id, nf = 0 AS is_valid, CASE WHEN nf > 0 THEN 'dates in the future' ELSE '' END AS errors,
    concat_ws('; ', CASE WHEN np > 5 THEN printf('High null percentage: %.2f%% (threshold: 5.0%%)', round(np, 2)) END, CASE WHEN oc > 0 THEN printf('Found %d outliers (%.2f%% of data)', oc, round(oc / n * 100, 2)) END) AS warnings,
    round(np, 6) AS null_percentage, oc AS outlier_count, n AS record_count FROM m""")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_report(inputs.events(spark, sf_dir), EVENTS_NOW)
    return out.withColumns({"errors": F.array_join("errors", "; "), "warnings": F.array_join("warnings", "; "), "null_percentage": F.round("null_percentage", 6)})


@registered(f"""WITH {EVENTS} SELECT indicator_id, bool_or(ts > TIMESTAMP '2024-01-25') AS future, bool_or(ts < TIMESTAMP '2024-01-02') AS too_early, bool_or(ts > TIMESTAMP '2024-01-29') AS too_late, CAST(0 AS BIGINT) AS unparsable FROM ev GROUP BY 1""")
def date_range_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.date_problems(inputs.events(spark, sf_dir), EVENTS_NOW, datetime(2024, 1, 2), datetime(2024, 1, 29))


@registered(f"WITH {EVENTS} SELECT indicator_id, date_trunc('day', ts)::TIMESTAMP AS \"timestamp\", max(event_id) AS event_id FROM ev GROUP BY 1, 2")
def dedupe_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = inputs.events(spark, sf_dir).withColumn("timestamp", F.date_trunc("day", "timestamp").cast("timestamp_ntz"))
    return quality.keep_last(daily, "event_id").select("indicator_id", "timestamp", "event_id")


# --- payloads and cleaning --------------------------------------------------------

_GOOD = "k % 29 <> 0 AND k % 31 <> 0"


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.payloads(inputs.annual(spark, sf_dir))


def _landing(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Payloads and a catalog without base years, out of one reading of the lines: a run takes each several times."""
    series = written(inputs.annual(spark, sf_dir))
    return inputs.payloads(series), written(inputs.catalog(series).withColumn("base_years", F.array().cast("array<int>")))


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all payloads, stored once as in a run: cleaning reads them several times."""
    return written(payload.raw_rows(payload.split_envelopes(_payloads(spark, sf_dir)).good).drop("is_object"))


@registered(f"""WITH {ANNUAL}, {RAW} SELECT indicator_id, page, count(*) AS n_rows, 2 AS pages, min('2000-01-' || lpad(CAST(k % 28 + 1 AS VARCHAR), 2, '0')) AS lastupdated
FROM (SELECT *, CASE WHEN y >= 1998 THEN 1 ELSE 2 END AS page FROM raw WHERE {_GOOD}) GROUP BY 1, 2""")
def envelope_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = payload.split_envelopes(_payloads(spark, sf_dir)).good
    return good.select("indicator_id", "page", F.size("rows").cast("long").alias("n_rows"), F.try_variant_get("meta", "$.pages", "int").alias("pages"), F.try_variant_get("meta", "$.lastupdated", "string").alias("lastupdated"))


@registered(f"""WITH {ANNUAL}, {RAW}, b AS (SELECT DISTINCT indicator_id, k, CASE WHEN y >= 1998 THEN 1 ELSE 2 END AS page FROM raw)
SELECT indicator_id, CASE WHEN k % 29 = 0 THEN 'api' ELSE 'parse' END AS error_type, CASE WHEN k % 29 = 0 THEN 'Invalid value: The parameter is not valid' ELSE 'payload is neither a list nor an object' END AS message FROM b WHERE k % 29 = 0 OR k % 31 = 0""")
def envelope_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload.split_envelopes(_payloads(spark, sf_dir)).violations


@registered(f"""WITH {ANNUAL}, {RAW}, p AS (SELECT indicator_id, count(*) AS n_rows, min(CASE WHEN y >= 1998 THEN 1 ELSE 2 END) AS first_page FROM raw WHERE {_GOOD} GROUP BY 1) SELECT * FROM p""")
def paged_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = payload.concatenated(payload.split_envelopes(_payloads(spark, sf_dir)).good)
    return whole.select("indicator_id", F.size("rows").cast("long").alias("n_rows"), F.try_variant_get("meta", "$.page", "int").alias("first_page"))


@registered(f"""WITH {ANNUAL}, {RAW}, p AS (SELECT indicator_id, count(*) AS n_rows, count(DISTINCT y >= 1998) AS pages FROM raw WHERE {_GOOD} GROUP BY 1) SELECT indicator_id, n_rows FROM p WHERE pages = 2""")
def streamed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series whose pages came in three micro-batches, second pages of half the series first, put together in the stream's state."""
    root, landed = scratch(spark), written(_payloads(spark, sf_dir))
    odd = F.regexp_extract("indicator_id", r"(\d+)$", 1).cast("int") % 2 == 1

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/batch={number}")

    # A batch takes all files that landed since the one before it, however many tasks wrote them; the state goes on from the checkpoint.
    for part in (odd & (F.col("page") == 2), (F.col("page") == 1) & ~odd, odd == (F.col("page") == 1)):
        landed.filter(part).write.mode("append").parquet(f"{root}/landed")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/landed")
        pages.started(pages.assembled(stream).writeStream.foreachBatch(keep).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True), spark).awaitTermination()
    ready = spark.read.parquet(f"{root}/out").filter(F.col("status") == pages.COMPLETE).drop("status", "batch")
    whole = payload.concatenated(payload.split_envelopes(ready).good)
    # An error payload has no second page, so it is complete by itself.
    return whole.select("indicator_id", F.size("rows").cast("long").alias("n_rows"))


@registered(f"""WITH {ANNUAL}, {RAW} SELECT indicator_id, code, CAST(y AS VARCHAR) AS date, round(value, 2) AS value, CASE WHEN copy = 1 THEN 'R' ELSE '' END AS obs_status FROM raw WHERE {_GOOD} AND y BETWEEN 1996 AND 1999""")
def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = payload.raw_rows(payload.split_envelopes(_payloads(spark, sf_dir)).good, 1996, 1999)
    return rows.select("indicator_id", "code", "date", F.round(F.col("value").cast("double"), 2).alias("value"), "obs_status")


@registered(f"WITH {ANNUAL}, {RAW} SELECT DISTINCT '2000-01-' || lpad(CAST(k % 28 + 1 AS VARCHAR), 2, '0') AS lastupdated FROM raw WHERE {_GOOD}")
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = payload.split_envelopes(_payloads(spark, sf_dir)).good
    return good.select(F.try_variant_get("meta", "$.lastupdated", "string").alias("lastupdated")).distinct()


@registered("""SELECT 'BRAND.' || p_brand AS indicator_id, 'Brand ' || p_brand AS name, CASE WHEN min(p_size) > 1 THEN 'USD' END AS unit, 'annual' AS frequency, CASE WHEN p_brand = 'Brand#11' THEN 'trade' ELSE 'unclassified' END AS domain, min(p_type) AS source_name FROM part GROUP BY p_brand""")
def catalog_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = spark.read.parquet(f"{sf_dir}/part.parquet").groupBy("p_brand").agg(F.min("p_size").alias("least"), F.min("p_type").alias("type"))
    row = F.struct(F.concat(F.lit("BRAND."), "p_brand").alias("id"), F.concat(F.lit("Brand "), "p_brand").alias("name"), F.when(F.col("least") > 1, "USD").otherwise("").alias("unit"), F.struct(F.col("type").alias("value")).alias("source"))
    landed = brands.select(F.col("p_brand").alias("indicator_id"), F.lit(1).alias("page"), F.concat(F.lit('[{"page":1},['), F.to_json(row), F.lit("]]")).alias("payload"))
    return payload.catalog_rows(landed, {"BRAND.Brand#11": "trade"}).select("indicator_id", "name", "unit", "frequency", "domain", "source_name")


@registered(f"""WITH {ANNUAL}, {RAW} SELECT indicator_id, ts AS "timestamp", round(value, 2) AS value, 'USD' AS unit, CASE WHEN copy = 1 THEN 'R' END AS obs_status, is_outlier, CASE WHEN is_outlier THEN 'flagged' ELSE 'valid' END AS validation_status FROM silver WHERE {_GOOD}""")
def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = clean(_rows(spark, sf_dir), NOW).silver
    return silver.select("indicator_id", "timestamp", _r("value", 2), "unit", "obs_status", "is_outlier", "validation_status")


@registered(f"""WITH {ANNUAL}, {RAW}, a AS (SELECT indicator_id, count(*) AS p, count(*) FILTER (ts > TIMESTAMP '2000-06-30') AS f, count(*) FILTER (ts <= TIMESTAMP '2000-06-30' AND value IS NULL) AS nl, count(*) FILTER (ts <= TIMESTAMP '2000-06-30') AS past FROM own WHERE {_GOOD} GROUP BY 1),
w AS (SELECT indicator_id, count(*) AS w, count(*) FILTER (is_outlier) AS o FROM silver GROUP BY 1)
SELECT indicator_id, p AS records_processed, f AS future_records, nl AS null_records, p - f - nl - coalesce(w, 0) AS duplicate_records, p - coalesce(w, 0) AS records_failed, coalesce(w, 0) AS records_written, coalesce(o, 0) AS outlier_count,
    CASE WHEN p = coalesce(w, 0) THEN 'success' WHEN coalesce(w, 0) > 0 THEN 'partial' ELSE 'failed' END AS status, CASE WHEN past = 0 THEN 0.0 ELSE round(100.0 * nl / past, 4) END AS null_percentage FROM a LEFT JOIN w USING (indicator_id)""")
def cleaning_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(_rows(spark, sf_dir), NOW).counters


@registered(f"WITH {ANNUAL}, {RAW} SELECT indicator_id, count(*) AS silver_rows FROM silver WHERE {_GOOD} GROUP BY 1")
def bronze_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.to_silver(_payloads(spark, sf_dir), NOW).rows.groupBy("indicator_id").agg(F.count(F.lit(1)).alias("silver_rows"))


# --- breaks and links -------------------------------------------------------------

_YEARS = """pairs AS (SELECT * FROM (VALUES (0, 1995, 1998), (1, 1996, 1998), (1, 1998, 2000)) v(m, base_from, base_to)),
seq AS (SELECT *, lag(value) OVER w AS before, lag(ts) OVER w AS earlier, row_number() OVER w AS n FROM rebased WINDOW w AS (PARTITION BY indicator_id ORDER BY ts)),
firsts AS (SELECT s.indicator_id, base_from, base_to, min_by(s.ts, s.ts) AS ts, min_by(s.n, s.ts) AS n, min_by(CASE WHEN before > 0 AND s.value > 0 THEN s.value / before END, s.ts) AS ratio FROM seq s JOIN pairs ON s.k % 3 = m AND y >= base_to GROUP BY 1, 2, 3),
brk AS (SELECT indicator_id, ts, min(base_from) AS base_year_from, max(base_to) AS base_year_to, min(ratio) AS level_ratio FROM firsts WHERE n > 1 GROUP BY 1, 2),
fac AS (SELECT r.indicator_id, r.k, r.y, r.ts, r.value AS original_value, coalesce((SELECT exp(sum(ln(level_ratio))) FROM brk b WHERE b.indicator_id = r.indicator_id AND b.ts > r.ts), 1.0) AS factor FROM rebased r)"""


def _series(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    series = inputs.annual(spark, sf_dir)
    return inputs.rebased(series).select("indicator_id", "timestamp", "value"), inputs.catalog(series)


@registered(f"""WITH {ANNUAL}, {REBASED}, {_YEARS} SELECT indicator_id, ts AS "timestamp", base_year_from, base_year_to, 'metadata' AS detected_by, round(level_ratio, 6) AS level_ratio FROM brk""")
def base_year_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    series, catalog = _series(spark, sf_dir)
    return linking.detect_breaks(series, catalog).withColumn("level_ratio", F.round("level_ratio", 6))


@registered(f"""WITH {ANNUAL}, {REBASED}, {_YEARS}, m AS (SELECT *, CASE WHEN before = 0 THEN CASE WHEN value <> 0 THEN 1e300 END ELSE abs(value / before - 1) END AS size FROM seq),
t AS (SELECT indicator_id, median(size) AS typical FROM m GROUP BY 1 HAVING count(*) >= 4)
SELECT indicator_id, ts AS "timestamp", CAST(year(earlier) AS INTEGER) AS base_year_from, CAST(year(ts) AS INTEGER) AS base_year_to, round(value / before, 6) AS level_ratio FROM m JOIN t USING (indicator_id) WHERE size >= 0.2 AND size >= 4 * typical""")
def level_shift_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    series, _ = _series(spark, sf_dir)
    return linking.breaks_from_level_shifts(series).drop("detected_by").withColumn("level_ratio", F.round("level_ratio", 6))


@registered(f"""WITH {ANNUAL}, {REBASED}, {_YEARS} SELECT indicator_id, ts AS "timestamp", round(original_value * factor, 2) AS value, original_value, round(factor, 6) AS scale_factor, abs(factor - 1) > 1e-12 AS is_linked FROM fac""")
def level_shift_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    series, catalog = _series(spark, sf_dir)
    out = linking.link_at_breaks(series, linking.detect_breaks(series, catalog)).frame
    return out.select("indicator_id", "timestamp", _r("value", 2), "original_value", _r("scale_factor", 6), "is_linked")


@registered(f"""WITH {ANNUAL}, {REBASED}, {_YEARS}, b AS (SELECT indicator_id, min_by(base_year_from, ts) AS base_year_from, max_by(base_year_to, ts) AS base_year_to FROM brk GROUP BY 1), n AS (SELECT indicator_id, count(*) FILTER (abs(factor - 1) > 1e-12) AS c FROM fac GROUP BY 1)
SELECT indicator_id, b.base_year_to IS NOT NULL AS is_chain_linked, CASE WHEN b.base_year_to IS NOT NULL THEN 'level_shift' END AS linking_method, c AS records_linked, CASE WHEN b.base_year_to IS NOT NULL THEN 0.2 END AS avg_confidence_score, base_year_from, base_year_to FROM n LEFT JOIN b USING (indicator_id)""")
def link_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    series, catalog = _series(spark, sf_dir)
    return linking.chain_link(series, catalog).summary.select("indicator_id", "is_chain_linked", "linking_method", "records_linked", "avg_confidence_score", "base_year_from", "base_year_to")


@registered(f"""WITH {ANNUAL}, {REBASED}, {_YEARS}, d AS (SELECT indicator_id, abs((value / lag(value) OVER w) - (value / lag(value) OVER w)) AS x FROM rebased WINDOW w AS (PARTITION BY indicator_id ORDER BY ts)),
g AS (SELECT r.indicator_id, round(max(abs(r.g1 - r.g0)) , 6) AS worst FROM (SELECT indicator_id, rebased.value / lag(rebased.value) OVER w AS g1, annual.value / lag(annual.value) OVER w AS g0 FROM rebased JOIN annual USING (indicator_id, ts) WINDOW w AS (PARTITION BY indicator_id ORDER BY ts)) r GROUP BY 1)
SELECT indicator_id, worst FROM g WHERE worst > 0.01""")
def growth_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the guard finds where series were put on a new base without being linked."""
    series = inputs.annual(spark, sf_dir)
    frame = inputs.rebased(series).select("indicator_id", "timestamp", "value", F.lit(1.0).alias("scale_factor")).join(series.select("indicator_id", "timestamp", F.col("value").alias("original_value")), ["indicator_id", "timestamp"])
    return linking.growth_violations(frame).select("indicator_id", _r("worst", 6))


_SPLICE = """old AS (SELECT indicator_id, ts, value FROM annual WHERE y <= 1999),
new AS (SELECT indicator_id, ts, round(value * (20 + (k + y) % 3), 2) AS value FROM annual WHERE y >= 1996),
sh AS (SELECT indicator_id, count(*) AS overlap_periods, avg(n.value / o.value) AS scale, var_pop(n.value / o.value) AS v FROM old o JOIN new n USING (indicator_id, ts) GROUP BY 1 HAVING count(*) >= 3),
st AS (SELECT indicator_id, min(ts) AS boundary FROM new GROUP BY 1),
en AS (SELECT indicator_id, max(ts) AS last FROM old GROUP BY 1)"""


def _spliced(spark: SparkSession, sf_dir: str, overlap: int | None = None) -> linking.Linked:
    series = inputs.annual(spark, sf_dir)
    new = series.filter("y >= 1996").withColumn("value", F.round(F.col("value") * (20 + (F.col("k") + F.col("y")) % 3), 2))
    columns = ["indicator_id", "timestamp", "value"]
    return linking.splice(series.filter("y <= 1999").select(*columns), new.select(*columns), overlap=overlap)


@registered(f"""WITH {ANNUAL}, {_SPLICE} SELECT indicator_id, ts AS "timestamp", round(value * scale, 2) AS value, value AS original_value, round(scale, 6) AS scale_factor, TRUE AS is_linked FROM old JOIN sh USING (indicator_id) JOIN st USING (indicator_id) WHERE ts < boundary
UNION ALL SELECT indicator_id, ts, value, value, 1.0, FALSE FROM new JOIN sh USING (indicator_id)""")
def overlap_splice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spliced(spark, sf_dir).frame.select("indicator_id", "timestamp", _r("value", 2), "original_value", _r("scale_factor", 6), "is_linked")


@registered(f"""WITH {ANNUAL}, {_SPLICE} SELECT indicator_id, round(scale, 6) AS scale, overlap_periods, round(v / (scale * scale), 12) AS ratio_variance, round((0.2 + 0.8 * least(overlap_periods * 12 / 36.0, 1.0)) / (1 + 50 * v / (scale * scale)), 3) AS confidence,
    CAST(year(last) AS INTEGER) AS base_year_from, CAST(year(boundary) AS INTEGER) AS base_year_to FROM sh JOIN st USING (indicator_id) JOIN en USING (indicator_id)""")
def splice_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spliced(spark, sf_dir).summary.select("indicator_id", _r("scale", 6), "overlap_periods", _r("ratio_variance", 12), _r("confidence", 3), "base_year_from", "base_year_to")


@registered(f"""WITH {ANNUAL}, o AS (SELECT DISTINCT indicator_id FROM annual WHERE y <= 1999), n AS (SELECT DISTINCT indicator_id FROM annual WHERE y >= 1996), s AS (SELECT indicator_id, count(*) AS c FROM annual WHERE y BETWEEN 1996 AND 1999 GROUP BY 1)
SELECT indicator_id, 'chain_linking' AS error_type, printf('insufficient overlap to chain-link: %d shared period(s)', coalesce(c, 0)) AS message FROM o JOIN n USING (indicator_id) LEFT JOIN s USING (indicator_id) WHERE coalesce(c, 0) < 3""")
def splice_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spliced(spark, sf_dir).violations


_FOLD = """s0 AS (SELECT indicator_id, ts, value FROM annual WHERE y <= 1997), s1 AS (SELECT indicator_id, ts, value * 2 AS value FROM annual WHERE y BETWEEN 1995 AND 2000), s2 AS (SELECT indicator_id, ts, value * 6 AS value FROM annual WHERE y >= 1998),
segs AS (SELECT indicator_id FROM s0 INTERSECT SELECT indicator_id FROM s1 INTERSECT SELECT indicator_id FROM s2),
a1 AS (SELECT indicator_id, count(*) AS n, avg(s2.value / s1.value) AS scale FROM s1 JOIN s2 USING (indicator_id, ts) WHERE indicator_id IN (SELECT * FROM segs) GROUP BY 1 HAVING count(*) >= 3),
c1 AS (SELECT s1.indicator_id, s1.ts, s1.value * scale AS value, s1.value AS original_value, TRUE AS is_linked FROM s1 JOIN a1 USING (indicator_id) WHERE s1.ts < (SELECT min(ts) FROM s2 WHERE s2.indicator_id = s1.indicator_id)
    UNION ALL SELECT s2.indicator_id, ts, value, value, FALSE FROM s2 JOIN a1 USING (indicator_id)),
a0 AS (SELECT indicator_id, count(*) AS n, avg(c1.value / s0.value) AS scale FROM s0 JOIN c1 USING (indicator_id, ts) GROUP BY 1 HAVING count(*) >= 3),
c0 AS (SELECT s0.indicator_id, s0.ts, s0.value * scale AS value, s0.value AS original_value, TRUE AS is_linked FROM s0 JOIN a0 USING (indicator_id) WHERE s0.ts < (SELECT min(ts) FROM c1 WHERE c1.indicator_id = s0.indicator_id)
    UNION ALL SELECT c1.indicator_id, ts, value, original_value, is_linked FROM c1 JOIN a0 USING (indicator_id))"""


def _folded(spark: SparkSession, sf_dir: str) -> linking.Linked:
    series = inputs.annual(spark, sf_dir)
    parts = [("y <= 1997", 1.0), ("y BETWEEN 1995 AND 2000", 2.0), ("y >= 1998", 6.0)]
    rows = [series.filter(years).select("indicator_id", "timestamp", (F.col("value") * by).alias("value"), F.lit(k).alias("segment")) for k, (years, by) in enumerate(parts)]
    whole = rows[0].unionByName(rows[1]).unionByName(rows[2])
    complete = whole.groupBy("indicator_id").agg(F.count_distinct("segment").alias("n")).filter("n = 3")
    return linking.fold_segments(whole.join(complete, "indicator_id", "left_semi"), most=2)


@registered(f"""WITH {ANNUAL}, {_FOLD} SELECT indicator_id, ts AS "timestamp", round(value, 2) AS value, original_value, is_linked FROM c0""")
def multi_segment_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _folded(spark, sf_dir).frame.select("indicator_id", "timestamp", _r("value", 2), "original_value", "is_linked")


@registered(f"""WITH {ANNUAL}, {_FOLD} SELECT indicator_id, TRUE AS is_chain_linked, 'overlap' AS linking_method, (SELECT count(*) FROM c0 WHERE is_linked AND c0.indicator_id = a0.indicator_id) AS records_linked, CAST(12 * (a0.n + a1.n) AS INTEGER) AS overlap_period_months, 1.0 AS avg_confidence_score FROM a0 JOIN a1 USING (indicator_id)""")
def segment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _folded(spark, sf_dir).summary.select("indicator_id", "is_chain_linked", "linking_method", "records_linked", "overlap_period_months", _r("avg_confidence_score", 3))


# --- gold and logs ----------------------------------------------------------------


def _silver(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    series, catalog = _series(spark, sf_dir)
    silver = series.select(stable_id("indicator_id", "timestamp").alias("id"), "indicator_id", "timestamp", "value", F.lit("USD").alias("unit"), F.lit("annual").alias("frequency"))
    return silver, catalog


_DOMAIN = "CASE WHEN k % 5 <> 0 THEN 'domain' || CAST(k % 3 AS VARCHAR) ELSE 'unclassified' END"


@registered(f"""WITH {ANNUAL} SELECT 'before' AS reader, indicator_id, ts AS "timestamp", value FROM annual
UNION ALL SELECT 'after', indicator_id, ts, value FROM annual WHERE k % 2 = 1 UNION ALL SELECT 'after', indicator_id, ts, value + 1 FROM annual WHERE k % 4 = 0""")
def versioned_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table whose even buckets are replaced, every other one of them by no rows; read as it is, and by a reader that began before."""
    path = f"{scratch(spark)}/table"
    series = inputs.annual(spark, sf_dir).withColumn("series_bucket", (F.col("k") % 64).cast("int"))
    rows = series.select("indicator_id", "timestamp", "value", "series_bucket")
    versioned.commit(rows, path, rows)
    before = versioned.read(spark, path)
    changed = series.filter("k % 4 = 0").select("indicator_id", "timestamp", (F.col("value") + 1).alias("value"), "series_bucket")
    versioned.commit(changed, path, series.filter("k % 2 = 0"))
    told = [df.select(F.lit(name).alias("reader"), "indicator_id", "timestamp", "value") for name, df in (("before", before), ("after", versioned.read(spark, path)))]
    return told[0].unionByName(told[1])


_DISCOVERED = [datetime(2000, 1, 1), datetime(2000, 2, 1), datetime(2000, 3, 1)]


@registered(f"""WITH {ANNUAL}, p AS (SELECT indicator_id, k, min(ts) AS first_seen, max(ts) AS last_seen FROM annual GROUP BY 1, 2)
SELECT indicator_id, CASE WHEN k % 2 = 0 THEN 'Part ' || k ELSE 'New part ' || k END AS name, CASE WHEN k % 2 = 0 THEN TIMESTAMP '2000-01-01' ELSE TIMESTAMP '2000-02-01' END AS valid_from,
  CASE WHEN k % 2 = 0 AND k % 3 <> 0 THEN TIMESTAMP '2000-02-01' END AS valid_to, CASE WHEN k % 2 = 0 THEN first_seen END AS availability_start FROM p WHERE k % 2 = 0 OR k % 3 <> 0
UNION ALL SELECT indicator_id, 'New part ' || k, TIMESTAMP '2000-02-01', NULL, first_seen FROM p WHERE k % 2 = 0 AND k % 3 <> 0""")
def catalog_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three discoveries, the last of them like the second: half the parts, with their ranges, then two thirds under new names; current rows and former ones."""
    path = f"{scratch(spark)}/catalog"
    series = inputs.annual(spark, sf_dir)
    catalog, key = inputs.catalog(series), F.regexp_extract("indicator_id", r"(\d+)$", 1).cast("int")
    renamed = catalog.filter(key % 3 != 0).withColumn("name", F.concat(F.lit("New part "), key.cast("string")))
    for at, found in zip(_DISCOVERED, (catalog.filter(key % 2 == 0), renamed, renamed), strict=True):
        known = versioned.read(spark, path)
        history = dimension.revised(known.drop("series_bucket") if known is not None else None, found, at)
        if known is None:
            history = dimension.observed(history, reports.observed_range(series), at)
        rows = written(history.withColumn("series_bucket", tables.bucket()))
        versioned.commit(rows, path, rows, order=("indicator_id", "valid_from"))
    return versioned.read(spark, path).select("indicator_id", "name", "valid_from", "valid_to", "availability_start")


@registered(f"""WITH {ANNUAL}, {RAW}, s AS (SELECT * FROM silver WHERE {_GOOD})
SELECT p.indicator_id, 'Part ' || any_value(p.k) AS name, min(s.ts) AS availability_start, max(s.ts) AS availability_end, count(DISTINCT p.indicator_id) AS n_rows FROM annual p LEFT JOIN s ON s.indicator_id = p.indicator_id GROUP BY p.indicator_id""")
def catalog_after_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored catalog's current rows after two runs: one a series, with the range of all its observations."""
    root, (landed, catalog) = scratch(spark), _landing(spark, sf_dir)
    for page in (2, 1):
        medallion.run(spark, landed.filter(F.col("page") == page), catalog, root, NOW, f"page{page}")
    now = medallion.catalog_now(spark, root)
    return now.groupBy("indicator_id", "name", "availability_start", "availability_end").agg(F.count(F.lit(1)).alias("n_rows"))


@registered(f"""WITH {ANNUAL}, {RAW} SELECT indicator_id, ts AS "timestamp", round(value, 2) AS value FROM silver WHERE {_GOOD} AND y < 1998""")
def run_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver, read back after a run over the older pages, one over the newer pages that broke off once silver was written, and its recovery."""
    root, (landed, catalog) = scratch(spark), _landing(spark, sf_dir)
    medallion.run(spark, landed.filter("page = 2"), catalog, root, NOW, "whole")
    journal.begin(spark, root, "broken", NOW)
    newer = written(medallion.stamped(medallion.to_silver(medallion.landed(landed.filter("page = 1"), "broken", NOW), NOW).rows, NOW))
    at = versioned.version(spark, f"{root}/silver_cleaned")
    medallion.store_silver(versioned.read(spark, f"{root}/silver_cleaned"), newer, root, "broken", at.number)
    for run_id in journal.open_runs(spark, root):
        journal.recover(spark, root, run_id)
    return versioned.read(spark, f"{root}/silver_cleaned").select("indicator_id", "timestamp", F.round("value", 2).alias("value"))


@registered(f"""WITH {ANNUAL}, s AS (SELECT DISTINCT indicator_id, k, CASE WHEN y >= 1998 THEN 1 ELSE 2 END AS page FROM annual WHERE k % 29 <> 0 AND k % 31 <> 0),
three AS (SELECT indicator_id, k, 3 AS page FROM s WHERE page = 1 AND k % 10 = 0 UNION ALL SELECT indicator_id, k, page FROM s)
SELECT indicator_id, page, page <= 2 AS counts FROM three""")
def page_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload pages that count, and third pages of series that have two."""
    landed = _payloads(spark, sf_dir)
    number = F.regexp_extract("indicator_id", r"(\d+)$", 1).cast("int")
    third = landed.filter((F.col("page") == 1) & (number % 10 == 0)).withColumn("page", F.lit(3))
    counting, beyond = within_pages(split_envelopes(landed.unionByName(third)).good)
    return counting.select("indicator_id", "page", F.lit(True).alias("counts")).unionByName(beyond.select("indicator_id", "page", F.lit(False).alias("counts")))


@registered(f"""WITH {ANNUAL}, {REBASED}, {_YEARS} SELECT indicator_id, ts AS "timestamp", round(original_value * factor, 2) AS value, original_value, abs(factor - 1) > 1e-12 AS is_chain_linked, CASE WHEN abs(factor - 1) > 1e-12 THEN 0.2 END AS chain_linking_confidence, 'USD' AS unit, {_DOMAIN} AS domain FROM fac""")
def gold_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver, catalog = _silver(spark, sf_dir)
    linked = linking.chain_link(silver.select("indicator_id", "timestamp", "value"), catalog)
    return publish.level_records(linked, silver, catalog).select("indicator_id", "timestamp", _r("value", 2), "original_value", "is_chain_linked", "chain_linking_confidence", "unit", "domain")


_GROWTH = f"""gr AS (SELECT indicator_id, k, ts, lag(ts) OVER w AS f, 100 * (original_value * factor / (lag(original_value) OVER w * lag(factor) OVER w) - 1) AS rate, 100 * (original_value / lag(original_value) OVER w - 1) AS raw_rate, abs(factor - lag(factor) OVER w) > 1e-12 AS crossed,
    abs(factor - 1) > 1e-12 OR abs(lag(factor) OVER w - 1) > 1e-12 AS either FROM fac WINDOW w AS (PARTITION BY indicator_id ORDER BY ts)),
gg AS (SELECT 'WB.' || indicator_id || '.YOY' AS indicator_id, ts AS "timestamp", round(rate, 4) + 0.0 AS value, CASE WHEN NOT crossed THEN round(raw_rate, 4) END AS original_value, either AS is_chain_linked, CASE WHEN either THEN 0.2 END AS chain_linking_confidence, 'annual %' AS unit, {_DOMAIN} AS domain, strftime(f, '%Y-%m-%d') AS from_period, crossed FROM gr WHERE f IS NOT NULL)"""


@registered(f"WITH {ANNUAL}, {REBASED}, {_YEARS}, {_GROWTH} SELECT * FROM gg")
def gold_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver, catalog = _silver(spark, sf_dir)
    linked = linking.chain_link(silver.select("indicator_id", "timestamp", "value"), catalog)
    rows = publish.growth_records(linked, silver, catalog)
    told = [F.get_json_object("metadata", "$.from_period").alias("from_period"), (F.get_json_object("metadata", "$.spans_base_year_break") == "true").alias("crossed")]
    return rows.select("indicator_id", "timestamp", (F.round("value", 4) + 0.0).alias("value"), _r("original_value"), "is_chain_linked", "chain_linking_confidence", "unit", "domain", *told)


@registered(f"""WITH {ANNUAL}, {REBASED}, {_YEARS} SELECT b.indicator_id, min_by(base_year_from, b.ts) AS base_year_from, max_by(base_year_to, b.ts) AS base_year_to, 'level_shift' AS linking_method, 0.2 AS avg_confidence_score, count(*) AS n_breaks FROM brk b GROUP BY 1""")
def link_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = medallion.to_gold(*_silver(spark, sf_dir)).link_log
    breaks = F.size(F.from_json("metadata", "array<struct<base_year_to:int>>")).cast("long").alias("n_breaks")
    return log.select("indicator_id", "base_year_from", "base_year_to", "linking_method", "avg_confidence_score", breaks)


@registered(f"""WITH {ANNUAL} SELECT 'silver' AS source_layer, 'gold' AS target_layer, 'chain_linking' AS transformation_type, 'success' AS status, count(DISTINCT indicator_id) AS n_hops, CAST(count(*) AS BIGINT) AS processed, CAST(0 AS BIGINT) AS failed FROM annual""")
def hop_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.hop_status(medallion.to_gold(*_silver(spark, sf_dir)).log)


@registered(f"""WITH {ANNUAL}, {REBASED}, {_YEARS} SELECT indicator_id, bool_or(abs(factor - 1) > 1e-12) AS any_linked, count(*) FILTER (abs(factor - 1) > 1e-12) AS n_linked FROM fac GROUP BY 1""")
def linked_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.linked_flags(medallion.to_gold(*_silver(spark, sf_dir)).levels)


# --- reports and sinks --------------------------------------------------------------


@registered(f'WITH {ANNUAL} SELECT indicator_id, count(*) AS n_obs, min(ts) AS first_ts, max(ts) AS last_ts FROM annual GROUP BY 1')
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.coverage(inputs.annual(spark, sf_dir))


@registered(f"""WITH {ANNUAL}, {RAW}, h AS (SELECT indicator_id, y FROM own WHERE value IS NOT NULL GROUP BY ALL), s AS (SELECT indicator_id, unnest(range(min(y), max(y) + 1)) AS y FROM h GROUP BY 1)
SELECT indicator_id, string_agg(CAST(s.y AS VARCHAR), ',' ORDER BY s.y) AS missing_years FROM s ANTI JOIN h ON s.indicator_id = h.indicator_id AND s.y = h.y GROUP BY 1""")
def interior_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = inputs.raw(inputs.annual(spark, sf_dir)).filter("value IS NOT NULL AND (code IS NULL OR code = indicator_id)")
    stamped = known.withColumn("timestamp", F.make_timestamp_ntz("y", F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0)))
    return reports.interior_gaps(stamped).select("indicator_id", F.array_join(F.col("missing_years").cast("array<string>"), ",").alias("missing_years"))


@registered("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 10 = 0")
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose order isn't there, after one order in ten was left out."""
    lines, orders = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "orders"))
    kept = orders.filter("o_orderkey % 10 <> 0")
    return reports.orphans(lines.select("l_orderkey", "l_linenumber"), kept.select("o_orderkey"), "l_orderkey", "o_orderkey")


@registered(f"WITH {ANNUAL} SELECT DISTINCT indicator_id, 'USD' AS unit, CAST(NULL AS VARCHAR) AS catalog_unit FROM annual WHERE k % 4 = 0")
def unit_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.unit_mismatches(*_silver(spark, sf_dir))


@registered(f"WITH {ANNUAL} SELECT DISTINCT CASE WHEN k % 5 <> 0 THEN 'domain' || CAST(k % 3 AS VARCHAR) END AS domain, CASE WHEN k % 4 <> 0 THEN 'USD' END AS unit FROM annual")
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.catalog(inputs.annual(spark, sf_dir)).select("domain", "unit").distinct()


@registered(f"""WITH {ANNUAL}, {RAW}, i AS (SELECT DISTINCT indicator_id, k FROM annual), w AS (SELECT indicator_id, count(*) AS w FROM silver GROUP BY 1), p AS (SELECT indicator_id, count(*) AS p FROM own GROUP BY 1),
o AS (SELECT i.*, CASE WHEN {_GOOD} THEN coalesce(w, 0) ELSE 0 END AS w, CASE WHEN {_GOOD} THEN p - coalesce(w, 0) ELSE 0 END AS f, NOT ({_GOOD}) AS bad FROM i LEFT JOIN w USING (indicator_id) LEFT JOIN p USING (indicator_id))
SELECT count(*) AS indicators, count(*) FILTER (NOT bad) AS succeeded, count(*) FILTER (bad) AS failed, CAST(sum(w) AS BIGINT) AS written, CAST(sum(f) AS BIGINT) AS records_failed, count(*) FILTER (bad) = 0 AS ok,
    CASE WHEN count(*) FILTER (bad) = 0 THEN 'success' WHEN count(*) FILTER (NOT bad) > 0 THEN 'partial' ELSE 'failed' END AS status, printf('%d of %d indicators succeeded, %d rows written', count(*) FILTER (NOT bad), count(*), CAST(sum(w) AS BIGINT)) AS report FROM o""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dry run over all landed payloads."""
    landed, catalog = _landing(spark, sf_dir)
    outcomes = medallion.run(spark, landed, catalog, "", NOW, "dry", dry_run=True)
    return reports.run_summary(outcomes)


@registered(f"WITH {ANNUAL}, {RAW} SELECT indicator_id, min(ts) AS first_seen, max(ts) AS last_seen FROM own WHERE value IS NOT NULL GROUP BY 1")
def availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.raw(inputs.annual(spark, sf_dir)).filter("code IS NULL OR code = indicator_id")
    return reports.observed_range(rows.withColumn("timestamp", F.make_timestamp_ntz("y", F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0))))


@registered(f"""WITH {ANNUAL}, i AS (SELECT DISTINCT k FROM annual), o AS (SELECT indicator_id, k, min(ts) AS a, max(ts) AS b FROM annual WHERE k % 2 = 0 GROUP BY ALL)
SELECT 'PART.' || CAST(i.k AS VARCHAR) AS indicator_id, CASE WHEN i.k % 3 <> 0 THEN 'New part ' ELSE 'Part ' END || CAST(i.k AS VARCHAR) AS name, a AS availability_start, b AS availability_end FROM i LEFT JOIN o ON o.k = i.k WHERE i.k % 2 = 0 OR i.k % 3 <> 0""")
def catalog_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the parts are known, with their ranges; two thirds are discovered anew, under new names."""
    series = inputs.annual(spark, sf_dir)
    catalog, key = inputs.catalog(series), F.regexp_extract("indicator_id", r"(\d+)$", 1).cast("int")
    known = tables.update_availability(catalog.filter(key % 2 == 0), reports.observed_range(series))
    found = catalog.filter(key % 3 != 0).withColumn("name", F.concat(F.lit("New part "), key.cast("string")))
    return tables.upsert_catalog(known, found).select("indicator_id", "name", "availability_start", "availability_end")


@registered(f"""WITH {ANNUAL} SELECT indicator_id, ts AS "timestamp", CASE WHEN y >= 1997 THEN round(value * 2, 2) ELSE value END AS value, CASE WHEN y <= 1998 THEN 'first' ELSE 'second' END AS created_by FROM annual""")
def silver_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations up to 1998 are known, from 1997 on they come anew with other values; what was there keeps its creator."""
    series = inputs.annual(spark, sf_dir)
    columns = [stable_id("indicator_id", "timestamp").alias("id"), "indicator_id", "timestamp"]
    old = series.filter("y <= 1998").select(*columns, "value", F.lit("first").alias("created_at")).withColumn("series_bucket", tables.bucket())
    new = series.filter("y >= 1997").select(*columns, F.round(F.col("value") * 2, 2).alias("value"), F.lit("second").alias("created_at"))
    merged = tables.upsert_silver(old, new).unionByName(old.join(new.select(tables.bucket().alias("series_bucket")).distinct(), "series_bucket", "left_anti").select("id", "indicator_id", "timestamp", "value", "created_at", "series_bucket"))
    return merged.select("indicator_id", "timestamp", "value", F.col("created_at").alias("created_by"))


@registered(f"""WITH {ANNUAL} SELECT indicator_id AS parent_id, ts AS "timestamp", value FROM annual WHERE k % 2 = 1 UNION ALL SELECT indicator_id, ts, value + 1 FROM annual WHERE k % 4 = 0""")
def gold_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even parts are replaced: by new rows where they are divisible by four, by none elsewhere."""
    series = inputs.annual(spark, sf_dir)
    old = series.select(F.col("indicator_id").alias("parent_id"), "timestamp", "value").withColumn("series_bucket", tables.bucket("parent_id"))
    new = series.filter("k % 4 = 0").select(F.col("indicator_id").alias("parent_id"), "timestamp", (F.col("value") + 1).alias("value"))
    even = series.filter("k % 2 = 0").select("indicator_id")
    rewritten = tables.replace_gold(old, even, new)
    others = old.join(even.select(tables.bucket().alias("series_bucket")).distinct(), "series_bucket", "left_anti")
    return rewritten.select("parent_id", "timestamp", "value").unionByName(others.select("parent_id", "timestamp", "value"))


# --- stored layers and further paths ---------------------------------------------------


@registered(f"""WITH {ANNUAL}, {RAW}, s AS (SELECT * FROM silver WHERE {_GOOD}), g AS (SELECT *, lag(value) OVER w AS before FROM s WINDOW w AS (PARTITION BY indicator_id ORDER BY ts))
SELECT indicator_id, ts AS "timestamp", round(value, 2) AS value, 'USD' AS unit FROM s UNION ALL SELECT 'WB.' || indicator_id || '.YOY', ts, round(100 * (value / before - 1), 4) + 0.0, 'annual %' FROM g WHERE before <> 0""")
def stored_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold, read back after two runs: the older pages' observations first, then the newer ones'."""
    root, (landed, catalog) = scratch(spark), _landing(spark, sf_dir)
    for page in (2, 1):
        medallion.run(spark, landed.filter(F.col("page") == page), catalog, root, NOW, f"page{page}")
    digits = F.when(F.col("unit") == "USD", F.round("value", 2)).otherwise(F.round("value", 4) + 0.0)
    return versioned.read(spark, f"{root}/gold_analytical").select("indicator_id", "timestamp", digits.alias("value"), "unit")


@registered(f"""WITH {ANNUAL}, {REBASED}, {_YEARS}, {_GROWTH} SELECT indicator_id, "timestamp", value, is_chain_linked, unit FROM gg
UNION ALL SELECT indicator_id, ts, round(original_value * factor, 2), abs(factor - 1) > 1e-12, 'USD' FROM fac""")
def gold_storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels and growth, written to gold's buckets and read back."""
    path = f"{scratch(spark)}/gold"
    gold = medallion.to_gold(*_silver(spark, sf_dir))
    levels = gold.levels.withColumn("parent_id", F.col("indicator_id"))
    growth_rows = gold.growth.withColumn("parent_id", F.get_json_object("metadata", "$.derived_from"))
    rows = tables.replace_gold(None, levels.select("indicator_id"), levels.unionByName(growth_rows))
    versioned.commit(rows, path, rows.select("series_bucket"))
    digits = F.when(F.col("unit") == "USD", F.round("value", 2)).otherwise(F.round("value", 4) + 0.0)
    return versioned.read(spark, path).select("indicator_id", "timestamp", digits.alias("value"), "is_chain_linked", "unit")


@registered(f"""WITH {ANNUAL}, {REBASED}, {_YEARS} SELECT indicator_id, ts AS "timestamp", round(original_value * factor, 2) AS value, original_value, abs(factor - 1) > 1e-12 AS is_chain_linked, CASE WHEN abs(factor - 1) > 1e-12 THEN 0.2 END AS chain_linking_confidence, 'USD' AS unit FROM fac WHERE k IN (1, 7)""")
def gold_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two published series, each read by its id."""
    levels = medallion.to_gold(*_silver(spark, sf_dir), include_growth=False).levels.withColumn("series_bucket", tables.bucket())
    rows = scan.gold_series(levels, "PART.1").unionByName(scan.gold_series(levels, "PART.7"))
    return rows.withColumn("value", F.round("value", 2))


@registered(f"""WITH {ANNUAL}, {RAW} SELECT indicator_id, ts AS "timestamp" FROM silver WHERE {_GOOD} AND k % 10 = 0""")
def bronze_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows whose bronze row isn't there, after the payloads of one part in ten were lost."""
    bronze = written(medallion.landed(_payloads(spark, sf_dir), "lineage"))
    silver = medallion.to_silver(bronze, NOW).rows
    kept = bronze.filter(~F.endswith("indicator_id", F.lit("0")))
    return reports.orphans(silver, kept.select("bronze_id"), "bronze_id", "bronze_id").select("indicator_id", "timestamp")


@registered(f"WITH {ANNUAL}, {RAW} SELECT indicator_id, 'EUR' AS unit, count(*) AS n FROM silver WHERE {_GOOD} GROUP BY 1")
def unit_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = clean(_rows(spark, sf_dir), NOW, unit="EUR").silver
    return silver.groupBy("indicator_id", "unit").agg(F.count(F.lit(1)).alias("n"))


@registered(f"""WITH {ANNUAL}, {_SPLICE}, ratios AS (SELECT indicator_id, n.value / o.value AS r FROM old o JOIN new n USING (indicator_id, ts) WHERE indicator_id IN (SELECT indicator_id FROM sh) QUALIFY row_number() OVER (PARTITION BY indicator_id ORDER BY ts DESC) <= 3)
SELECT indicator_id, round(avg(r), 6) AS scale, count(*) AS overlap_periods, round(var_pop(r) / (avg(r) * avg(r)), 12) AS ratio_variance FROM ratios GROUP BY 1""")
def recent_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splices by the three most recent shared periods."""
    return _spliced(spark, sf_dir, overlap=3).summary.select("indicator_id", _r("scale", 6), "overlap_periods", _r("ratio_variance", 12))


@registered(f"""WITH {ANNUAL}, {REBASED}, {_YEARS}, {_SPLICE}, o AS (SELECT * FROM old WHERE indicator_id IN (SELECT indicator_id FROM annual WHERE k % 2 = 0)), n AS (SELECT * FROM new WHERE indicator_id IN (SELECT indicator_id FROM annual WHERE k % 2 = 0))
SELECT indicator_id, ts AS "timestamp", round(value * scale, 2) AS value, value AS original_value, TRUE AS is_linked FROM o JOIN sh USING (indicator_id) JOIN st USING (indicator_id) WHERE ts < boundary
UNION ALL SELECT indicator_id, ts, value, value, FALSE FROM n WHERE indicator_id IN (SELECT indicator_id FROM sh) OR indicator_id NOT IN (SELECT indicator_id FROM o)
UNION ALL SELECT indicator_id, ts, value, value, FALSE FROM o WHERE indicator_id NOT IN (SELECT indicator_id FROM n)
UNION ALL SELECT indicator_id, ts, round(original_value * factor, 2), original_value, abs(factor - 1) > 1e-12 FROM fac WHERE k % 2 = 1""")
def link_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even parts come in two published segments, the others are linked at their base years."""
    series, catalog = _series(spark, sf_dir)
    even = inputs.annual(spark, sf_dir).filter("k % 2 = 0")
    value = F.round(F.col("value") * (20 + (F.col("k") + F.col("y")) % 3), 2)
    segments = even.filter("y <= 1999").withColumn("segment", F.lit(0)).unionByName(even.filter("y >= 1996").withColumns({"value": value, "segment": F.lit(1)}))
    # A series' segments count from 0, also where it has but one.
    first = segments.groupBy("indicator_id").agg(F.min("segment").alias("first"))
    segments = segments.join(first, "indicator_id").select("indicator_id", "timestamp", "value", (F.col("segment") - F.col("first")).alias("segment"))
    linked = linking.chain_link(series.select("indicator_id", "timestamp", "value"), catalog, segments=segments)
    return linked.frame.select("indicator_id", "timestamp", _r("value", 2), "original_value", "is_linked")


@registered(f"""WITH {ANNUAL}, {REBASED}, {_YEARS} SELECT indicator_id, count(*) AS n_rows, count(*) FILTER (abs(factor - 1) <= 1e-12) AS n_without, CAST(0 AS BIGINT) AS n_outside FROM fac GROUP BY 1""")
def confidence_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.confidence_range(medallion.to_gold(*_silver(spark, sf_dir), include_growth=False).levels)


@registered(f"WITH {ANNUAL} SELECT indicator_id, count(DISTINCT y) AS n_years FROM annual GROUP BY 1 HAVING count(DISTINCT y) < 7")
def short_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.short_coverage(inputs.annual(spark, sf_dir), years=7)


# --- optional series transformations --------------------------------------------------


@registered(f"""WITH {EVENTS} SELECT indicator_id, date_trunc('day', ts)::TIMESTAMP AS "timestamp", round(avg(value), 6) AS mean_value, max_by(value, ts) AS closing, round(stddev_samp(value), 6) AS volatility FROM ev WHERE value IS NOT NULL GROUP BY 1, 2""")
def downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = resampling.downsample(inputs.events(spark, sf_dir), "day")
    return daily.select("indicator_id", "timestamp", _r("mean_value", 6), "closing", _r("volatility", 6))


@registered(f"""WITH {EVENTS}, d AS (SELECT indicator_id, date_trunc('day', ts)::TIMESTAMP AS ts, sum(value) AS v FROM ev WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT indicator_id, ts AS "timestamp", round(avg(v) OVER (PARTITION BY indicator_id ORDER BY ts ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS moving_average FROM d""")
def moving_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.moving_average(_daily(spark, sf_dir), 7).withColumn("moving_average", F.round("moving_average", 6))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_trunc("day", "timestamp").cast("timestamp_ntz").alias("timestamp")
    return inputs.events(spark, sf_dir).filter("value IS NOT NULL AND NOT isnan(value)").groupBy("indicator_id", day).agg(F.sum("value").alias("value"))


_DAILY = f"""{EVENTS}, daily AS (SELECT indicator_id, CAST(date_trunc('day', ts) AS DATE) AS day, sum(value) AS v FROM ev WHERE value IS NOT NULL GROUP BY 1, 2)"""


@registered("""WITH s AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'ALL' ELSE 'SUPP.' || CAST(l_suppkey AS VARCHAR) END AS indicator_id, l_shipdate::TIMESTAMP AS "timestamp", l_orderkey AS order_id, sum(l_quantity) AS value FROM lineitem GROUP BY ALL)
SELECT *, lag(value) OVER w AS previous, round(avg(value) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS moving_average, sum(value) OVER (w ROWS UNBOUNDED PRECEDING) AS total, max(value) OVER (w ROWS UNBOUNDED PRECEDING) AS peak
FROM s WINDOW w AS (PARTITION BY indicator_id ORDER BY "timestamp", order_id)""")
def split_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows over the suppliers' quantities and a series with a third of all orders, cut into chunks of time."""
    name = F.when(F.col("l_orderkey") % 3 == 0, "ALL").otherwise(F.concat(F.lit("SUPP."), F.col("l_suppkey").cast("string"))).alias("indicator_id")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(name, F.col("l_shipdate").cast("timestamp_ntz").alias("timestamp"), F.col("l_orderkey").alias("order_id"), "l_quantity")
    order = ("timestamp", "order_id")
    chunked = chunks.split(lines, order, within=lambda dealt: dealt.groupBy(chunks.KEY, *order).agg(F.sum("l_quantity").alias("value")))
    seen = {"previous": lambda w: F.lag("value").over(w), "moving_average": lambda w: F.round(F.avg("value").over(w.rowsBetween(-6, 0)), 6)}
    backward = chunks.with_rows_before(chunked, 6, seen, order)
    return chunks.with_totals_before(chunked, {"total": ("sum", "value"), "peak": ("max", "value")}, order, onto=backward).drop("chunk")


@registered(f"""WITH {_DAILY}, s AS (SELECT indicator_id, CAST(unnest(generate_series(min(day)::TIMESTAMP, max(day)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day FROM daily GROUP BY 1)
SELECT indicator_id, CAST(day AS TIMESTAMP) AS "timestamp", round(last_value(v IGNORE NULLS) OVER (PARTITION BY indicator_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS value FROM s LEFT JOIN daily USING (indicator_id, day)""")
def upsample_forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = resampling.upsample_days(_daily(spark, sf_dir))
    return days.select("indicator_id", F.col("day").cast("timestamp_ntz").alias("timestamp"), _r("value", 6))


@registered(f"""WITH {_DAILY}, r AS (SELECT indicator_id, day, v / nullif(lag(v) OVER w, 0) - 1 AS x FROM daily WINDOW w AS (PARTITION BY indicator_id ORDER BY day))
SELECT p.indicator_id AS a, q.indicator_id AS b, round(corr(p.x, q.x), 6) AS correlation, count(*) AS periods FROM r p JOIN r q USING (day) WHERE p.indicator_id < q.indicator_id AND p.x IS NOT NULL AND q.x IS NOT NULL GROUP BY 1, 2""")
def growth_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All series against each other."""
    return resampling.correlations(_daily(spark, sf_dir)).withColumn("correlation", F.round("correlation", 6))


@registered(f"""WITH {_DAILY} SELECT d.indicator_id, CAST(d.day AS TIMESTAMP) AS "timestamp", round(100 * (d.v / nullif(e.v, 0) - 1), 4) + 0.0 AS change FROM daily d LEFT JOIN daily e ON e.indicator_id = d.indicator_id AND e.day = d.day - 1""")
def daily_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    returns = resampling.daily_returns(_daily(spark, sf_dir))
    return returns.select("indicator_id", "timestamp", (F.round("change", 4) + 0.0).alias("change"))


@registered(f"""WITH {_DAILY} SELECT indicator_id, CAST(day AS TIMESTAMP) AS "timestamp", round(avg(v) OVER w + 1e-9, 6) AS moving_average, count(*) OVER w AS observations FROM daily
WINDOW w AS (PARTITION BY indicator_id ORDER BY day RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW)""")
def calendar_average_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The small number keeps means off the half of the last digit."""
    return resampling.calendar_average(_daily(spark, sf_dir), 30).withColumn("moving_average", F.round(F.col("moving_average") + 1e-9, 6))


_MONTHLY = """o AS (SELECT o_orderpriority || '.' || CAST(o_custkey % 50 AS VARCHAR) AS indicator_id, date_trunc('month', o_orderdate)::TIMESTAMP AS ts, floor(sum(o_totalprice) + 0.001) AS v FROM orders WHERE (o_custkey + month(o_orderdate)) % 11 <> 0 GROUP BY 1, 2)"""


def _period_sql() -> str:
    views = {"mom": 1, "qoq": 3, "yoy": 12}
    one = "SELECT '{}' AS view, x.indicator_id, x.ts AS \"timestamp\", round(100 * (x.v / nullif(y.v, 0) - 1), 4) + 0.0 AS change FROM o x LEFT JOIN o y ON y.indicator_id = x.indicator_id AND y.ts = x.ts - INTERVAL {} MONTH"
    return f"WITH {_MONTHLY} " + " UNION ALL ".join(one.format(name, months) for name, months in views.items())


@registered(_period_sql())
def period_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly order values by priority and customer group, with gaps, against a month, a quarter and a year before."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").filter((F.col("o_custkey") + F.month("o_orderdate")) % 11 != 0)
    ids = F.concat("o_orderpriority", F.lit("."), (F.col("o_custkey") % 50).cast("string")).alias("indicator_id")
    monthly = orders.groupBy(ids, F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("timestamp")).agg(F.floor(F.sum("o_totalprice") + 0.001).cast("double").alias("value"))
    views = [resampling.period_change(monthly, "monthly", v).select(F.lit(v).alias("view"), "indicator_id", "timestamp", (F.round("change", 4) + 0.0).alias("change")) for v in resampling.VIEWS["monthly"]]
    return views[0].unionByName(views[1]).unionByName(views[2])


@registered(f"""WITH {EVENTS}, known AS (SELECT indicator_id, ts, event_id, value FROM ev WHERE value IS NOT NULL AND event_id % 3 = 0), asked AS (SELECT indicator_id, event_id, ts FROM ev WHERE event_id % 3 <> 0)
SELECT a.event_id, 'backward' AS direction, round(k.value, 6) AS value FROM asked a ASOF LEFT JOIN known k ON a.indicator_id = k.indicator_id AND a.ts >= k.ts
UNION ALL SELECT a.event_id, 'forward', round(k.value, 6) FROM asked a ASOF LEFT JOIN known k ON a.indicator_id = k.indicator_id AND a.ts <= k.ts""")
def asof_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For two thirds of the events the nearest known value before and after them in their series, out of the others."""
    events = inputs.events(spark, sf_dir)
    known = events.filter("event_id % 3 = 0 AND value IS NOT NULL AND NOT isnan(value)").select("indicator_id", "timestamp", "value")
    asked = events.filter("event_id % 3 <> 0").select("indicator_id", "event_id", "timestamp")
    found = [asof.asof_join(asked, known, on="timestamp", direction=d).select("event_id", F.lit(d).alias("direction"), F.round("matched.value", 6).alias("value")) for d in ("backward", "forward")]
    return found[0].unionByName(found[1])


@registered(f"""WITH {ANNUAL}, {REBASED}, {_YEARS}, {_GROWTH}, rows AS (SELECT indicator_id, "timestamp", value, unit, indicator_id LIKE 'WB.%' AS derived FROM gg
UNION ALL SELECT indicator_id, ts, round(original_value * factor, 2), 'USD', FALSE FROM fac)
SELECT indicator_id, "timestamp", value, unit FROM rows WHERE CAST(regexp_extract(indicator_id, '([0-9]+)', 1) AS INTEGER) % 10 = 3 AND year("timestamp") BETWEEN 1996 AND 1999""")
def export_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the series with their growth from 1996 to 1999, out of stored gold, exported as CSV and read back."""
    root = scratch(spark)
    gold = medallion.to_gold(*_silver(spark, sf_dir))
    levels = gold.levels.withColumn("parent_id", F.col("indicator_id"))
    derived = gold.growth.withColumn("parent_id", F.get_json_object("metadata", "$.derived_from"))
    new = levels.unionByName(derived)
    medallion.store_gold(new, levels.select("indicator_id").distinct(), root, "export")
    wanted = inputs.annual(spark, sf_dir).filter("k % 10 = 3").select("indicator_id")
    chosen = scan.series_set(versioned.read(spark, f"{root}/gold_analytical"), wanted, datetime(1996, 1, 1), datetime(1999, 12, 31), parent_col="parent_id")
    scan.export_csv(chosen, f"{root}/csv", ["indicator_id", "timestamp", "value", "unit"])
    back = spark.read.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").schema("indicator_id string, timestamp timestamp_ntz, value double, unit string").csv(f"{root}/csv")
    digits = F.when(F.col("unit") == "USD", F.round("value", 2)).otherwise(F.round("value", 4) + 0.0)
    return back.select("indicator_id", "timestamp", digits.alias("value"), "unit")


@registered(f"""WITH {ANNUAL} SELECT indicator_id, 'Part ' || CAST(k AS VARCHAR) AS name FROM (SELECT DISTINCT indicator_id, k FROM annual) WHERE contains(lower('Part ' || CAST(k AS VARCHAR)), 'part 1')""")
def catalog_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.search_catalog(inputs.catalog(inputs.annual(spark, sf_dir)), "PART 1").select("indicator_id", "name")


@registered(f"""WITH {ANNUAL}, {REBASED} SELECT indicator_id, ts AS "timestamp", value, 'USD' AS unit, 'annual' AS frequency FROM rebased WHERE k IN (1, 7)""")
def series_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two series, each read by its id."""
    silver, _ = _silver(spark, sf_dir)
    stored = silver.withColumn("series_bucket", tables.bucket())
    return scan.silver_series(stored, "PART.1").unionByName(scan.silver_series(stored, "PART.7")).drop("id")


@registered(f"""WITH {ANNUAL} SELECT indicator_id, count(*) AS n_rows FROM annual WHERE k % 6 = 0 GROUP BY 1""")
def lookup_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the wanted parts have series; those found, with their rows."""
    series = inputs.annual(spark, sf_dir)
    wanted = series.filter("k % 6 = 0").select("indicator_id").unionByName(series.select(F.concat("indicator_id", F.lit("x")).alias("indicator_id")))
    found, _ = scan.by_id(series, wanted, "indicator_id")
    return found.groupBy("indicator_id").agg(F.count(F.lit(1)).alias("n_rows"))


@registered(f"""WITH {ANNUAL}, {RAW} SELECT indicator_id, count(*) AS records_collected, 'success' AS status FROM raw WHERE {_GOOD} GROUP BY 1
UNION ALL SELECT indicator_id, CAST(0 AS BIGINT), 'failed' FROM (SELECT DISTINCT indicator_id, k FROM raw) WHERE NOT ({_GOOD})""")
def collection_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.collection_log(_payloads(spark, sf_dir)).select("indicator_id", "records_collected", "status")


@registered(f"""WITH {ANNUAL}, {RAW}, c AS (SELECT indicator_id, count(*) AS p FROM own WHERE {_GOOD} GROUP BY 1), w AS (SELECT indicator_id, count(*) AS w FROM silver GROUP BY 1)
SELECT count(*) AS series, CAST(0 AS BIGINT) AS broken FROM c LEFT JOIN w USING (indicator_id)""")
def layer_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series whose silver rows aren't what was processed less what failed: none."""
    cleaned = clean(_rows(spark, sf_dir), NOW)
    broken = reports.layer_identity(cleaned.counters, cleaned.silver).select("indicator_id", F.lit(1).alias("broken"))
    return cleaned.counters.join(broken, "indicator_id", "left").agg(F.count(F.lit(1)).alias("series"), F.count("broken").alias("broken"))
