"""Synthetic series with exact answers."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from seriesloom.functions import expr
from seriesloom.operators import growth, linking, publish, quality
from seriesloom.operators.cleaning import clean
from seriesloom.plans import medallion, reports
from seriesloom.sinks import tables, versioned
from seriesloom.sources import payload
from seriesloom.streaming.ingest import ingest

NOW = datetime(2026, 6, 30)


def series(spark, values, start=2000, name="A"):
    rows = [(name, datetime(start + k, 12, 31), None if v is None else float(v)) for k, v in enumerate(values)]
    return spark.createDataFrame(rows, "indicator_id string, timestamp timestamp_ntz, value double")


def years(spark, *bases, name="A"):
    return spark.createDataFrame([(name, list(bases))], "indicator_id string, base_years array<int>")


def values(df, column="value"):
    return [r[0] for r in df.orderBy("timestamp").select(column).collect()]


def test_growth_is_against_the_previous_observation_and_finite(spark):
    got = growth.growth_rates(series(spark, [100, 110, 0, 5, 10])).orderBy("timestamp").collect()
    assert [round(r["growth"], 6) for r in got] == [10.0, -100.0, 100.0]


def test_break_at_a_known_base_year(spark):
    got = linking.detect_breaks(series(spark, [100, 105, 110, 300, 315, 330]), years(spark, 2000, 2003)).collect()
    assert [(r["timestamp"].year, r["base_year_from"], r["base_year_to"], r["detected_by"]) for r in got] == [(2003, 2000, 2003, "metadata")]
    assert got[0]["level_ratio"] == 300 / 110


def test_two_rebases_and_none_without_metadata(spark):
    s = series(spark, [100, 105, 300, 315, 900, 950])
    assert sorted(r["timestamp"].year for r in linking.detect_breaks(s, years(spark, 2000, 2002, 2004)).collect()) == [2002, 2004]
    assert linking.detect_breaks(s, years(spark)).count() == 0
    assert linking.detect_breaks(series(spark, [100]), years(spark, 1990, 2000)).count() == 0


def test_level_shifts_only_on_request(spark):
    s = series(spark, [100, 102, 104, 400, 408, 416])
    none = years(spark)
    assert linking.detect_breaks(s, none).count() == 0
    assert [r["timestamp"].year for r in linking.detect_breaks(s, none, statistical=True).collect()] == [2003]
    assert linking.detect_breaks(s, years(spark, 2001), statistical=True).count() == 0  # known base years decide


def test_base_years_on_one_observation_make_one_break(spark):
    s = series(spark, [100, 110, None, None, None, 220])
    got = linking.detect_breaks(s, years(spark, 2000, 2003, 2004)).collect()
    assert [(r["base_year_from"], r["base_year_to"], r["level_ratio"]) for r in got] == [(2000, 2004, 2.0)]


def test_level_shift_link(spark):
    s = series(spark, [100, 105, 110, 275, 288.75, 302.5])
    linked = linking.chain_link(s, years(spark, 2000, 2003))
    assert values(linked.frame) == pytest.approx([250, 262.5, 275, 275, 288.75, 302.5])
    row = linked.summary.first()
    assert (row["records_linked"], row["avg_confidence_score"], row["overlap_period_months"], row["linking_method"]) == (3, 0.2, 0, "level_shift")
    assert linked.violations.count() == 0


def test_a_series_that_cant_be_linked_doesnt_stop_the_others(spark):
    rows = [(name, datetime(2000 + k, 12, 31), float(v)) for name, vals in (("BAD", [100, 105, 0, 275, 288.75]), ("GOOD", [1, 2, 3, 4])) for k, v in enumerate(vals)]
    both = spark.createDataFrame(rows, "indicator_id string, timestamp timestamp_ntz, value double")
    linked = linking.chain_link(both, years(spark, 2000, 2003, name="BAD"))
    assert "junction ratio is undefined" in linked.violations.first()["message"]
    assert {r[0] for r in linked.frame.select("indicator_id").distinct().collect()} == {"GOOD"}
    row = linked.summary.first()
    assert (row["is_chain_linked"], row["avg_confidence_score"], row["records_linked"]) == (False, None, 0)


def test_splice_recovers_the_scale(spark):
    old, new = series(spark, [100, 110, 120, 130, 140]), series(spark, [300, 325, 350], start=2002)
    linked = linking.splice(old, new)
    row = linked.summary.first()
    assert (row["scale"], row["confidence"], row["overlap_periods"]) == (2.5, 1.0, 3)
    assert values(linked.frame) == [250, 275, 300, 325, 350]
    assert values(linked.frame, "is_linked") == [True, True, False, False, False]
    noisy = linking.splice(old, series(spark, [240, 390, 350], start=2002)).summary.first()
    assert noisy["confidence"] < 1


@pytest.mark.parametrize(
    ("old", "new", "overlap", "message"),
    [([100, 110, 120], [300, 325], None, "insufficient overlap"), ([100, 110, 120, 130, 140], [300, 325, 350], 2, "below the"), ([100, 110, 0, 0, 0], [0, 0, 0], None, "usable overlap ratio")],
)
def test_splices_that_are_refused(spark, old, new, overlap, message):
    start = 2002 if len(new) == 3 else 2001
    linked = linking.splice(series(spark, old), series(spark, new, start=start), overlap=overlap)
    assert message in linked.violations.first()["message"]
    assert linked.frame.count() == 0


def test_three_segments_fold(spark):
    level = [100 * 1.05**k for k in range(15)]
    parts = [(0, 0, 7, 1), (1, 4, 11, 2), (2, 8, 15, 3)]
    rows = [("A", datetime(2000 + k, 12, 31), level[k] * by, seg) for seg, a, b, by in parts for k in range(a, b)]
    linked = linking.fold_segments(spark.createDataFrame(rows, "indicator_id string, timestamp timestamp_ntz, value double, segment int"))
    assert values(linked.frame) == pytest.approx([3 * v for v in level])
    row = linked.summary.first()
    assert (row["records_linked"], row["overlap_period_months"], row["linking_method"]) == (8, 72, "overlap")


def test_growth_guard(spark):
    s = series(spark, [100, 110, 121]).withColumn("original_value", F.col("value")).withColumn("scale_factor", F.lit(1.0))
    assert linking.growth_violations(s).count() == 0
    moved = s.withColumn("value", F.when(F.year("timestamp") == 2002, 140.0).otherwise(F.col("value")))
    assert linking.growth_violations(moved).count() == 1


def test_gold_of_a_rebased_series(spark):
    vals = [100 * 1.05**k * (2 if k >= 5 else 1) for k in range(10)]
    silver = series(spark, vals).select(expr.stable_id("indicator_id", "timestamp").alias("id"), "*", F.lit("USD").alias("unit"), F.lit("annual").alias("frequency"))
    catalog = years(spark, 2000, 2005).withColumn("domain", F.lit("gdp"))
    gold = medallion.to_gold(silver, catalog)
    levels = gold.levels.orderBy("timestamp").collect()
    assert [r["is_chain_linked"] for r in levels] == [True] * 5 + [False] * 5
    assert levels[0]["value"] == pytest.approx(levels[0]["original_value"] * 2.1)
    assert json.loads(levels[0]["metadata"])["scale_factor"] == pytest.approx(2.1)
    rates = {r["timestamp"].year: r for r in gold.growth.collect()}
    assert rates[2005]["value"] == pytest.approx(0) and rates[2005]["original_value"] is None
    assert all(rates[y]["value"] == pytest.approx(5) for y in rates if y != 2005)
    assert {y for y in rates if rates[y]["chain_linking_confidence"] == 0.2} == set(range(2001, 2006))
    assert rates[2001]["indicator_id"] == "WB.A.YOY" and rates[2001]["domain"] == "gdp"
    assert gold.link_log.count() == 1 and gold.log.first()["status"] == "success"


def raw(spark, rows):
    full = [(i, code, "Name (USD)", date, value, "", "", pos) for pos, (i, code, date, value) in enumerate(rows)]
    return spark.createDataFrame(full, "indicator_id string, code string, name string, date string, value string, unit string, obs_status string, pos long")


def test_cleaning_counts_what_it_drops(spark):
    got = clean(raw(spark, [("A", "A", "2020", "1.0"), ("A", "A", "2020", "2.0"), ("A", None, "2021", "3.0"), ("A", "B", "2020", "9"), ("A", "A", "2019", None), ("A", "A", "2030", "5")]), NOW)
    c = got.counters.first()
    assert (c["records_processed"], c["null_records"], c["duplicate_records"], c["future_records"], c["records_written"], c["status"]) == (5, 1, 1, 1, 2, "partial")
    assert values(got.silver) == [2.0, 3.0]
    assert got.silver.first()["unit"] == "USD"


def test_cleaning_extremes(spark):
    flat = [("A", "A", str(2000 + k), "10.0") for k in range(10)] + [("A", "A", "2015", "900.0")]
    assert clean(raw(spark, flat), NOW).silver.filter("validation_status = 'flagged'").count() == 1
    c = clean(raw(spark, [("A", "A", "2019", None), ("A", "A", "2020", "")]), NOW).counters.first()
    assert (c["records_written"], c["records_failed"], c["status"]) == (0, 2, "failed")
    assert clean(raw(spark, [("A", "A", "2019", "1")]).limit(0), NOW).counters.count() == 0


@pytest.mark.parametrize("date", ["2022-01", "22", "twenty", "", None])
def test_bad_dates_are_violations(spark, date):
    got = clean(raw(spark, [("A", "A", date, "1"), ("B", "B", "2020", "1")]), NOW)
    assert [r["indicator_id"] for r in got.violations.collect()] == ["A"]
    assert [r["indicator_id"] for r in got.silver.collect()] == ["B"]


def test_expressions(spark):
    row = spark.range(1).select(
        expr.number(F.lit("n/a")).alias("a"), expr.is_bad_number(F.lit("n/a")).alias("b"), expr.number(F.lit("۱۲")).alias("c"),
        expr.safe_ratio(F.lit(1.0), F.lit(0.0)).alias("d"), expr.safe_ratio(F.lit(-1.0), F.lit(2.0)).alias("e"), expr.confidence(F.lit(36.0), F.lit(None).cast("double")).alias("f"),
        expr.run_status(F.lit(0), F.lit(0)).alias("g"), expr.run_status(F.lit(1), F.lit(1)).alias("h"), expr.run_status(F.lit(0), F.lit(1)).alias("i"),
        expr.unit_of(F.lit(" "), F.lit("GDP (current US$) ")).alias("j"), expr.months_per_period(F.lit("weekly")).alias("k"), expr.min_overlap(F.lit("monthly")).alias("l"),
    ).first()
    assert tuple(row) == (None, True, 12.0, None, None, 1.0, "success", "partial", "failed", "current US$", 12, 12)


def test_quality(spark):
    months = [("A", datetime(2020, m, 28), v) for m, v in enumerate([100.0, None, 102, 103, None, 105, 106, 107, None, 500, 110, 1000], 1)]
    df = spark.createDataFrame([(a, t, None if v is None else float(v)) for a, t, v in months], "indicator_id string, timestamp timestamp_ntz, value double")
    r = quality.quality_report(df, NOW).first()
    assert (r["null_percentage"], r["outlier_count"], r["is_valid"], len(r["warnings"]), r["record_count"]) == (25.0, 2, True, 2, 12)
    empty = quality.empty_report(spark.createDataFrame([("Z",)], "indicator_id string"), df).first()
    assert (empty["is_valid"], empty["errors"]) == (False, ["DataFrame is empty"])
    assert quality.missing_columns(df, ["value", "x"]) == ["x"]


def envelope(spark, *payloads):
    return spark.createDataFrame([(i, p, t) for i, p, t in payloads], "indicator_id string, page int, payload string")


ROW = '{"indicator":{"id":"%s","value":"N (USD)"},"date":"%d","value":%s,"unit":"","obs_status":""}'


def test_quartiles_are_exact(spark):
    hash_, k = F.pmod(F.xxhash64("id"), F.lit(100_003)), F.col("id") % 4
    value = F.when(k == 0, (hash_ % 7).cast("double")).when(k == 1, F.exp(hash_ / 5000.0)).when(k == 2, -hash_ / 10.0).otherwise(F.lit(2.5))
    long = spark.range(40_000).select(F.concat(F.lit("long"), k.cast("string")).alias("indicator_id"), value.alias("value"))
    short = spark.range(300).select(F.concat(F.lit("short"), F.floor(F.sqrt("id")).cast("string")).alias("indicator_id"), (F.col("id") % 11).cast("double").alias("value"))
    odd = spark.createDataFrame([("odd", None), ("odd", float("nan")), ("none", None), ("odd", 4.0)], "indicator_id string, value double")
    rows = long.unionByName(short).unionByName(odd)
    plain = rows.filter("value IS NOT NULL AND NOT isnan(value)").groupBy("indicator_id").agg(F.percentile("value", F.array(F.lit(0.25), F.lit(0.75))).alias("q"))
    assert {r[0]: [r[1], r[2]] for r in quality.quartiles(rows).collect()} == {r[0]: r[1] for r in plain.collect()}


def test_envelopes(spark):
    got = payload.split_envelopes(
        envelope(
            spark,
            ("A", 1, '[{"pages":2},[%s]]' % (ROW % ("A", 2020, "1"))),
            ("A", 2, '[{"pages":9},[%s]]' % (ROW % ("A", 2019, "2.5"))),
            ("B", 1, '[{"pages":1}]'),
            ("C", 1, '[{"message":[{"id":"120","key":"Invalid value","value":"bad"}]}]'),
            ("D", 1, "nonsense"),
            ("E", 1, '{"meta":{"pages":1},"rows":[%s]}' % (ROW % ("E", 2020, "null"))),
        )
    )
    whole = {r["indicator_id"]: r["n"] for r in payload.concatenated(got.good).select("indicator_id", F.size("rows").alias("n")).collect()}
    assert whole == {"A": 2, "B": 0, "E": 1}
    assert {(r["indicator_id"], r["error_type"]) for r in got.violations.collect()} == {("C", "api"), ("D", "parse")}
    assert {r["value"] for r in payload.raw_rows(got.good).collect()} == {"1", "2.5", None}


def test_runs_are_idempotent_and_failures_contained(spark, tmp_path):
    body = ",".join(ROW % ("A", 2000 + k, 100 * 1.05**k) for k in reversed(range(5)))
    landed = envelope(spark, ("A", 1, f'[{{"pages":1}},[{body}]]'), ("B", 1, "42"))
    catalog = years(spark).withColumn("domain", F.lit("gdp"))
    root = str(tmp_path)
    for run_id in ("one", "two"):
        outcomes = medallion.run(spark, landed, catalog, root, NOW, run_id)
        summary = reports.run_summary(outcomes).first()
        assert (summary["succeeded"], summary["failed"], summary["ok"]) == (1, 1, False)
    silver, gold = versioned.read(spark, f"{root}/silver_cleaned"), versioned.read(spark, f"{root}/gold_analytical")
    assert silver.count() == 5 and gold.count() == 9
    assert spark.read.parquet(f"{root}/bronze_raw").filter("run_id = 'two'").count() == 1
    log = spark.read.parquet(f"{root}/transformation_log").filter("run_id = 'two'")
    assert {(r["indicator_id"], r["target_layer"], r["status"]) for r in log.collect()} >= {("B", "silver", "failed"), ("A", "silver", "success"), ("A", "gold", "success")}
    assert reports.orphans(gold.select("silver_id"), silver, "silver_id").count() == 0


def told(spark, years, factor=1.0, code="A"):
    body = ",".join(ROW % (code, y, factor * 100 * 1.05 ** (y - 2000)) for y in years)
    return envelope(spark, (code, 1, f'[{{"pages":2}},[{body}]]'))


def gold_rows(spark, root):
    columns = ["indicator_id", "timestamp", F.round("value", 6).alias("value"), F.round("original_value", 6).alias("original_value"), "is_chain_linked"]
    return sorted((tuple(r) for r in versioned.read(spark, f"{root}/gold_analytical").select(*columns).collect()), key=str)


def test_gold_is_built_from_the_whole_stored_history(spark, tmp_path):
    """Two runs, and a stream of two files, leave the same layers as one run over all payloads."""
    catalog = spark.createDataFrame([("A", [2000, 2006], "gdp")], "indicator_id string, base_years array<int>, domain string")
    early, late = told(spark, range(2000, 2006)), told(spark, range(2006, 2009), factor=2.0)
    roots = {k: str(tmp_path / k) for k in ("whole", "parts", "stream")}
    medallion.run(spark, early.unionByName(late.withColumn("page", F.lit(2))), catalog, roots["whole"], NOW, "all")
    for run_id, batch in (("early", early), ("late", late), ("late", late)):
        medallion.run(spark, batch, catalog, roots["parts"], NOW, run_id)
    want = gold_rows(spark, roots["whole"])
    assert len(want) == 9 + 8 and gold_rows(spark, roots["parts"]) == want
    early.coalesce(1).write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        ingest(spark, str(tmp_path / "in"), catalog, roots["stream"], str(tmp_path / "ck"), lambda: NOW).awaitTermination(120)
        late.coalesce(1).write.mode("append").parquet(str(tmp_path / "in")) if not _ else None
    assert gold_rows(spark, roots["stream"]) == want
    # A run that is repeated replaces its own bronze rows and audit rows.
    assert spark.read.parquet(f"{roots['parts']}/bronze_raw").count() == 2
    log = spark.read.parquet(f"{roots['parts']}/transformation_log")
    assert log.count() == 4 and log.filter("duration_seconds >= 0 AND records_written > 0 AND started_at IS NOT NULL").count() == 4
    silver, bronze = versioned.read(spark, f"{roots['parts']}/silver_cleaned"), spark.read.parquet(f"{roots['parts']}/bronze_raw")
    assert reports.orphans(silver.select("bronze_id"), bronze, "bronze_id", "bronze_id").count() == 0 and silver.filter("bronze_id IS NULL").count() == 0
    again = medallion.replay(spark, roots["parts"], bronze.filter("run_id = 'late'").select("bronze_id"), NOW).rows
    assert {(r["timestamp"].year, round(r["value"], 4)) for r in again.collect()} == {(y, round(200 * 1.05 ** (y - 2000), 4)) for y in range(2006, 2009)}


def test_stream_gives_the_batch_result(spark, tmp_path):
    landing, root = str(tmp_path / "in"), str(tmp_path / "out")
    body = ",".join(ROW % ("A", 2000 + k, 100 + k) for k in range(3))
    envelope(spark, ("A", 1, f'[{{"pages":1}},[{body}]]')).write.parquet(landing)
    catalog = years(spark).withColumn("domain", F.lit("gdp"))
    ingest(spark, landing, catalog, root, str(tmp_path / "ck"), lambda: NOW).awaitTermination(120)
    assert versioned.read(spark, f"{root}/silver_cleaned").count() == 3


def test_upserts(spark):
    old = spark.createDataFrame([("A", "Old", datetime(2000, 1, 1), None)], "indicator_id string, name string, availability_start timestamp_ntz, availability_end timestamp_ntz")
    new = spark.createDataFrame([("A", "New", None, None), ("B", "B", None, None)], old.schema)
    got = {r["indicator_id"]: (r["name"], r["availability_start"]) for r in tables.upsert_catalog(old, new).collect()}
    assert got == {"A": ("New", datetime(2000, 1, 1)), "B": ("B", None)}
    same = tables.update_availability(old, spark.createDataFrame([("Z", datetime(1999, 1, 1), datetime(2001, 1, 1))], "indicator_id string, first_seen timestamp_ntz, last_seen timestamp_ntz"))
    assert same.first()["availability_start"] == datetime(2000, 1, 1)


def test_replacing_with_nothing_removes_the_rows(spark):
    old = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "parent_id string, value double").withColumn("series_bucket", tables.bucket("parent_id"))
    got = tables.replace_gold(old, spark.createDataFrame([("A",)], "indicator_id string"), old.drop("series_bucket").limit(0))
    assert "A" not in {r["parent_id"] for r in got.collect()}


def test_publishing_leaves_out_observations_without_silver(spark):
    s = series(spark, [1, 2, 3])
    linked = linking.chain_link(s, years(spark))
    silver = s.filter(F.year("timestamp") > 2000).select(F.lit("x").alias("id"), "*", F.lit(None).cast("string").alias("unit"), F.lit("annual").alias("frequency"))
    assert publish.level_records(linked, silver).count() == 2
    assert publish.unmatched(linked, silver).first()["records_failed"] == 1
