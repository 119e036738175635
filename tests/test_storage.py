"""Versioned tables, the catalog's history, and runs that break off."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from seriesloom.plans import journal, medallion
from seriesloom.sinks import dimension, files, tables, versioned
from seriesloom.sources import payload

NOW = datetime(2026, 6, 30)


def rows(spark, *given):
    return spark.createDataFrame(given, "indicator_id string, timestamp timestamp_ntz, value double, series_bucket int")


def told(df):
    return sorted((r["indicator_id"], r["value"]) for r in df.collect())


def day(k):
    return datetime(2020, 1, k)


def test_a_version_replaces_buckets_and_empties_them(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versioned.read(spark, path) is None and versioned.versions(spark, path) == []
    first = rows(spark, ("A", day(1), 1.0, 0), ("B", day(1), 2.0, 1), ("C", day(1), 3.0, 2))
    versioned.commit(first, path, first, "one")
    reader = versioned.read(spark, path)
    touched = spark.createDataFrame([(0,), (1,), (5,)], "series_bucket int")
    second = versioned.commit(rows(spark, ("D", day(1), 4.0, 0)), path, touched, "two")
    # Bucket 1 is emptied, 2 untouched; who read before still sees all of it.
    assert told(versioned.read(spark, path)) == [("C", 3.0), ("D", 4.0)] and second.buckets[1] is None and second.run_id == "two"
    assert told(reader) == [("A", 1.0), ("B", 2.0), ("C", 3.0)] == told(versioned.read(spark, path, 1))
    assert told(versioned.read(spark, path, buckets=[2, 9])) == [("C", 3.0)]
    assert versioned.read(spark, path).columns == first.columns
    plan = versioned.read(spark, path).filter("series_bucket = 2")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(series_bucket" in plan
    versioned.restore(spark, path, 1)
    assert told(versioned.read(spark, path)) == told(reader)
    versioned.restore(spark, path, None)
    assert versioned.read(spark, path).count() == 0 and versioned.versions(spark, path) == [1, 2, 3, 4]
    assert versioned.vacuum(spark, path, keep=1) != [] and versioned.read(spark, path).count() == 0


def test_of_two_writers_the_later_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    one = rows(spark, ("A", day(1), 1.0, 0))
    versioned.commit(one, path, one)
    versioned.commit(one.withColumn("value", F.lit(5.0)), path, one, base=1)
    with pytest.raises(files.Taken):
        versioned.commit(one.withColumn("value", F.lit(7.0)), path, one, base=1)
    assert told(versioned.read(spark, path)) == [("A", 5.0)]
    assert len(files.names(spark, f"{path}/data")) == 2
    with pytest.raises(ValueError, match="touched"):
        versioned.commit(one, path, one.filter("series_bucket = 9"))
    # A write that never got its version leaves no trace for readers, and goes with the next vacuum.
    one.write.partitionBy("series_bucket").parquet(f"{path}/data/write=000000000002-lost")
    assert told(versioned.read(spark, path)) == [("A", 5.0)]
    assert "write=000000000002-lost" in versioned.vacuum(spark, path)
    assert told(versioned.read(spark, path)) == [("A", 5.0)]


def test_a_series_of_many_rows_is_written_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "t")
    many = spark.range(40_000).select(F.lit("A").alias("indicator_id"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("timestamp"), F.col("id").cast("double").alias("value"), F.lit(3).alias("series_bucket"))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        at = versioned.commit(many, path, many)
    finally:
        spark.conf.unset(coalesce)
    parts = [n for n in files.names(spark, f"{path}/data/{at.buckets[3]}/series_bucket=3") if n.startswith("part-")]
    assert len(parts) == 4 and versioned.read(spark, path).count() == 40_000


SCHEMA = "indicator_id string, name string, unit string, availability_start timestamp_ntz, availability_end timestamp_ntz"


def test_a_dimension_keeps_what_was_current_before(spark):
    t1, t2, t3 = datetime(2020, 1, 1), datetime(2021, 1, 1), datetime(2022, 1, 1)
    first = dimension.revised(None, spark.createDataFrame([("A", "Old", None, None, None), ("B", "B", "USD", None, None)], SCHEMA), t1)
    ranged = dimension.observed(first, spark.createDataFrame([("A", t1, t2), ("Z", t1, t2)], "indicator_id string, first_seen timestamp_ntz, last_seen timestamp_ntz"), t1)
    assert {r["indicator_id"] for r in ranged.collect()} == {"A", "B"}
    found = spark.createDataFrame([("A", "New", None, None, None), ("C", "C", None, None, None)], SCHEMA)
    second = dimension.revised(ranged, found, t2)
    for again in (second, dimension.revised(second, found, t3)):
        got = {(r["indicator_id"], r["name"], r["valid_from"], r["valid_to"], r["availability_start"], r["created_at"]) for r in again.collect()}
        assert got == {("A", "Old", t1, t2, t1, t1), ("A", "New", t2, None, t1, t1), ("B", "B", t1, None, None, t1), ("C", "C", t2, None, None, t2)}
    assert sorted(r["name"] for r in dimension.as_of(second, t1).collect()) == ["B", "Old"]
    # Null is a value: a unit that goes makes a new row; so does a column that wasn't known before.
    third = dimension.revised(second, spark.createDataFrame([("B", "B", None)], "indicator_id string, name string, unit string"), t3)
    assert {(r["unit"], r["valid_to"]) for r in third.filter("indicator_id = 'B'").collect()} == {("USD", t3), (None, None)}
    wider = dimension.revised(second, found.filter("indicator_id = 'C'").withColumn("domain", F.lit("gdp")), t3)
    assert {(r["domain"], r["valid_to"]) for r in wider.filter("indicator_id = 'C'").collect()} == {(None, t3), ("gdp", None)}


ROW = '{"indicator":{"id":"%s","value":"N (USD)"},"date":"%d","value":%s,"unit":"","obs_status":""}'


def landing(spark, years, page=1, pages=2, code="A"):
    body = ",".join(ROW % (code, y, 100.0 + y) for y in years)
    return spark.createDataFrame([(code, page, f'[{{"pages":{pages}}},[{body}]]', 200)], "indicator_id string, page int, payload string, http_status_code int")


def catalog_of(spark):
    return spark.createDataFrame([("A", "Series A", "gdp", [])], "indicator_id string, name string, domain string, base_years array<int>")


def layers(spark, root):
    out = {}
    for t in ("silver_cleaned", "gold_analytical"):
        stored = versioned.read(spark, f"{root}/{t}")
        out[t] = sorted((r["indicator_id"], r["timestamp"], r["value"], r["created_at"]) for r in stored.collect())
    return out


def test_a_run_that_broke_off_is_undone(spark, tmp_path):
    root, catalog = str(tmp_path), catalog_of(spark)
    medallion.run(spark, landing(spark, range(2000, 2004)), catalog, root, NOW, "one")
    before = layers(spark, root)
    assert len(before["silver_cleaned"]) == 4 and len(before["gold_analytical"]) == 7 and journal.state(spark, root, "one")[0] == "complete"
    bronze = spark.read.parquet(f"{root}/bronze_raw").first()
    assert (bronze["source_name"], bronze["source_type"], bronze["http_status_code"], bronze["collection_timestamp"], bronze["request_url"]) == ("landed", "file", 200, NOW, None)
    # The driver dies once silver is written.
    later = landing(spark, range(2004, 2006), page=2)
    journal.begin(spark, root, "two", NOW)
    bronze = medallion.landed(later, "two", NOW)
    tables.append_run(bronze, f"{root}/bronze_raw", "two")
    fresh = medallion.stamped(medallion.to_silver(bronze.select("indicator_id", "page", "payload", "bronze_id"), NOW).rows, NOW)
    at = versioned.version(spark, f"{root}/silver_cleaned")
    medallion.store_silver(versioned.read(spark, f"{root}/silver_cleaned"), fresh, root, "two", at.number)
    assert len(layers(spark, root)["silver_cleaned"]) == 6 and journal.open_runs(spark, root) == ["two"]
    assert journal.recover(spark, root, "two") and not journal.recover(spark, root, "two")
    assert layers(spark, root) == before and journal.open_runs(spark, root) == []
    failed = journal.audit(spark, root).filter("run_id = 'two'").collect()
    assert [(r["status"], r["error_message"]) for r in failed] == [("failed", "the run broke off")]
    assert spark.read.parquet(f"{root}/bronze_raw").filter("run_id = 'two'").count() == 0
    # Running it again gives what it would have given; what was known keeps its time of creation.
    medallion.run(spark, later, catalog, root, datetime(2027, 1, 1), "two")
    after = layers(spark, root)
    assert len(after["silver_cleaned"]) == 6 and set(before["silver_cleaned"]) < set(after["silver_cleaned"])
    now = medallion.catalog_now(spark, root).collect()
    assert [(r["indicator_id"], r["availability_start"], r["availability_end"]) for r in now] == [("A", datetime(2000, 12, 31), datetime(2005, 12, 31))]
    log = journal.audit(spark, root).filter("run_id = 'two'").collect()
    assert {r["target_layer"] for r in log} == {"silver", "gold"} and all(r["status"] == "success" and r["duration_seconds"] > 0 for r in log)
    # Replaying stored payloads writes and audits; an id that isn't stored writes nothing.
    ids = spark.read.parquet(f"{root}/bronze_raw").select("bronze_id")
    medallion.replay(spark, root, ids, NOW, "again")
    assert [r[:3] for r in layers(spark, root)["silver_cleaned"]] == [r[:3] for r in after["silver_cleaned"]]
    assert journal.audit(spark, root).filter("run_id = 'again'").first()["transformation_type"] == "replay"
    with pytest.raises(LookupError):
        medallion.replay(spark, root, spark.createDataFrame([("none",)], "bronze_id string"), NOW, "lost")
    assert journal.audit(spark, root).filter("run_id = 'lost'").first()["status"] == "failed"


def test_a_hop_that_raises_leaves_a_failed_row(spark, tmp_path, monkeypatch):
    root, catalog = str(tmp_path), catalog_of(spark)

    def broken(*_):
        raise OSError("disk full")

    monkeypatch.setattr(medallion, "store_gold", broken)
    with pytest.raises(OSError, match="disk full"):
        medallion.run(spark, landing(spark, range(2000, 2004)), catalog, root, NOW, "one")
    assert versioned.read(spark, f"{root}/silver_cleaned").count() == 0 and journal.state(spark, root, "one")[0] == "recovered"
    assert [(r["status"], r["error_message"]) for r in journal.audit(spark, root).collect()] == [("failed", "OSError: disk full")]


def test_pages_past_the_count_stay_out_of_a_run(spark, tmp_path):
    landed = landing(spark, [2000, 2001], 1, 1).unionByName(landing(spark, [2002], 7, 1))
    silver = medallion.to_silver(landed, NOW)
    assert silver.rows.count() == 2
    assert [tuple(r) for r in silver.quarantine.collect()] == [("A", 7, "page", "page 7 of 1")]
    pages, beyond = payload.within_pages(payload.split_envelopes(landing(spark, [2000], 1, 500).unionByName(landing(spark, [2001], 101, 500))).good)
    assert pages.count() == 1 and beyond.first()["message"] == "page 101 of 100"
    assert json.loads(medallion.landed(landed, "r", NOW).first()["metadata"])["page"] == 1


def test_a_run_frees_its_scratch_tables(spark, tmp_path):
    from seriesloom import shared

    made = []
    with shared.scope(spark) as outer:
        outcomes = medallion.run(spark, landing(spark, range(2000, 2003)), catalog_of(spark), str(tmp_path), NOW, "one")
        assert outcomes.count() == 1 and len(outer.paths) == 1
        with shared.scope(spark) as inner:
            kept, gone = inner.keep(shared.written(outcomes)), shared.written(outcomes)
            made = list(inner.paths)
        assert kept.count() == 1 and [files.exists(spark, p) for p in made] == [True, False] and gone is not None
