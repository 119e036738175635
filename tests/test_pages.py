"""Pages that come out of order in a stream."""

import itertools
import os
import random
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesloom import queries
from seriesloom.plans import medallion
from seriesloom.sinks import versioned
from seriesloom.streaming import pages
from tests.test_storage import catalog_of, landing

NOW = datetime(2026, 6, 30)


def told(rows):
    return sorted((r["indicator_id"], r["page"], r["status"]) for r in rows)


def test_pages_wait_for_each_other(spark, tmp_path):
    schema = "indicator_id string, page int, payload string"
    body = '[{"pages":%d},[]]'
    batches = [
        [("A", 2, body % 2), ("B", 1, body % 1), ("C", 3, body % 2), ("E", 1, "42")],
        [("A", 1, body % 2), ("C", 1, body % 2), ("D", 2, body % 2), ("F", 1, '{"meta":{"pages":2},"rows":[]}')],
        [("C", 2, body % 2), ("A", 1, body % 1), ("F", 2, "{}"), ("G", 101, body % 500)],
    ]
    landed = str(tmp_path / "in")
    seen: list[list] = []
    spark.createDataFrame(batches[0], schema).coalesce(1).write.parquet(landed)
    stream = spark.readStream.schema(schema).parquet(landed)
    writer = pages.assembled(stream).writeStream.foreachBatch(lambda df, _: seen.append(told(df.collect())))
    query = pages.started(writer.option("checkpointLocation", str(tmp_path / "ck")), spark)
    try:
        query.processAllAvailable()
        for batch in batches[1:]:
            spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(landed)
            query.processAllAvailable()
        every = [x for batch in seen for x in batch]
        # A page that is sent again starts anew; one past the guard leaves at once.
        assert sorted(every) == sorted([
            ("B", 1, "complete"), ("E", 1, "complete"), ("A", 1, "complete"), ("A", 2, "complete"), ("C", 3, "page"), ("C", 1, "complete"), ("C", 2, "complete"), ("A", 1, "complete"),
            ("F", 1, "complete"), ("F", 2, "complete"), ("G", 101, "page"),
        ])
    finally:
        query.stop()


def test_pages_that_wait_too_long_leave(spark, tmp_path):
    schema, landed = "indicator_id string, page int, payload string", str(tmp_path / "in")
    seen: list = []
    spark.createDataFrame([("D", 2, "x"), ("D", 3, "y")], schema).coalesce(1).write.parquet(landed)
    writer = pages.assembled(spark.readStream.schema(schema).parquet(landed), wait_ms=1).writeStream.foreachBatch(lambda df, _: seen.extend(told(df.collect())))
    query = pages.started(writer.option("checkpointLocation", str(tmp_path / "ck")), spark)
    try:
        query.processAllAvailable()
        assert seen == []
        spark.createDataFrame([("H", 1, "[{}]")], schema).coalesce(1).write.mode("append").parquet(landed)
        query.processAllAvailable()
        assert sorted(seen) == [("D", 2, "incomplete"), ("D", 3, "incomplete"), ("H", 1, "complete")]
    finally:
        query.stop()


def test_a_run_follows_when_the_pages_are_there(spark, tmp_path):
    root, landed, catalog = str(tmp_path / "root"), str(tmp_path / "in"), catalog_of(spark)
    one, two = landing(spark, range(2000, 2003), 1), landing(spark, range(2003, 2006), 2)
    beyond = landing(spark, [2010], 9)
    both = str(tmp_path / "whole")
    medallion.run(spark, one.unionByName(two), catalog, both, NOW, "all")
    for batch in (two.unionByName(beyond), one):
        batch.drop("http_status_code").coalesce(1).write.mode("append").parquet(landed)
    query = pages.ingest_pages(spark, landed, catalog, root, str(tmp_path / "ck"), lambda: NOW, files_per_batch=1)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    rows = [sorted((r["timestamp"], r["value"]) for r in versioned.read(spark, f"{r}/gold_analytical").filter(F.col("indicator_id") == "A").collect()) for r in (root, both)]
    assert rows[0] == rows[1] and len(rows[0]) == 6
    assert [(r["page"], r["error_type"]) for r in spark.read.parquet(f"{root}/quarantine").collect()] == [(9, "page")]


class Clocked:
    """The state of a lot, with a clock that the test sets."""

    def __init__(self):
        self.now, self.held, self.timeout = 0, None, None

    exists = property(lambda self: self.held is not None)
    get = property(lambda self: self.held)

    def getCurrentProcessingTimeMs(self):
        return self.now

    def setTimeoutDuration(self, ms):
        assert ms > 0
        self.timeout = self.now + ms

    def update(self, held):
        self.held = held

    def remove(self):
        self.held = self.timeout = None


def stepped(step, state, now, rows):
    """What the lot puts out at a time, rows being (indicator, page, payload, told)."""
    state.now = now
    frames = [pd.DataFrame(rows, columns=["indicator_id", "page", "payload", "told"])] if rows else []
    return sorted(tuple(r) for frame in step((0,), iter(frames), state) for r in frame.itertuples(index=False))


def test_series_of_a_lot_wait_each_for_itself():
    state, step = Clocked(), pages._assembler(100, 10)
    assert stepped(step, state, 0, [("A", 2, "a2", None), ("B", 3, "b3", None)]) == []
    assert stepped(step, state, 5, [("C", 2, "c2", None), ("B", 2, "b2", None)]) == []
    # A has waited too long; B came again since, and C later; D comes whole.
    assert state.timeout == 10
    assert stepped(step, state, 11, [("D", 1, "d1", None)]) == [("A", 2, "a2", "incomplete"), ("D", 1, "d1", "complete")]
    # C is overdue as well, but its page is there; nothing came for B.
    assert stepped(step, state, 16, [("C", 1, "c1", 2)]) == [("B", 2, "b2", "incomplete"), ("B", 3, "b3", "incomplete"), ("C", 1, "c1", "complete"), ("C", 2, "c2", "complete")]
    assert not state.exists


def test_of_two_payloads_the_greater_of_the_later_batch_counts():
    state, step = Clocked(), pages._assembler(100, 10)
    assert stepped(step, state, 0, [("A", 2, "z", None)]) == []
    came = [("A", 2, "x", None), ("A", 2, "y", None), ("A", 1, "a", 9), ("A", 1, "b", 2)]
    for rows in itertools.permutations(came):
        again = Clocked()
        again.held = state.held
        assert stepped(step, again, 1, list(rows)) == [("A", 1, "b", "complete"), ("A", 2, "y", "complete")]


@pytest.mark.parametrize("lots", [3, pages.LOTS])
def test_lots_of_series_in_the_state(spark, tmp_path, lots):
    schema, landed = "indicator_id string, page int, payload string", str(tmp_path / "in")
    counts = {f"S{i}": i % 4 + 1 for i in range(200)}
    every = [(s, p, '[{"pages":%d},["%s %d"]]' % (n, s, p)) for s, n in counts.items() for p in range(1, n + 1)]
    random.Random(4).shuffle(every)
    batches = [every[:250], every[250:400], every[400:]]
    seen: dict[int, list] = {}
    held = []
    for batch in batches:
        # Each batch in a run of its own, from the checkpoint of the one before.
        spark.createDataFrame(batch, schema).repartition(3).write.mode("append").parquet(landed)
        writer = pages.assembled(spark.readStream.schema(schema).parquet(landed), lots=lots).writeStream.foreachBatch(lambda df, n: seen.setdefault(n, []).extend(map(tuple, df.collect())))
        query = pages.started(writer.option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True), spark)
        query.awaitTermination()
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    there: set = set()
    for n, batch in enumerate(batches):
        before = {s for s, k in counts.items() if all((s, p) in there for p in range(1, k + 1))}
        there |= {(s, p) for s, p, _ in batch}
        done = {s for s, k in counts.items() if all((s, p) in there for p in range(1, k + 1))} - before
        assert sorted(seen.get(n, [])) == sorted((s, p, payload, "complete") for s, p, payload in every if s in done)
    assert max(held) <= lots and held[-1] == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables here")
def test_a_landed_batch_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "scratch", lambda _: str(tmp_path))
    merged = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merged, "false")
    try:
        queries.streamed_pages(spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.unset(merged)
    assert len(list((tmp_path / "landed").glob("*.parquet"))) > 3
    assert len(list((tmp_path / "out").glob("batch=*"))) == 3
