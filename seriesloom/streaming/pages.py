"""Pages of a series that come one by one, in any order, put together before they are used.

Each series' pages wait in the state of a stream until its first page has come
and with it all pages that its meta asks for.  They then leave together.  A page
past that count, or past the guard, leaves as one that doesn't count; pages of
a series for which nothing came for too long leave as incomplete, with the next
batch that brings any page.  State is one row per lot of series by hash, with
the pages of those of its series that wait, each of no more pages than the
guard: a call and a state update per series would cost more than all else.  A
batch rewrites the lots that it has pages of.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from seriesloom import constants as K
from seriesloom.plans.medallion import run
from seriesloom.shared import scope
from seriesloom.sinks import tables
from seriesloom.streaming.ingest import SCHEMA

COMPLETE, BEYOND, INCOMPLETE = "complete", "page", "incomplete"
#: Lots of series by hash.  A stream goes on from its checkpoint only with the number that it began with.
LOTS = 1 << 12
_OUTPUT = "indicator_id string, page int, payload string, status string"
_STATE = "ids array<string>, pages array<int>, payloads array<string>, told array<int>, until array<bigint>"


def _assembler(max_pages: int, wait_ms: int) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    def step(key: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now, out = state.getCurrentProcessingTimeMs(), []
        # By series: its pages so far, how many it has if known, and when it has waited too long.
        waiting: dict[str, tuple[dict[int, str], int | None, int]] = {}
        if state.exists:
            for indicator, page, payload, told, until in zip(*state.get, strict=True):
                waiting.setdefault(indicator, ({}, told, until))[0][page] = payload
        # Of two payloads of one page that of the later batch counts, and of one batch the greater.
        came: dict[str, dict[int, tuple[tuple[bool, str], Any]]] = {}
        for batch in batches:
            for indicator, page, payload, told in zip(*(batch[c].tolist() for c in ("indicator_id", "page", "payload", "told")), strict=True):
                own, page, rank = came.setdefault(indicator, {}), int(page), (payload is None, payload or "")
                if page not in own or rank > own[page][0]:
                    own[page] = rank, told
        for indicator, own in came.items():
            held, told, _ = waiting.pop(indicator, ({}, None, 0))
            for page, ((missing, payload), pages_told) in own.items():
                held[page] = None if missing else payload
                if page == 1:
                    told = 1 if pd.isna(pages_told) else int(pages_told)
            most = max_pages if told is None else min(told, max_pages)
            out += ((indicator, p, held.pop(p), BEYOND) for p in sorted(held) if p > most)
            if told is not None and all(p in held for p in range(1, most + 1)):
                out += ((indicator, p, held[p], COMPLETE) for p in sorted(held))
            elif held:
                waiting[indicator] = held, told, now + wait_ms
        for indicator in [i for i, (_, _, until) in waiting.items() if until < now and i not in came]:
            held = waiting.pop(indicator)[0]
            out += ((indicator, p, held[p], INCOMPLETE) for p in sorted(held))
        if waiting:
            rows = [(i, p, payload, told, until) for i, (held, told, until) in waiting.items() for p, payload in held.items()]
            state.update(tuple(map(list, zip(*rows, strict=True))))
            state.setTimeoutDuration(max(1, min(until for _, _, until in waiting.values()) - now))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=["indicator_id", "page", "payload", "status"])

    return step


def assembled(pages: DataFrame, wait_ms: int = 3_600_000, max_pages: int = K.MAX_PAGES, lots: int = LOTS) -> DataFrame:
    """(indicator_id, page, payload, status) of a stream of payloads (indicator_id, page, payload); see the module."""
    v = F.try_parse_json("payload")
    told = F.coalesce(F.try_variant_get(v, "$[0].pages", "int"), F.try_variant_get(v, "$.meta.pages", "int"))
    keyed = pages.select(F.pmod(F.xxhash64("indicator_id"), F.lit(lots)).alias("lot"), "indicator_id", "page", "payload", told.alias("told"))
    return keyed.groupBy("lot").applyInPandasWithState(_assembler(max_pages, wait_ms), _OUTPUT, _STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)


def started(writer: DataStreamWriter, spark: SparkSession) -> StreamingQuery:
    """Start a stream of ``assembled`` pages.  Timeouts would make Spark run empty batches without end; so it runs none."""
    empty = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(empty)
    spark.conf.set(empty, "false")
    try:
        return writer.start()
    finally:
        spark.conf.set(empty, before)


def ingest_pages(spark: SparkSession, landing: str, catalog: DataFrame, root: str, checkpoint: str, now: Callable[[], datetime], wait_ms: int = 3_600_000, files_per_batch: int = 1000) -> StreamingQuery:
    """Start the stream over Parquet files of payloads in ``landing``: series whose pages are all there go through the hops, other pages to quarantine; it runs until it is stopped."""

    def each(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            ready = batch.filter(F.col("status") == COMPLETE).drop("status")
            if not ready.isEmpty():
                with scope(spark):
                    run(spark, ready, catalog, root, now(), run_id=f"pages-{number}")
            rest = batch.filter(F.col("status") != COMPLETE)
            told = F.when(F.col("status") == BEYOND, "a page past the count").otherwise("pages are missing")
            tables.append_run(rest.select("indicator_id", "page", F.col("status").alias("error_type"), told.alias("message")), f"{root}/quarantine", f"rest-{number}")
        finally:
            batch.unpersist()

    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    return started(assembled(stream, wait_ms).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint), spark)
