"""Incremental ingest: landed payload files as a stream, each micro-batch run through the hops.

The sinks may be repeated, so a batch that is delivered twice leaves the same
tables.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from seriesloom.plans.medallion import run
from seriesloom.shared import scope

SCHEMA = "indicator_id string, page int, payload string"


def ingest(spark: SparkSession, landing: str, catalog: DataFrame, root: str, checkpoint: str, now: Callable[[], datetime]) -> StreamingQuery:
    """Start the stream over Parquet files of payloads in ``landing``; it ends when all files there are done."""

    def each(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            with scope(spark):
                run(spark, batch, catalog, root, now(), run_id=f"stream-{number}")

    stream = spark.readStream.schema(SCHEMA).parquet(landing)
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
