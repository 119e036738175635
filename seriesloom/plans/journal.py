"""What a run is about to do and what of it is done, so that a run that broke off can be undone.

Before a run writes, it notes the versions of the tables it will replace; after
each table it notes that this one is done, and at last that all are.  ``recover``
brings the tables of a run that has no such end back to the noted versions,
takes away the rows it appended, and leaves one audit row that says it failed.
"""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from seriesloom.sinks import files, versioned

VERSIONED = ("silver_cleaned", "gold_analytical", "indicator_catalog")
APPENDED = ("bronze_raw", "data_collection_log", "chain_linking_log", "quarantine")
LOG = "transformation_log"
LOG_COLUMNS = (
    "indicator_id string, source_layer string, target_layer string, transformation_type string, records_processed long, records_written long, records_failed long, "
    "status string, error_message string, metadata string, started_at timestamp_ntz, duration_seconds double"
)


def _path(root: str, run_id: str, step: str) -> str:
    return f"{root}/_journal/{run_id}/{step}.json"


def begin(spark: SparkSession, root: str, run_id: str, at: datetime) -> None:
    """Note the versions that the run starts from; a run id that is run again starts a new entry."""
    if files.exists(spark, _path(root, run_id, "begun")) and not files.exists(spark, _path(root, run_id, "ended")):
        recover(spark, root, run_id)
    files.delete(spark, f"{root}/_journal/{run_id}")
    before = {t: v.number if (v := versioned.version(spark, f"{root}/{t}")) else None for t in VERSIONED}
    files.put_text(spark, _path(root, run_id, "begun"), json.dumps({"at": at.isoformat(), "versions": before}))


def done(spark: SparkSession, root: str, run_id: str, table: str) -> None:
    files.put_text(spark, _path(root, run_id, f"done-{table}"), "{}", replace=True)


def end(spark: SparkSession, root: str, run_id: str, how: str = "complete") -> None:
    files.put_text(spark, _path(root, run_id, "ended"), json.dumps({"how": how}), replace=True)


def state(spark: SparkSession, root: str, run_id: str) -> tuple[str, list[str]]:
    """(unknown, open or how it ended; the tables that are done)."""
    names = files.names(spark, f"{root}/_journal/{run_id}")
    if "begun.json" not in names:
        return "unknown", []
    tables = [n.removeprefix("done-").removesuffix(".json") for n in names if n.startswith("done-")]
    return (json.loads(files.get_text(spark, _path(root, run_id, "ended")))["how"] if "ended.json" in names else "open"), tables


def open_runs(spark: SparkSession, root: str) -> list[str]:
    """Runs that began and didn't end; one that is still under way is among them."""
    return [r for r in files.names(spark, f"{root}/_journal") if state(spark, root, r)[0] == "open"]


def failed_row(spark: SparkSession, root: str, run_id: str, at: datetime, message: str, seconds: float | None = None) -> None:
    """The audit row of a run that failed as a whole, in place of the run's other audit rows."""
    row = (None, "landed", "gold", "run", 0, 0, 0, "failed", message[:2000], None, at, seconds)
    spark.createDataFrame([row], LOG_COLUMNS).coalesce(1).write.mode("overwrite").parquet(f"{root}/{LOG}/run_id={run_id}")


def recover(spark: SparkSession, root: str, run_id: str, message: str = "the run broke off") -> bool:
    """Undo a run that has no end; False if there is nothing to undo.  No other run may write the tables meanwhile."""
    if state(spark, root, run_id)[0] != "open":
        return False
    told = json.loads(files.get_text(spark, _path(root, run_id, "begun")))
    for table, number in told["versions"].items():
        newest = versioned.version(spark, f"{root}/{table}")
        # Only what this run wrote is undone.
        if newest and newest.number != number and newest.run_id == run_id:
            versioned.restore(spark, f"{root}/{table}", number, f"recover {run_id}")
    for table in APPENDED:
        files.delete(spark, f"{root}/{table}/run_id={run_id}")
    failed_row(spark, root, run_id, datetime.fromisoformat(told["at"]), message)
    end(spark, root, run_id, "recovered")
    return True


def audit(spark: SparkSession, root: str) -> DataFrame:
    """The audit rows of all runs, with their run_id."""
    return spark.read.parquet(f"{root}/{LOG}")
