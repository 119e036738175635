"""Bucketed Parquet tables in versions, for writes that replace or empty buckets.

A write puts the rows of the touched buckets into a new folder and then adds a
manifest, a small file that names for every bucket the folder it is read from,
or none for a bucket that was emptied.  The manifest appears by one rename, so
a reader sees the version before or the one after; files are never changed,
and a DataFrame that was read from an older version stays whole until
``vacuum`` removes what no kept version names.  Of two writers that began from
one version the later fails with ``Taken``.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from seriesloom.sinks import files
from seriesloom.sinks.files import Taken

BUCKET = "series_bucket"


@dataclass(frozen=True)
class Version:
    """A version of a table: its number, the run that wrote it, its columns, and each bucket's folder (None: emptied)."""

    number: int
    run_id: str
    schema: T.StructType
    buckets: dict[int, str | None]


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the versions there are, ascending."""
    return [int(n.removesuffix(".json")) for n in files.names(spark, f"{path}/_versions") if n.endswith(".json")]


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """A version, by default the newest; None before the first write."""
    if number is None:
        known = versions(spark, path)
        if not known:
            return None
        number = known[-1]
    told = json.loads(files.get_text(spark, f"{path}/_versions/{number:012d}.json"))
    return Version(number, told["run_id"], T.StructType.fromJson(told["schema"]), {int(k): v for k, v in told["buckets"].items()})


def _add(spark: SparkSession, path: str, new: Version) -> None:
    told = {"run_id": new.run_id, "schema": new.schema.jsonValue(), "buckets": {str(k): v for k, v in sorted(new.buckets.items())}}
    files.put_text(spark, f"{path}/_versions/{new.number:012d}.json", json.dumps(told))


def read(spark: SparkSession, path: str, number: int | None = None, buckets: list[int] | None = None) -> DataFrame | None:
    """The table's rows at a version, by default the newest; with ``buckets`` only those; None before the first write."""
    at = version(spark, path, number)
    if at is None:
        return None
    wanted = at.buckets if buckets is None else {k: at.buckets.get(k) for k in buckets}
    folders = [f"{path}/data/{folder}/{BUCKET}={k}" for k, folder in sorted(wanted.items()) if folder]
    if not folders:
        return spark.createDataFrame([], at.schema)
    return spark.read.schema(at.schema).option("basePath", f"{path}/data").parquet(*folders).select(*at.schema.names)


def commit(rows: DataFrame, path: str, touched: DataFrame, run_id: str = "", base: int | None = None, order: tuple[str, ...] = ("indicator_id", "timestamp")) -> Version:
    """Replace the ``touched`` buckets (a column series_bucket) by ``rows``; a touched bucket without rows is emptied.

    ``base``: the version that the rows were made from, by default the newest;
    if there is a newer one by now, nothing changes and ``Taken`` is raised.
    Rows are dealt by ranges of bucket and ``order``, so one series of many
    rows is written by many tasks, in files that cover few series and periods.
    """
    spark = rows.sparkSession
    before = version(spark, path, base)
    number = before.number + 1 if before else 1
    # At most as many rows as a table has buckets.
    emptied = {r[0]: None for r in touched.select(BUCKET).distinct().collect()}
    folder = f"write={number:012d}-{uuid.uuid4().hex[:12]}"
    keys = [BUCKET, *order]
    rows.repartitionByRange(*keys).sortWithinPartitions(*keys).write.option("compression", "zstd").partitionBy(BUCKET).parquet(f"{path}/data/{folder}")
    present = [int(n.partition("=")[2]) for n in files.names(spark, f"{path}/data/{folder}") if n.startswith(f"{BUCKET}=")]
    if not set(present) <= set(emptied):
        raise ValueError("rows outside the touched buckets")
    new = Version(number, run_id, rows.schema, {**(before.buckets if before else {}), **emptied, **{k: folder for k in present}})
    try:
        _add(spark, path, new)
    except Taken:
        files.delete(spark, f"{path}/data/{folder}")
        raise
    return new


def restore(spark: SparkSession, path: str, number: int | None, run_id: str = "") -> None:
    """Make the table what it was at a version (None: empty), as a newer version; later versions stay readable."""
    now = version(spark, path)
    if now is None or now.number == number:
        return
    then = version(spark, path, number) if number is not None else None
    _add(spark, path, Version(now.number + 1, run_id, then.schema if then else now.schema, then.buckets if then else {k: None for k in now.buckets}))


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Forget all but the newest ``keep`` versions and delete the folders that none of them names; returns those."""
    known = versions(spark, path)
    kept = [version(spark, path, n) for n in known[-keep:]]
    named = {f for v in kept for f in v.buckets.values() if f}
    # Folders newer than the newest version may belong to a write under way.
    newest = f"write={known[-1]:012d}" if known else ""
    gone = [f for f in files.names(spark, f"{path}/data") if f.startswith("write=") and f not in named and f[: len(newest)] <= newest]
    for n in known[:-keep]:
        files.delete(spark, f"{path}/_versions/{n:012d}.json")
    for f in gone:
        files.delete(spark, f"{path}/data/{f}")
    return gone
