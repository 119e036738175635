"""Cutting long lineages with tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own_dir: list[str] = []
_scopes = threading.local()


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or a folder of our own where that is unset (tests)."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not _own_dir:
        _own_dir.append("file://" + tempfile.mkdtemp(prefix="series-shared-"))
    return _own_dir[0]


class Scope:
    """The scratch paths made while it is open; all but the kept ones go when it closes."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []
        self.kept: set[str] = set()

    def keep(self, df: DataFrame) -> DataFrame:
        """``df``, a table made by ``written`` in this scope, stays after it."""
        self.kept.add(self.paths[-1])
        return df

    def close(self) -> None:
        for path in self.paths:
            if path not in self.kept:
                hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                files = hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration())
                files.delete(hadoop_path, True)
                files.cancelDeleteOnExit(hadoop_path)


@contextmanager
def scope(spark: SparkSession) -> Iterator[Scope]:
    """Free the scratch tables of a piece of work once its last result is written; for this thread, innermost scope first."""
    opened = Scope(spark)
    stack = _scopes.__dict__.setdefault("stack", [])
    stack.append(opened)
    try:
        yield opened
    finally:
        stack.remove(opened)
        opened.close()
        if stack:
            stack[-1].paths += sorted(opened.kept)


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder; what is there goes when its scope closes or the application ends."""
    path = f"{shared_dir(spark)}/series-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(hadoop_path)  # only what exists can be marked for deletion
    files.deleteOnExit(hadoop_path)
    if stack := _scopes.__dict__.get("stack"):
        stack[-1].paths.append(path)
    return path


def written(df: DataFrame) -> DataFrame:
    """The table written to the shared folder and read back: it is computed once and outlives any executor."""
    path = scratch(df.sparkSession) + "/rows"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
