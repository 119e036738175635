"""Small text files in any file system that Spark knows; each appears whole or not at all."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import SparkSession


class Taken(RuntimeError):
    """The file is there already: another writer was first."""


def _at(spark: SparkSession, path: str) -> tuple[Any, Any]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _at(spark, path)
    return files.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, sorted; none where there is no folder."""
    files, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def put_text(spark: SparkSession, path: str, text: str, replace: bool = False) -> None:
    """Write the file by a rename, so that readers never see a part of it."""
    files, where = _at(spark, path)
    if not replace and files.exists(where):
        raise Taken(path)
    _, temporary = _at(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = files.create(temporary, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if replace:
        files.delete(where, False)
    if not files.rename(temporary, where):
        files.delete(temporary, False)
        raise Taken(path)


def get_text(spark: SparkSession, path: str) -> str:
    files, where = _at(spark, path)
    stream = files.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    files, where = _at(spark, path)
    files.delete(where, True)
