"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows turned into Python objects at once; bounds a worker's memory.
SLICE_ROWS = 128

_own_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or one of our own where that is unset (tests)."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not _own_dir:
        _own_dir.append("file://" + tempfile.mkdtemp(prefix="spark-shared-"))
    return _own_dir[0]


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    This cuts the lineage with files that outlive any executor, and later
    readers prune columns.  The files go when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def id_remainder(col: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text (crc32 0)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % F.lit(divisor)


def code_points(text: str) -> np.ndarray:
    """The text's code points as uint32."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
