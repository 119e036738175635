"""Appends, and the rows that upserts and replacements leave in the touched buckets of a table; ``versioned`` writes them.

Series are dealt to a fixed number of buckets, so a series and what is derived
from it share a directory and readers of one series prune the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

BUCKETS = 64


def bucket(indicator: str = "indicator_id", buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(indicator), F.lit(buckets)).cast("int")


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None before its first write."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def append_run(df: DataFrame, path: str, run_id: str) -> None:
    """Add a run's rows to an append-only table, as its partition ``run_id``; the same run again replaces its own rows."""
    df.write.mode("overwrite").parquet(f"{path}/run_id={run_id}")


def merged(old: DataFrame, new: DataFrame, keys: list[str], keep: list[str]) -> DataFrame:
    """Old and new rows, one per key: the new one where there is one, with the old one's ``keep`` columns."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    # One sort for both: the oldest row is the first so far, the newest has none after it.
    by_age = Window.partitionBy(*keys).orderBy("_new")
    so_far = by_age.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = both.withColumns({**{f"_{c}": F.first(c).over(so_far) for c in keep}, "_next": F.lead("_new").over(by_age)}).filter("_next IS NULL")
    return out.withColumns({c: F.col(f"_{c}") for c in keep}).select(*old.columns)


def upsert_silver(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """The touched buckets' rows after the upsert on (indicator_id, timestamp); ids and creation times of known rows stay."""
    new = new.withColumn("series_bucket", bucket())
    if old is None:
        return new
    touched = new.select("series_bucket").distinct()
    keep = ["id"] + [c for c in ("created_at",) if c in new.columns]
    return merged(old.join(F.broadcast(touched), "series_bucket", "left_semi").select(*new.columns), new, ["indicator_id", "timestamp"], keep)


def replace_gold(old: DataFrame | None, ids: DataFrame, new: DataFrame, parent: str = "parent_id") -> DataFrame:
    """The touched buckets' rows after all rows of the parents ``ids`` (indicator_id) gave way to ``new``, even to none.

    Levels and derived rows of a series carry its id as ``parent_id`` and share
    its bucket.
    """
    new = new.withColumn("series_bucket", bucket(parent))
    if old is None:
        return new
    touched = ids.select(bucket().alias("series_bucket")).distinct()
    gone = ids.select(F.col("indicator_id").alias(parent)).distinct()
    stay = old.join(F.broadcast(touched), "series_bucket", "left_semi").join(gone, parent, "left_anti")
    return stay.select(*new.columns).unionByName(new)


def upsert_catalog(old: DataFrame, new: DataFrame) -> DataFrame:
    """The catalog after discovery: new values where there are any, but known availability and creation times stay."""
    fixed = {"availability_start", "availability_end", "created_at"}
    o, n = old.alias("o"), new.alias("n")
    joined = o.join(n, F.col("o.indicator_id") == F.col("n.indicator_id"), "full_outer")

    def pick(c: str) -> Column:
        if c == "indicator_id":
            return F.coalesce("n.indicator_id", "o.indicator_id").alias(c)
        if c not in new.columns:
            return F.col(f"o.{c}").alias(c)
        if c in fixed:
            return F.coalesce(f"o.{c}", f"n.{c}").alias(c)
        return F.when(F.col("n.indicator_id").isNotNull(), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)

    return joined.select(*(pick(c) for c in old.columns))


def update_availability(catalog: DataFrame, observed: DataFrame) -> DataFrame:
    """The catalog with the observed ranges (indicator_id, first_seen, last_seen); unknown ids change nothing."""
    out = catalog.join(observed, "indicator_id", "left")
    seen = F.col("first_seen").isNotNull()
    for name, value in (("availability_start", "first_seen"), ("availability_end", "last_seen")):
        out = out.withColumn(name, F.when(seen, F.col(value)).otherwise(F.col(name)))
    return out.select(*catalog.columns)
