"""A dimension with one current row per key and the rows that were current before."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns that this module adds to a dimension's own.
HISTORY = ("created_at", "updated_at", "valid_from", "valid_to")


def current(history: DataFrame) -> DataFrame:
    """The rows that hold now."""
    return history.filter("valid_to IS NULL")


def as_of(history: DataFrame, at: datetime) -> DataFrame:
    """The rows that held at a time."""
    when = F.lit(at).cast("timestamp_ntz")
    return history.filter((F.col("valid_from") <= when) & (F.col("valid_to").isNull() | (F.col("valid_to") > when)))


def revised(history: DataFrame | None, found: DataFrame, at: datetime, key: str = "indicator_id", kept: tuple[str, ...] = ("availability_start", "availability_end")) -> DataFrame:
    """The history after ``found`` (one row per key) was seen at a time.

    A key whose columns differ, null being a value, gets a new current row,
    and its former one ends.  Columns in ``kept`` don't come from discovery:
    the known value stays, and they alone make no new row.  A key that wasn't
    found stays as it is.  Seeing the same rows again changes nothing.
    """
    now = F.lit(at).cast("timestamp_ntz")
    own = [c for c in found.columns if c != key]
    if history is None:
        nothing = F.lit(None).cast("timestamp_ntz")
        return found.select(key, *own, now.alias("created_at"), now.alias("updated_at"), now.alias("valid_from"), nothing.alias("valid_to"))
    more = [c for c in history.columns if c not in {key, *own, *HISTORY}]
    o, n = current(history).alias("o"), found.alias("n")
    both = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    old, new = F.col(f"o.{key}").isNotNull(), F.col(f"n.{key}").isNotNull()
    differs = F.lit(False)
    for c in own:
        if c in history.columns and c not in kept:
            differs = differs | ~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
        elif c not in kept:
            differs = differs | F.col(f"n.{c}").isNotNull()
    fields = [key, *own, *more, *HISTORY]

    def value(c: str, fresh: bool) -> Column:
        known = F.col(f"o.{c}") if c in history.columns else F.lit(None).cast(found.schema[c].dataType)
        if c == key:
            return F.coalesce(f"o.{c}", f"n.{c}")
        if c == "valid_from":
            return now if fresh else known
        if c == "created_at":
            return F.coalesce(known, now) if fresh else known
        if c == "updated_at":
            return now if fresh else known
        if c == "valid_to":
            return F.lit(None).cast("timestamp_ntz")
        if c in more or not fresh:
            return known
        return F.coalesce(known, F.col(f"n.{c}")) if c in kept else F.col(f"n.{c}")

    def row(fresh: bool, ends: bool = False) -> Column:
        return F.struct(*((now if ends and c == "valid_to" else value(c, fresh)).alias(c) for c in fields))

    stays = F.array(row(False))
    changes = F.array(row(False, ends=True), row(True))
    rows = F.when(~new, stays).when(~old, F.array(row(True))).when(differs, changes).otherwise(stays)
    live = both.select(F.explode(rows).alias("r")).select("r.*")
    past = history.filter("valid_to IS NOT NULL")
    return live.unionByName(past, allowMissingColumns=True)


def observed(history: DataFrame, ranges: DataFrame, at: datetime, key: str = "indicator_id") -> DataFrame:
    """The history with the observed ranges (key, first_seen, last_seen) in the current rows; unknown keys change nothing."""
    now = F.lit(at).cast("timestamp_ntz")
    live = F.col("valid_to").isNull() & F.col("first_seen").isNotNull()
    moved = live & ~(F.col("availability_start").eqNullSafe(F.col("first_seen")) & F.col("availability_end").eqNullSafe(F.col("last_seen")))
    out = history.join(ranges, key, "left").withColumn("_moved", moved)
    return out.withColumns({
        "availability_start": F.when(F.col("_moved"), F.col("first_seen")).otherwise(F.col("availability_start")),
        "availability_end": F.when(F.col("_moved"), F.col("last_seen")).otherwise(F.col("availability_end")),
        "updated_at": F.when(F.col("_moved"), now).otherwise(F.col("updated_at")),
    }).select(*history.columns)
