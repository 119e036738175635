"""As-of joins: for each row the nearest one before or after it in its series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, *, on: str, keys: tuple[str, ...] = ("indicator_id",), direction: str = "backward", exact: bool = True) -> DataFrame:
    """The rows of ``left`` with ``matched``: of the right rows with the same keys the last one at or before ``on`` ("forward": the first at or after), or null.

    ``exact``: whether a right row at the same place counts.  Both sides become
    one table that is sorted once by keys and place, so rows are as many as
    both sides have, whatever number of them meet.  Of right rows at one place
    the one that is last in order of its columns counts (forward: the first).
    Left rows whose key or place is null match nothing; right rows without a
    place are left out.
    """
    if direction not in ("backward", "forward"):
        raise ValueError("direction must be backward or forward")
    clash = {"matched", "_side", "_left", "_right", *(f"_key{k}" for k in range(len(keys)))} & set(left.columns)
    if clash:
        raise ValueError(f"columns of that name are taken: {sorted(clash)}")
    key = [f"_key{k}" for k in range(len(keys))]
    forward = direction == "forward"
    # In the order of reading, right rows that may match come before the left row at their place.
    first, second = (0, 1) if exact else (1, 0)
    lefts = left.select(*(F.col(k).alias(n) for k, n in zip(keys, key, strict=True)), F.col(on).alias("_at"), F.lit(second).alias("_side"), F.struct(*left.columns).alias("_left"))
    rights = right.filter(F.col(on).isNotNull()).select(*(F.col(k).alias(n) for k, n in zip(keys, key, strict=True)), F.col(on).alias("_at"), F.lit(first).alias("_side"), F.struct(*right.columns).alias("_right"))
    both = lefts.unionByName(rights, allowMissingColumns=True)
    place, among = (F.desc("_at"), F.desc("_right")) if forward else (F.asc("_at"), F.asc("_right"))
    order = Window.partitionBy(*key).orderBy(place, F.asc("_side"), among).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = F.last("_right", ignorenulls=True).over(order)
    usable = F.col("_at").isNotNull()
    for k in key:
        usable = usable & F.col(k).isNotNull()
    met = both.withColumn("matched", F.when(usable, seen)).filter(F.col("_left").isNotNull())
    return met.select("_left.*", "matched")
