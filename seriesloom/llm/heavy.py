"""Lookups of per-key values for many rows when a few keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], count: str, at_most: int = 4096, total: int | None = None) -> DataFrame:
    """Inner join of ``rows`` with ``table`` (one row per key; ``count``: how many rows the key has at most).

    Keys with over 1/at_most of all counted rows number fewer than
    ``at_most``, whatever the data: that part of the table is broadcast.  No
    other key can unbalance the shuffled join, so both parts stay even.
    """
    if total is None:
        total = table.agg(F.sum(count)).first()[0] or 0
    frequent = F.col(count) > F.lit(max(64, total // at_most))
    hot = F.broadcast(table.filter(frequent))
    hot_rows = rows.join(hot, keys)
    rest = rows.join(F.broadcast(table.filter(frequent).select(*keys)), keys, "left_anti")
    return hot_rows.unionByName(rest.join(table.filter(~frequent), keys))
