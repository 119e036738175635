"""Reading the layers: lookups by id and whole series in the order of time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.sinks.tables import bucket


def by_id(table: DataFrame, ids: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """The rows of the wanted ids, and the ids that aren't there."""
    wanted = ids.select(key).distinct()
    return table.join(wanted, key, "left_semi"), wanted.join(table.select(key), key, "left_anti")


def _of(table: DataFrame, indicator: str) -> DataFrame:
    """One series' rows; where the table is bucketed, the other buckets' files aren't read."""
    out = table.filter(F.col("indicator_id") == indicator)
    return out.filter(F.col("series_bucket") == bucket_of(table, indicator)) if "series_bucket" in table.columns else out


def bucket_of(table: DataFrame, indicator: str) -> int:
    return table.sparkSession.range(1).select(F.lit(indicator).alias("i")).select(bucket("i")).first()[0]


def silver_series(table: DataFrame, indicator: str) -> DataFrame:
    """A series with its ids, ascending."""
    return _of(table, indicator).select("indicator_id", "timestamp", "value", "id", "unit", "frequency").orderBy("timestamp")


def gold_series(table: DataFrame, indicator: str) -> DataFrame:
    """A published series, ascending."""
    return _of(table, indicator).select("indicator_id", "timestamp", "value", "original_value", "is_chain_linked", "chain_linking_confidence", "unit").orderBy("timestamp")


def series_set(table: DataFrame, ids: DataFrame, first: datetime | None = None, last: datetime | None = None, id_col: str = "indicator_id", parent_col: str | None = None) -> DataFrame:
    """The rows of a set of series in a range of time, ends included; other buckets' files aren't read.

    ``ids`` has a column ``id_col``.  Rows are found by ``parent_col``, where
    the table has what is derived from a series in that series' bucket, else
    by ``indicator_id``.
    """
    out, name = table, parent_col or "indicator_id"
    wanted = ids.select(F.col(id_col).alias(name)).filter(F.col(name).isNotNull()).distinct()
    if "series_bucket" in table.columns:
        # No more rows than a table has buckets.
        known = sorted(r[0] for r in wanted.select(bucket(name)).distinct().collect())
        out = out.filter(F.col("series_bucket").isin(known))
    if first is not None:
        out = out.filter(F.col("timestamp") >= F.lit(first).cast("timestamp_ntz"))
    if last is not None:
        out = out.filter(F.col("timestamp") <= F.lit(last).cast("timestamp_ntz"))
    return out.join(wanted, name, "left_semi")


def export_csv(rows: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Write rows as CSV files with a header, dealt and sorted by series and time; a second export replaces the first."""
    chosen = rows.select(*(columns or [c for c in rows.columns if c != "series_bucket"]))
    keys = ["indicator_id", "timestamp"]
    chosen.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)


def first_attributes(silver: DataFrame) -> DataFrame:
    """(indicator_id, unit, frequency) of each series' first observation."""
    return silver.groupBy("indicator_id").agg(F.min_by("unit", "timestamp").alias("unit"), F.min_by("frequency", "timestamp").alias("frequency"))


def search_catalog(catalog: DataFrame, text: str) -> DataFrame:
    """Catalog rows whose name holds the text, whatever its case."""
    return catalog.filter(F.contains(F.lower("name"), F.lit(text.lower())))
