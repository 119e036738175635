"""Growth against the previous observation of a series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from seriesloom import constants as K
from seriesloom.functions.expr import is_finite, is_missing


def in_time() -> WindowSpec:
    """One series in the order of time; all windows of this package share it, so a plan has one exchange for them."""
    return Window.partitionBy("indicator_id").orderBy("timestamp")


def previous(column: str) -> Column:
    return F.lag(column).over(in_time())


def change(column: str) -> Column:
    """Relative change against the previous observation (not the previous calendar period)."""
    return F.try_divide(F.col(column), previous(column)) - 1


def scale_changed() -> Column:
    """True where the scale factor differs from the previous observation's."""
    return F.coalesce(F.abs(F.col("scale_factor") - previous("scale_factor")) > K.SCALE_EPSILON, F.lit(False))


def normalised(series: DataFrame) -> DataFrame:
    """The series without missing values, values as doubles."""
    missing = {"indicator_id", "timestamp", "value"} - set(series.columns)
    if missing:
        raise ValueError(f"columns are missing: {sorted(missing)}")
    return series.withColumn("value", F.col("value").cast("double")).filter(~is_missing(F.col("value")))


def growth_rates(series: DataFrame) -> DataFrame:
    """(indicator_id, timestamp, previous_timestamp, value, growth) in percent, finite rates only."""
    out = series.select("indicator_id", "timestamp", previous("timestamp").alias("previous_timestamp"), "value", (100 * change("value")).alias("growth"))
    return out.filter(is_finite(F.col("growth")))
