"""Data quality: missing values, outliers, dates, reports and deduplication, for all series at once."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom import constants as K
from seriesloom.functions.expr import is_missing

#: The sketch's ranks are off by one part in ``SKETCH_ACCURACY`` at most; brackets reach five times as far.
SKETCH_ACCURACY = 1000
BRACKET = 0.005


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """Required columns that the table doesn't have; known before anything runs."""
    return sorted(set(required) - set(df.columns))


def null_share() -> Column:
    """Percentage of missing values in a group; 0 for none."""
    return F.coalesce(F.avg(is_missing(F.col("value")).cast("double")) * 100, F.lit(0.0))


def null_percentage(series: DataFrame) -> DataFrame:
    return series.groupBy("indicator_id").agg(null_share().alias("null_percentage"))


def exact_quantiles(values: DataFrame, probabilities: dict[str, float], key: str = "indicator_id", column: str = "value") -> DataFrame:
    """(key, one column per name): exact quantiles of a group's values that aren't missing, interpolated between neighbours; infinities are values.

    A sketch of bounded size brackets each quantile; a second pass counts what
    lies outside the brackets and keeps single values only inside, a hundredth
    of a large group for each (of a small one, all).  So no task holds all
    values of a group.
    """
    if not probabilities or not all(0 <= p <= 1 for p in probabilities.values()):
        raise ValueError("probabilities must lie from 0 to 1")
    known = values.filter(~is_missing(F.col(column))).select(key, F.col(column).alias("value"))
    spans: list[list[float]] = []
    for p in sorted(set(probabilities.values())):
        low, high = max(0.0, p - BRACKET), min(1.0, p + BRACKET)
        if spans and low <= spans[-1][1]:
            spans[-1][1] = high
        else:
            spans.append([low, high])
    ends = [x for span in spans for x in span]
    sketch = known.groupBy(key).agg(F.percentile_approx("value", ends, SKETCH_ACCURACY).alias("b"), F.count(F.lit(1)).alias("n"))
    v, b, far = F.col("value"), F.col("b"), F.lit(float("inf"))
    # Between the brackets no rank is asked for: those values count for the end below them.
    snapped = F.when(F.col("n") <= SKETCH_ACCURACY, v).when(v < b[0], -far)
    for k in range(len(spans)):
        snapped = snapped.when(v <= b[2 * k + 1], v)
        snapped = snapped.when(v < b[2 * k + 2], b[2 * k + 1]) if k + 1 < len(spans) else snapped.otherwise(far)
    counts = known.join(sketch, key).groupBy(key, "n", snapped.alias("value")).agg(F.count(F.lit(1)).alias("c"))
    upto = Window.partitionBy(key).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("stop", F.sum("c").over(upto))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("stop") - F.col("c") <= rank) & (rank < F.col("stop")), v))

    places = {name: (F.col("n") - 1) * p for name, p in probabilities.items()}
    found = ranked.groupBy(key, "n").agg(*(c for name, p in places.items() for c in (at(F.floor(p)).alias(f"{name}_lo"), at(F.ceil(p)).alias(f"{name}_hi"))))

    def between(name: str) -> Column:
        lo, hi, p = F.col(f"{name}_lo"), F.col(f"{name}_hi"), places[name]
        return F.when(lo == hi, lo).otherwise((F.ceil(p) - p) * lo + (p - F.floor(p)) * hi).alias(name)

    return found.select(key, *map(between, probabilities))


def quartiles(series: DataFrame) -> DataFrame:
    """(indicator_id, q1, q3) of the values that aren't missing."""
    return exact_quantiles(series, {"q1": 0.25, "q3": 0.75})


def iqr_bounds(series: DataFrame, multiplier: float = K.IQR_MULTIPLIER) -> DataFrame:
    """(indicator_id, low, high): the fences around the exact quartiles of the values that aren't missing."""
    spread = (F.col("q3") - F.col("q1")) * multiplier
    return quartiles(series).select("indicator_id", (F.col("q1") - spread).alias("low"), (F.col("q3") + spread).alias("high"))


def flag_outliers(series: DataFrame, multiplier: float = K.IQR_MULTIPLIER) -> DataFrame:
    """The series with ``is_outlier``: strictly beyond its fences.  The fences are joined back, one row per series."""
    bounds = iqr_bounds(series, multiplier)
    beyond = (F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))
    return series.join(bounds, "indicator_id", "left").withColumn("is_outlier", F.coalesce(beyond & ~F.isnan("value"), F.lit(False))).drop("low", "high")


def date_problems(series: DataFrame, now: datetime, earliest: datetime | None = None, latest: datetime | None = None) -> DataFrame:
    """(indicator_id, future, too_early, too_late, unparsable): whether a series has dates beyond each limit, and rows without a date."""

    def over(condition: Column) -> Column:
        return F.coalesce(F.bool_or(condition), F.lit(False))

    ts, never = F.col("timestamp"), F.lit(False)
    return series.groupBy("indicator_id").agg(
        over(ts > F.lit(now).cast("timestamp_ntz")).alias("future"),
        over(ts < F.lit(earliest).cast("timestamp_ntz") if earliest else never).alias("too_early"),
        over(ts > F.lit(latest).cast("timestamp_ntz") if latest else never).alias("too_late"),
        F.count_if(ts.isNull()).alias("unparsable"),
    )


def quality_report(series: DataFrame, now: datetime, null_threshold: float = K.NULL_THRESHOLD) -> DataFrame:
    """One row per series: (indicator_id, is_valid, errors, warnings, null_percentage, outlier_count, record_count).

    Errors are dates in the future; warnings a high share of missing values
    and outliers.  A series without rows has no group here; see ``empty_report``.
    """
    flagged = flag_outliers(series)
    measured = flagged.groupBy("indicator_id").agg(
        null_share().alias("null_percentage"),
        F.count_if("is_outlier").alias("outlier_count"),
        F.count(F.lit(1)).alias("record_count"),
        F.count_if(F.col("timestamp") > F.lit(now).cast("timestamp_ntz")).alias("n_future"),
    )
    errors = F.array_compact(F.array(F.when(F.col("n_future") > 0, F.lit("dates in the future"))))
    warnings = F.array_compact(
        F.array(
            F.when(F.col("null_percentage") > null_threshold, F.format_string(f"High null percentage: %.2f%% (threshold: {null_threshold}%%)", "null_percentage")),
            F.when(F.col("outlier_count") > 0, F.format_string("Found %d outliers (%.2f%% of data)", "outlier_count", F.col("outlier_count") / F.col("record_count") * 100)),
        )
    )
    return measured.select("indicator_id", (F.col("n_future") == 0).alias("is_valid"), errors.alias("errors"), warnings.alias("warnings"), "null_percentage", "outlier_count", "record_count")


def empty_report(indicators: DataFrame, series: DataFrame) -> DataFrame:
    """Reports of the indicators that have no row in ``series``: not valid, with one error."""
    none = F.array().cast("array<string>")
    return indicators.select("indicator_id").distinct().join(series, "indicator_id", "left_anti").select(
        "indicator_id", F.lit(False).alias("is_valid"), F.array(F.lit("DataFrame is empty")).alias("errors"), none.alias("warnings"),
        F.lit(0.0).alias("null_percentage"), F.lit(0).cast("long").alias("outlier_count"), F.lit(0).cast("long").alias("record_count"),
    )


def keep_last(series: DataFrame, order: str = "pos") -> DataFrame:
    """One row per (indicator_id, timestamp): the one that stands last in the payload."""
    latest = Window.partitionBy("indicator_id", "timestamp").orderBy(F.col(order).desc())
    return series.withColumn("_rank", F.row_number().over(latest)).filter("_rank = 1").drop("_rank")
