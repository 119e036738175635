"""From raw observation rows to clean observations with counters, for all series at once."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom import constants as K
from seriesloom.functions.expr import blank_to_null, is_bad_number, is_missing, number, period_end, run_status, stable_id, unit_of
from seriesloom.operators.quality import flag_outliers, keep_last, quality_report
from seriesloom.shared import written

PARSE_ERROR = "parse"


@dataclass(frozen=True)
class Cleaned:
    """Clean observations, one row of counters and one report per series, and the series with rows that can't be parsed."""

    silver: DataFrame
    counters: DataFrame
    report: DataFrame
    violations: DataFrame


def relevant(rows: DataFrame) -> DataFrame:
    """Rows of the series itself: those with its code, or with none."""
    code = blank_to_null(F.col("code"))
    return rows.filter(code.isNull() | (code == F.col("indicator_id")))


def parsed(rows: DataFrame) -> DataFrame:
    """Typed observations of raw rows (indicator_id, code, name, date, value, unit, obs_status, pos), with ``problem`` where a row can't be read."""
    bad = F.when(period_end(F.col("date")).isNull(), F.concat(F.lit("bad date: "), F.coalesce("date", F.lit("null")))).when(is_bad_number(F.col("value")), F.concat(F.lit("bad value: "), F.col("value")))
    return rows.withColumns({
        "timestamp": period_end(F.col("date")),
        "problem": bad,
        "value": number(F.col("value")),
        "unit": unit_of(F.col("unit"), F.col("name")),
        "obs_status": blank_to_null(F.col("obs_status")),
    })


def clean(rows: DataFrame, now: datetime, unit: str | None = None) -> Cleaned:
    """Relevant rows, parsed, without future periods, missing values and earlier duplicates; outliers are flagged, not dropped.

    The report is made before missing values go, so that it describes the
    source.  A row that can't be parsed puts its whole series among the
    violations.  The few broken series, the observations kept and those flagged
    are written, so what several results share is worked out once.
    """
    own = parsed(relevant(rows))
    broken = written(own.filter("problem IS NOT NULL").groupBy("indicator_id").agg(F.min("problem").alias("message")))
    violations = broken.select("indicator_id", F.lit(PARSE_ERROR).alias("error_type"), "message")
    good = own.join(broken, "indicator_id", "left_anti").drop("problem", "message")
    past = F.col("timestamp") <= F.lit(now).cast("timestamp_ntz")
    known = ~is_missing(F.col("value"))
    kept = written(keep_last(good.filter(past & known)))
    flagged = written(flag_outliers(kept))
    silver = flagged.withColumns({
        "unit": F.coalesce(F.lit(unit).cast("string"), F.col("unit")),
        "validation_status": F.when(F.col("is_outlier"), K.STATUS_FLAGGED).otherwise(K.STATUS_VALID),
        "validation_notes": F.when(F.col("is_outlier"), K.OUTLIER_NOTE),
    })
    before = good.groupBy("indicator_id").agg(
        F.count(F.lit(1)).alias("records_processed"),
        F.count_if(~past).alias("future_records"),
        F.count_if(past & ~known).alias("null_records"),
        F.round(F.coalesce(F.avg(F.when(past, (~known).cast("double"))) * 100, F.lit(0.0)), 4).alias("null_percentage"),
        F.count_if(past & known).alias("_known"),
    )
    after = flagged.groupBy("indicator_id").agg(F.count(F.lit(1)).alias("records_written"), F.count_if("is_outlier").alias("outlier_count"))
    counters = before.join(after, "indicator_id", "left").fillna(0, ["records_written", "outlier_count"]).withColumn("duplicate_records", F.col("_known") - F.col("records_written"))
    counters = counters.withColumn("records_failed", F.col("null_records") + F.col("duplicate_records") + F.col("future_records"))
    counters = counters.withColumn("status", run_status(F.col("records_written"), F.col("records_failed"))).drop("_known")
    return Cleaned(silver, counters, quality_report(good.filter(past), now), violations)


def silver_records(silver: DataFrame, source: str, frequency: str) -> DataFrame:
    """Rows of the silver table; ids depend on series and period, so a rerun writes the same ones."""
    return silver.select(
        stable_id("indicator_id", "timestamp").alias("id"),
        "indicator_id",
        "timestamp",
        "value",
        "unit",
        F.lit(frequency).alias("frequency"),
        F.lit(source).alias("source_name"),
        *(["bronze_id"] if "bronze_id" in silver.columns else [F.lit(None).cast("string").alias("bronze_id")]),
        "validation_status",
        "validation_notes",
        "is_outlier",
        F.when(F.col("obs_status").isNotNull(), F.to_json(F.struct("obs_status"))).alias("metadata"),
    )
