"""Checks and rollups across layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom import constants as K
from seriesloom.functions.expr import is_missing, run_status


def observed_range(series: DataFrame) -> DataFrame:
    """(indicator_id, first_seen, last_seen) of the values that aren't missing."""
    known = F.when(~is_missing(F.col("value")), F.col("timestamp"))
    return series.groupBy("indicator_id").agg(F.min(known).alias("first_seen"), F.max(known).alias("last_seen")).filter("first_seen IS NOT NULL")


def coverage(series: DataFrame) -> DataFrame:
    return series.groupBy("indicator_id").agg(F.count(F.lit(1)).alias("n_obs"), F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"))


def short_coverage(series: DataFrame, years: int = K.COVERAGE_YEARS) -> DataFrame:
    """(indicator_id, n_years): series with observations in fewer years than they should have."""
    known = F.when(~is_missing(F.col("value")), F.year("timestamp"))
    return series.groupBy("indicator_id").agg(F.count_distinct(known).alias("n_years")).filter(F.col("n_years") < years)


def confidence_range(gold: DataFrame) -> DataFrame:
    """(indicator_id, n_rows, n_without, n_outside): rows without a confidence, and those whose confidence isn't from 0 to 1."""
    c = F.col("chain_linking_confidence")
    outside = c.isNotNull() & ~((c >= 0) & (c <= 1) & ~F.isnan(c))
    return gold.groupBy("indicator_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(c.isNull()).alias("n_without"), F.count_if(outside).alias("n_outside"))


def interior_gaps(series: DataFrame) -> DataFrame:
    """(indicator_id, missing_years): years between a series' first and last without an observation."""
    years = series.select("indicator_id", F.year("timestamp").alias("year")).distinct()
    spine = years.groupBy("indicator_id").agg(F.min("year").alias("lo"), F.max("year").alias("hi")).select("indicator_id", F.explode(F.sequence("lo", "hi")).alias("year"))
    gaps = spine.join(years, ["indicator_id", "year"], "left_anti")
    return gaps.groupBy("indicator_id").agg(F.array_sort(F.collect_list("year")).alias("missing_years"))


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str = "id") -> DataFrame:
    """Child rows whose parent row isn't there."""
    return child.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def unit_mismatches(series: DataFrame, catalog: DataFrame) -> DataFrame:
    """(indicator_id, unit, catalog_unit) where they differ, null being a value."""
    both = series.select("indicator_id", "unit").distinct().join(catalog.select("indicator_id", F.col("unit").alias("catalog_unit")), "indicator_id")
    return both.filter(~F.col("unit").eqNullSafe(F.col("catalog_unit")))


def linked_flags(gold: DataFrame) -> DataFrame:
    return gold.groupBy("indicator_id").agg(F.bool_or("is_chain_linked").alias("any_linked"), F.count_if("is_chain_linked").alias("n_linked"))


def hop_status(log: DataFrame) -> DataFrame:
    return log.groupBy("source_layer", "target_layer", "transformation_type", "status").agg(F.count(F.lit(1)).alias("n_hops"), F.sum("records_processed").alias("processed"), F.sum("records_failed").alias("failed"))


def run_summary(outcomes: DataFrame) -> DataFrame:
    """One row: indicators that succeeded and failed, rows written, whether the run succeeded, and a line of text.

    ``outcomes``: (indicator_id, records_written, records_failed, error).
    """
    ok = F.col("error").isNull()
    totals = outcomes.agg(
        F.count(F.lit(1)).alias("indicators"), F.count_if(ok).alias("succeeded"), F.count_if(~ok).alias("failed"),
        F.coalesce(F.sum(F.when(ok, F.col("records_written"))), F.lit(0)).alias("written"), F.coalesce(F.sum("records_failed"), F.lit(0)).alias("records_failed"),
    )
    return totals.withColumns({
        "ok": F.col("failed") == 0,
        "status": run_status(F.col("succeeded"), F.col("failed")),
        "report": F.format_string("%d of %d indicators succeeded, %d rows written", "succeeded", "indicators", "written"),
    })


def layer_identity(counters: DataFrame, silver: DataFrame) -> DataFrame:
    """Series where silver isn't what was processed less what failed."""
    rows = silver.groupBy("indicator_id").agg(F.count(F.lit(1)).alias("silver_rows"))
    both = counters.join(rows, "indicator_id", "left").fillna(0, ["silver_rows"])
    return both.filter(F.col("silver_rows") != F.col("records_processed") - F.col("records_failed")).select("indicator_id", "records_processed", "records_failed", "silver_rows")
