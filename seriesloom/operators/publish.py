"""Published rows: levels on one base and the growth derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom import constants as K
from seriesloom.functions.expr import derived_id, is_finite, stable_id
from seriesloom.operators.growth import change, previous, scale_changed
from seriesloom.operators.linking import Linked


def _joined(linked: Linked, silver: DataFrame, domains: DataFrame | None) -> DataFrame:
    """Linked observations with their silver row's id, the series' first unit and frequency, its link's summary and its domain."""
    first = silver.groupBy("indicator_id").agg(F.min_by("unit", "timestamp").alias("unit"), F.min_by("frequency", "timestamp").alias("frequency"))
    ids = silver.select("indicator_id", "timestamp", F.col("id").alias("silver_id"))
    summary = linked.summary.select("indicator_id", "linking_method", "avg_confidence_score", "base_year_from", "base_year_to")
    out = linked.frame.select("indicator_id", "timestamp", "value", "original_value", "scale_factor", "is_linked").join(ids, ["indicator_id", "timestamp"], "left").join(first, "indicator_id").join(summary, "indicator_id", "left")
    if domains is not None:
        out = out.join(domains.select("indicator_id", F.col("domain").alias("_domain")), "indicator_id", "left")
    else:
        out = out.withColumn("_domain", F.lit(None).cast("string"))
    return _with_domain(out)


def _with_domain(rows: DataFrame) -> DataFrame:
    return rows.withColumn("domain", F.coalesce(F.nullif(F.trim("_domain"), F.lit("")), F.lit(K.DEFAULT_DOMAIN))).drop("_domain")


def described(silver: DataFrame, domains: DataFrame) -> DataFrame:
    """Silver observations with what their published rows need: their ids, their series' first unit and frequency, its domain."""
    whole = Window.partitionBy("indicator_id").orderBy("timestamp").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = silver.select("indicator_id", "timestamp", "value", F.col("id").alias("silver_id"), "unit", "frequency")
    out = _with_domain(own.join(domains.select("indicator_id", F.col("domain").alias("_domain")), "indicator_id", "left"))
    return out.withColumns({c: F.first(c).over(whole) for c in ("unit", "frequency")})


def _confidence(is_linked: Column) -> Column:
    return F.when(is_linked, F.col("avg_confidence_score"))


_COLUMNS = ["id", "indicator_id", "timestamp", "value", "original_value", "is_chain_linked", "chain_linking_confidence", "unit", "frequency", "domain", "silver_id", "metadata"]


def level_records(linked: Linked, silver: DataFrame, domains: DataFrame | None = None, run_id: str = "") -> DataFrame:
    """Gold rows of the levels; observations without a silver row are left out."""
    return levels_of(_joined(linked, silver, domains), run_id)


def levels_of(rows: DataFrame, run_id: str = "") -> DataFrame:
    """Gold rows of the levels of observations that carry their silver row, link and domain."""
    rows = rows.filter("silver_id IS NOT NULL")
    how = F.to_json(F.struct("linking_method", "scale_factor", "base_year_from", "base_year_to"))
    return rows.withColumns({
        "id": stable_id(F.lit(run_id), "indicator_id", "timestamp"),
        "is_chain_linked": F.col("is_linked"),
        "chain_linking_confidence": _confidence(F.col("is_linked")),
        "metadata": F.when(F.col("is_linked"), how),
    }).select(*_COLUMNS)


def growth_records(linked: Linked, silver: DataFrame, domains: DataFrame | None = None, run_id: str = "") -> DataFrame:
    """Gold rows of the derived growth: finite rates only, given to the later period.

    ``original_value`` is the growth of the unlinked values, null where the
    two periods lie on different bases or it isn't finite.
    """
    return growth_of(with_rates(_joined(linked, silver, domains)), run_id)


def with_rates(rows: DataFrame) -> DataFrame:
    """Linked observations with their change against the one before."""
    return rows.withColumns({
        "rate": 100 * change("value"),
        "raw_rate": 100 * change("original_value"),
        "crossed": scale_changed(),
        "from_period": previous("timestamp"),
        "either": F.col("is_linked") | F.coalesce(previous("is_linked"), F.lit(False)),
    })


def is_grown() -> Column:
    """Whether an observation has a growth row."""
    return F.coalesce(is_finite(F.col("rate")), F.lit(False)) & F.col("silver_id").isNotNull()


def growth_of(rows: DataFrame, run_id: str = "") -> DataFrame:
    """Gold rows of the growth of observations ``with_rates``."""
    rows = rows.filter(is_finite(F.col("rate")) & F.col("silver_id").isNotNull())
    how = F.struct(
        F.col("indicator_id").alias("derived_from"),
        F.lit(K.DERIVED_METHOD).alias("method"),
        F.date_format("from_period", "yyyy-MM-dd").alias("from_period"),
        F.date_format("timestamp", "yyyy-MM-dd").alias("to_period"),
        F.col("crossed").alias("spans_base_year_break"),
    )
    return rows.select(
        stable_id(F.lit(run_id), derived_id(F.col("indicator_id")), "timestamp").alias("id"),
        derived_id(F.col("indicator_id")).alias("indicator_id"),
        "timestamp",
        F.col("rate").alias("value"),
        F.when(~F.col("crossed") & is_finite(F.col("raw_rate")), F.col("raw_rate")).alias("original_value"),
        F.col("either").alias("is_chain_linked"),
        _confidence(F.col("either")).alias("chain_linking_confidence"),
        F.lit(K.DERIVED_UNIT).alias("unit"),
        "frequency",
        "domain",
        "silver_id",
        F.to_json(how).alias("metadata"),
    )


def unmatched(linked: Linked, silver: DataFrame) -> DataFrame:
    """(indicator_id, records_failed): linked observations that have no silver row."""
    lost = linked.frame.join(silver.select("indicator_id", "timestamp"), ["indicator_id", "timestamp"], "left_anti")
    return lost.groupBy("indicator_id").agg(F.count(F.lit(1)).alias("records_failed"))
