"""Chain-linking: finding base-year breaks and putting a series on its newest base.

A series that can't be linked doesn't stop the others: each operator returns
violations (indicator_id, error_type, message) beside its result, and such a
series is left out of the result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from seriesloom import constants as K
from seriesloom.functions.expr import base_year_pairs, confidence, is_finite, min_overlap, months_per_period, safe_ratio
from seriesloom.operators.asof import asof_join
from seriesloom.operators.growth import change, in_time, normalised, previous, scale_changed
from seriesloom.operators.quality import exact_quantiles
from seriesloom.shared import written

LINK_ERROR = "chain_linking"

_FRAME = ["indicator_id", "timestamp", "value", "original_value", "scale_factor", "is_linked"]


def _whole() -> WindowSpec:
    """All rows of one series."""
    return Window.partitionBy("indicator_id")


@dataclass(frozen=True)
class Linked:
    """The linked observations, one summary row per series, and what couldn't be linked."""

    frame: DataFrame
    summary: DataFrame
    violations: DataFrame
    breaks: DataFrame | None = None


def _violation(df: DataFrame, message: Column) -> DataFrame:
    return df.select("indicator_id", F.lit(LINK_ERROR).alias("error_type"), message.alias("message"))


def prepared(series: DataFrame) -> DataFrame:
    """The series with the bookkeeping columns that it lacks."""
    out = normalised(series)
    for name, value in (("original_value", F.col("value")), ("scale_factor", F.lit(1.0)), ("is_linked", F.lit(False))):
        if name not in out.columns:
            out = out.withColumn(name, value)
    return out


# --- breaks --------------------------------------------------------------------


def breaks_from_base_years(series: DataFrame, base_years: DataFrame) -> DataFrame:
    """Breaks at the first observation in or after each new base year; ``base_years``: (indicator_id, base_years).

    Base years that fall on one observation, for lack of data between them,
    make one break there: the junction is crossed once.
    """
    seen = normalised(series).select("indicator_id", "timestamp", "value", previous("value").alias("before"), F.row_number().over(in_time()).alias("n"))
    pairs = base_years.select("indicator_id", F.explode(base_year_pairs(F.col("base_years"))).alias("pair")).select("indicator_id", "pair.*")
    # A new base begins with its year; the first observation from there on is the nearest following one.
    begins = pairs.withColumn("timestamp", F.make_timestamp_ntz("base_to", F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).cast(series.schema["timestamp"].dataType))
    first = asof_join(begins, seen, on="timestamp", direction="forward").select("indicator_id", "base_from", "base_to", F.col("matched").alias("at")).filter("at.n > 1")
    return first.groupBy("indicator_id", F.col("at.timestamp").alias("timestamp")).agg(
        F.min("base_from").alias("base_year_from"),
        F.max("base_to").alias("base_year_to"),
        F.lit(K.DETECTED_BY_METADATA).alias("detected_by"),
        F.first(safe_ratio(F.col("at.value"), F.col("at.before"))).alias("level_ratio"),
    )


def breaks_from_level_shifts(series: DataFrame, threshold: float = K.SHIFT_THRESHOLD, multiple: float = K.JUMP_MULTIPLE) -> DataFrame:
    """Breaks at jumps that dwarf the series' typical movement."""
    before = previous("value")
    # A change from zero is infinite, one from zero to zero undefined.
    size = F.when(before == 0, F.when(F.col("value") != 0, F.lit(float("inf")))).otherwise(F.abs(change("value")))
    moves = normalised(series).select("indicator_id", "timestamp", "value", before.alias("before"), previous("timestamp").alias("earlier"), size.alias("size"))
    moves = written(moves)
    middle = exact_quantiles(moves.select("indicator_id", F.col("size").alias("value")), {"typical": 0.5}).select("indicator_id", "typical")
    rows = moves.groupBy("indicator_id").agg(F.count(F.lit(1)).alias("rows"))
    typical = middle.join(rows, "indicator_id").filter((F.col("rows") >= K.MIN_ROWS_FOR_SHIFTS) & is_finite(F.col("typical")))
    jump = is_finite(F.col("size")) & (F.col("size") >= threshold) & ((F.col("typical") <= 0) | (F.col("size") >= multiple * F.col("typical")))
    return moves.join(typical, "indicator_id").filter(jump).select(
        "indicator_id",
        "timestamp",
        F.year("earlier").alias("base_year_from"),
        F.year("timestamp").alias("base_year_to"),
        F.lit(K.DETECTED_BY_LEVEL_SHIFT).alias("detected_by"),
        safe_ratio(F.col("value"), F.col("before")).alias("level_ratio"),
    )


def detect_breaks(series: DataFrame, base_years: DataFrame, statistical: bool = False) -> DataFrame:
    """Known base years decide; level shifts are looked for only where none are known and only if asked."""
    known = base_years.filter(F.size(F.coalesce("base_years", F.array().cast("array<int>"))) > 0)
    out = breaks_from_base_years(series, known)
    if statistical:
        out = out.unionByName(breaks_from_level_shifts(series.join(known, "indicator_id", "left_anti")))
    return out


# --- level shifts --------------------------------------------------------------


def growth_violations(frame: DataFrame, tolerance: float = K.GROWTH_TOLERANCE) -> DataFrame:
    """Series whose growth within a segment moved by more than ``tolerance``: (indicator_id, error_type, message, worst)."""
    moved = frame.select("indicator_id", F.abs(change("value") - change("original_value")).alias("deviation"), scale_changed().alias("junction"))
    worst = moved.groupBy("indicator_id").agg(F.max(F.when(~F.col("junction") & is_finite(F.col("deviation")), F.col("deviation"))).alias("worst"))
    bad = worst.filter(F.col("worst") > tolerance)
    return bad.select("indicator_id", F.lit(LINK_ERROR).alias("error_type"), F.format_string("linking altered growth rates by %.6f", "worst").alias("message"), "worst")


def _measured(frame: DataFrame) -> DataFrame:
    """With ``_worst``, the growth guard's measure of a series.  A window, so that the frame isn't made twice to be joined with itself."""
    deviation = F.abs(change("value") - change("original_value"))
    moved = frame.withColumn("_moved", F.when(~scale_changed() & is_finite(deviation), deviation))
    return moved.withColumn("_worst", F.coalesce(F.max("_moved").over(_whole()), F.lit(0.0))).drop("_moved")


def _guarded(frame: DataFrame, tolerance: float = K.GROWTH_TOLERANCE) -> tuple[DataFrame, DataFrame]:
    """The series that pass the growth guard, and violations for the others."""
    return _passing(_measured(frame), tolerance)


def _passing(worst: DataFrame, tolerance: float = K.GROWTH_TOLERANCE) -> tuple[DataFrame, DataFrame]:
    broken = worst.filter(F.col("_worst") > tolerance).groupBy("indicator_id").agg(F.max("_worst").alias("_worst"))
    return worst.filter(F.col("_worst") <= tolerance).drop("_worst"), _violation(broken, F.format_string("linking altered growth rates by %.6f", "_worst"))


def link_columns() -> dict[str, Column]:
    """What the breaks of a series tell of its link."""
    linked = F.col("breaks").isNotNull()
    return {
        "linking_method": F.when(linked, F.lit(K.METHOD_LEVEL_SHIFT)),
        "avg_confidence_score": F.when(linked, confidence(F.lit(0.0), F.lit(None).cast("double"))),
        "base_year_from": F.get("breaks", F.lit(0))["base_year_from"],
        "base_year_to": F.element_at("breaks", -1)["base_year_to"],
    }


def link_at_breaks(series: DataFrame, breaks: DataFrame, once: Callable[[DataFrame], DataFrame] | None = None) -> Linked:
    """Each older segment times the product of the junction ratios after it.

    Series without breaks pass through unlinked and without confidence.  A
    series' few breaks travel with its rows as one array, by one join.  Who
    takes more than the frame gives ``once``: it stores the rows, with whatever
    columns it adds, so that frame, summary and violations are read from there.
    """
    entry = F.struct("timestamp", "base_year_from", "base_year_to", "detected_by", "level_ratio")
    known = breaks.groupBy("indicator_id").agg(
        F.array_sort(F.collect_list(entry)).alias("breaks"),
        F.min(F.when(F.col("level_ratio").isNull(), F.col("timestamp"))).alias("undefined_at"),
    )
    if once is not None:
        known = written(known)
    undefined = known.filter("undefined_at IS NOT NULL")
    no_ratio = _violation(undefined, F.concat(F.lit("cannot chain-link across the break at "), F.date_format("undefined_at", "yyyy-MM-dd"), F.lit(": junction ratio is undefined")))
    rows = prepared(series).join(known, "indicator_id", "left").filter("undefined_at IS NULL").drop("undefined_at")
    # All junctions between an observation and the newest base, newest first.
    ahead = F.filter(F.reverse("breaks"), lambda b: b["timestamp"] > F.col("timestamp"))
    rows = rows.withColumn("_factor", F.coalesce(F.aggregate(ahead, F.lit(1.0), lambda product, b: product * b["level_ratio"]), F.lit(1.0)))
    rows = rows.withColumns({"value": F.col("value") * F.col("_factor"), "scale_factor": F.col("scale_factor") * F.col("_factor"), "is_linked": F.abs(F.col("_factor") - 1) > K.SCALE_EPSILON}).drop("_factor")
    rows = _measured(rows)
    rows, broken = _passing(once(rows) if once is not None else rows)
    linked, told = F.col("breaks").isNotNull(), link_columns()
    summary = (
        rows.groupBy("indicator_id")
        .agg(F.count_if("is_linked").alias("records_linked"), F.first("breaks").alias("breaks"))
        .select(
            "indicator_id",
            linked.alias("is_chain_linked"),
            told["linking_method"].alias("linking_method"),
            F.when(linked, F.col("records_linked")).otherwise(0).cast("long").alias("records_linked"),
            told["avg_confidence_score"].alias("avg_confidence_score"),
            F.when(linked, F.lit(0)).cast("int").alias("overlap_period_months"),
            F.lit(None).cast("double").alias("growth_rate_variance"),
            told["base_year_from"].alias("base_year_from"),
            told["base_year_to"].alias("base_year_to"),
            "breaks",
        )
    )
    usable = known.filter("undefined_at IS NULL").select("indicator_id", F.inline("breaks"))
    return Linked(rows.drop("breaks"), summary, no_ratio.unionByName(broken), usable)


# --- overlaps ------------------------------------------------------------------


def _compared(old: DataFrame, new: DataFrame, frequency: str, overlap: int | None) -> DataFrame:
    """Rows of both sides, each with its series' measurements and ``problem``: one exchange by series, all else are windows on it.

    Each side has one row per series and period.  ``ends`` is null for a series
    without old rows, ``boundary`` for one without new rows.
    """
    sides = [prepared(side).select(*_FRAME, F.lit(is_new).alias("is_new")) for side, is_new in ((old, False), (new, True))]
    in_pairs = Window.partitionBy("indicator_id").orderBy("timestamp", "is_new")
    partner = F.col("is_new") & ~F.lag("is_new").over(in_pairs) & (F.lag("timestamp").over(in_pairs) == F.col("timestamp"))
    rows = sides[0].unionByName(sides[1]).withColumns({"shares": F.coalesce(partner, F.lit(False)), "ratio": F.when(partner, safe_ratio(F.col("value"), F.lag("value").over(in_pairs)))})
    taken = F.col("shares")
    if overlap is not None:
        recent = Window.partitionBy("indicator_id").orderBy(F.col("shares").desc(), F.col("timestamp").desc())
        rows = rows.withColumn("back", F.row_number().over(recent))
        taken = taken & (F.col("back") <= overlap)
    measured = rows.withColumns({
        "shared": F.count_if("shares").over(_whole()),
        "overlap_periods": F.count_if(taken).over(_whole()),
        "usable": F.count(F.when(taken, F.col("ratio"))).over(_whole()),
        "scale": F.avg(F.when(taken, F.col("ratio"))).over(_whole()),
        "ratio_var": F.var_pop(F.when(taken, F.col("ratio"))).over(_whole()),
        "ends": F.max(F.when(~F.col("is_new"), F.col("timestamp"))).over(_whole()),
        "boundary": F.min(F.when(F.col("is_new"), F.col("timestamp"))).over(_whole()),
    })
    required = min_overlap(F.lit(frequency))
    problem = (
        F.when(F.col("ends").isNull() | F.col("boundary").isNull(), F.lit(None).cast("string"))
        .when(F.col("shared") < required, F.format_string("insufficient overlap to chain-link: %d shared period(s)", "shared"))
        .when(F.lit(overlap is not None) & (F.lit(overlap or 0) < required), F.lit(f"requested overlap of {overlap} period(s) is below the required number"))
        .when(F.col("usable") < required, F.format_string("only %d usable overlap ratio(s)", "usable"))
    )
    return measured.withColumn("problem", problem)


def _joined_up(compared: DataFrame, frequency: str) -> Linked:
    """The rescaled old rows before the boundary and the new ones from there on; series without old rows stay as they are, without a summary."""
    refused = _violation(compared.filter("problem IS NOT NULL").groupBy("indicator_id").agg(F.first("problem").alias("problem")), F.col("problem"))
    kept = compared.filter("problem IS NULL AND boundary IS NOT NULL AND (is_new OR timestamp < boundary)")

    def scaled(name: str) -> Column:
        return F.when(F.col("is_new"), F.col(name)).otherwise(F.col(name) * F.col("scale"))

    frame = kept.withColumns({"value": scaled("value"), "scale_factor": scaled("scale_factor"), "is_linked": F.col("is_linked") | ~F.col("is_new")})
    frame, broken = _guarded(frame)
    months = F.col("overlap_periods") * months_per_period(F.lit(frequency))
    # The variance of ratio / scale is the ratios' variance over the square of their mean.
    summary = frame.filter("ends IS NOT NULL").groupBy("indicator_id").agg(
        F.first("scale").alias("scale"),
        F.first("overlap_periods").alias("overlap_periods"),
        F.first(F.col("ratio_var") / (F.col("scale") * F.col("scale"))).alias("ratio_variance"),
        F.year(F.first("ends")).alias("base_year_from"),
        F.year(F.first("boundary")).alias("base_year_to"),
    )
    summary = summary.withColumn("confidence", confidence(months, F.col("ratio_variance")))
    return Linked(frame.select(*_FRAME), summary, refused.unionByName(broken))


def splice(old: DataFrame, new: DataFrame, frequency: str = "annual", overlap: int | None = None) -> Linked:
    """Old series put on the base of new ones by the mean ratio of their shared periods; each side has one row per period.

    The new series holds from its first period on.  ``overlap`` takes the most
    recent so many shared periods only.  Series that one side lacks are left
    out.  The summary has a row per pair: (indicator_id, scale,
    overlap_periods, ratio_variance, base_year_from, base_year_to, confidence).
    """
    return _joined_up(_compared(old, new, frequency, overlap).filter("ends IS NOT NULL"), frequency)


def fold_segments(segments: DataFrame, frequency: str = "annual", most: int | None = None) -> Linked:
    """Series published in overlapping segments, folded from the newest (highest ``segment``) back to the oldest.

    ``segments``: observations with an integer ``segment`` that counts from 0
    per indicator.  Each step splices the next older segment of all series at
    once, so there are as many steps as the longest series has segments less
    one.  A series with one segment passes through.
    """
    last = segments.groupBy("indicator_id").agg(F.max("segment").alias("last"))
    dealt = written(segments.join(last, "indicator_id").withColumn("age", F.col("last") - F.col("segment")))
    steps = most if most is not None else (dealt.agg(F.max("last")).first()[0] or 0)
    combined = prepared(dealt.filter("age = 0").select("indicator_id", "timestamp", "value")).select(*_FRAME)
    outcomes, violations = None, None
    for age in range(1, steps + 1):
        older = dealt.filter(F.col("age") == age).select("indicator_id", "timestamp", "value")
        # One table a step, from which come the next step's series, the outcomes and the violations.
        step = _joined_up(written(_compared(older, combined, frequency, None)), frequency)
        combined = step.frame
        outcomes = step.summary if outcomes is None else outcomes.unionByName(step.summary)
        violations = step.violations if violations is None else violations.unionByName(step.violations)
    if outcomes is None or violations is None:
        nothing = combined.select("indicator_id").limit(0)
        violations = _violation(nothing, F.lit(""))
        return Linked(combined, _passed(combined), violations)
    months = months_per_period(F.lit(frequency))
    folded = outcomes.groupBy("indicator_id").agg(
        F.round(F.avg("confidence"), 4).alias("avg_confidence_score"),
        F.round(F.avg("ratio_variance"), 10).alias("growth_rate_variance"),
        (F.sum("overlap_periods") * F.first(months)).cast("int").alias("overlap_period_months"),
        F.min("base_year_from").alias("base_year_from"),
        F.max("base_year_to").alias("base_year_to"),
    )
    # A series that was refused at one step isn't among the next one's.
    counted = combined.groupBy("indicator_id").agg(F.count_if("is_linked").alias("records_linked"))
    linked = F.col("avg_confidence_score").isNotNull()
    summary = counted.join(folded, "indicator_id", "left").select(
        "indicator_id", linked.alias("is_chain_linked"), F.when(linked, F.lit(K.METHOD_OVERLAP)).alias("linking_method"), "records_linked", "avg_confidence_score",
        "overlap_period_months", "growth_rate_variance", "base_year_from", "base_year_to",
    )
    return Linked(combined, summary, violations)


def _passed(frame: DataFrame) -> DataFrame:
    none = F.lit(None)
    return frame.groupBy("indicator_id").agg(F.lit(0).cast("long").alias("records_linked")).select(
        "indicator_id", F.lit(False).alias("is_chain_linked"), none.cast("string").alias("linking_method"), "records_linked", none.cast("double").alias("avg_confidence_score"),
        none.cast("int").alias("overlap_period_months"), none.cast("double").alias("growth_rate_variance"), none.cast("int").alias("base_year_from"), none.cast("int").alias("base_year_to"),
    )


def chain_link(series: DataFrame, base_years: DataFrame, segments: DataFrame | None = None, frequency: str = "annual", statistical: bool = False) -> Linked:
    """Every series by its means: published segments where there are any, else breaks, else passed through."""
    if segments is None:
        return link_at_breaks(series, detect_breaks(series, base_years, statistical))
    own = segments.select("indicator_id").distinct()
    rest = series.join(own, "indicator_id", "left_anti")
    folded = fold_segments(segments, frequency)
    cut = link_at_breaks(rest, detect_breaks(rest, base_years, statistical))
    return Linked(
        folded.frame.select(*_FRAME).unionByName(cut.frame.select(*_FRAME)),
        folded.summary.unionByName(cut.summary.drop("breaks")),
        folded.violations.unionByName(cut.violations),
        cut.breaks,
    )
