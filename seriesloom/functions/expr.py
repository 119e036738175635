"""Column expressions of the operators; all stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seriesloom import constants as K

#: Digits of two other scripts that payloads may use, by their value (fixed values).
_OTHER_DIGITS = "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹"


def is_missing(value: Column) -> Column:
    """Null or not a number."""
    return value.isNull() | F.isnan(value)


def is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def blank_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


def _ascii(value: Column) -> Column:
    return F.trim(F.translate(value, _OTHER_DIGITS, "0123456789" * 2))


def period_end(date: Column) -> Column:
    """The last day of a four-digit year, at midnight UTC; null for anything else."""
    year = _ascii(date)
    whole = year.rlike("^[0-9]{4}$") & (year != "0000")
    return F.when(whole, F.make_timestamp_ntz(year.try_cast("int"), F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0)))


def number(text: Column) -> Column:
    """A value given as text: null if blank or no number (see ``is_bad_number``)."""
    return blank_to_null(_ascii(text)).try_cast("double")


def is_bad_number(text: Column) -> Column:
    """True for text that is neither blank nor a number."""
    return blank_to_null(text).isNotNull() & number(text).isNull()


def unit_of(unit: Column, name: Column) -> Column:
    """The given unit, else what stands in brackets at the end of the indicator's name; cut to 50 characters."""
    bracketed = F.regexp_extract(name, r"\(([^()]+)\)\s*$", 1)
    return F.substring(F.coalesce(blank_to_null(unit), blank_to_null(bracketed)), 1, K.MAX_UNIT_CHARS)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """The ratio, or null if it is undefined, not finite or not positive."""
    ratio = F.try_divide(numerator, denominator)
    return F.when(is_finite(numerator) & is_finite(denominator) & (ratio > 0), ratio)


def confidence(months: Column, variance: Column) -> Column:
    """Trust in a link from its overlap and the variance of its ratios, 0 to 1 in four decimals."""
    share = F.least(F.greatest(months / K.FULL_OVERLAP_MONTHS, F.lit(0.0)), F.lit(1.0))
    base = K.CONFIDENCE_FLOOR + (1 - K.CONFIDENCE_FLOOR) * share
    penalty = 1 + K.VARIANCE_WEIGHT * F.greatest(F.coalesce(variance, F.lit(0.0)), F.lit(0.0))
    return F.round(F.least(F.greatest(base / penalty, F.lit(0.0)), F.lit(1.0)), 4)


def _by_frequency(frequency: Column, table: dict[str, int], default: int) -> Column:
    out = F.lit(default)
    for name, value in table.items():
        out = F.when(frequency == name, F.lit(value)).otherwise(out)
    return out


def min_overlap(frequency: Column) -> Column:
    return _by_frequency(frequency, K.MIN_OVERLAP_PERIODS, K.DEFAULT_MIN_OVERLAP)


def months_per_period(frequency: Column) -> Column:
    return _by_frequency(frequency, K.MONTHS_PER_PERIOD, K.DEFAULT_MONTHS)


def run_status(written: Column, failed: Column) -> Column:
    """success without failures (even of nothing), partial if anything was written, else failed."""
    return F.when(failed == 0, "success").when(written > 0, "partial").otherwise("failed")


def derived_id(indicator: Column) -> Column:
    return F.concat(F.lit(f"{K.DERIVED_PREFIX}."), indicator, F.lit(f".{K.DERIVED_SUFFIX}"))


def domain_of(explicit: Column, catalog: Column) -> Column:
    return F.coalesce(blank_to_null(explicit), blank_to_null(catalog), F.lit(K.DEFAULT_DOMAIN))


def base_years_of(explicit: Column, catalog: Column) -> Column:
    """The given base years, or the catalog's where none are given."""
    return F.when(F.size(F.coalesce(explicit, F.array().cast("array<int>"))) > 0, explicit).otherwise(catalog)


def stable_id(*parts: Column | str) -> Column:
    """An id that depends on the parts alone, so that a rerun writes the same row."""
    return F.sha2(F.concat_ws("/", *(F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts)), 256)


def base_year_pairs(years: Column) -> Column:
    """Neighbouring pairs (base_from, base_to) of the sorted distinct years."""
    ordered = F.array_sort(F.array_distinct(F.filter(years, lambda y: y.isNotNull())))
    return F.transform(
        F.slice(ordered, 1, F.greatest(F.size(ordered) - 1, F.lit(0))),
        lambda y, k: F.struct(y.alias("base_from"), F.get(ordered, k + 1).alias("base_to")),
    )
