"""Landed payloads: JSON envelopes of meta and rows, in pages, and what they hold.

An envelope is a JSON array [meta, rows] or an object {"meta", "rows"}.
Payload tables have (indicator_id, page, payload), the payload as text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesloom import constants as K


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """(path, payload) of landed files, one payload a file."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("payload"))


def _get(v: str, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(F.col(v), path, kind)


@dataclass(frozen=True)
class Envelopes:
    """(indicator_id, page, meta, rows) with variants, and what isn't an envelope."""

    good: DataFrame
    violations: DataFrame


def error_message(v: str = "v") -> Column:
    """The message of an error payload, "key: value" or as it stands; null for others."""
    out = []
    for at in ("$[0].message", "$.message"):
        key, value = _get(v, f"{at}[0].key"), _get(v, f"{at}[0].value")
        out += [F.when(key.isNotNull() | value.isNotNull(), F.concat_ws(": ", key, value)), F.nullif(_get(v, at), F.lit(""))]
    return F.coalesce(*out)


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with further columns, worked out once a row: a filter above isn't pushed below the generator, so it doesn't repeat them."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def split_envelopes(payloads: DataFrame) -> Envelopes:
    """Meta and rows of each payload; a list of one has no rows, rows that are no list count as none, meta that is no object as empty."""
    v = _once(payloads, v=F.try_parse_json("payload"))
    # Only what stands at the top is looked at: a schema of the whole payload would be read off all its rows.
    v = _once(v, items=_get("v", "$", "array<variant>"), is_object=_get("v", "$", "map<string,variant>").isNotNull(), message=error_message())
    is_list = F.col("items").isNotNull()
    meta = F.when(is_list, F.get("items", F.lit(0))).otherwise(_get("v", "$.meta", "variant"))
    rows = F.when(is_list, F.try_variant_get(F.get("items", F.lit(1)), "$", "array<variant>")).otherwise(_get("v", "$.rows", "array<variant>"))
    wrong = F.when(F.col("message").isNotNull(), F.col("message")).when(~(is_list | F.col("is_object")), F.lit("payload is neither a list nor an object"))
    v = v.withColumn("problem", wrong)
    told = [c for c in ("bronze_id",) if c in payloads.columns]
    good = v.filter("problem IS NULL").select("indicator_id", "page", *told, F.when(F.schema_of_variant(meta).startswith("OBJECT"), meta).alias("meta"), F.coalesce(rows, F.array().cast("array<variant>")).alias("rows"))
    bad = v.filter("problem IS NOT NULL").select("indicator_id", F.when(F.col("message").isNotNull(), "api").otherwise("parse").alias("error_type"), F.col("problem").alias("message"))
    return Envelopes(good, bad)


def within_pages(good: DataFrame, max_pages: int = K.MAX_PAGES) -> tuple[DataFrame, DataFrame]:
    """The pages that count, and why the others don't (indicator_id, page, error_type, message).

    A series has as many pages as the meta of its first page says (one where
    it says nothing), and no more than the guard.
    """
    told = F.coalesce(F.try_variant_get("meta", "$.pages", "int"), F.lit(1))
    in_order = Window.partitionBy("indicator_id").orderBy(F.asc_nulls_last("page")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A window, so that pages aren't read twice to be joined with themselves.
    every = good.withColumn("_told", told).withColumn("pages", F.first("_told").over(in_order)).drop("_told")
    most = F.least("pages", F.lit(max_pages))
    beyond = every.filter(F.col("page") > most)
    why = F.format_string("page %d of %d", "page", most)
    return every.filter(F.col("page") <= most).drop("pages"), beyond.select("indicator_id", "page", F.lit("page").alias("error_type"), why.alias("message"))


def concatenated(good: DataFrame, max_pages: int = K.MAX_PAGES) -> DataFrame:
    """(indicator_id, meta, rows): all pages' rows in page order and the first page's meta; pages past meta.pages or the guard are left out."""
    pages, _ = within_pages(good, max_pages)
    # Where any page counts, the first one does.  Pages without a series are no series.
    parts = pages.filter("indicator_id IS NOT NULL").groupBy("indicator_id").agg(F.array_sort(F.collect_list(F.struct("page", F.to_json("rows").alias("rows")))).alias("parts"), F.min_by("meta", "page").alias("meta"))
    joined = F.flatten(F.transform("parts", lambda p: F.from_json(p["rows"], "array<string>")))
    return parts.select("indicator_id", "meta", joined.alias("rows"))


def raw_rows(good: DataFrame, first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """One row per observation object: (indicator_id, page, code, name, date, value, unit, obs_status, pos), all as text; ``pos`` is its place in the payload, ``bronze_id`` goes along where the envelopes have one."""
    told = [c for c in ("bronze_id",) if c in good.columns]
    each = good.select("indicator_id", "page", *told, F.posexplode("rows").alias("n", "row"))
    out = each.select(
        "indicator_id",
        "page",
        *told,
        _get("row", "$.indicator.id").alias("code"),
        _get("row", "$.indicator.value").alias("name"),
        _get("row", "$.date").alias("date"),
        _get("row", "$.value").alias("value"),
        _get("row", "$.unit").alias("unit"),
        _get("row", "$.obs_status").alias("obs_status"),
        (F.col("page").cast("long") * (1 << 32) + F.col("n")).alias("pos"),
        F.schema_of_variant("row").startswith("OBJECT").alias("is_object"),
    )
    if first_year is not None or last_year is not None:
        year = F.col("date").try_cast("int")
        out = out.filter(year.isNull() | year.between(first_year or 0, last_year or 9999))
    return out


def row_violations(rows: DataFrame) -> DataFrame:
    """Series with elements among their rows that aren't objects."""
    bad = rows.filter(~F.coalesce("is_object", F.lit(False))).select("indicator_id").distinct()
    return bad.select("indicator_id", F.lit("parse").alias("error_type"), F.lit("a row isn't an object").alias("message"))


def catalog_rows(payloads: DataFrame, domains: dict[str, str] | DataFrame, frequency: str = "annual") -> DataFrame:
    """Catalog rows of metadata payloads; dates and base years aren't known there.

    ``domains``: a table (indicator_id, domain), or the same as a dictionary.
    Of several domains of an id the first in order counts; a blank one is none.
    """
    spark = payloads.sparkSession
    if isinstance(domains, dict):
        # What a program spells out is small.
        known = F.broadcast(spark.createDataFrame(list(domains.items()), "code string, named string"))
    else:
        known = domains.groupBy(F.col("indicator_id").alias("code")).agg(F.min(F.nullif(F.trim("domain"), F.lit(""))).alias("named"))
    each = split_envelopes(payloads).good.select(F.explode("rows").alias("row")).withColumn("code", _get("row", "$.id")).join(known, "code", "left")
    domain = F.coalesce("named", F.lit(K.DEFAULT_DOMAIN))
    return each.select(
        F.col("code").alias("indicator_id"),
        _get("row", "$.name").alias("name"),
        F.nullif(_get("row", "$.sourceNote"), F.lit("")).alias("description"),
        F.nullif(_get("row", "$.unit"), F.lit("")).alias("unit"),
        F.lit(frequency).alias("frequency"),
        domain.alias("domain"),
        _get("row", "$.source.value").alias("source_name"),
        F.lit(None).cast("array<int>").alias("base_years"),
    ).filter("indicator_id IS NOT NULL")


def discovered(payloads: DataFrame, domains: dict[str, str] | DataFrame, frequency: str = "annual") -> tuple[DataFrame, DataFrame]:
    """``catalog_rows``, one per id, and the payloads that are no envelopes; a discovery that finds no series at all is an error."""
    rows = catalog_rows(payloads, domains, frequency).dropDuplicates(["indicator_id"])
    wrong = split_envelopes(payloads).violations
    if rows.isEmpty():
        first = wrong.agg(F.min("message")).first()[0]
        raise LookupError("discovery found no series" + (f": {first}" if first else ""))
    return rows, wrong
