"""Validation, and quarantine with one row per reason."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.functions.identity import content_id
from adjudica.functions.privacy import mask_text

# --- fixed values: reasons are part of the quarantine key, so their wording must not change -----------
CRITICAL_FIELDS = [
    ("ticket_id", "missing_ticket_id"),
    ("vehicle_reg", "missing_vehicle"),
    ("origin_hub", "missing_origin_hub"),
    ("created_at", "unparseable_created_at"),
]
NOT_AN_OBJECT = "record_not_an_object"
NOT_IN_FLEET = "vehicle_not_in_fleet"


def validate(
    df: DataFrame, checks: Sequence[tuple[str, str]] = tuple(CRITICAL_FIELDS), is_object: Column | None = None
) -> DataFrame:
    """``df`` with ``reasons``: every failed check in the given order, empty for a usable record."""
    failed = []
    for name, reason in checks:
        absent = F.col(name).isNull()
        if df.schema[name].dataType.typeName() == "string":
            absent = absent | (F.col(name) == "")
        failed.append(F.when(absent, F.lit(reason)))
    reasons = F.array_compact(F.array(*failed))
    if is_object is not None:
        reasons = F.when(is_object, reasons).otherwise(F.array(F.lit(NOT_AN_OBJECT)))
    return df.withColumn("reasons", reasons)


def quarantine_key(key: Column | str, raw: Column | str) -> Column:
    """The record's own key, or one made from its content where it has none."""
    k = F.col(key) if isinstance(key, str) else key
    return F.coalesce(k, F.concat(F.lit("MALFORMED:"), content_id("Q", raw)))


def quarantine_rows(df: DataFrame, key: str, raw: str, salt: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per (key, reason), for records with at least one; the raw record is masked here.

    Records without a key that are equal in content share a key, and so one row per reason: the first by
    its masked text and the ``keep`` columns.
    """
    keyed = df.filter(F.size("reasons") > 0).select(
        quarantine_key(key, raw).alias("ticket_key"), "reasons", mask_text(raw, salt).alias("raw_json"), *keep
    )
    each = keyed.select("ticket_key", F.explode("reasons").alias("reason"), F.struct("raw_json", *keep).alias("row"))
    return each.groupBy("ticket_key", "reason").agg(F.min("row").alias("row")).select("ticket_key", "reason", "row.*")


def reject_orphans(df: DataFrame, dimension: DataFrame, key: str, dimension_key: str) -> DataFrame:
    """Rows whose key is set but unknown to the dimension."""
    known = dimension.select(F.col(dimension_key).alias("__known"))
    return df.filter(F.col(key).isNotNull()).join(known, F.col(key) == F.col("__known"), "left_anti")
