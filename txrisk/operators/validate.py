"""Gates: required columns, and row-level validation of scoring requests."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.functions.columns import named
from txrisk.schema import REQUEST_COLUMNS, REQUEST_SCHEMA

POSITIVE_COLUMNS = ("Amount", "Value")


def require_columns(df: DataFrame, required: Sequence[str] = tuple(REQUEST_COLUMNS)) -> DataFrame:
    """``df`` itself, or an error that lists the missing columns; looks at the schema only."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def _typed(df: DataFrame, name: str) -> Column:
    """The column in its declared type, null where its text does not parse."""
    target = REQUEST_SCHEMA[name].dataType
    if name not in df.columns:
        return F.lit(None).cast(target)
    if df.schema[name].dataType == target:
        return named(name)
    parsed = named(name).try_cast(target)
    if target.typeName() in ("integer", "long") and df.schema[name].dataType.typeName() in ("double", "float", "decimal"):
        # A fraction isn't a whole number.
        return F.when(named(name) == F.floor(named(name)), parsed)
    if target.typeName() == "timestamp" and df.schema[name].dataType.typeName() == "string":
        # Spark would read a bare time of day as today; ISO 8601 starts with the date.
        return F.when(F.trim(named(name)).rlike(r"^\d{4}-\d{2}-\d{2}"), parsed)
    return parsed


def with_errors(df: DataFrame) -> DataFrame:
    """``df`` in declared types plus ``errors``: the reasons each row is bad, empty for a good one. One pass, no shuffle.

    ``raw`` holds the values that don't fit their type, by column, as text; it is empty for the others.
    """
    errors, typed, raws = [], [], []
    for name in REQUEST_COLUMNS:
        raw = named(name) if name in df.columns else F.lit(None).cast("string")
        value = _typed(df, name)
        bad_type = raw.isNotNull() & value.isNull()
        errors.append(F.when(raw.isNull(), F.lit(f"{name}: missing")))
        errors.append(F.when(bad_type, F.lit(f"{name}: not a valid {REQUEST_SCHEMA[name].dataType.simpleString()}")))
        if name in POSITIVE_COLUMNS:
            errors.append(F.when((value <= 0) | F.isnan(value), F.lit(f"{name}: must be greater than 0")))
        raws.append(F.when(bad_type, F.struct(F.lit(name).alias("column"), raw.cast("string").alias("value"))))
        typed.append(value.alias(name))
    others = [named(c) for c in df.columns if c not in REQUEST_COLUMNS]
    raw_values = F.map_from_entries(F.array_compact(F.array(*raws)))
    return df.select(*others, *typed, F.array_compact(F.array(*errors)).alias("errors"), raw_values.alias("raw"))


class Validated(NamedTuple):
    accepted: DataFrame
    rejected: DataFrame


def split_valid(checked: DataFrame, request: str | None = None) -> Validated:
    """Good and bad rows of a ``with_errors`` frame.

    With ``request`` (a request id column) one bad row refuses its whole request; the other rows of such a request are
    rejected with an empty ``errors`` list. Rows without request id are rejected. Every row is on one of the two sides.
    """
    bad = F.size("errors") > 0
    if request is None:
        return Validated(checked.where(~bad).drop("errors", "raw"), checked.where(bad))
    unknown = named(request).isNull()
    reason = F.when(unknown, F.array_append("errors", F.lit(f"{request}: missing"))).otherwise(F.col("errors"))
    refused = checked.where(bad & ~unknown).select(request).distinct()
    return Validated(
        checked.where(~unknown).join(refused, request, "left_anti").drop("errors", "raw"),
        checked.where(~unknown).join(refused, request, "left_semi").unionByName(checked.where(unknown).withColumn("errors", reason)),
    )


def validate_transactions(df: DataFrame, strict: bool = False) -> Validated:
    """Split into accepted rows and rejected rows with reasons.

    ``strict`` refuses the whole table when any row is bad (this looks for one bad row, so it runs a job).
    """
    checked = with_errors(df)
    if strict:
        first_bad = checked.where(F.size("errors") > 0).select("errors").first()
        if first_bad is not None:
            raise ValueError(f"Invalid transactions, for example: {first_bad['errors']}")
    return split_valid(checked)


def error_counts(df: DataFrame) -> DataFrame:
    """``(reason, n)`` over all rows of ``df``."""
    reasons = with_errors(df).select(F.explode("errors").alias("reason"))
    return reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
