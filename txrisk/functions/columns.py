"""Small column expressions shared by the operators. All of them are built-in Spark expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def named(name: str) -> Column:
    """A column by its exact name, also when the name holds dots, spaces or backticks (``cat__...`` columns may)."""
    return F.col("`" + name.replace("`", "``") + "`")


def days_since(moment: Column, reference: Column) -> Column:
    """Whole days from ``moment`` to ``reference``, rounded down: one hour in the future is -1."""
    return F.floor((F.unix_micros(reference) - F.unix_micros(moment)) / F.lit(MICROS_PER_DAY))


def position_of_first_max(values: Sequence[Column]) -> Column:
    """0-based position of the largest of ``values``; the first one on ties."""
    return (F.array_position(F.array(*values), F.greatest(*values)) - 1).cast("int")


def position_of_first_min(values: Sequence[Column]) -> Column:
    """0-based position of the smallest of ``values``; the first one on ties."""
    return (F.array_position(F.array(*values), F.least(*values)) - 1).cast("int")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Spark counts NaN as a value; here it always means "missing", so floating columns get nulls instead."""
    floating = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(named(c)), named(c)) for c in floating}) if floating else df


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "feature") -> DataFrame:
    """Unpivot ``values`` (cast to double) into one row per id and value column: ``(*ids, name, value)``."""
    wide = df.select(*(named(c) for c in ids), *(named(c).cast("double").alias(c) for c in values))
    return wide.unpivot([named(c) for c in ids], [named(c) for c in values], name, "value")
