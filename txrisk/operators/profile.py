"""Profiling of a transaction table: each function returns the table behind one report or chart."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.functions.columns import named, to_long
from txrisk.operators.quantiles import exact_quantiles

QUARTILES = (0.25, 0.5, 0.75)


def shape(df: DataFrame) -> DataFrame:
    """``(rows, columns)``."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"))


def column_info(df: DataFrame) -> DataFrame:
    """``(column, type, non_null)``, from one scan."""
    counted = df.agg(*(F.count(named(c)).alias(c) for c in df.columns))
    types = F.create_map(*(F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())))
    long = counted.unpivot([], [named(c) for c in df.columns], "column", "non_null")
    return long.select("column", types[F.col("column")].alias("type"), "non_null")


def _long_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value)`` with values as text."""
    text = df.select(*(named(c).cast("string").alias(c) for c in columns))
    return text.unpivot([], [named(c) for c in columns], "column", "value")


def describe(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """``(column, count, mean, std, min, p25, p50, p75, max)``; std is the sample deviation.

    Quartiles are exact and interpolated (which runs jobs). ``approx`` replaces them by one-pass sketches, without
    interpolation.
    """
    long = to_long(df, [], columns, "column")
    sketch = [F.percentile_approx("value", p, 10_000).alias(f"p{int(p * 100)}") for p in QUARTILES] if approx else []
    stats = long.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        *sketch,
    )
    if not approx:
        quartiles = exact_quantiles(df, columns, QUARTILES)
        stats = stats.withColumns({f"p{int(p * 100)}": _constant(quartiles, i) for i, p in enumerate(QUARTILES)})
    return stats.select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def _constant(per_column: Mapping[str, Sequence[float]], i: int) -> Column:
    """The ``i``-th constant of the row's ``column``; null for a column that has none."""
    known = [x for name, values in per_column.items() for x in (F.lit(name), F.lit(values[i]))]
    return F.create_map(*known)[F.col("column")] if known else F.lit(None).cast("double")


def id_uniqueness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, distinct_values, rows, duplicates, is_unique)``; nulls are no value.

    Counts per (column, value) first, so the distinct work of all columns spreads over one shuffle.
    """
    counts = _long_text(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    per_column = counts.groupBy("column").agg(F.count("value").alias("distinct_values"), F.sum("n").alias("rows"))
    duplicates = F.col("rows") - F.col("distinct_values")
    return per_column.withColumns({"duplicates": duplicates, "is_unique": duplicates == 0})


def value_counts(df: DataFrame, columns: Sequence[str], ordered: bool = True) -> DataFrame:
    """``(column, value, n)`` over the known values of several columns; largest count first, smaller value on ties."""
    long = _long_text(df, columns).where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy("column", F.desc("n"), "value") if ordered else counts


def class_balance(df: DataFrame, column: str) -> DataFrame:
    """``(<column>, n, share)`` over the known values."""
    known = df.where(named(column).isNotNull())
    counts = known.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    # One row per class: their total needs no second scan.
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))))


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """``(<column>, n)``: the ``n`` most frequent known values; the smaller value wins ties."""
    counts = df.where(named(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(column)).limit(n)


def filter_top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The rows of ``df`` whose value is among the ``n`` most frequent ones."""
    return df.join(top_values(df, column, n).select(column), column, "left_semi")


def _bounds(long: DataFrame) -> DataFrame:
    """``(column, lo, hi)``; one row per column, a single-valued column is widened by half a unit on both sides."""
    ends = long.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    return ends.where(F.col("lo").isNotNull()).select(
        "column",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )


def _finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 50) -> DataFrame:
    """``(column, bin, lower, upper, n)``: equal bins over [min, max], the last one closed, empty ones kept.

    Every value lies in ``lower <= value < upper`` as they are given. Values that aren't finite are left out.
    """
    long = to_long(df, [], columns, "column").where(_finite(F.col("value")))
    bounds = _bounds(long)
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)

    def edge(number: Column) -> Column:
        return F.when(number == bins, F.col("hi")).otherwise(F.col("lo") + number * width)

    # Rounding can put a value on an edge beside its bin by one.
    near = F.greatest(F.lit(0), F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1)))
    moved = near + F.when(F.col("value") < edge(near), -1).when((F.col("value") >= edge(near + 1)) & (near < bins - 1), 1).otherwise(0)
    # One row per column is broadcast; the counts are at most ``bins`` rows per column.
    binned = long.join(F.broadcast(bounds), "column").withColumn("bin", (moved + 1).cast("int"))
    counts = binned.groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n"))
    grid = bounds.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
    return grid.join(counts, ["column", "bin"], "left").select(
        "column",
        "bin",
        edge(F.col("bin") - 1).alias("lower"),
        edge(F.col("bin")).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


# Cells per bandwidth, and terms of the kernel's expansion about the middle of a cell: together they leave an error far below
# 1e-12 of the peak. Beyond this reach, in bandwidths, the kernel is 0 in double precision.
_CELLS_PER_BANDWIDTH = 16
_TERMS = 10
_REACH = 39.0


def density_curve(df: DataFrame, columns: Sequence[str], points: int = 200) -> DataFrame:
    """``(column, point, x, density)``: Gaussian kernel density with Scott's bandwidth, on an even grid over [min, max].

    Values are counted in cells a sixteenth of a bandwidth wide, which keep the first moments of their values. The kernel at
    a grid point is expanded in Hermite polynomials about the middle of each cell, so the sum is that over all values,
    while the kernel work depends on the range, not on the row count. Values that aren't finite are left out.
    """
    long = to_long(df, [], columns, "column").where(_finite(F.col("value")))
    stats = long.groupBy("column").agg(
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
        F.count(F.lit(1)).alias("total"),
        (F.stddev_samp("value") * F.pow(F.count(F.lit(1)).cast("double"), F.lit(-0.2))).alias("h"),
    )
    # A density needs spread; columns without it give no rows. One row per column is broadcast.
    stats = stats.where(F.col("h") > 0).withColumn("step", (F.col("hi") - F.col("lo")) / F.lit(points - 1))
    width = F.col("h") / _CELLS_PER_BANDWIDTH
    placed = long.join(F.broadcast(stats), "column").withColumn("cell", F.floor((F.col("value") - F.col("lo")) / width))
    off = (F.col("value") - F.col("lo") - (F.col("cell") + 0.5) * width) / F.col("h")
    moments = [F.sum(F.pow(off, F.lit(float(k)))).alias(f"m{k}") for k in range(_TERMS)]
    cells = placed.groupBy("column", "cell").agg(*moments)
    middle = (F.col("cell") + 0.5) * width
    reach = F.lit(_REACH) * F.col("h")
    first = F.greatest(F.lit(0), F.ceil((middle - reach) / F.col("step")))
    last = F.least(F.lit(points - 1), F.floor((middle + reach) / F.col("step")))
    touched = (
        cells.join(F.broadcast(stats), "column")
        .where(first <= last)
        .withColumn("point", F.explode(F.sequence(first, last)))
        .withColumn("t", (F.col("point") * F.col("step") - middle) / F.col("h"))
    )
    # He(0) = 1, He(1) = t, He(k + 1) = t He(k) - k He(k - 1).
    for k in range(_TERMS):
        term = F.lit(1.0) if k == 0 else F.col("t") if k == 1 else F.col("t") * F.col(f"he{k - 1}") - (k - 1) * F.col(f"he{k - 2}")
        touched = touched.withColumn(f"he{k}", term)
    series = sum((F.col(f"he{k}") * F.col(f"m{k}") / math.factorial(k) for k in range(1, _TERMS)), F.col("m0"))
    sums = touched.groupBy("column", "point").agg(F.sum(F.exp(-F.col("t") * F.col("t") / 2) * series).alias("mass"))
    grid = stats.withColumn("point", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(points - 1).cast("long"))))
    return grid.join(sums, ["column", "point"], "left").select(
        "column",
        F.col("point").cast("int").alias("point"),
        (F.col("lo") + F.col("point") * F.col("step")).alias("x"),
        (F.coalesce("mass", F.lit(0.0)) / (F.col("total") * F.col("h") * math.sqrt(2 * math.pi))).alias("density"),
    )


def box_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, q1, median, q3, whisker_low, whisker_high, outliers)``.

    Whiskers reach the furthest values within 1.5 interquartile ranges of the box, and end at the box where there is none
    outside it; values beyond are outliers. The quartiles run jobs.
    """
    quartiles = exact_quantiles(df, columns, QUARTILES)
    q1, median, q3 = (_constant(quartiles, i) for i in range(3))
    long = to_long(df, [], [c for c in columns if c in quartiles], "column").where(F.col("value").isNotNull())
    margin = (q3 - q1) * 1.5
    inside = F.col("value").between(q1 - margin, q3 + margin)
    return (
        long.groupBy("column")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
        .select("column", q1.alias("q1"), median.alias("median"), q3.alias("q3"), F.least("whisker_low", q1).alias("whisker_low"), F.greatest("whisker_high", q3).alias("whisker_high"), "outliers")
    )


def distinct_pairs(df: DataFrame, left: str, right: str) -> DataFrame:
    """The distinct ``(left, right)`` pairs; null is a value of its own here."""
    return df.select(left, right).distinct()


def pair_counts(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``(pair, n)``: number of distinct pairs for each of ``pairs``."""
    counted = [
        distinct_pairs(df, a, b).agg(F.lit(f"{a}-{b}").alias("pair"), F.count(F.lit(1)).alias("n")) for a, b in pairs
    ]
    return _union(counted)


def keys_with_many(df: DataFrame, key: str, other: str) -> DataFrame:
    """``(<key>, n)``: keys that occur with more than one value of ``other``.

    Distinct pairs come first, so a key shared by very many others is spread over tasks and reaches the count reduced.
    """
    pairs = distinct_pairs(df, key, other).where(named(key).isNotNull())
    return pairs.groupBy(key).agg(F.count(other).alias("n")).where(F.col("n") > 1)


def relation_checks(df: DataFrame, relations: Sequence[tuple[str, str]]) -> DataFrame:
    """``(relation, keys, keys_with_many, is_unique)``, one row per ``(key, other)`` relation.

    Both directions of a relation read the same distinct pairs, so Spark runs that shuffle once. For this the pair is always
    written in the same column order, and null keys are left out of the counts instead of being filtered (a filter would be
    pushed into the scan of each direction and make the two differ).
    """
    checks = []
    for key, other in relations:
        per_key = distinct_pairs(df, *sorted((key, other))).groupBy(key).agg(F.count(other).alias("n"))
        checks.append(
            per_key.agg(
                F.lit(f"{key}->{other}").alias("relation"),
                F.count(named(key)).alias("keys"),
                F.count_if(named(key).isNotNull() & (F.col("n") > 1)).alias("keys_with_many"),
            )
        )
    return _union(checks).withColumn("is_unique", F.col("keys_with_many") == 0)


def shared_key_samples(
    df: DataFrame,
    key: str = "AccountId",
    other: str = "CustomerId",
    order: Sequence[str] = ("TransactionStartTime", "TransactionId"),
    columns: Sequence[str] = ("AccountId", "CustomerId", "TransactionId", "TransactionStartTime", "Amount"),
    n: int = 5,
) -> DataFrame:
    """The first ``n`` rows of every key that occurs with more than one ``other``.

    The rows are numbered before the join: Spark cuts every partition to ``n`` rows per key ahead of the shuffle, so a key
    with very many rows costs no more than any other, and the join finds both sides partitioned by the key. (A semi join
    would be pushed below the window and move all rows of the shared keys.)
    """
    ranked = df.where(named(key).isNotNull()).select(
        *columns, F.row_number().over(Window.partitionBy(key).orderBy(*order)).alias("row")
    )
    return ranked.where(F.col("row") <= n).join(keys_with_many(df, key, other).select(key), key).select(*columns, "row")


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
