"""Exact quantiles with linear interpolation, by radix selection, for columns of any size.

``percentile`` would hold all distinct values of a column in one task. Here every double becomes a 64-bit integer in the same
order, and the wanted ranks are narrowed down 16 bits at a time: count per prefix, keep the prefixes that hold a rank, count those 16 bits
deeper. A prefix whose values are all equal ends the search. Whatever the values are like - tiny, clustered, over many powers of ten - a
step counts at most 65,536 cells per column and open prefix, no task sorts or holds values, and four scans are the most; money amounts
end after two. Later scans have literal bounds, which for a stored column reach the Parquet reader.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.functions.columns import named, to_long

_DIGIT = 16
_SHIFTS = (48, 32, 16, 0)


def ordered_bits(value: Column) -> Column:
    """A double as a long integer of the same order: its bits, negative for negative values. Not for nulls and NaN.

    Exponent and fraction come from exact divisions by powers of two; the logarithm only guesses the exponent.
    """
    size = F.abs(value)
    normal = F.greatest(size, F.lit(2.0**-1022))
    guess = F.greatest(F.lit(-1022), F.least(F.lit(1023), F.floor(F.log2(normal)).cast("int")))
    ratio = normal / F.pow(F.lit(2.0), guess)
    exponent = F.when(ratio >= 2, guess + 1).when(ratio < 1, guess - 1).otherwise(guess)
    fraction = normal / F.pow(F.lit(2.0), exponent) - 1
    bits = F.shiftleft((exponent + 1023).cast("long"), 52) + (fraction * F.lit(2.0**52)).cast("long")
    # Below the normal range the fraction alone counts, in steps of 2 ** -1074.
    tiny = (size * F.lit(2.0**537) * F.lit(2.0**537)).cast("long")
    whole = F.when(size == float("inf"), F.lit(0x7FF << 52)).when(size < 2.0**-1022, tiny).otherwise(bits)
    return F.when(value < 0, -whole).otherwise(whole)


def _values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, bits)`` of the known values; adding 0 makes one value of -0.0 and 0.0."""
    long = to_long(df, [], columns, "column").where(F.col("value").isNotNull() & ~F.isnan("value"))
    long = long.withColumn("value", F.col("value") + F.lit(0.0))
    return long.withColumn("bits", ordered_bits(F.col("value")))


def _counts(long: DataFrame, shift: int) -> DataFrame:
    """Values per prefix: ``(column, prefix, n, low, high)``, at most 65,536 rows below one prefix of the level before."""
    prefix = F.shiftright("bits", shift).alias("prefix")
    return long.groupBy("column", prefix).agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))


def _holding(counts: DataFrame, parts: list[str], ranks: Column, *more: str) -> DataFrame:
    """The rows of ``counts`` that hold a rank: one row per rank, with ``id`` and ``at``, the rank inside the row, and ``more`` columns."""
    window = Window.partitionBy(*parts).orderBy("prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counts.withColumn("end", F.sum("n").over(window))
    inside = F.filter(ranks, lambda r: (r["at"] >= F.col("end") - F.col("n")) & (r["at"] < F.col("end")))
    found = placed.select("*", F.explode(inside).alias("rank"))
    return found.select("column", "prefix", "low", "high", F.col("rank.id").alias("id"), (F.col("rank.at") - F.col("end") + F.col("n")).alias("at"), *more)


def _ranks_of(spots: Mapping[tuple[str, int], list[tuple[int, int]]], key: Column) -> Column:
    """Ranks per open prefix as a literal map."""
    entries = []
    for (column, prefix), wanted in spots.items():
        entries.append(F.lit(f"{prefix}/{column}"))
        entries.append(F.array(*(F.struct(F.lit(at).alias("at"), F.lit(i).alias("id")) for at, i in wanted)))
    return F.create_map(*entries)[key]


def _inside(df: DataFrame, spots: list) -> DataFrame:
    """Rows of ``df`` with a value between the ends of an open cell, by plain bounds that a file reader understands."""
    near = F.lit(False)
    for column in {r["column"] for r in spots}:
        own = [r for r in spots if r["column"] == column]
        near = near | named(column).between(min(r["low"] for r in own), max(r["high"] for r in own))
    return df.where(near)


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> dict[str, list[float]]:
    """The value at each of ``shares`` per column, like ``DataFrame.approxQuantile`` but exact and interpolated.

    Runs jobs. Nulls and NaN are ignored; a column without values is absent. What reaches the driver is at most two rows
    per column and share at every step.
    """
    counts = _counts(_values(df, columns), _SHIFTS[0])
    counts = counts.withColumn("last", F.sum("n").over(Window.partitionBy("column")) - 1)
    # Both neighbours of every wanted position, numbered 2i and 2i + 1.
    ranks = F.array(
        *(
            F.struct(side(F.col("last") * F.lit(float(p))).alias("at"), F.lit(2 * i + j).alias("id"))
            for i, p in enumerate(shares)
            for j, side in enumerate((F.floor, F.ceil))
        )
    )
    spots = _holding(counts, ["column"], ranks, "last").collect()
    last = {r["column"]: r["last"] for r in spots}
    found: dict[tuple[str, int], float] = {}
    for shift in (*_SHIFTS[1:], None):
        found |= {(r["column"], r["id"]): r["low"] for r in spots if r["low"] == r["high"]}
        spots = [r for r in spots if r["low"] < r["high"]]
        if not spots or shift is None:
            break
        wanted: dict[tuple[str, int], list[tuple[int, int]]] = {}
        for r in spots:
            wanted.setdefault((r["column"], r["prefix"]), []).append((r["at"], r["id"]))
        open_columns = [c for c in columns if any(r["column"] == c for r in spots)]
        long = _values(_inside(df, spots), open_columns)
        above = F.concat(F.shiftright("bits", shift + _DIGIT).cast("string"), F.lit("/"), F.col("column"))
        counts = _counts(long.where(above.isin([f"{prefix}/{column}" for column, prefix in wanted])), shift)
        parent = F.shiftright("prefix", _DIGIT)
        counts = counts.withColumn("parent", parent)
        key = F.concat(F.col("parent").cast("string"), F.lit("/"), F.col("column"))
        spots = _holding(counts, ["column", "parent"], _ranks_of(wanted, key)).collect()

    def interpolate(column: str, i: int, share: float) -> float:
        low, high = found[column, 2 * i], found[column, 2 * i + 1]
        position = last[column] * share
        # Infinite neighbours have no difference.
        return low if low == high else low + (high - low) * (position - math.floor(position))

    return {c: [interpolate(c, i, float(p)) for i, p in enumerate(shares)] for c in last}
