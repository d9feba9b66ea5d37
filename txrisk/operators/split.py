"""Stratified train/test split and stratified folds: exact shares per class, independent of layout and row order.

Rows are ranked inside their class by a hash of their key. The rank itself is never computed: per class, the hash at each
wanted rank is found (counts per hash prefix, then a look inside the one prefix that holds the rank), and every row is
compared with those few hashes, which are joined by class. No task holds a class, and no class is gathered on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.functions.columns import named
from txrisk.schema import CUSTOMER

_PREFIX = 4  # hex digits: 65,536 prefixes per class at most, even by construction of the hash


def key_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat(named(key).cast("string"), F.lit(f":{seed}")))


def stratum_cuts(df: DataFrame, label: str, key: str, shares: Sequence[float], seed: int) -> DataFrame:
    """``(_label, _cuts)``: per class, the hash of the row at rank ``round(share * rows)`` for each of ``shares``.

    A share that rounds to no row has the empty string, which no hash is below; a class without any cut has no row.
    """
    hashed = df.where(named(label).isNotNull()).select(named(label).alias("_label"), key_hash(key, seed).alias("_hash"))
    hashed = hashed.withColumn("_prefix", F.substring("_hash", 1, _PREFIX))
    counts = hashed.groupBy("_label", "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    in_class = Window.partitionBy("_label")
    counts = counts.withColumns(
        {
            "_end": F.sum("_n").over(in_class.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)),
            "_total": F.sum("_n").over(in_class),
        }
    )
    wanted = F.array(
        *(
            F.struct(F.lit(i).alias("id"), F.round(F.col("_total") * F.lit(float(s))).cast("long").alias("rank"))
            for i, s in enumerate(shares)
        )
    )
    holds = F.filter(wanted, lambda w: (w["rank"] > F.col("_end") - F.col("_n")) & (w["rank"] <= F.col("_end")))
    spots = counts.select("_label", "_prefix", (F.col("_end") - F.col("_n")).alias("_before"), F.explode(holds).alias("_w"))
    spots = spots.select("_label", "_prefix", (F.col("_w.rank") - F.col("_before")).alias("_row"), F.col("_w.id").alias("_id"))
    # Only the prefixes that hold a wanted rank are ranked, each by itself.
    order = Window.partitionBy("_label", "_prefix").orderBy("_hash")
    near = hashed.join(spots.select("_label", "_prefix").distinct(), ["_label", "_prefix"])
    near = near.withColumn("_row", F.row_number().over(order))
    found = near.join(spots, ["_label", "_prefix", "_row"]).groupBy("_label").agg(F.collect_list(F.struct("_id", "_hash")).alias("_found"))
    by_id = F.map_from_entries("_found")
    cut = [F.coalesce(by_id[i], F.lit("")) for i in range(len(shares))]
    return found.select("_label", F.array(*cut).alias("_cuts"))


def stratified_bands(
    df: DataFrame, label: str, key: str, shares: Sequence[float], seed: int = 42, output: str = "band"
) -> DataFrame:
    """Add the number of ``shares`` (ascending, cumulative) each row lies beyond; rows without a label are dropped.

    The cuts, one row per class, are joined; a class that owns most rows makes no shuffle where Spark broadcasts them and is split as
    a skewed key where it doesn't.
    """
    cuts = stratum_cuts(df, label, key, shares, seed)
    rows = df.where(named(label).isNotNull()).join(cuts, named(label) == F.col("_label"), "left")
    beyond = F.size(F.filter(F.coalesce("_cuts", F.array(*[F.lit("")] * len(shares))), lambda c: c < F.col("_own")))
    rows = rows.withColumn("_own", key_hash(key, seed)).withColumn(output, beyond)
    return rows.drop("_label", "_cuts", "_own")


def stratified_split(
    df: DataFrame, label: str = "is_high_risk", key: str = CUSTOMER, test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``split``: ``test`` for ``round(test_share * rows)`` rows of each class, ``train`` for the rest."""
    banded = stratified_bands(df, label, key, [test_share], seed, "_band")
    return banded.withColumn("split", F.when(F.col("_band") == 0, "test").otherwise("train")).drop("_band")


def stratified_folds(
    df: DataFrame, folds: int = 3, label: str = "is_high_risk", key: str = CUSTOMER, seed: int = 42
) -> DataFrame:
    """Add ``fold`` in ``0 .. folds - 1``, even within each class."""
    return stratified_bands(df, label, key, [i / folds for i in range(1, folds)], seed, "fold")
