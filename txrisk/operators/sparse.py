"""One-hot encoding for any number of categories: a category index kept as a table, joined in, and one sparse vector per row.

Nothing per category reaches the driver or the plan. The index numbers the known values of all features in one sequence, feature by
feature and sorted within each; a value takes the slot of its number, unseen values take none, nulls the most frequent value. The
vector continues with the scaled numbers and the extras, so its order is that of ``Preparation.names`` and the extras.

Fitting counts per (feature, value), so a hot value reaches the shuffle as one row per map task; numbers come from the place in a range
partition and the totals of the partitions before it. Encoding joins the index once per feature; a small index is broadcast by
Spark, a large one is a plain table, so a hot value's join can be split.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txrisk.functions.columns import named
from txrisk.operators.prepare import Preparation, numeric_constants, scaled_columns
from txrisk.session import materialise

_ROW_BITS = 33  # monotonically_increasing_id: partition above, place in it below


@dataclass(frozen=True)
class SparsePreparation:
    """``index``: (feature, value, n, slot). ``sizes``: known values per categorical feature; the rest as in ``Preparation``."""

    index: DataFrame
    categorical: tuple[str, ...]
    numerical: tuple[str, ...]
    extras: tuple[str, ...]
    sizes: dict[str, int]
    fill: dict[str, str | float | None]
    scale: dict[str, float]

    @property
    def width(self) -> int:
        return sum(self.sizes.values()) + len(self.numerical) + len(self.extras)

    @property
    def names(self) -> list[str]:
        """Names of the slots after the categories."""
        return [f"num__{c}" for c in self.numerical] + list(self.extras)

    def slots(self) -> DataFrame:
        """(slot, feature): the name of every position of the vector."""
        encoded = self.index.select("slot", F.concat(F.lit("cat__"), "feature", F.lit("_"), "value").alias("feature"))
        start = sum(self.sizes.values())
        spark = self.index.sparkSession
        rest = spark.createDataFrame([(start + i, name) for i, name in enumerate(self.names)], "slot long, feature string")
        return encoded.unionByName(rest)

    def wide(self) -> Preparation:
        """The same constants with the categories on the driver, for tables with one column per category."""
        categories: dict[str, list[str]] = {c: [] for c in self.categorical}
        for row in self.index.orderBy("slot").select("feature", "value").collect():
            categories[row["feature"]].append(row["value"])
        return Preparation(self.categorical, self.numerical, self.fill, categories, self.scale)

    def constants(self, spark: SparkSession) -> DataFrame:
        own = {k: getattr(self, k) for k in ("categorical", "numerical", "extras", "sizes", "fill", "scale")}
        return spark.createDataFrame([(json.dumps({"sparse": own}),)], "preparation string")

    @classmethod
    def read(cls, constants: dict, index: DataFrame) -> SparsePreparation:
        return cls(index=index, **{**constants, **{k: tuple(constants[k]) for k in ("categorical", "numerical", "extras")}})


def category_index(df: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """(feature, value, n, slot) of all known values, slots in the order of ``categorical`` and of the values."""
    text = df.select(*(named(c).cast("string").alias(c) for c in categorical))
    long = text.unpivot([], [named(c) for c in categorical], "feature", "value").where(F.col("value").isNotNull())
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    place = F.array_position(F.array(*(F.lit(c) for c in categorical)), F.col("feature"))
    ranged = counts.withColumn("place", place).repartitionByRange("place", "value").sortWithinPartitions("place", "value")
    numbered = materialise(ranged.select("feature", "value", "n", F.monotonically_increasing_id().alias("id")))
    part = F.shiftright("id", _ROW_BITS)
    # One row per partition.
    totals = numbered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    slot = F.col("start") + F.col("id").bitwiseAND((1 << _ROW_BITS) - 1)
    return numbered.join(F.broadcast(starts), part == F.col("part")).select("feature", "value", "n", slot.alias("slot"))


def fit_sparse(df: DataFrame, categorical: Sequence[str], numerical: Sequence[str], extras: Sequence[str] = ()) -> SparsePreparation:
    """Fit on ``df`` (pass a materialised frame). The driver gets one row per feature."""
    fill: dict[str, str | float | None] = dict.fromkeys(categorical)
    sizes = dict.fromkeys(categorical, 0)
    if categorical:
        index = materialise(category_index(df, categorical))
        top = F.min_by("value", F.struct(-F.col("n"), "value"))
        for row in index.groupBy("feature").agg(F.count(F.lit(1)).alias("size"), top.alias("top")).collect():
            sizes[row["feature"]], fill[row["feature"]] = row["size"], row["top"]
    else:
        index = df.sparkSession.createDataFrame([], "feature string, value string, n long, slot long")
    means, scale = numeric_constants(df, numerical)
    return SparsePreparation(index, tuple(categorical), tuple(numerical), tuple(extras), sizes, {**fill, **means}, scale)


def encode_sparse(df: DataFrame, fitted: SparsePreparation, keep: Sequence[str] = (), output: str = "features") -> DataFrame:
    """``keep`` and one vector per row. Inputs that ``df`` lacks count as null; nulls in extras become 0."""
    kinds = {**dict.fromkeys(fitted.categorical, "string"), **dict.fromkeys((*fitted.numerical, *fitted.extras), "double")}
    df = df.withColumns({c: F.lit(None).cast(kind) for c, kind in kinds.items() if c not in df.columns})
    rows = df.select(
        *(named(c) for c in keep),
        *(F.coalesce(named(c).cast("string"), F.lit(fitted.fill[c])).alias(f"_value{i}") for i, c in enumerate(fitted.categorical)),
        *(column.alias(f"_number{i}") for i, column in enumerate(_numbers(fitted))),
    )
    parts, start = [], 0
    for i, c in enumerate(fitted.categorical):
        size = fitted.sizes[c]
        if size:
            own = fitted.index.where(F.col("feature") == c).select(F.col("value").alias("_known"), "slot")
            rows = rows.join(own, F.col(f"_value{i}") == F.col("_known"), "left")
            # The number after the last is taken for "none of them".
            rows = rows.withColumn(f"_slot{i}", F.coalesce(F.col("slot") - start, F.lit(size)).cast("double")).drop("_known", "slot")
            parts.append((f"_slot{i}", size))
            start += size
    blocks = []
    if parts:
        names = [name for name, _ in parts]
        encoder = OneHotEncoder(inputCols=names, outputCols=[f"{n}_vector" for n in names], handleInvalid="keep", dropLast=True)
        last = df.sparkSession.createDataFrame([tuple(float(size - 1) for _, size in parts)], ", ".join(f"{n} double" for n in names))
        rows = encoder.fit(last).transform(rows)
        blocks = [f"{n}_vector" for n in names]
    blocks += [f"_number{i}" for i in range(len(fitted.numerical) + len(fitted.extras))]
    made = VectorAssembler(inputCols=blocks, outputCol="_vector").transform(rows)
    return made.select(*(named(c) for c in keep), F.col("_vector").alias(output))


def _numbers(fitted: SparsePreparation) -> list[Column]:
    scaled = scaled_columns(Preparation((), fitted.numerical, fitted.fill, {}, fitted.scale))
    return scaled + [F.coalesce(named(c).cast("double"), F.lit(0.0)) for c in fitted.extras]


def long_entries(vectors: DataFrame, fitted: SparsePreparation, keep: Sequence[str], column: str = "features") -> DataFrame:
    """(*keep, feature, value) of the entries of the vectors that aren't 0, with their names."""
    entries = vectors.select(*(named(c) for c in keep), F.posexplode(vector_to_array(column)).alias("slot", "value"))
    entries = entries.where(F.col("value") != 0).withColumn("slot", F.col("slot").cast("long"))
    return entries.join(fitted.slots(), "slot").select(*(named(c) for c in keep), "feature", "value")
