"""Feature preparation: impute, one-hot encode and standardise; fit once, apply anywhere.

Fitting is two aggregations whose results are a handful of constants; applying is one projection against them.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txrisk.functions.columns import named

# Up to this many known values a feature gets a column for each; beyond, its values become slots of a sparse vector
# (operators.sparse), without a limit.
WIDE_CATEGORIES = 1000


@dataclass(frozen=True)
class Preparation:
    """Fitted constants. ``categories`` are sorted; ``fill`` holds the most frequent category or the mean."""

    categorical: tuple[str, ...]
    numerical: tuple[str, ...]
    fill: dict[str, str | float | None]
    categories: dict[str, list[str]] = field(default_factory=dict)
    scale: dict[str, float] = field(default_factory=dict)

    @property
    def encoded_names(self) -> list[str]:
        return [f"cat__{c}_{v}" for c in self.categorical for v in self.categories[c]]

    @property
    def scaled_names(self) -> list[str]:
        return [f"num__{c}" for c in self.numerical]

    @property
    def names(self) -> list[str]:
        """Output columns in order: the categorical block, then the numeric one."""
        return self.encoded_names + self.scaled_names

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(json.dumps(asdict(self)),)], "preparation string")

    @classmethod
    def from_frame(cls, frame: DataFrame) -> Preparation:
        values = json.loads(frame.first()["preparation"])
        return cls(**{**values, **{k: tuple(values[k]) for k in ("categorical", "numerical")}})


def numeric_stats(df: DataFrame, numerical: Sequence[str]) -> DataFrame:
    """``(feature, mean, std)``: mean of the known values, population deviation of the column once nulls became the mean.

    Filling with the mean leaves the sum of squares alone and only raises the count, so one pass over the raw column
    gives both. A column without any value gets mean 0.
    """
    per_column = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *(
            F.struct(
                F.lit(c).alias("feature"),
                F.avg(named(c).cast("double")).alias("mean"),
                F.stddev_pop(named(c).cast("double")).alias("std"),
                F.count(named(c)).alias("known"),
            ).alias(f"_{i}")
            for i, c in enumerate(numerical)
        ),
    )
    # One row turns into one row per feature.
    rows = per_column.select("_rows", F.inline(F.array(*(F.col(f"_{i}") for i in range(len(numerical))))))
    return rows.select(
        "feature",
        F.coalesce("mean", F.lit(0.0)).alias("mean"),
        F.coalesce(F.col("std") * F.sqrt(F.try_divide("known", "_rows")), F.lit(0.0)).alias("std"),
    )


def category_counts(df: DataFrame, categorical: Sequence[str], limit: int) -> DataFrame:
    """``(feature, value, n, rank)``: the ``limit`` most frequent known values per feature, the smaller value first on ties.

    Spark trims every partition to ``limit`` rows per feature before the ranking shuffle.
    """
    text = df.select(*(named(c).cast("string").alias(c) for c in categorical))
    long = text.unpivot([], [named(c) for c in categorical], "feature", "value").where(F.col("value").isNotNull())
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("feature").orderBy(F.desc("n"), F.asc("value"))
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def impute_stats(df: DataFrame, categorical: Sequence[str], numerical: Sequence[str]) -> DataFrame:
    """``(feature, most_frequent, mean, std)``: what fitting would learn, as a table."""
    modes = category_counts(df, categorical, limit=1).select(
        "feature",
        F.col("value").alias("most_frequent"),
        F.lit(None).cast("double").alias("mean"),
        F.lit(None).cast("double").alias("std"),
    )
    numbers = numeric_stats(df, numerical).select("feature", F.lit(None).cast("string").alias("most_frequent"), "mean", "std")
    return modes.unionByName(numbers)


def numeric_constants(df: DataFrame, numerical: Sequence[str]) -> tuple[dict[str, float], dict[str, float]]:
    """Means and scales per column (one job)."""
    means: dict[str, float] = {}
    scale: dict[str, float] = {}
    if numerical:
        for row in numeric_stats(df, numerical).collect():
            means[row["feature"]] = row["mean"]
            # A constant column divides by 1; its computed deviation may be a rounding residue instead of 0.
            constant = row["std"] <= 1e-13 * abs(row["mean"])
            scale[row["feature"]] = 1.0 if constant else row["std"]
    return means, scale


def fit_preparation(
    df: DataFrame,
    categorical: Sequence[str],
    numerical: Sequence[str],
    max_categories: int = WIDE_CATEGORIES,
) -> Preparation:
    """Fit on ``df`` (two jobs; pass a materialised frame) for a table with one column per category, or raise an error."""
    fitted = fit_if_narrow(df, categorical, numerical, max_categories)
    if fitted is None:
        raise ValueError(f"More than {max_categories} categories in a feature: raise max_categories, or use operators.sparse, which has no limit")
    return fitted


def fit_if_narrow(df: DataFrame, categorical: Sequence[str], numerical: Sequence[str], max_categories: int = WIDE_CATEGORIES) -> Preparation | None:
    """``fit_preparation``, or nothing if a feature has more than ``max_categories`` values. One more than that reach the driver at most."""
    fill: dict[str, str | float | None] = dict.fromkeys(categorical)
    categories: dict[str, list[str]] = {c: [] for c in categorical}
    if categorical:
        for row in category_counts(df, categorical, limit=max_categories + 1).collect():
            categories[row["feature"]].append(row["value"])
            if row["rank"] == 1:
                fill[row["feature"]] = row["value"]
    if any(len(known) > max_categories for known in categories.values()):
        return None
    means, scale = numeric_constants(df, numerical)
    return Preparation(
        categorical=tuple(categorical),
        numerical=tuple(numerical),
        fill={**fill, **means},
        categories={c: sorted(v) for c, v in categories.items()},
        scale=scale,
    )


def encoded_columns(fitted: Preparation) -> list[Column]:
    """One indicator per known category; a null takes the most frequent one, an unseen value sets none."""
    columns = []
    for c in fitted.categorical:
        # A feature has categories only if it has a most frequent one, so the value is never null.
        value = F.coalesce(named(c).cast("string"), F.lit(fitted.fill[c]))
        columns += [(value == v).cast("double").alias(f"cat__{c}_{v}") for v in fitted.categories[c]]
    return columns


def scaled_columns(fitted: Preparation) -> list[Column]:
    """Nulls become the mean before scaling, so they end at 0."""
    return [
        (
            (F.coalesce(named(c).cast("double"), F.lit(fitted.fill[c])) - F.lit(fitted.fill[c])) / F.lit(fitted.scale[c])
        ).alias(f"num__{c}")
        for c in fitted.numerical
    ]


def apply_preparation(
    df: DataFrame, fitted: Preparation, keep: Sequence[str] = (), extras: Sequence[str] = ()
) -> DataFrame:
    """``keep`` columns as they are, the encoded and the scaled block, then ``extras`` with nulls as 0; no join, no shuffle.

    Inputs that ``df`` lacks count as null.
    """
    absent = [c for c in (*fitted.categorical, *fitted.numerical) if c not in df.columns]
    if absent:
        df = df.withColumns({c: F.lit(None).cast("string" if c in fitted.categorical else "double") for c in absent})
    passed = [F.coalesce(named(c), F.lit(0)).alias(c) for c in extras]
    return df.select(*(named(c) for c in keep), *encoded_columns(fitted), *scaled_columns(fitted), *passed)


def feature_vector(df: DataFrame, names: Sequence[str], output: str = "features") -> DataFrame:
    """Add the named columns as one dense vector, in order; a null counts as 0."""
    values = F.array(*(F.coalesce(named(c).cast("double"), F.lit(0.0)) for c in names))
    return df.withColumn(output, array_to_vector(values))


def align_features(
    df: DataFrame, manifest: Sequence[str], extras: Sequence[str] = (), keep: Sequence[str] = (), fill: float = 0.0
) -> DataFrame:
    """The manifest's columns in its order: absent ones are ``fill``, others are dropped, nulls in ``extras`` become 0."""
    present = set(df.columns)
    columns = []
    for name in manifest:
        if name not in present:
            columns.append(F.lit(fill).alias(name))
        elif name in extras:
            columns.append(F.coalesce(named(name).cast("double"), F.lit(0.0)).alias(name))
        else:
            columns.append(named(name).cast("double").alias(name))
    return df.select(*(named(c) for c in keep), *columns)


def require_feature_names(df: DataFrame, manifest: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """For training: the manifest's columns in its order, or an error that lists the missing ones."""
    missing = [c for c in manifest if c not in df.columns]
    if missing:
        raise ValueError(f"Missing features: {missing}")
    return df.select(*(named(c) for c in keep), *(named(c) for c in manifest))
