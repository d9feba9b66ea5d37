"""The proxy label: cluster customers on spend, frequency and recency, mark one cluster as high risk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.functions.columns import named, position_of_first_min
from txrisk.operators.prepare import feature_vector
from txrisk.schema import CUSTOMER, RFM_COLUMNS


def fit_rfm_clusters(
    features: DataFrame, columns: Sequence[str] = tuple(RFM_COLUMNS), k: int = 3, seed: int = 42, iterations: int = 300
) -> KMeansModel:
    """k-means on the scaled RFM columns (iterative: pass a materialised frame); ends before ``iterations`` if it converges."""
    vectors = feature_vector(features.select(*(named(c) for c in columns)), columns)
    return KMeans(k=k, seed=seed, maxIter=iterations, featuresCol="features", predictionCol="cluster").fit(vectors)


def centres_of(model: KMeansModel) -> list[list[float]]:
    return [[float(x) for x in centre] for centre in model.clusterCenters()]


def assign_clusters(
    features: DataFrame, centres: Sequence[Sequence[float]], columns: Sequence[str] = tuple(RFM_COLUMNS)
) -> DataFrame:
    """Add ``cluster``: position of the nearest centre, the lowest position on ties. A projection, no shuffle."""
    distances: list[Column] = []
    for centre in centres:
        distance = F.lit(0.0)
        for name, at in zip(columns, centre, strict=True):
            gap = named(name) - F.lit(float(at))
            distance = distance + gap * gap
        distances.append(distance)
    return features.withColumn("cluster", position_of_first_min(distances))


def cluster_summary(assigned: DataFrame, columns: Sequence[str] = tuple(RFM_COLUMNS)) -> DataFrame:
    """``(cluster, customers, mean of each column)``."""
    return assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("customers"), *(F.avg(named(c)).alias(c) for c in columns)
    )


def high_risk_cluster(summary: DataFrame) -> DataFrame:
    """One row with the cluster of the lowest mean frequency; the highest mean recency decides ties."""
    return summary.orderBy(F.asc("num__Frequency"), F.desc("num__Recency"), "cluster").limit(1).select("cluster")


def label_from_cluster(assigned: DataFrame, cluster: int | None = None) -> DataFrame:
    """``(CustomerId, is_high_risk)``; without a given cluster id the rule of ``high_risk_cluster`` picks it."""
    chosen = F.lit(cluster) if cluster is not None else high_risk_cluster(cluster_summary(assigned)).scalar()
    return assigned.select(CUSTOMER, (F.col("cluster") == chosen).cast("int").alias("is_high_risk"))


def rfm_labels(features: DataFrame, cluster: int | None = None, k: int = 3, seed: int = 42) -> DataFrame:
    """Cluster feature set A and label it (pass a materialised frame)."""
    model = fit_rfm_clusters(features, k=k, seed=seed)
    return label_from_cluster(assign_clusters(features, centres_of(model)), cluster)
