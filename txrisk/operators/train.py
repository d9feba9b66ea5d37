"""Training set, classifiers, model search and scoring columns, on Spark ML.

The label is made from spend, frequency and recency, and the same columns are features: a very high area under the curve
is expected and says nothing about real risk.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.operators.prepare import feature_vector
from txrisk.operators.split import stratified_folds
from txrisk.schema import CUSTOMER

LABEL = "is_high_risk"

# The settings searched, and the deepest tree Spark ML grows (standing for "no limit").
UNLIMITED_DEPTH = 30
GRID_TREES = [50, 100]
GRID_DEPTHS = [UNLIMITED_DEPTH, 10, 20]
GRID_MIN_SPLIT = [2, 5]


def training_set(features: DataFrame, labels: DataFrame, keep_id: bool = False) -> DataFrame:
    """Features with an integer label; customers without one are dropped, and the id unless ``keep_id``.

    Written as a left join and a null filter; Catalyst makes it an inner join and filters both sides before it.
    """
    joined = features.join(labels.select(CUSTOMER, LABEL), CUSTOMER, "left").where(F.col(LABEL).isNotNull())
    joined = joined.withColumn(LABEL, F.col(LABEL).cast("int"))
    return joined if keep_id else joined.drop(CUSTOMER)


def logistic_regression(rows: int, max_iter: int = 1000, c: float = 1.0, tol: float = 1e-10) -> LogisticRegression:
    """L2 penalty with inverse strength ``c`` on the sum of losses; Spark averages the losses, hence ``1 / (c * rows)``."""
    return LogisticRegression(
        featuresCol="features",
        labelCol=LABEL,
        maxIter=max_iter,
        tol=tol,
        regParam=1.0 / (c * rows),
        elasticNetParam=0.0,
        standardization=False,
    )


def logistic_gradient(vectors: DataFrame, model: LogisticRegressionModel, label: str = LABEL) -> DataFrame:
    """``(slot, gradient)`` of the mean loss with its penalty at the model's weights; the last slot is the intercept.

    All zero at the optimum, whatever way led there. One aggregation over the rows, whose vectors stay sparse.
    """
    off = model.transform(vectors).select("features", (vector_to_array("probability")[1] - F.col(label)).alias("off"))
    # A weighted sum takes weights of one sign only.
    above, below = F.greatest("off", F.lit(0.0)), F.greatest(-F.col("off"), F.lit(0.0))
    add = lambda weight: Summarizer.sum(F.col("features"), weight)
    sums = off.agg(F.avg("off").alias("mean"), F.count(F.lit(1)).alias("n"), add(above).alias("above"), add(below).alias("below"))
    weights = F.array(*(F.lit(float(w)) for w in model.coefficients.toArray()))
    data = F.zip_with(vector_to_array("above"), vector_to_array("below"), lambda a, b: (a - b) / F.col("n"))
    slopes = F.zip_with(data, weights, lambda g, w: g + w * F.lit(model.getRegParam()))
    return sums.select(F.posexplode(F.concat(slopes, F.array("mean"))).alias("slot", "gradient"))


def random_forest(
    trees: int = 100, max_depth: int = 10, seed: int = 42, min_instances: int = 1, max_bins: int = 32
) -> RandomForestClassifier:
    """``max_bins`` - 1 thresholds at most are tried per continuous feature; more cost time and memory in proportion.

    Each row's node in each tree is kept from level to level, so that a level costs the same however deep it is.
    """
    return RandomForestClassifier(
        featuresCol="features",
        labelCol=LABEL,
        numTrees=trees,
        maxDepth=max_depth,
        featureSubsetStrategy="sqrt",
        minInstancesPerNode=min_instances,
        maxBins=max_bins,
        cacheNodeIds=True,
        seed=seed,
    )


def default_random_forest(seed: int = 42) -> RandomForestClassifier:
    """100 trees without a depth limit, as far as Spark ML goes."""
    return random_forest(max_depth=UNLIMITED_DEPTH, seed=seed)


def train_models(train: DataFrame, estimators: Mapping[str, Estimator]) -> dict[str, Model]:
    """Fit several named estimators on one frame (pass a materialised one with ``features`` and the label)."""
    return {name: estimator.fit(train) for name, estimator in estimators.items()}


def min_instances_for(min_samples_split: int) -> int:
    """Spark ML limits the rows of a child, not of the node that is split; half of the latter is the nearest limit."""
    return max(1, min_samples_split // 2)


def grid_search(
    train: DataFrame,
    trees: Sequence[int] = tuple(GRID_TREES),
    depths: Sequence[int] = tuple(GRID_DEPTHS),
    min_splits: Sequence[int] = tuple(GRID_MIN_SPLIT),
    folds: int = 3,
    seed: int = 42,
    parallelism: int = 4,
) -> CrossValidatorModel:
    """Search the forest's settings by stratified cross-validation on ROC AUC; ``bestModel`` is refitted on all of ``train``.

    ``train`` keeps the customer id, which decides the folds.
    """
    forest = random_forest(seed=seed)
    grid = (
        ParamGridBuilder()
        .addGrid(forest.numTrees, list(trees))
        .addGrid(forest.maxDepth, list(depths))
        .addGrid(forest.minInstancesPerNode, [min_instances_for(s) for s in min_splits])
        .build()
    )
    validator = CrossValidator(
        estimator=forest,
        estimatorParamMaps=grid,
        evaluator=BinaryClassificationEvaluator(
            labelCol=LABEL, rawPredictionCol="rawPrediction", metricName="areaUnderROC", numBins=0
        ),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=seed,
    )
    return validator.fit(stratified_folds(train, folds, LABEL, CUSTOMER, seed))


def best_parameters(search: CrossValidatorModel) -> dict[str, Any]:
    """The winning setting and its mean area."""
    at = max(range(len(search.avgMetrics)), key=lambda i: search.avgMetrics[i])
    chosen = {param.name: value for param, value in search.getEstimatorParamMaps()[at].items()}
    return {**chosen, "roc_auc": search.avgMetrics[at]}


def with_probability(model: Model, vectors: DataFrame, output: str = "risk_probability") -> DataFrame:
    """Add the positive-class probability and the predicted class; the model's own columns are dropped."""
    scored = model.transform(vectors)
    scored = scored.withColumn(output, vector_to_array("probability")[1])
    return scored.withColumn("predicted", F.col("prediction").cast("int")).drop(
        "rawPrediction", "probability", "prediction", "features"
    )


def vectors_of(matrix: DataFrame, manifest: Sequence[str]) -> DataFrame:
    """Add ``features``: the manifest's columns as one vector."""
    return feature_vector(matrix, manifest)
