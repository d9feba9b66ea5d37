"""The whole training run: transactions to features, label, split, model, metrics and saved artifacts."""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple
from uuid import uuid4

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.functions.columns import named
from txrisk.operators.label import rfm_labels
from txrisk.operators.metrics import METRIC_NAMES, evaluate
from txrisk.operators.prepare import WIDE_CATEGORIES
from txrisk.operators.rollup import customer_features
from txrisk.operators.split import stratified_split
from txrisk.operators.train import LABEL, random_forest, training_set, with_probability
from txrisk.operators.validate import require_columns, validate_transactions
from txrisk.plans.features import Vectors, fit_vectors, rfm_features
from txrisk.schema import CUSTOMER
from txrisk.session import Scratch, materialise
from txrisk.sources.artifacts import Artifacts, save_artifacts
from txrisk.sources.tables import log_run

TASK_CUSTOMERS = 100_000  # vectors that one task trains on and scores


class TrainingRun(NamedTuple):
    artifacts: Artifacts
    metrics: dict[str, float | None]
    test_scores: DataFrame


def labelled_vectors(
    customers: DataFrame,
    labels: DataFrame,
    feature_set: str = "B",
    test_share: float = 0.2,
    seed: int = 42,
    fit_on: str = "all",
    max_categories: int = WIDE_CATEGORIES,
) -> tuple[DataFrame, Vectors]:
    """``(frame, vectors)``: id, label, split and feature vector per labelled customer, with what was fitted.

    The frame is dealt to a partition per core at least. Both inputs should be materialised. The preparation is fitted on all customers, or with ``fit_on="train"`` on those of
    the training part only; the split is the same either way.
    """
    split = stratified_split(training_set(customers.select(CUSTOMER), labels, keep_id=True), LABEL, CUSTOMER, test_share, seed)
    if fit_on not in ("all", "train"):
        raise ValueError(f"fit_on is 'all' or 'train', not {fit_on!r}")
    base = None
    if fit_on == "train":
        base = customers.join(split.where(F.col("split") == "train").select(CUSTOMER), CUSTOMER, "left_semi")
    made = fit_vectors(customers, feature_set, max_categories, fit_on=base)
    # Vectors are small and training reads them many times: Spark would leave them in one partition, and the fit to one task.
    tasks = max(customers.sparkSession.sparkContext.defaultParallelism, -(-customers.count() // TASK_CUSTOMERS))
    return made.rows.join(split, CUSTOMER).repartition(tasks, CUSTOMER), made


def train_risk_model(
    tx: DataFrame,
    labels: DataFrame | None = None,
    reference: datetime | str | None = None,
    estimator: Estimator | None = None,
    test_share: float = 0.2,
    seed: int = 42,
    fit_on: str = "all",
    only_valid: bool = False,
    max_categories: int = WIDE_CATEGORIES,
    artifact_path: str | None = None,
    run_log_path: str | None = None,
    run_name: str = "random_forest",
) -> TrainingRun:
    """Train and evaluate; without ``labels`` the proxy label is derived from the same customers.

    ``only_valid`` leaves out the transactions that scoring would refuse, for example those with a negative amount.
    Runs jobs: the roll-up is computed once and kept, then read for fitting, labelling and training. Of what it keeps, only the
    scored test rows outlive the run; ``release`` them when they are read.
    """
    require_columns(tx)
    spark = tx.sparkSession
    if only_valid:
        tx = validate_transactions(tx).accepted
    with Scratch() as own:
        customers = own.keep(customer_features(tx, reference))
        if labels is None:
            labels = rfm_labels(own.keep(rfm_features(customers)), seed=seed)
        labels = own.keep(labels)
        vectors, made = labelled_vectors(customers, labels, "B", test_share, seed, fit_on, max_categories)
        vectors = own.keep(vectors)
        estimator = estimator or random_forest(seed=seed)
        model = estimator.fit(vectors.where(F.col("split") == "train").select("features", named(LABEL)))
        scored = materialise(with_probability(model, vectors.where(F.col("split") == "test")).drop("split"))
        metrics = evaluate(scored, LABEL, "risk_probability", keep=own.keep).first().asDict()
        artifacts = Artifacts(made.fitted, made.manifest, model, "B")
        if artifact_path:
            save_artifacts(spark, artifact_path, artifacts)
        if run_log_path:
            params = {p.name: v for p, v in estimator.extractParamMap().items()}
            log_run(spark, run_log_path, uuid4().hex, params, {m: metrics[m] for m in METRIC_NAMES}, run_name)
    return TrainingRun(artifacts, {m: metrics[m] for m in METRIC_NAMES}, scored)
