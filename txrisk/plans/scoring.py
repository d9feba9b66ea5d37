"""Transactions to risk probabilities, with what training fitted."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.functions.columns import named
from txrisk.operators.prepare import align_features
from txrisk.operators.rollup import customer_features
from txrisk.operators.sparse import SparsePreparation, encode_sparse
from txrisk.operators.train import vectors_of, with_probability
from txrisk.operators.validate import require_columns
from txrisk.plans.features import encode_customers
from txrisk.schema import CUSTOMER, FEATURE_SETS
from txrisk.sources.artifacts import Artifacts


def score_inputs(
    tx: DataFrame, artifacts: Artifacts, reference=None, by: Sequence[str] = (CUSTOMER,)
) -> DataFrame:
    """``(*by, *manifest)``: the aligned feature matrix of new transactions, encoded with the fitted constants.

    ``reference`` is the moment recency counts from, or a column of ``by`` that holds it; by default the start of the query.
    """
    require_columns(tx)
    moment = F.current_timestamp() if reference is None else reference
    customers = customer_features(tx, moment, by)
    matrix = encode_customers(customers, artifacts.fitted, artifacts.feature_set, keep=tuple(by))
    extras = FEATURE_SETS[artifacts.feature_set].extras
    return align_features(matrix, artifacts.manifest, extras, keep=tuple(by))


def score(tx: DataFrame, artifacts: Artifacts, reference=None, by: Sequence[str] = (CUSTOMER,)) -> DataFrame:
    """``(*by, risk_probability)``, one row per customer; one lazy plan from transactions to probabilities."""
    if isinstance(artifacts.fitted, SparsePreparation):
        require_columns(tx)
        customers = customer_features(tx, F.current_timestamp() if reference is None else reference, by)
        vectors = encode_sparse(customers, artifacts.fitted, keep=tuple(by))
    else:
        vectors = vectors_of(score_inputs(tx, artifacts, reference, by), artifacts.manifest)
    scored = with_probability(artifacts.model, vectors)
    return scored.select(*(named(c) for c in by), "risk_probability")


def linear_probability(matrix: DataFrame, weights: Mapping[str, float], intercept: float) -> Column:
    """Logistic probability of a weighted sum of ``matrix`` columns, for scorecards with given weights.

    Columns that ``matrix`` lacks count as 0.
    """
    total = F.lit(float(intercept))
    for name, weight in weights.items():
        if name in matrix.columns:
            total = total + named(name) * F.lit(float(weight))
    return 1 / (1 + F.exp(-total))


def score_linear(
    tx: DataFrame,
    artifacts: Artifacts,
    weights: Mapping[str, float],
    intercept: float,
    reference=None,
    by: Sequence[str] = (CUSTOMER,),
) -> DataFrame:
    """``score`` with given weights instead of a fitted model."""
    inputs = score_inputs(tx, artifacts, reference, by)
    return inputs.select(
        *(named(c) for c in by), linear_probability(inputs, weights, intercept).alias("risk_probability")
    )
