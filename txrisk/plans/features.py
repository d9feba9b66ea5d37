"""Transactions to the encoded feature matrix, for either feature set."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from txrisk.operators.prepare import WIDE_CATEGORIES, Preparation, apply_preparation, fit_if_narrow, fit_preparation, require_feature_names
from txrisk.operators.rollup import customer_features
from txrisk.operators.sparse import SparsePreparation, encode_sparse, fit_sparse
from txrisk.operators.train import vectors_of
from txrisk.operators.validate import require_columns
from txrisk.schema import CUSTOMER, FEATURE_SETS, RFM_COLUMNS
from txrisk.session import materialise


class Features(NamedTuple):
    """``matrix`` has one column per name of the manifest."""

    matrix: DataFrame
    fitted: Preparation
    manifest: list[str]


class Vectors(NamedTuple):
    """``rows``: id and vector. With a sparse preparation the manifest has the names after the categories."""

    rows: DataFrame
    fitted: Preparation | SparsePreparation
    manifest: list[str]


def encode_customers(customers: DataFrame, fitted: Preparation, feature_set: str, keep=(CUSTOMER,)) -> DataFrame:
    """Encode already rolled-up customers: id, categorical block, numeric block, extras (nulls in extras become 0)."""
    extras = [c for c in FEATURE_SETS[feature_set].extras if c in customers.columns]
    return apply_preparation(customers, fitted, keep, extras)


def fit_features(
    customers: DataFrame, feature_set: str, max_categories: int = WIDE_CATEGORIES, fit_on: DataFrame | None = None
) -> Features:
    """Fit the preparation on ``customers`` (or on ``fit_on``) and encode them. Pass a materialised frame."""
    chosen = FEATURE_SETS[feature_set]
    fitted = fit_preparation(
        customers if fit_on is None else fit_on, chosen.categorical, chosen.numerical, max_categories
    )
    matrix = encode_customers(customers, fitted, feature_set)
    return Features(matrix, fitted, [*fitted.names, *chosen.extras])


def fit_vectors(
    customers: DataFrame, feature_set: str, max_categories: int = WIDE_CATEGORIES, fit_on: DataFrame | None = None
) -> Vectors:
    """Fit on ``customers`` (or on ``fit_on``) and encode them as vectors, with any number of categories.

    Features of up to ``max_categories`` values are constants of one projection; with more, the values are a table that is joined
    in. The vectors are the same.
    """
    chosen = FEATURE_SETS[feature_set]
    base = customers if fit_on is None else fit_on
    fitted = fit_if_narrow(base, chosen.categorical, chosen.numerical, max_categories)
    if fitted is None:
        sparse = fit_sparse(base, chosen.categorical, chosen.numerical, chosen.extras)
        return Vectors(encode_sparse(customers, sparse, keep=(CUSTOMER,)), sparse, sparse.names)
    manifest = [*fitted.names, *chosen.extras]
    matrix = require_feature_names(encode_customers(customers, fitted, feature_set), manifest, keep=[CUSTOMER])
    return Vectors(vectors_of(matrix, manifest).select(CUSTOMER, "features"), fitted, manifest)


def rfm_features(customers: DataFrame) -> DataFrame:
    """Id and the scaled spend, frequency and recency: all that clustering reads of feature set A. Pass a materialised frame."""
    fitted = fit_preparation(customers, (), [c.removeprefix("num__") for c in RFM_COLUMNS])
    return apply_preparation(customers, fitted, keep=(CUSTOMER,))


def features(tx: DataFrame, reference=None, feature_set: str = "A", max_categories: int = WIDE_CATEGORIES) -> Features:
    """Roll up, fit and encode. The roll-up is computed once and kept, since fitting and encoding both read it."""
    require_columns(tx)
    customers = materialise(customer_features(tx, reference))
    return fit_features(customers, feature_set, max_categories)
