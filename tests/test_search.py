import pytest
from pyspark.sql import functions as F

from txrisk.operators import metrics, train
from txrisk.operators.forest import cut_small_nodes, forest_nodes, score_forest
from txrisk.operators.rollup import customer_features
from txrisk.operators.split import stratified_folds
from txrisk.plans.search import search_forests
from txrisk.plans.training import labelled_vectors
from txrisk.session import materialise


@pytest.fixture(scope="module")
def vectors(many_tx):
    customers = materialise(customer_features(many_tx))
    mixed = F.col("Value_mean") + F.abs(F.xxhash64("CustomerId")) % 100
    labels = customers.select("CustomerId", (mixed > 550).cast("int").alias("is_high_risk"))
    return materialise(labelled_vectors(customers, labels)[0].drop("split"))


def test_one_evaluation_equals_one_for_each_fit(spark, vectors):
    found = search_forests(vectors, trees=[2, 3], depths=[3], min_splits=[2, 12], folds=2, parallelism=2)
    areas = {(r["trees"], r["max_depth"], r["min_samples_split"], r["fold"]): (r["n"], r["roc_auc"]) for r in found.areas.collect()}
    assert len(areas) == 8
    folded = materialise(stratified_folds(vectors, 2))
    for (count, depth, limit, fold), (n, area) in areas.items():
        own = folded.where(F.col("fold") == fold)
        model = train.random_forest(count, depth).fit(folded.where(F.col("fold") != fold))
        nodes = cut_small_nodes(forest_nodes(spark, model), limit)
        scored = score_forest(own, nodes, ["CustomerId"], depth).join(own, "CustomerId")
        assert n == own.count() and area == pytest.approx(metrics.roc_auc(scored, "is_high_risk", "risk_probability").first()[0], abs=1e-12)
        if limit == 2:
            plain = train.with_probability(model, own)
            assert area == pytest.approx(metrics.roc_auc(plain, "is_high_risk", "risk_probability").first()[0], abs=1e-12)
    means = {}
    for (*setting, _), (_, area) in areas.items():
        means.setdefault(tuple(setting), []).append(area)
    best = max(sum(v) / len(v) for v in means.values())
    assert found.best["roc_auc"] == pytest.approx(best) and found.model.getNumTrees == found.best["trees"]
    cut = found.nodes.where((F.col("n") < found.best["min_samples_split"]) & (F.col("left") >= 0))
    assert cut.count() == 0


def test_min_samples_split_changes_the_forest(spark, vectors):
    nodes = forest_nodes(spark, train.random_forest(3, 5).fit(vectors))
    inner = [cut_small_nodes(nodes, limit).where("left >= 0").count() for limit in (2, 10, 10**6)]
    assert inner[0] > inner[1] > inner[2] == 0
