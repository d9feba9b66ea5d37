import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from txrisk.operators import train
from txrisk.operators.forest import cut_small_nodes, forest_nodes, score_forest
from txrisk.operators.prepare import feature_vector


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (600, 4))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(0, 0.7, 600) > 0).astype(int)
    df = spark.createDataFrame([(i, *map(float, v), int(t)) for i, (v, t) in enumerate(zip(x, y, strict=True))], "k long, a double, b double, c double, d double, is_high_risk int")
    return feature_vector(df, ["a", "b", "c", "d"]).cache()


def scores(frame):
    return {r["k"]: r["risk_probability"] for r in frame.collect()}


def test_the_table_scores_like_the_model(spark, rows):
    model = train.random_forest(trees=12, max_depth=6).fit(rows)
    nodes = forest_nodes(spark, model)
    assert nodes.select("tree").distinct().count() == 12 and nodes.count() == model.totalNumNodes
    want, got = scores(train.with_probability(model, rows)), scores(score_forest(rows, nodes, ["k"], 6))
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-12
    assert len(set(got.values())) > 50


@pytest.mark.parametrize("limit", [2, 5, 40, 10_000])
def test_cut_nodes_equal_growing_with_the_limit(spark, rows, limit):
    """One tree without sampling: the share of the positive class in the first node on a row's way that is small or final."""
    model = DecisionTreeClassifier(featuresCol="features", labelCol="is_high_risk", maxDepth=8).fit(rows)
    nodes = forest_nodes(spark, model)
    tree = {r["id"]: r for r in nodes.collect()}
    data = [(r["k"], r["features"].toArray(), r["is_high_risk"]) for r in rows.collect()]
    want = {}

    def grow(node, own):
        r = tree[node]
        assert r["n"] == len(own)
        if len(own) < limit or r["left"] < 0:
            want.update({k: sum(y for _, _, y in own) / len(own) for k, _, _ in own})
            return
        grow(r["left"], [d for d in own if d[1][r["feature"]] <= r["threshold"]])
        grow(r["right"], [d for d in own if d[1][r["feature"]] > r["threshold"]])

    grow(0, data)
    got = scores(score_forest(rows, cut_small_nodes(nodes, limit), ["k"], 8))
    assert got == pytest.approx(want, abs=1e-12) and len(got) == 600
    assert (len(set(got.values())) == 1) == (limit == 10_000)
