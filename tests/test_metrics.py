import numpy as np
import pytest
from pyspark.sql import functions as F

from txrisk.operators.metrics import classification_metrics, compare_models, evaluate, roc_auc


def frame(spark, labels, scores):
    return spark.createDataFrame([(int(y), float(s)) for y, s in zip(labels, scores, strict=True)], "y int, s double")


def direct_auc(labels, scores):
    pos, neg = scores[labels == 1], scores[labels == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("kind", ["distinct", "ties", "saturated"])
@pytest.mark.parametrize("ranges", [1, 4, 512])
def test_area_is_exact(spark, kind, ranges):
    rng = np.random.default_rng(3)
    labels = rng.integers(0, 2, 700)
    scores = {
        "distinct": rng.uniform(0, 1, 700) + 0.2 * labels,
        "ties": np.round(rng.uniform(0, 1, 700) * 0.9 + 0.1 * labels, 1),
        # A third of all rows share the lowest score and most others crowd near it.
        "saturated": np.where(np.arange(700) % 3 == 0, 0.0, 10.0 ** (-rng.uniform(0, 200, 700))),
    }[kind]
    got = roc_auc(frame(spark, labels, scores), "y", "s", ranges).first()["roc_auc"]
    assert got == pytest.approx(direct_auc(labels, scores), rel=1e-12)


def test_all_tied_and_one_class(spark):
    assert roc_auc(frame(spark, [0, 1, 1, 0], [0.3] * 4), "y", "s").first()["roc_auc"] == 0.5
    row = evaluate(frame(spark, [0, 0, 0], [0.1, 0.2, 0.3]), "y", "s").first()
    assert row["roc_auc"] is None
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (1.0, 0.0, 0.0, 0.0)


def test_no_rows(spark):
    assert roc_auc(frame(spark, [], []), "y", "s").first()["roc_auc"] is None


def test_counts(spark):
    df = frame(spark, [1, 1, 1, 0, 0, 0, 0], [0.9, 0.8, 0.5, 0.6, 0.1, 0.2, 0.3])
    row = classification_metrics(df, "y", "s").first()
    # A score of exactly one half is not positive.
    assert (row["n"], row["accuracy"], row["precision"]) == (7, pytest.approx(5 / 7), pytest.approx(2 / 3))
    assert (row["recall"], row["f1"]) == (pytest.approx(2 / 3), pytest.approx(2 / 3))


def test_compare(spark):
    df = frame(spark, [1, 0, 1, 0], [0.9, 0.1, 0.8, 0.3]).withColumn("worse", 1 - F.col("s"))
    rows = {r["model"]: r for r in compare_models(df, "y", {"good": "s", "bad": "worse"}).collect()}
    assert rows["good"]["roc_auc"] == 1.0 and rows["bad"]["roc_auc"] == 0.0
    assert rows["good"]["accuracy"] == 1.0 and rows["bad"]["f1"] == 0.0
    with pytest.raises(ValueError, match="No models"):
        compare_models(df, "y", {})
