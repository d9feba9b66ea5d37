import pytest
from pyspark.sql import functions as F

from txrisk.operators import train
from txrisk.operators.rollup import customer_features
from txrisk.operators.split import stratified_folds
from txrisk.plans import scoring
from txrisk.plans.features import fit_features
from txrisk.plans.training import labelled_vectors, train_risk_model
from txrisk.schema import FEATURE_SETS
from txrisk.session import materialise
from txrisk.sources.artifacts import load_artifacts, save_artifacts
from txrisk.sources.tables import read_runs

REF = "2024-02-01 00:00:00"


@pytest.fixture(scope="module")
def vectors(many_tx):
    customers = materialise(customer_features(many_tx))
    labels = customers.select("CustomerId", (F.col("Value_mean") > 500).cast("int").alias("is_high_risk"))
    rows, _ = labelled_vectors(customers, labels)
    return materialise(rows)


@pytest.fixture(scope="module")
def run(many_tx, tmp_path_factory):
    folder = tmp_path_factory.mktemp("run")
    estimator = train.random_forest(trees=5, max_depth=4)
    made = train_risk_model(
        many_tx, estimator=estimator, artifact_path=str(folder / "artifacts"), run_log_path=str(folder / "runs")
    )
    return made, folder


def test_training_set_drops_unlabelled_customers_and_the_id(spark):
    features = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "CustomerId string, x double")
    labels = spark.createDataFrame([("a", "1"), ("b", None), ("z", "0")], "CustomerId string, is_high_risk string")
    rows = train.training_set(features, labels)
    assert rows.columns == ["x", "is_high_risk"]
    assert [tuple(r) for r in rows.collect()] == [(1.0, 1)]
    kept = train.training_set(features, labels, keep_id=True)
    assert kept.columns[0] == "CustomerId"
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "LeftOuter" not in plan


def test_vectors_are_dealt_to_all_cores_and_deep_trees_keep_their_nodes(spark, vectors):
    assert vectors.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism > 1
    assert all(r[0] > 0 for r in vectors.groupBy(F.spark_partition_id()).count().select("count").collect())
    assert train.default_random_forest().getCacheNodeIds()


def test_several_models(vectors):
    fit_rows = vectors.where("split = 'train'")
    models = train.train_models(
        fit_rows,
        {"logistic": train.logistic_regression(fit_rows.count(), max_iter=50), "forest": train.random_forest(5, 4)},
    )
    for model in models.values():
        scored = train.with_probability(model, vectors.where("split = 'test'")).collect()
        assert scored and all(0 <= r["risk_probability"] <= 1 for r in scored)
        assert all(r["predicted"] == int(r["risk_probability"] > 0.5) for r in scored)
    assert models["logistic"].getRegParam() == pytest.approx(1 / fit_rows.count())


def test_default_forest_has_no_practical_depth_limit():
    assert train.default_random_forest().getMaxDepth() == train.UNLIMITED_DEPTH
    assert train.random_forest().getNumTrees() == 100 and train.random_forest().getMaxDepth() == 10


def test_grid_search(vectors):
    search = train.grid_search(vectors, trees=[2, 4], depths=[3], min_splits=[2], parallelism=2)
    best = train.best_parameters(search)
    assert best["numTrees"] in (2, 4) and best["maxDepth"] == 3 and best["minInstancesPerNode"] == 1
    assert best["roc_auc"] == max(search.avgMetrics)
    assert search.bestModel.getNumTrees == best["numTrees"]
    assert len(train.GRID_TREES) * len(train.GRID_DEPTHS) * len(train.GRID_MIN_SPLIT) == 12
    folds = stratified_folds(vectors, 3).groupBy("fold").count().collect()
    assert {r["fold"] for r in folds} == {0, 1, 2}


def test_whole_run(run, spark, many_tx):
    made, folder = run
    assert set(made.metrics) == {"accuracy", "precision", "recall", "f1", "roc_auc"}
    assert 0.5 < made.metrics["accuracy"] <= 1
    assert made.artifacts.manifest == [*made.artifacts.fitted.names, *FEATURE_SETS["B"].extras]
    logged = {(r["kind"], r["name"]): r["value"] for r in read_runs(spark, str(folder / "runs")).collect()}
    assert logged["param", "numTrees"] == "5" and logged["model", "name"] == "random_forest"
    assert float(logged["metric", "accuracy"]) == made.metrics["accuracy"]


def test_loaded_artifacts_score_the_same(run, spark, many_tx):
    made, folder = run
    loaded = load_artifacts(spark, str(folder / "artifacts"))
    assert loaded[:2] == made.artifacts[:2] and loaded.feature_set == "B"
    before = {r["CustomerId"]: r["risk_probability"] for r in scoring.score(many_tx, made.artifacts, REF).collect()}
    after = {r["CustomerId"]: r["risk_probability"] for r in scoring.score(many_tx, loaded, REF).collect()}
    assert before == after and len(before) == many_tx.select("CustomerId").distinct().count()


def test_missing_artifacts_are_named(run, spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="versions"):
        load_artifacts(spark, str(tmp_path))
    run[0].artifacts.fitted.to_frame(spark).write.parquet(str(tmp_path / "v" / "preparation"))
    with pytest.raises(FileNotFoundError, match="manifest"):
        load_artifacts(spark, str(tmp_path), "v")


def test_a_version_counts_only_when_it_is_whole(run, spark, tmp_path):
    artifacts = run[0].artifacts
    first = save_artifacts(spark, str(tmp_path), artifacts)
    with pytest.raises(Exception):
        save_artifacts(spark, str(tmp_path), artifacts._replace(model=None, manifest=["other"]))
    assert load_artifacts(spark, str(tmp_path)).manifest == artifacts.manifest
    save_artifacts(spark, str(tmp_path), artifacts._replace(feature_set="A"))
    assert load_artifacts(spark, str(tmp_path)).feature_set == "A"
    assert load_artifacts(spark, str(tmp_path), first).feature_set == "B"


def test_one_transaction_scores(run, make_tx):
    rows = scoring.score(make_tx({}), run[0].artifacts).collect()
    assert len(rows) == 1 and rows[0].asDict().keys() == {"CustomerId", "risk_probability"}
    assert rows[0]["CustomerId"] == "K-31" and 0 <= rows[0]["risk_probability"] <= 1


def test_one_transaction_takes_the_training_mean_of_the_deviation(run, make_tx):
    row = scoring.score_inputs(make_tx({}), run[0].artifacts).first()
    assert row["num__Amount_std"] == 0.0
    assert all(row[c] == 0.0 for c in run[0].artifacts.fitted.encoded_names if c.startswith("cat__CountryCode"))


def test_missing_column_is_refused(run, make_tx):
    with pytest.raises(ValueError, match="Amount"):
        scoring.score(make_tx({}).drop("Amount"), run[0].artifacts)


def test_scorecard(many_tx, run):
    rows = scoring.score_linear(many_tx, run[0].artifacts, {"Frequency": 0.0, "gone": 9.0}, 0.0, REF).collect()
    assert {r["risk_probability"] for r in rows} == {0.5}


def test_feature_sets_share_what_they_should(many_tx):
    customers = materialise(customer_features(many_tx))
    a, b = fit_features(customers, "A"), fit_features(customers, "B")
    assert "num__Frequency" in a.manifest and "Frequency" in b.manifest and "num__Frequency" not in b.manifest
    assert a.fitted.categories == b.fitted.categories
    assert a.matrix.columns == ["CustomerId", *a.manifest] and b.matrix.columns == ["CustomerId", *b.manifest]


def test_preparation_fitted_on_the_training_part_only(many_tx):
    customers = materialise(customer_features(many_tx))
    labels = customers.select("CustomerId", (F.col("Value_mean") > 500).cast("int").alias("is_high_risk"))
    everyone, on_all = labelled_vectors(customers, labels)
    some, on_train = labelled_vectors(customers, labels, fit_on="train")
    assert on_all.fitted.fill["Amount_sum"] != on_train.fitted.fill["Amount_sum"]
    splits = [{(r["CustomerId"], r["split"]) for r in df.collect()} for df in (everyone, some)]
    assert splits[0] == splits[1]
    with pytest.raises(ValueError, match="fit_on"):
        labelled_vectors(customers, labels, fit_on="test")


def test_training_may_leave_out_invalid_transactions(many_tx):
    estimator = train.random_forest(trees=2, max_depth=2)
    made = train_risk_model(many_tx, estimator=estimator, only_valid=True, reference=REF)
    whole = train_risk_model(many_tx, estimator=estimator, reference=REF)
    assert made.artifacts.fitted.fill["Amount_min"] > 0 > whole.artifacts.fitted.fill["Amount_min"]
