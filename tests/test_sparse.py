import pytest
from pyspark.sql import functions as F

from txrisk.operators import train
from txrisk.operators.prepare import apply_preparation, feature_vector, fit_preparation
from txrisk.operators.rollup import customer_features
from txrisk.operators.sparse import category_index, encode_sparse, fit_sparse, long_entries
from txrisk.plans import scoring
from txrisk.plans.training import labelled_vectors, train_risk_model
from txrisk.session import materialise
from txrisk.sources.artifacts import load_artifacts

CATEGORICAL = ["CountryCode", "CurrencyCode", "ChannelId"]
NUMERICAL = ["Amount_sum", "Value_mean"]
EXTRAS = ["Recency"]
REF = "2024-02-01 00:00:00"


@pytest.fixture(scope="module")
def customers(many_tx):
    return materialise(customer_features(many_tx))


@pytest.fixture(scope="module")
def wide_tx(spark, many_tx):
    """5,000 customers and as many country codes; one code owns a third of the rows, some are null."""
    i = F.col("id")
    rows = spark.range(9000).select(
        F.concat(F.lit("T"), i).alias("TransactionId"),
        F.concat(F.lit("K"), i % 6000).alias("CustomerId"),
        F.concat(F.lit("X"), i % 700).alias("AccountId"),
        F.lit("ETB").alias("CurrencyCode"),
        F.when(i % 6000 % 3 == 0, "7").when(i % 6000 % 11 != 5, (i % 6000 + 1000).cast("string")).alias("CountryCode"),
        F.lit(3).alias("ChannelId"),
        (F.abs(F.xxhash64(i)) % 9973 / 10.0 + 1).alias("Amount"),
        (F.abs(F.xxhash64(i, F.lit(1))) % 9973 / 10.0 + 1).alias("Value"),
        F.timestamp_micros(F.lit(1_704_067_200_000_000) + i * 60_000_000).alias("TransactionStartTime"),
    )
    return materialise(many_tx.limit(0).unionByName(rows, allowMissingColumns=True).unionByName(many_tx.limit(0)))


def test_sparse_vectors_equal_the_wide_ones(spark, customers):
    new = customers.unionByName(customers.limit(1).withColumns({"CustomerId": F.lit("new"), "CountryCode": F.lit("unseen"), "ChannelId": F.lit(None)}))
    wide = fit_preparation(customers, CATEGORICAL, NUMERICAL)
    sparse = fit_sparse(customers, CATEGORICAL, NUMERICAL, EXTRAS)
    assert sparse.wide() == wide and sparse.width == len(wide.names) + 1
    names = [*wide.names, *EXTRAS]
    dense = feature_vector(apply_preparation(new, wide, ["CustomerId"], EXTRAS), names)
    want = {r["CustomerId"]: list(r["features"].toArray()) for r in dense.collect()}
    got = {r["CustomerId"]: list(r["features"].toArray()) for r in encode_sparse(new, sparse, ["CustomerId"]).collect()}
    assert got == want and len(got) == customers.count() + 1
    assert [r["feature"] for r in sparse.slots().orderBy("slot").collect()] == names
    # Columns that are absent count as null.
    few = encode_sparse(new.select("CustomerId", "CountryCode"), sparse, ["CustomerId"]).where("CustomerId = 'new'").first()
    assert sum(few["features"].toArray()) == 2


def test_slots_follow_features_and_values_over_many_partitions(spark):
    df = spark.range(3000).select((F.col("id") * 7 % 1999).cast("string").alias("b"), F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("a"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = category_index(df.repartition(7), ["a", "b"]).orderBy("slot").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = [("a", str(i)) for i in range(1, 5)] + [("b", v) for v in sorted(str(i) for i in range(1999))]
    assert [(r["feature"], r["value"]) for r in rows] == want and [r["slot"] for r in rows] == list(range(len(want)))
    assert sum(r["n"] for r in rows) == 3000 + 2400


def test_long_entries_name_what_is_set(spark, customers):
    sparse = fit_sparse(customers, CATEGORICAL, [], [])
    rows = long_entries(encode_sparse(customers, sparse, ["CustomerId"]), sparse, ["CustomerId"])
    assert rows.count() == 3 * customers.count() and {r["value"] for r in rows.collect()} == {1.0}


def test_nothing_to_fit(spark, customers):
    empty = fit_sparse(customers.limit(0), CATEGORICAL, NUMERICAL)
    assert empty.width == 2 and empty.fill["CountryCode"] is None
    assert encode_sparse(customers, empty, ["CustomerId"]).count() == customers.count()
    assert fit_sparse(customers, [], NUMERICAL).sizes == {}


def test_thousands_of_categories_train_save_load_and_score(spark, wide_tx, tmp_path):
    estimator = train.random_forest(trees=3, max_depth=3)
    made = train_risk_model(wide_tx, estimator=estimator, reference=REF, artifact_path=str(tmp_path))
    assert made.artifacts.fitted.sizes["CountryCode"] > 3500 and 0.5 < made.metrics["accuracy"] <= 1
    loaded = load_artifacts(spark, str(tmp_path))
    before, after = ({r["CustomerId"]: r["risk_probability"] for r in scoring.score(wide_tx, a, REF).collect()} for a in (made.artifacts, loaded))
    assert before == after and len(before) == 6000
    one = scoring.score(wide_tx.limit(1), loaded, REF).collect()
    assert len(one) == 1 and 0 <= one[0]["risk_probability"] <= 1


@pytest.mark.parametrize("limit", [1000, 1])
def test_gradient_of_the_logistic_model_vanishes(customers, limit):
    labels = customers.select("CustomerId", (F.col("Value_mean") > 500).cast("int").alias("is_high_risk"))
    vectors, made = labelled_vectors(customers, labels, max_categories=limit)
    vectors = materialise(vectors)
    model = train.logistic_regression(vectors.count()).fit(vectors)
    found = train.logistic_gradient(vectors, model).collect()
    assert len(found) == model.numFeatures + 1 and max(abs(r["gradient"]) for r in found) < 1e-4
    other = train.logistic_regression(vectors.count(), c=0.01).fit(vectors)
    wrong = other.copy({other.regParam: model.getRegParam()})
    assert max(abs(r["gradient"]) for r in train.logistic_gradient(vectors, wrong).collect()) > 1e-4
