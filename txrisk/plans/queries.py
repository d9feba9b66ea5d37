"""The registered queries: every operator run over the whole generated tables.

Floating results are rounded here, and only here, because their last digits depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from txrisk.functions.columns import named, to_long
from txrisk.functions.timefeat import time_features
from txrisk.operators import forest, label, metrics, prepare, profile, rollup, sparse, split, train, validate
from txrisk.plans import scoring, search
from txrisk.plans.features import Features, features, fit_features, rfm_features
from txrisk.plans.training import labelled_vectors
from txrisk.schema import CATEGORY_COLUMNS, CUSTOMER, FEATURE_SETS, ID_COLUMNS, REQUEST_COLUMNS, REQUEST_TEXT_SCHEMA, RFM_COLUMNS
from txrisk.session import materialise, scratch_path
from txrisk.sources.artifacts import Artifacts
from txrisk.sources.fixtures import order_transactions, transactions
from txrisk.streaming.scoring import REQUEST, read_published, score_stream

MONEY = ["Amount", "Value"]
NUMBERS = ["CountryCode", "ChannelId", "Amount", "Value", "PricingStrategy", "FraudResult"]

# Fixed values of the queries that need constants: three cluster centres, a cut between history and new transactions with
# the moment recency counts from, a manifest with one absent column, and scorecard weights.
CENTRES = [[0.8, 0.8, -0.5], [-0.8, -0.8, -0.3], [0.0, 0.0, 2.0]]
CUT = "2024-01-21 00:00:00"
SCORING_DATE = "2024-02-01 00:00:00"
MANIFEST = ["num__Value_mean", "Recency", "cat__CountryCode_none", "AvgTransactionHour", "num__Amount_std"]
WEIGHTS = {
    "num__Value_mean": 0.8,
    "num__Amount_sum": 0.4,
    "Frequency": -0.02,
    "Recency": 0.1,
    "cat__CurrencyCode_ASIA": 0.3,
    "cat__ChannelId_8": -0.2,
}
INTERCEPT = -0.5
GRID = {"trees": [4, 8], "depths": [3, 6], "min_splits": [2, 20], "folds": 3}

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(named(c), digits) for c in columns})


def _long(df: DataFrame, columns: list[str]) -> DataFrame:
    """Feature columns depend on the data, so matrices are returned as ``(CustomerId, feature, value)``."""
    return rounded(to_long(df, [CUSTOMER], columns), 6, "value")


def q_time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return time_features(transactions(spark, sf_dir)).select(
        "TransactionId",
        "TransactionHour",
        "TransactionDay",
        "TransactionMonth",
        "TransactionDayOfWeek",
        "TransactionWeekend",
        "TransactionYear",
    )


def _round_customers(df: DataFrame) -> DataFrame:
    df = rounded(df, 4, "Amount_sum", "Amount_min", "Amount_max", "Value_sum")
    return rounded(df, 8, "Amount_mean", "Amount_std", "Value_mean", "AvgTransactionHour")


def q_customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_customers(rollup.customer_features(transactions(spark, sf_dir)))


def q_order_customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = rollup.customer_features(order_transactions(spark, sf_dir))
    df = rounded(df, 3, "Amount_sum", "Amount_min", "Amount_max", "Value_sum")
    return rounded(df, 6, "Amount_mean", "Amount_std", "Value_mean", "AvgTransactionHour")


def q_reference_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.reference_date(transactions(spark, sf_dir))


def q_validate_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.error_counts(transactions(spark, sf_dir))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(rollup.customer_features(transactions(spark, sf_dir)))


def q_impute_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = FEATURE_SETS["A"]
    stats = prepare.impute_stats(_customers(spark, sf_dir), chosen.categorical, chosen.numerical)
    return rounded(stats, 6, "mean", "std")


def _features(spark: SparkSession, sf_dir: str, feature_set: str) -> Features:
    return features(transactions(spark, sf_dir), feature_set=feature_set)


def q_encode_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _features(spark, sf_dir, "A")
    return _long(made.matrix, made.fitted.encoded_names)


def q_scale_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _features(spark, sf_dir, "A")
    return _long(made.matrix, made.fitted.scaled_names)


def q_features_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _features(spark, sf_dir, "A")
    return _long(made.matrix, made.manifest)


def q_features_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _features(spark, sf_dir, "B")
    return _long(made.matrix, made.manifest)


def q_align_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _features(spark, sf_dir, "B")
    extras = FEATURE_SETS["B"].extras
    return _long(prepare.align_features(made.matrix, MANIFEST, extras, keep=[CUSTOMER]), MANIFEST)


def _history_artifacts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Artifacts]:
    """New transactions, and what was fitted on those before the cut."""
    tx = transactions(spark, sf_dir)
    cut = F.lit(CUT).cast("timestamp")
    customers = materialise(rollup.customer_features(tx.where(F.col("TransactionStartTime") < cut), CUT))
    made = fit_features(customers, "B")
    return tx.where(F.col("TransactionStartTime") >= cut), Artifacts(made.fitted, made.manifest, None, "B")


def q_score_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent, artifacts = _history_artifacts(spark, sf_dir)
    return _long(scoring.score_inputs(recent, artifacts, SCORING_DATE), artifacts.manifest)


def q_score_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent, artifacts = _history_artifacts(spark, sf_dir)
    scores = scoring.score_linear(recent, artifacts, WEIGHTS, INTERCEPT, SCORING_DATE)
    return rounded(scores, 6, "risk_probability")


def q_profile_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.shape(transactions(spark, sf_dir))


def q_profile_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.column_info(transactions(spark, sf_dir))


def q_profile_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = profile.describe(transactions(spark, sf_dir), NUMBERS)
    return rounded(df, 6, "mean", "std", "min", "p25", "p50", "p75", "max")


def q_id_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.id_uniqueness(transactions(spark, sf_dir), ID_COLUMNS)


def q_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_counts(transactions(spark, sf_dir), CATEGORY_COLUMNS)


def q_class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.class_balance(transactions(spark, sf_dir), "FraudResult"), 6, "share")


def q_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = profile.filter_top_values(transactions(spark, sf_dir), "ProductId", 10)
    return rows.groupBy("ProductId").agg(F.count(F.lit(1)).alias("n"))


def q_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.histogram(transactions(spark, sf_dir), MONEY), 6, "lower", "upper")


def q_density_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.density_curve(transactions(spark, sf_dir), MONEY), 8, "x", "density")


def q_box_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = profile.box_stats(transactions(spark, sf_dir), MONEY)
    return rounded(df, 6, "q1", "median", "q3", "whisker_low", "whisker_high")


def q_distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = [("AccountId", "CustomerId"), ("AccountId", "SubscriptionId")]
    return profile.pair_counts(transactions(spark, sf_dir), pairs)


def q_relation_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    relations = [
        ("AccountId", "CustomerId"),
        ("CustomerId", "AccountId"),
        ("AccountId", "SubscriptionId"),
        ("SubscriptionId", "AccountId"),
    ]
    return profile.relation_checks(transactions(spark, sf_dir), relations)


def q_shared_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.keys_with_many(transactions(spark, sf_dir), "AccountId", "CustomerId")


def q_shared_account_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.shared_key_samples(transactions(spark, sf_dir))


def _assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaled spend, frequency and recency with the cluster of the nearest fixed centre."""
    return label.assign_clusters(rfm_features(_customers(spark, sf_dir)), CENTRES)


def q_assign_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assigned(spark, sf_dir).select(CUSTOMER, "cluster")


def q_cluster_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(label.cluster_summary(_assigned(spark, sf_dir)), 6, *RFM_COLUMNS)


def q_label_from_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label.label_from_cluster(_assigned(spark, sf_dir))


def q_training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of unknown country have no label here, so that some rows have none."""
    customers = _customers(spark, sf_dir)
    assigned = label.assign_clusters(rfm_features(customers), CENTRES)
    known = customers.where(F.col("CountryCode") != "Unknown").select(CUSTOMER)
    labels = label.label_from_cluster(assigned).join(known, CUSTOMER, "left_semi")
    rows = train.training_set(fit_features(customers, "B").matrix, labels)
    names = [*(f"num__{c}" for c in FEATURE_SETS["B"].numerical), *FEATURE_SETS["B"].extras]
    return rounded(rows.select(*names, "is_high_risk"), 6, *names[:8], "AvgTransactionHour")


def q_stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = label.label_from_cluster(_assigned(spark, sf_dir))
    return split.stratified_split(materialise(labels))


def q_stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = label.label_from_cluster(_assigned(spark, sf_dir))
    return split.stratified_folds(materialise(labels), 3)


def _scored_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fixed scores of every transaction, one of many values and one of few, and a label related to both."""
    tx = time_features(transactions(spark, sf_dir))
    return tx.select(
        (F.col("Value") + F.col("TransactionHour") > 60).cast("int").alias("is_high_risk"),
        (F.col("Value") / (F.col("Value") + 50)).alias("by_value"),
        (F.col("TransactionHour") / 23).alias("by_hour"),
    )


def q_classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored_transactions(spark, sf_dir)
    df = metrics.classification_metrics(scored, "is_high_risk", "by_value")
    return rounded(df, 6, "accuracy", "precision", "recall", "f1")


def q_roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.roc_auc(_scored_transactions(spark, sf_dir), "is_high_risk", "by_value"), 6, "roc_auc")


def q_model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored_transactions(spark, sf_dir)
    df = metrics.compare_models(scored, "is_high_risk", {"by_value": "by_value", "by_hour": "by_hour"})
    return rounded(df, 6, *metrics.METRIC_NAMES)


def q_rfm_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each customer is at the nearest centre found, and that centre is the mean of its customers."""
    matrix = materialise(rfm_features(_customers(spark, sf_dir)))
    model = label.fit_rfm_clusters(matrix)
    centres = label.centres_of(model)
    assigned = label.assign_clusters(matrix, centres)
    distances = [sum(((named(c) - x) * (named(c) - x) for c, x in zip(RFM_COLUMNS, at, strict=True)), F.lit(0.0)) for at in centres]
    own = F.array(*distances)[F.col("cluster")]
    means = label.cluster_summary(assigned).select(F.col("cluster").alias("of"), *(F.col(c).alias(f"mean_{c}") for c in RFM_COLUMNS))
    gaps = [F.abs(F.array(*(F.lit(at[i]) for at in centres))[F.col("cluster")] - F.col(f"mean_{c}")) for i, c in enumerate(RFM_COLUMNS)]
    return assigned.join(means, F.col("cluster") == F.col("of")).select(
        CUSTOMER, (own <= F.array_min(F.array(*distances))).alias("nearest"), (F.greatest(*gaps) < 1e-2).alias("centred")
    )


def _labelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """Feature vectors with the label of the fixed centres and the split, and the names of their positions."""
    customers = _customers(spark, sf_dir)
    labels = label.label_from_cluster(label.assign_clusters(rfm_features(customers), CENTRES))
    vectors, made = labelled_vectors(customers, labels)
    return materialise(vectors), made.manifest


def held_out_scores(spark: SparkSession, sf_dir: str, make_estimator: Callable[[DataFrame], Estimator]) -> tuple[DataFrame, DataFrame, Model]:
    """Train on the training part of the fixed-centre label and score the test part: scores, test vectors and the model."""
    vectors, _ = _labelled(spark, sf_dir)
    fit_rows = vectors.where(F.col("split") == "train").select("features", "is_high_risk")
    model = make_estimator(fit_rows).fit(fit_rows)
    test = vectors.where(F.col("split") == "test")
    scored = train.with_probability(model, test).select(CUSTOMER, "is_high_risk", "risk_probability", "predicted")
    return materialise(scored), test, model


def _in_range(score: str) -> Column:
    return F.coalesce(named(score).between(0, 1), F.lit(False))


def _checked(scores: DataFrame, *more: Column) -> DataFrame:
    """What SQL can state of a model's scores: who is scored, with which label, that both outputs fit together, and that the scores tell
    the classes apart (the label depends on the features, so an area below 0.9 is a fault)."""
    agrees = F.col("predicted") == (F.col("risk_probability") > 0.5).cast("int")
    area = metrics.roc_auc(scores, "is_high_risk", "risk_probability").first()[0]
    checks = [_in_range("risk_probability").alias("in_range"), agrees.alias("agrees"), F.lit(area is not None and area >= 0.9).alias("separates")]
    return scores.select(CUSTOMER, "is_high_risk", *checks, *more)


def _with_table_scores(scores: DataFrame, vectors: DataFrame, nodes: DataFrame, depth: int) -> tuple[DataFrame, Column]:
    """The scores of the node table beside the model's, and whether they are the same."""
    table = forest.score_forest(vectors, nodes, [CUSTOMER], depth, "_table")
    same = F.coalesce(F.abs(F.col("risk_probability") - F.col("_table")) <= 1e-12, F.lit(False)).alias("as_table")
    return scores.join(table, CUSTOMER, "left"), same


def _forest_checks(spark: SparkSession, sf_dir: str, estimator: RandomForestClassifier) -> DataFrame:
    scores, test, model = held_out_scores(spark, sf_dir, lambda rows: estimator)
    scores, same = _with_table_scores(scores, test, forest.forest_nodes(spark, model), estimator.getMaxDepth())
    return _checked(materialise(scores), same)


def q_rf_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _forest_checks(spark, sf_dir, train.random_forest())


def q_default_rf_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _forest_checks(spark, sf_dir, train.default_random_forest())


def q_logistic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(held_out_scores(spark, sf_dir, lambda rows: train.logistic_regression(rows.count()))[0])


def q_logistic_optimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the gradient of the penalised loss vanishes at the fitted weights, per feature and for the intercept."""
    vectors, names = _labelled(spark, sf_dir)
    rows = vectors.where(F.col("split") == "train").select("features", "is_high_risk")
    gradient = train.logistic_gradient(rows, train.logistic_regression(rows.count()).fit(rows))
    named_slots = F.array(*(F.lit(n) for n in [*names, "(intercept)"]))[F.col("slot")]
    return gradient.select(named_slots.alias("feature"), (F.abs("gradient") < 1e-4).alias("at_optimum"))


def q_grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every setting and fold with its size; whether the area is one, and whether no setting's mean is above that of the best."""
    vectors, _ = _labelled(spark, sf_dir)
    found = search.search_forests(vectors.drop("split"), GRID["trees"], GRID["depths"], GRID["min_splits"], GRID["folds"])
    means = found.areas.groupBy(*search.SETTING).agg(F.avg("roc_auc").alias("mean"))
    greatest = found.best["roc_auc"]
    rows = found.areas.join(means, list(search.SETTING))
    return rows.select(*search.SETTING, "fold", "n", F.col("roc_auc").between(0, 1).alias("is_area"), (F.col("mean") <= greatest).alias("best_is_greatest"))


def q_encode_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse vectors with a category for about every customer, back in long form: (CustomerId, feature, value) of what isn't 0."""
    own = transactions(spark, sf_dir).groupBy(CUSTOMER).agg(F.min("AccountId").alias("FirstAccount"))
    customers = materialise(_customers(spark, sf_dir).join(own, CUSTOMER))
    fitted = sparse.fit_sparse(customers, [*FEATURE_SETS["B"].categorical, "FirstAccount"], ["Amount_sum", "Value_mean"], ["Frequency"])
    return rounded(sparse.long_entries(sparse.encode_sparse(customers, fitted, [CUSTOMER]), fitted, [CUSTOMER]), 6, "value")


def batch_scores(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, Artifacts]:
    """Train on the transactions before the cut, score those after it: scores, the vectors scored and what was fitted."""
    tx = transactions(spark, sf_dir)
    cut = F.lit(CUT).cast("timestamp")
    customers = materialise(rollup.customer_features(tx.where(F.col("TransactionStartTime") < cut), CUT))
    labels = label.label_from_cluster(label.assign_clusters(rfm_features(customers), CENTRES))
    vectors, made = labelled_vectors(customers, labels)
    vectors = materialise(vectors)
    model = train.random_forest().fit(vectors.where(F.col("split") == "train").select("features", "is_high_risk"))
    artifacts = Artifacts(made.fitted, made.manifest, model, "B")
    recent = tx.where(F.col("TransactionStartTime") >= cut)
    inputs = train.vectors_of(scoring.score_inputs(recent, artifacts, SCORING_DATE), artifacts.manifest)
    return scoring.score(recent, artifacts, SCORING_DATE), inputs, artifacts


def q_score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the scores of a batch are probabilities, and those that the forest's node table gives for the same inputs."""
    scores, inputs, artifacts = batch_scores(spark, sf_dir)
    scores, same = _with_table_scores(scores, inputs, forest.forest_nodes(spark, artifacts.model), 10)
    return scores.select(CUSTOMER, _in_range("risk_probability").alias("in_range"), same)


def q_stream_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty events make a request; requests run through the stream, and what it publishes is read: scores, and rejected rows counted.

    ``what`` is the customer, or "rejected" with the number of rows refused as the score.
    """
    tx = transactions(spark, sf_dir)
    _, artifacts = _history_artifacts(spark, sf_dir)
    feed = scratch_path(spark, "feed")
    number = F.floor(F.substring("TransactionId", 2, 20).cast("long") / 20)
    text = [named(c).cast("string").alias(c) for c in REQUEST_COLUMNS]
    tx.select(*text, F.concat(F.lit("R"), number).alias(REQUEST)).write.parquet(f"{feed}/in")
    requests = spark.readStream.schema(StructType([*REQUEST_TEXT_SCHEMA.fields, StructField(REQUEST, StringType())])).parquet(f"{feed}/in")

    def scorer(rows: DataFrame, fitted: Artifacts, reference: str, by: Sequence[str]) -> DataFrame:
        return scoring.score_linear(rows, fitted, WEIGHTS, INTERCEPT, reference, by)

    query = score_stream(requests, artifacts, f"{feed}/scores", f"{feed}/rejected", f"{feed}/state", SCORING_DATE, scorer=scorer)
    query.awaitTermination()
    scores, rejected = (read_published(spark, f"{feed}/{part}", f"{feed}/scores") for part in ("scores", "rejected"))
    refused = rejected.groupBy(REQUEST).agg(F.count(F.lit(1)).cast("double").alias("score"))
    made = scores.select(REQUEST, F.col(CUSTOMER).alias("what"), F.col("risk_probability").alias("score"))
    return rounded(made.unionByName(refused.select(REQUEST, F.lit("rejected").alias("what"), "score")), 6, "score")


QUERIES: dict[str, Query] = {name[2:]: value for name, value in list(globals().items()) if name.startswith("q_")}
