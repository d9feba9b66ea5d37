import pytest
from pyspark.sql import functions as F

from txrisk.functions.columns import named
from txrisk.operators import prepare
from txrisk.operators.prepare import Preparation, apply_preparation, fit_preparation

CATEGORICAL = ["CountryCode", "CurrencyCode", "ChannelId"]
NUMERICAL = ["Amount_sum", "Frequency"]


@pytest.fixture(scope="module")
def sample(spark):
    return spark.createDataFrame(
        [("a", "ET", "ETB", 1, 100, 1), ("b", "US", "USD", 2, 200, 2), ("c", None, "ETB", 3, 300, 3)],
        "CustomerId string, CountryCode string, CurrencyCode string, ChannelId int, Amount_sum int, Frequency int",
    )


@pytest.fixture(scope="module")
def fitted(sample):
    return fit_preparation(sample, CATEGORICAL, NUMERICAL)


def test_width_and_order(sample, fitted):
    encoded = apply_preparation(sample, fitted)
    assert encoded.columns == [
        "cat__CountryCode_ET",
        "cat__CountryCode_US",
        "cat__CurrencyCode_ETB",
        "cat__CurrencyCode_USD",
        "cat__ChannelId_1",
        "cat__ChannelId_2",
        "cat__ChannelId_3",
        "num__Amount_sum",
        "num__Frequency",
    ]
    assert len(encoded.columns) == 9


def test_null_takes_the_smaller_of_tied_categories(sample, fitted):
    row = apply_preparation(sample, fitted, ["CustomerId"]).where("CustomerId = 'c'").first()
    assert (row["cat__CountryCode_ET"], row["cat__CountryCode_US"]) == (1.0, 0.0)


def test_scaling_uses_the_population_deviation(sample, fitted):
    rows = apply_preparation(sample, fitted, ["CustomerId"]).orderBy("CustomerId").collect()
    assert [r["num__Amount_sum"] for r in rows] == pytest.approx([-1.224744871391589, 0.0, 1.224744871391589])


def test_imputing_comes_before_scaling(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,), (None,)], "x double")
    fitted = fit_preparation(df, [], ["x"])
    assert fitted.fill["x"] == 2.0
    assert fitted.scale["x"] == pytest.approx((2 / 4) ** 0.5)  # deviation of 1, 3, 2, 2
    values = sorted(r[0] for r in apply_preparation(df, fitted).collect())
    assert values == pytest.approx([-(2**0.5), 0.0, 0.0, 2**0.5])


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(0.1, None)] * 7, "x double, y double")
    fitted = fit_preparation(df, [], ["x", "y"])
    assert (fitted.scale["x"], fitted.fill["y"], fitted.scale["y"]) == (1.0, 0.0, 1.0)
    row = apply_preparation(df, fitted).first()
    assert row["num__x"] == pytest.approx(0.0, abs=1e-12) and row["num__y"] == 0.0


def test_unseen_category_sets_no_indicator(spark, fitted):
    df = spark.createDataFrame(
        [("KE", "ETB", 9, 200.0, 2)], "CountryCode string, CurrencyCode string, ChannelId int, Amount_sum double, Frequency int"
    )
    row = apply_preparation(df, fitted).first()
    assert row["cat__CountryCode_ET"] == row["cat__CountryCode_US"] == 0.0
    assert row["cat__CurrencyCode_ETB"] == 1.0
    assert row["num__Amount_sum"] == 0.0


def test_absent_input_counts_as_null(sample, fitted):
    row = apply_preparation(sample.drop("Amount_sum", "CurrencyCode"), fitted).first()
    assert (row["num__Amount_sum"], row["cat__CurrencyCode_ETB"]) == (0.0, 1.0)


def test_names_with_dots_and_backticks(spark):
    df = spark.createDataFrame([("a.b",), ("c`d",)], "code string")
    fitted = fit_preparation(df, ["code"], [])
    encoded = apply_preparation(df, fitted, ["code"])
    assert encoded.columns[1:] == ["cat__code_a.b", "cat__code_c`d"]
    assert encoded.where(named("cat__code_a.b") == 1).first()["code"] == "a.b"


def test_too_many_categories_are_refused(spark):
    df = spark.range(11).select(F.col("id").cast("string").alias("code"))
    with pytest.raises(ValueError, match="operators.sparse"):
        fit_preparation(df, ["code"], [], max_categories=10)
    assert len(fit_preparation(df, ["code"], [], max_categories=11).categories["code"]) == 11


def test_stats_table_round_trip(spark, fitted, tmp_path):
    fitted.to_frame(spark).write.parquet(str(tmp_path / "p"))
    assert Preparation.from_frame(spark.read.parquet(str(tmp_path / "p"))) == fitted


def test_align(spark):
    df = spark.createDataFrame([("a", 1, None, 7)], "CustomerId string, x int, extra double, other int")
    aligned = prepare.align_features(df, ["extra", "gone", "x"], extras=["extra"], keep=["CustomerId"])
    assert aligned.columns == ["CustomerId", "extra", "gone", "x"]
    assert list(aligned.first()) == ["a", 0.0, 0.0, 1.0]


def test_training_names_are_required(sample):
    assert prepare.require_feature_names(sample, ["Frequency", "Amount_sum"]).columns == ["Frequency", "Amount_sum"]
    with pytest.raises(ValueError, match="gone"):
        prepare.require_feature_names(sample, ["Frequency", "gone"])
