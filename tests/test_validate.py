import pytest
from pyspark.sql import functions as F

from tests.conftest import ONE_TX
from txrisk.operators.validate import (
    error_counts,
    require_columns,
    split_valid,
    validate_transactions,
    with_errors,
)
from txrisk.schema import REQUEST_TEXT_SCHEMA


def request(spark, *rows):
    full = [{**ONE_TX, **row} for row in rows]
    values = [tuple(None if r[c] is None else str(r[c]) for c in REQUEST_TEXT_SCHEMA.names) for r in full]
    return spark.createDataFrame(values, REQUEST_TEXT_SCHEMA)


def errors_of(spark, **row):
    return with_errors(request(spark, row)).first()["errors"]


def test_good_row(spark):
    row = with_errors(request(spark, {})).first()
    assert row["errors"] == []
    assert (row["Amount"], row["ChannelId"], row["TransactionStartTime"].hour) == (37.25, 4, 10)


@pytest.mark.parametrize(
    ("row", "reasons"),
    [
        ({"Amount": None}, ["Amount: missing"]),
        ({"Amount": "abc"}, ["Amount: not a valid double"]),
        ({"Amount": 0}, ["Amount: must be greater than 0"]),
        ({"Amount": "NaN"}, ["Amount: must be greater than 0"]),
        ({"Value": -1, "ChannelId": "1.5x"}, ["ChannelId: not a valid int", "Value: must be greater than 0"]),
        ({"TransactionStartTime": "yesterday"}, ["TransactionStartTime: not a valid timestamp"]),
        ({"TransactionStartTime": "12:30:00"}, ["TransactionStartTime: not a valid timestamp"]),
        ({"TransactionStartTime": "2024-09-08T14:00:00Z"}, []),
        ({"TransactionStartTime": "2024-09-08"}, []),
        ({"CustomerId": None, "AccountId": None}, ["CustomerId: missing", "AccountId: missing"]),
    ],
)
def test_reasons(spark, row, reasons):
    assert errors_of(spark, **row) == reasons


def test_absent_column_is_missing_in_every_row(spark):
    rows = with_errors(request(spark, {}, {}).drop("Amount")).collect()
    assert [r["errors"] for r in rows] == [["Amount: missing"]] * 2


def test_split_and_strict(spark):
    df = request(spark, {}, {"Amount": None}, {"CustomerId": "C9"})
    valid = validate_transactions(df)
    assert valid.accepted.count() == 2 and valid.rejected.count() == 1
    assert "errors" not in valid.accepted.columns
    with pytest.raises(ValueError, match="Amount: missing"):
        validate_transactions(df, strict=True)
    assert validate_transactions(df.where("Amount is not null"), strict=True).accepted.count() == 2


def test_one_bad_row_refuses_its_request_only(spark):
    df = request(spark, {"TransactionId": "ok"}, {"TransactionId": "with bad"}, {"Amount": None})
    df = df.withColumn("request", F.when(F.col("TransactionId") == "ok", "r1").otherwise("r2"))
    valid = split_valid(with_errors(df), "request")
    assert [r["TransactionId"] for r in valid.accepted.collect()] == ["ok"]
    assert valid.rejected.count() == 2


def test_counts_per_reason(spark):
    df = request(spark, {"Amount": None}, {"Amount": None, "Value": 0}, {})
    assert {r["reason"]: r["n"] for r in error_counts(df).collect()} == {
        "Amount: missing": 2,
        "Value: must be greater than 0": 1,
    }


def test_required_columns(spark):
    df = request(spark, {})
    assert require_columns(df) is df
    with pytest.raises(ValueError, match=r"\['Amount', 'AccountId'\]"):
        require_columns(df.drop("AccountId", "Amount"))


def test_no_row_is_lost(make_tx):
    df = make_tx({}, {"Amount": None}, {}, {}).withColumn("request", F.element_at(F.array(F.lit("a"), F.lit("a"), F.lit("b"), F.lit(None)), F.substring("TransactionId", 2, 1).cast("int") + 1))
    valid = split_valid(with_errors(df), "request")
    assert [r["request"] for r in valid.accepted.collect()] == ["b"]
    rejected = {(r["request"], tuple(r["errors"])) for r in valid.rejected.collect()}
    assert rejected == {("a", ()), ("a", ("Amount: missing",)), (None, ("request: missing",))}


def test_raw_values_and_fractions(spark, make_tx):
    df = make_tx({}).withColumn("Amount", F.lit("abc")).withColumn("ChannelId", F.lit(1.9))
    row = with_errors(df).first()
    assert row["raw"] == {"Amount": "abc", "ChannelId": "1.9"} and len(row["errors"]) == 2
    assert with_errors(make_tx({}).withColumn("ChannelId", F.lit(2.0))).first()["ChannelId"] == 2
