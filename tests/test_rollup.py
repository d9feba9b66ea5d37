import math
from collections import Counter, defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import types as T

from txrisk.functions.columns import nan_to_null
from txrisk.operators.rollup import customer_features, reference_date
from txrisk.schema import FEATURE_SCHEMA, TX_SCHEMA

REF = "2024-09-13 14:00:00"


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_schema(make_tx):
    df = customer_features(make_tx({}), REF)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in FEATURE_SCHEMA]


def test_single_transaction(make_tx):
    row = one(customer_features(make_tx({}), REF))
    assert (row["Recency"], row["Frequency"], row["AccountFrequency"], row["Amount_count"]) == (5, 1, 1, 1)
    assert row["Amount_std"] is None
    assert (row["Amount_sum"], row["Value_mean"], row["AvgTransactionHour"]) == (37.25, 412.0, 10.0)
    assert (row["CountryCode"], row["CurrencyCode"], row["ChannelId"]) == ("KE", "KES", "4")
    assert row["MostFrequentDayOfWeek"] == 6


def test_ties_take_the_smallest_value_of_the_columns_own_type(make_tx):
    row = one(
        customer_features(
            make_tx(
                {"ChannelId": 10, "CountryCode": "US", "TransactionStartTime": "2024-09-11T10:00:00"},
                {"ChannelId": 8, "CountryCode": "ET", "TransactionStartTime": "2024-09-09T10:00:00"},
            ),
            REF,
        )
    )
    assert (row["ChannelId"], row["CountryCode"], row["MostFrequentDayOfWeek"]) == ("8", "ET", 0)


def test_integer_country_ties_resolve_by_number(make_tx):
    fields = [T.StructField(f.name, T.IntegerType()) if f.name == "CountryCode" else f for f in TX_SCHEMA]
    tx = make_tx({"CountryCode": 10}, {"CountryCode": 9}, schema=T.StructType(fields))
    assert one(customer_features(tx, REF))["CountryCode"] == "9"


def test_majority_beats_smaller_value(make_tx):
    tx = make_tx({"ChannelId": 3}, {"ChannelId": 3}, {"ChannelId": 1}, {"ChannelId": None}, {"ChannelId": None})
    assert one(customer_features(tx, REF))["ChannelId"] == "3"


def test_nothing_known(make_tx):
    nothing = {
        "Amount": None,
        "Value": None,
        "CountryCode": None,
        "CurrencyCode": None,
        "ChannelId": None,
        "AccountId": None,
        "TransactionStartTime": None,
    }
    row = one(customer_features(make_tx(nothing, nothing), REF))
    assert (row["Amount_sum"], row["Value_sum"], row["Amount_count"], row["Frequency"]) == (0.0, 0.0, 0, 2)
    assert all(row[c] is None for c in ("Amount_mean", "Amount_std", "Amount_min", "Amount_max", "Value_mean"))
    assert row["Recency"] is None and row["AvgTransactionHour"] is None
    assert row["AccountFrequency"] == 0 and row["MostFrequentDayOfWeek"] == -1
    assert (row["CountryCode"], row["CurrencyCode"], row["ChannelId"]) == ("Unknown",) * 3


@pytest.mark.parametrize(
    ("moment", "days"),
    [
        ("2024-09-13T15:00:00", -1),  # an hour after the reference
        ("2024-09-13T14:00:00", 0),
        ("2024-09-12T14:00:01", 0),
        ("2024-09-12T14:00:00", 1),
        ("2024-09-15T15:00:00", -3),
    ],
)
def test_recency_rounds_down(make_tx, moment, days):
    assert one(customer_features(make_tx({"TransactionStartTime": moment}), REF))["Recency"] == days


@pytest.mark.parametrize(("zone", "days"), [(None, 1), (timezone.utc, 1), (timezone(timedelta(hours=3)), 0)])
def test_reference_may_be_a_datetime(make_tx, zone, days):
    row = one(customer_features(make_tx({}), datetime(2024, 9, 9, 10, tzinfo=zone)))
    assert row["Recency"] == days


def test_null_customers_are_dropped_but_count_for_the_reference_date(make_tx):
    tx = make_tx({}, {"CustomerId": None, "TransactionStartTime": "2024-09-10T14:00:00"})
    assert reference_date(tx).first()[0] == datetime(2024, 9, 10, 14)
    row = one(customer_features(tx))
    assert (row["CustomerId"], row["Recency"]) == ("K-31", 2)


def test_nan_is_missing(make_tx):
    tx = nan_to_null(make_tx({"Amount": math.nan}, {"Amount": 3.0}))
    row = one(customer_features(tx, REF))
    assert (row["Amount_count"], row["Amount_mean"], row["Amount_max"]) == (1, 3.0, 3.0)


def test_wider_key_keeps_requests_apart(make_tx):
    from pyspark.sql import functions as F

    tx = make_tx({"BatchId": "r1"}, {"BatchId": "r2"}, {"BatchId": "r2"})
    rows = customer_features(tx, F.lit(REF).cast("timestamp"), by=("BatchId", "CustomerId")).collect()
    assert sorted((r["BatchId"], r["Frequency"]) for r in rows) == [("r1", 1), ("r2", 2)]


def test_matches_brute_force_with_a_hot_customer(many_tx):
    """Against plain Python; one customer owns a third of the rows, one account another third."""
    groups = defaultdict(list)
    rows = many_tx.collect()
    for r in rows:
        groups[r["CustomerId"]].append(r)
    ref = max(r["TransactionStartTime"] for r in rows)

    def mode(values):
        counts = Counter(v for v in values if v is not None)
        return min(counts, key=lambda v: (-counts[v], v)) if counts else None

    result = {r["CustomerId"]: r for r in customer_features(many_tx).collect()}
    assert result.keys() == groups.keys()
    assert len(groups["K0"]) >= len(rows) / 3
    for customer, members in groups.items():
        got = result[customer]
        amounts = [r["Amount"] for r in members if r["Amount"] is not None]
        times = [r["TransactionStartTime"] for r in members]
        assert got["Recency"] == (ref - max(times)).days
        assert got["Frequency"] == len(members)
        assert got["AccountFrequency"] == len({r["AccountId"] for r in members})
        assert got["Amount_count"] == len(amounts)
        assert got["Amount_sum"] == pytest.approx(math.fsum(amounts))
        assert got["Amount_min"] == min(amounts) and got["Amount_max"] == max(amounts)
        mean = math.fsum(amounts) / len(amounts)
        deviation = math.sqrt(math.fsum((a - mean) ** 2 for a in amounts) / (len(amounts) - 1))
        assert got["Amount_std"] == pytest.approx(deviation)
        assert got["AvgTransactionHour"] == pytest.approx(sum(t.hour for t in times) / len(times))
        assert got["MostFrequentDayOfWeek"] == mode(t.weekday() for t in times)
        assert got["CountryCode"] == mode(r["CountryCode"] for r in members)
        assert got["CurrencyCode"] == mode(r["CurrencyCode"] for r in members)
        assert got["ChannelId"] == str(mode(r["ChannelId"] for r in members))


def test_layout_does_not_matter(many_tx):
    whole = ["CustomerId", "Recency", "Frequency", "MostFrequentDayOfWeek", "CountryCode", "ChannelId", "Amount_max"]
    first = customer_features(many_tx).select(*whole)
    second = customer_features(many_tx.repartition(13, "Value").sortWithinPartitions("Amount")).select(*whole)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect()))
