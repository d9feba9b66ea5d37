"""Declared schemas and the two feature sets."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

CUSTOMER = "CustomerId"
ACCOUNT = "AccountId"
TIME = "TransactionStartTime"

TX_SCHEMA = T.StructType(
    [
        T.StructField("TransactionId", T.StringType()),
        T.StructField("BatchId", T.StringType()),
        T.StructField("AccountId", T.StringType()),
        T.StructField("SubscriptionId", T.StringType()),
        T.StructField("CustomerId", T.StringType()),
        T.StructField("CurrencyCode", T.StringType()),
        T.StructField("CountryCode", T.StringType()),
        T.StructField("ProviderId", T.StringType()),
        T.StructField("ProductId", T.StringType()),
        T.StructField("ProductCategory", T.StringType()),
        T.StructField("ChannelId", T.IntegerType()),
        T.StructField("Amount", T.DoubleType()),
        T.StructField("Value", T.DoubleType()),
        T.StructField("TransactionStartTime", T.TimestampType()),
        T.StructField("PricingStrategy", T.IntegerType()),
        T.StructField("FraudResult", T.IntegerType()),
    ]
)

# The columns the customer roll-up reads; a scoring request carries exactly these.
REQUEST_COLUMNS = [
    "CustomerId",
    "TransactionId",
    "TransactionStartTime",
    "CountryCode",
    "CurrencyCode",
    "ChannelId",
    "Amount",
    "Value",
    "AccountId",
]

REQUEST_SCHEMA = T.StructType([TX_SCHEMA[name] for name in REQUEST_COLUMNS])

# Requests are read as text so that validation can tell "missing" from "not a number".
# Column and feature names are the data contract.
REQUEST_TEXT_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in REQUEST_COLUMNS])

LABEL_SCHEMA = T.StructType(
    [T.StructField("CustomerId", T.StringType()), T.StructField("is_high_risk", T.IntegerType())]
)

ID_COLUMNS = ["TransactionId", "BatchId", "AccountId", "SubscriptionId", "CustomerId"]

CATEGORY_COLUMNS = [
    "CurrencyCode",
    "CountryCode",
    "ProviderId",
    "ProductId",
    "ProductCategory",
    "ChannelId",
    "PricingStrategy",
    "FraudResult",
]

# Names and types of the feature table, and the two feature sets below.
FEATURE_SCHEMA = T.StructType(
    [
        T.StructField("CustomerId", T.StringType()),
        T.StructField("Recency", T.LongType()),
        T.StructField("Frequency", T.LongType()),
        T.StructField("AccountFrequency", T.LongType()),
        T.StructField("Amount_sum", T.DoubleType()),
        T.StructField("Amount_mean", T.DoubleType()),
        T.StructField("Amount_std", T.DoubleType()),
        T.StructField("Amount_min", T.DoubleType()),
        T.StructField("Amount_max", T.DoubleType()),
        T.StructField("Amount_count", T.LongType()),
        T.StructField("Value_sum", T.DoubleType()),
        T.StructField("Value_mean", T.DoubleType()),
        T.StructField("AvgTransactionHour", T.DoubleType()),
        T.StructField("MostFrequentDayOfWeek", T.IntegerType()),
        T.StructField("CountryCode", T.StringType()),
        T.StructField("CurrencyCode", T.StringType()),
        T.StructField("ChannelId", T.StringType()),
    ]
)


class FeatureSet(NamedTuple):
    """Which customer features are encoded, which are scaled and which pass through."""

    categorical: tuple[str, ...]
    numerical: tuple[str, ...]
    extras: tuple[str, ...]


_SPEND = (
    "Amount_sum",
    "Amount_mean",
    "Amount_std",
    "Amount_min",
    "Amount_max",
    "Amount_count",
    "Value_sum",
    "Value_mean",
)
_CODES = ("CountryCode", "CurrencyCode", "ChannelId")

FEATURE_SETS = {
    # A feeds the clustering that makes the label: recency and frequency are scaled.
    "A": FeatureSet(
        categorical=_CODES,
        numerical=(*_SPEND, "Frequency", "Recency"),
        extras=("AvgTransactionHour", "MostFrequentDayOfWeek", "AccountFrequency"),
    ),
    # B feeds the classifier and scoring: recency and frequency pass through unscaled.
    "B": FeatureSet(
        categorical=_CODES,
        numerical=_SPEND,
        extras=("Frequency", "AvgTransactionHour", "MostFrequentDayOfWeek", "Recency", "AccountFrequency"),
    ),
}

RFM_COLUMNS = ["num__Amount_sum", "num__Frequency", "num__Recency"]
