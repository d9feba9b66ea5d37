from __future__ import annotations

import os
import sys
import time
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Rows cross between Python and Spark in the zone of the Python process; expected values are in UTC.
os.environ["TZ"] = "UTC"
time.tzset()

from txrisk.schema import TX_SCHEMA  # noqa: E402
from txrisk.session import spark_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = spark_session(
        "txrisk-tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# The request of the scoring tests.
ONE_TX = {
    "CustomerId": "K-31",
    "TransactionId": "P-9",
    "TransactionStartTime": "2024-09-08T10:00:00",
    "CountryCode": "KE",
    "CurrencyCode": "KES",
    "ChannelId": 4,
    "Amount": 37.25,
    "Value": 412.0,
    "AccountId": "D-2",
}


@pytest.fixture(scope="session")
def make_tx(spark):
    """Transactions from partial rows; what a row leaves out takes a default, ``None`` stays null."""

    def make(*rows, schema=TX_SCHEMA):
        full = []
        for i, row in enumerate(rows):
            values = {**ONE_TX, "TransactionId": f"T{i}", **row}
            if isinstance(values["TransactionStartTime"], str):
                values["TransactionStartTime"] = datetime.fromisoformat(values["TransactionStartTime"])
            full.append(tuple(values.get(f.name) for f in schema.fields))
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def many_tx(spark):
    """3,000 transactions from a range, derived by Spark; customer K0 and account X0 own a third of them each."""
    from pyspark.sql import functions as F

    i = F.col("id")
    mixed = F.abs(F.xxhash64(i))
    return spark.range(3000).select(
        F.concat(F.lit("T"), i).alias("TransactionId"),
        F.concat(F.lit("B"), F.floor(i / 4)).alias("BatchId"),
        F.when(mixed % 3 == 1, "X0").otherwise(F.concat(F.lit("X"), mixed % 40)).alias("AccountId"),
        F.concat(F.lit("S"), mixed % 20).alias("SubscriptionId"),
        F.when(i % 3 == 0, "K0").otherwise(F.concat(F.lit("K"), mixed % 50)).alias("CustomerId"),
        F.element_at(F.array(F.lit("UGX"), F.lit("KES"), F.lit("ETB")), (mixed % 3 + 1).cast("int")).alias("CurrencyCode"),
        F.when(mixed % 11 != 0, (mixed % 7 + 250).cast("string")).alias("CountryCode"),
        F.concat(F.lit("P"), mixed % 6).alias("ProviderId"),
        F.concat(F.lit("PR"), mixed % 23).alias("ProductId"),
        F.concat(F.lit("c"), mixed % 5).alias("ProductCategory"),
        (8 + mixed % 5).cast("int").alias("ChannelId"),
        F.when(mixed % 17 != 0, (mixed % 100_000) / 100.0 - 100).alias("Amount"),
        ((mixed % 99_991) / 100.0 + 1).alias("Value"),
        F.timestamp_micros(F.lit(1_704_067_200_000_000) + (mixed % 2_592_000) * 1_000_000).alias("TransactionStartTime"),
        (mixed % 5).cast("int").alias("PricingStrategy"),
        (mixed % 500 == 0).cast("int").alias("FraudResult"),
    )
