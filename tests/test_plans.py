"""What the physical plans over a Parquet table must look like."""

import re

import pytest
from pyspark.sql import functions as F

from txrisk.operators import profile
from txrisk.operators.rollup import customer_features
from txrisk.sources.tables import read_transactions, write_table


@pytest.fixture(scope="module")
def table(spark, many_tx, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "tx")
    write_table(many_tx, path)
    return read_transactions(spark, path)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(spark, df):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    return [set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<(.*)>", text)], text


def test_roll_up_reads_each_column_once_and_prunes_the_rest(spark, table):
    columns, text = read_columns(spark, customer_features(table, "2024-02-01 00:00:00"))
    assert sorted(map(sorted, columns)) == sorted(
        map(
            sorted,
            [
                {"CustomerId", "TransactionId", "TransactionStartTime", "Amount", "Value"},
                {"CustomerId", "AccountId", "CountryCode", "CurrencyCode", "ChannelId"},
            ],
        )
    )
    assert text.count("PushedFilters: [IsNotNull(CustomerId)]") == 2


def test_roll_up_pre_aggregates_and_adds_no_shuffle_for_its_join(table):
    df = customer_features(table, "2024-02-01 00:00:00")
    plan = plan_of(df)
    assert plan.count("Exchange hashpartitioning") == 4  # totals; combinations, values, customers
    assert "ObjectHashAggregate" not in plan
    for exchange in re.finditer(r"Exchange hashpartitioning.*\n(.*)\n", plan):
        assert "partial_" in exchange.group(1)


def test_time_filters_reach_the_scan(table):
    recent = table.where(F.col("TransactionStartTime") >= F.lit("2024-01-21").cast("timestamp"))
    assert "GreaterThanOrEqual(TransactionStartTime" in plan_of(customer_features(recent, "2024-02-01 00:00:00"))


def test_both_directions_of_a_relation_share_a_shuffle(table):
    df = profile.relation_checks(table, [("AccountId", "CustomerId"), ("CustomerId", "AccountId")])
    df.collect()
    final = plan_of(df)
    assert "ReusedExchange" in final


def test_top_values_are_not_sorted_globally(table):
    plan = plan_of(profile.top_values(table, "ProductId"))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
