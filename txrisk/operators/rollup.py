"""Transactions to one feature row per customer."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.functions.columns import days_since, position_of_first_max
from txrisk.functions.timefeat import day_of_week, hour_of
from txrisk.schema import CUSTOMER, TIME

_MODE_COLUMNS = ("CountryCode", "CurrencyCode", "ChannelId")


def reference_date(tx: DataFrame) -> DataFrame:
    """One row with the latest transaction time of the table."""
    return tx.agg(F.max(TIME).alias("reference_date"))


def _reference(tx: DataFrame, given: datetime | str | Column | None) -> Column:
    if given is None:
        return reference_date(tx).scalar()
    if isinstance(given, Column):
        return given
    # As text, so that a moment without a zone is read in the session time zone, not in that of the Python process.
    return F.lit(given.isoformat() if isinstance(given, datetime) else given).cast("timestamp")


def customer_features(
    tx: DataFrame,
    reference: datetime | str | Column | None = None,
    by: Sequence[str] = (CUSTOMER,),
) -> DataFrame:
    """One row per customer with recency, frequency, spend statistics and most frequent attributes.

    ``reference`` is the moment recency counts from; by default the latest time in ``tx``. ``by`` widens the key, for
    example to keep requests apart. Rows with a null key are dropped.

    Two aggregations that share no input column but the key, joined on it:

    * the totals use only fixed-width aggregates, so both halves are hash aggregates and a customer that owns a large
      part of the table still reaches the shuffle as one row per map task;
    * the most frequent values and the account count start from counts per (customer, account, country, currency,
      channel), so the rows of one large customer spread over tasks, and no task ever holds a customer's distinct values
      in memory. Grouping sets over those counts then give counts per value.

    Both end partitioned by the key, so the join adds no shuffle.
    """
    keys = list(by)
    rows = tx.where(F.col(CUSTOMER).isNotNull())
    ref = _reference(tx, reference)
    features = _totals(rows, keys).join(_favourites(rows, keys), keys)
    weekdays = [F.col(f"_dow{d}") for d in range(7)]
    return features.select(
        *keys,
        days_since(F.col("_last"), ref).alias("Recency"),
        "Frequency",
        "AccountFrequency",
        # A customer whose amounts are all missing has spent 0, not null.
        F.coalesce("Amount_sum", F.lit(0.0)).alias("Amount_sum"),
        "Amount_mean",
        "Amount_std",
        "Amount_min",
        "Amount_max",
        "Amount_count",
        F.coalesce("Value_sum", F.lit(0.0)).alias("Value_sum"),
        "Value_mean",
        "AvgTransactionHour",
        F.when(F.greatest(*weekdays) > 0, position_of_first_max(weekdays)).otherwise(-1).alias("MostFrequentDayOfWeek"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("Unknown")).alias(c) for c in _MODE_COLUMNS),
    )


def _totals(rows: DataFrame, keys: list[str]) -> DataFrame:
    moment = F.col(TIME)
    return rows.groupBy(*keys).agg(
        F.max(moment).alias("_last"),
        F.count("TransactionId").alias("Frequency"),
        F.sum("Amount").alias("Amount_sum"),
        F.avg("Amount").alias("Amount_mean"),
        F.stddev_samp("Amount").alias("Amount_std"),
        F.min("Amount").alias("Amount_min"),
        F.max("Amount").alias("Amount_max"),
        F.count("Amount").alias("Amount_count"),
        F.sum("Value").alias("Value_sum"),
        F.avg("Value").alias("Value_mean"),
        F.avg(hour_of(moment)).alias("AvgTransactionHour"),
        # Seven counters are all a weekday mode needs.
        *(F.count_if(day_of_week(moment) == d).alias(f"_dow{d}") for d in range(7)),
    )


def _favourites(rows: DataFrame, keys: list[str]) -> DataFrame:
    combos = rows.groupBy(*keys, "AccountId", *_MODE_COLUMNS).agg(F.count(F.lit(1)).alias("_n"))
    key_columns = [F.col(k) for k in keys]
    per_value = combos.groupingSets(
        [[*key_columns, F.col(c)] for c in ("AccountId", *_MODE_COLUMNS)],
        *key_columns,
        F.col("AccountId"),
        *(F.col(c) for c in _MODE_COLUMNS),
    ).agg(F.sum("_n").alias("_n"))

    def most_frequent(name: str) -> Column:
        # Smallest (-count, value): the largest count, and the smallest value in the column's own type on ties.
        # Of the four columns only the one of the row's grouping set is set, so the null check also picks the set.
        ranked = F.struct((-F.col("_n")).alias("n"), F.col(name).alias("value"))
        return F.min(F.when(F.col(name).isNotNull(), ranked))["value"].alias(name)

    return per_value.groupBy(*keys).agg(
        F.count("AccountId").alias("AccountFrequency"), *(most_frequent(c) for c in _MODE_COLUMNS)
    )
