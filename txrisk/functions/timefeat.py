"""Calendar columns of a transaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.schema import TIME


def hour_of(moment: Column) -> Column:
    return F.hour(moment)


def day_of_week(moment: Column) -> Column:
    """Monday is 0 and Sunday is 6."""
    return F.weekday(moment)


def time_features(tx: DataFrame) -> DataFrame:
    """Add the six calendar columns; text timestamps are parsed first."""
    if tx.schema[TIME].dataType.typeName() == "string":
        tx = tx.withColumn(TIME, F.to_timestamp(TIME))
    moment = F.col(TIME)
    return tx.withColumns(
        {
            "TransactionHour": hour_of(moment),
            "TransactionDay": F.dayofmonth(moment),
            "TransactionMonth": F.month(moment),
            "TransactionDayOfWeek": day_of_week(moment),
            # A row without a time is not on a weekend: the flag is 0, not null.
            "TransactionWeekend": F.coalesce(day_of_week(moment).isin(5, 6), F.lit(False)).cast("int"),
            "TransactionYear": F.year(moment),
        }
    )
