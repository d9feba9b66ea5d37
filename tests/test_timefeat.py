from txrisk.functions.timefeat import time_features

NAMES = [
    "TransactionHour",
    "TransactionDay",
    "TransactionMonth",
    "TransactionDayOfWeek",
    "TransactionWeekend",
    "TransactionYear",
]


def test_calendar_columns(make_tx):
    tx = make_tx(
        {"TransactionStartTime": "2025-06-15T14:30:00"},  # a Sunday
        {"TransactionStartTime": "2025-06-16T00:00:00"},  # a Monday
        {"TransactionStartTime": None},
    )
    rows = time_features(tx).select("TransactionId", *NAMES).orderBy("TransactionId").collect()
    assert list(rows[0])[1:] == [14, 15, 6, 6, 1, 2025]
    assert list(rows[1])[1:] == [0, 16, 6, 0, 0, 2025]
    assert list(rows[2])[1:] == [None, None, None, None, 0, None]


def test_text_is_parsed(spark):
    tx = spark.createDataFrame([("2025-06-14T23:59:59",)], "TransactionStartTime string")
    row = time_features(tx).first()
    assert (row["TransactionHour"], row["TransactionDayOfWeek"], row["TransactionWeekend"]) == (23, 5, 1)
