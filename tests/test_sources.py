import json
from datetime import datetime

import pytest

from tests.conftest import ONE_TX
from txrisk.schema import LABEL_SCHEMA, TX_SCHEMA
from txrisk.session import materialise
from txrisk.sources import tables


def test_csv_by_name_with_missing_texts(spark, tmp_path):
    path = tmp_path / "tx.csv"
    path.write_text(
        "Amount,CustomerId,TransactionStartTime,ChannelId,Note,CountryCode,Value\n"
        '10.5,C1,2018-11-15T02:18:49Z,3,"says ""hi"", twice",256,NaN\n'
        "NA,null,,n/a,x,,7\n"
    )
    tx = tables.read_transactions(spark, str(path), "csv")
    first, second = tx.collect()
    assert first["Amount"] == 10.5 and first["Value"] is None and first["ChannelId"] == 3
    assert first["CountryCode"] == "256" and first["Note"] == 'says "hi", twice'
    assert first["TransactionStartTime"] == datetime(2018, 11, 15, 2, 18, 49)
    assert [second[c] for c in tx.columns if c not in ("Note", "Value")] == [None] * 5
    assert tx.schema["Amount"].dataType.typeName() == "double"


def test_parquet_and_json_round_trip(spark, make_tx, tmp_path):
    tx = make_tx({}, {"Amount": float("nan"), "CountryCode": None})
    tables.write_table(tx, str(tmp_path / "p"))
    tables.write_table(tx.drop("Amount"), str(tmp_path / "j"), "json")
    parquet = tables.read_transactions(spark, str(tmp_path / "p")).orderBy("TransactionId").collect()
    assert [r["Amount"] for r in parquet] == [37.25, None]
    from_json = tables.read_transactions(spark, str(tmp_path / "j"), "json")
    assert from_json.schema == TX_SCHEMA and from_json.count() == 2
    with pytest.raises(ValueError, match="Unknown format"):
        tables.read_transactions(spark, str(tmp_path / "p"), "xml")


def test_parquet_without_zone_becomes_a_timestamp(spark, tmp_path):
    raw = spark.sql("select 'C1' as CustomerId, timestamp_ntz'2024-01-01 10:00:00' as TransactionStartTime, 2 as Amount")
    raw.write.parquet(str(tmp_path / "p"))
    tx = tables.read_transactions(spark, str(tmp_path / "p"))
    assert dict(tx.dtypes) == {"CustomerId": "string", "TransactionStartTime": "timestamp", "Amount": "double"}


def test_labels_and_features_as_csv(spark, tmp_path):
    labels = spark.createDataFrame([("C1", 1), ("C2", 0)], LABEL_SCHEMA)
    tables.write_table(labels, str(tmp_path / "labels"), "csv")
    tables.write_table(labels.limit(1), str(tmp_path / "labels"), "csv")  # overwrites
    assert [tuple(r) for r in tables.read_labels(spark, str(tmp_path / "labels"), "csv").collect()] == [("C1", 1)]
    features = spark.createDataFrame([("C1", 0.25, 3)], "CustomerId string, `num__Value_mean` double, Frequency bigint")
    tables.write_table(features, str(tmp_path / "f"), "csv")
    assert tables.read_features(spark, str(tmp_path / "f"), "csv").collect() == features.collect()


def test_requests_keep_their_text(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps([ONE_TX, {**ONE_TX, "Amount": "abc"}]))
    rows = tables.read_requests(spark, str(tmp_path / "r.json")).collect()
    assert [r["Amount"] for r in rows] == ["37.25", "abc"]


def test_layouts_of_requests(spark, tmp_path):
    records = [ONE_TX, {**ONE_TX, "Amount": 7, "AccountId": "x } { y"}]
    layouts = {
        "compact": json.dumps(records),
        "pretty": json.dumps(records, indent=2),
        "lines": "\n".join(map(json.dumps, records)) + "\n",
    }
    found = {}
    for name, text in layouts.items():
        (tmp_path / f"{name}.json").write_text(text)
        found[name] = sorted(map(tuple, tables.read_requests(spark, str(tmp_path / f"{name}.json")).collect()))
    assert found["compact"] == found["pretty"] == found["lines"] and len(found["lines"]) == 2


def test_run_log_appends(spark, tmp_path):
    path = str(tmp_path / "runs")
    for run in ("r1", "r2"):
        tables.log_run(spark, path, run, {"trees": 100}, {"roc_auc": 0.75}, "forest")
    assert tables.read_runs(spark, path).count() == 6
    one = {r["name"]: r["value"] for r in tables.read_runs(spark, path, ["r2"]).collect()}
    assert one == {"name": "forest", "trees": "100", "roc_auc": "0.75"}


def test_materialise_writes_to_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    kept = materialise(spark.range(10))
    assert kept.count() == 10 and not kept.is_cached
    assert all(f.removeprefix("file://").startswith(folder) for f in kept.inputFiles())
