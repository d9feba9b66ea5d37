import json
import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tests.conftest import ONE_TX
from txrisk.operators import train
from txrisk.operators.rollup import customer_features
from txrisk.plans.scoring import score
from txrisk.plans.training import labelled_vectors
from txrisk.schema import TX_SCHEMA
from txrisk.session import materialise
from txrisk.sources.artifacts import Artifacts
from txrisk.streaming import scoring as feed
from txrisk.streaming.scoring import read_published, read_request_stream, score_stream

REF = "2024-09-24 00:00:00"


@pytest.fixture(scope="module")
def artifacts(many_tx):
    customers = materialise(customer_features(many_tx))
    labels = customers.select("CustomerId", (F.col("Value_mean") > 500).cast("int").alias("is_high_risk"))
    vectors, made = labelled_vectors(customers, labels)
    return Artifacts(made.fitted, made.manifest, train.random_forest(3, 3).fit(vectors), "B")


REQUESTS = {
    "a": [{**ONE_TX, "CustomerId": "C1", "Amount": a} for a in (5.0, 900.0)] + [{**ONE_TX, "CustomerId": "C2"}],
    "b": [{**ONE_TX, "CustomerId": "C1", "Amount": 50.0}],
    "bad": [{**ONE_TX, "CustomerId": "C3"}, {k: v for k, v in ONE_TX.items() if k != "Amount"}],
}


def write_requests(folder, names):
    folder.mkdir(exist_ok=True)
    for name in names:
        (folder / f"{name}.json").write_text(json.dumps(REQUESTS[name]))


def published(spark, out):
    return [read_published(spark, str(out / part), str(out / "scores")) for part in ("scores", "rejected")]


def run_stream(spark, folder, out, artifacts, **options):
    requests = read_request_stream(spark, str(folder), options.pop("max_files", None))
    query = score_stream(
        requests, artifacts, str(out / "scores"), str(out / "rejected"), str(out / "state"), options.pop("reference", REF), **options
    )
    query.awaitTermination(120)
    assert query.exception() is None
    return published(spark, out)


@pytest.mark.parametrize("max_files", [None, 1])
def test_stream_equals_batch_per_request(spark, artifacts, tmp_path, max_files):
    write_requests(tmp_path / "in", REQUESTS)
    scores, rejected = run_stream(spark, tmp_path / "in", tmp_path, artifacts, max_files=max_files)
    got = {(r["RequestId"].split("/")[-1], r["CustomerId"]): r["risk_probability"] for r in scores.collect()}
    expected = {}
    for name in ("a", "b"):
        tx = spark.read.schema(TX_SCHEMA).json(str(tmp_path / "in" / f"{name}.json"))
        for r in score(tx, artifacts, REF).collect():
            expected[f"{name}.json", r["CustomerId"]] = r["risk_probability"]
    assert got == pytest.approx(expected)
    assert sorted((r["CustomerId"], list(r["errors"])) for r in rejected.collect()) == [
        ("C3", []),
        ("K-31", ["Amount: missing"]),
    ]


def test_rows_can_be_refused_one_by_one_and_new_files_are_picked_up(spark, artifacts, tmp_path):
    write_requests(tmp_path / "in", ["bad"])
    scores, rejected = run_stream(spark, tmp_path / "in", tmp_path, artifacts, refuse_whole_request=False)
    assert [r["CustomerId"] for r in scores.collect()] == ["C3"] and rejected.count() == 1
    write_requests(tmp_path / "in", ["b"])
    scores, _ = run_stream(spark, tmp_path / "in", tmp_path, artifacts, refuse_whole_request=False)
    assert sorted(r["CustomerId"] for r in scores.collect()) == ["C1", "C3"]


def test_recency_counts_from_the_time_of_the_request(spark, artifacts, tmp_path):
    write_requests(tmp_path / "in", ["a", "b"])
    moments = {"a.json": REF, "b.json": "2024-12-01 00:00:00"}
    for name, moment in moments.items():
        seconds = datetime.fromisoformat(moment).replace(tzinfo=timezone.utc).timestamp()
        os.utime(tmp_path / "in" / name, (seconds, seconds))
    runs = []
    for attempt in ("first", "again"):
        scores, _ = run_stream(spark, tmp_path / "in", tmp_path / attempt, artifacts, reference=None)
        assert scores.columns[:3] == ["RequestId", "CustomerId", "risk_probability"]
        runs.append({(r["RequestId"].split("/")[-1], r["CustomerId"]): r["risk_probability"] for r in scores.collect()})
    expected = {}
    for name, moment in moments.items():
        tx = spark.read.schema(TX_SCHEMA).json(str(tmp_path / "in" / name))
        expected |= {(name, r["CustomerId"]): r["risk_probability"] for r in score(tx, artifacts, moment).collect()}
    assert runs[0] == runs[1] == pytest.approx(expected)


def test_columns_are_checked(spark, artifacts, tmp_path):
    (tmp_path / "in").mkdir()
    with pytest.raises(ValueError, match="Amount"):
        score_stream(read_request_stream(spark, str(tmp_path / "in")).drop("Amount"), artifacts, "s", "r", "c")


def test_a_batch_is_published_whole_or_not_at_all(spark, artifacts, tmp_path, monkeypatch):
    """Killed between the two writes, after both, and after the commit: nothing, nothing, then everything once."""
    write_requests(tmp_path / "in", REQUESTS)
    plain = feed.split_valid

    class Fails:
        def __getattr__(self, name):
            raise RuntimeError("killed")

    def half(checked, by):
        out = plain(checked, by)
        return out._replace(rejected=Fails())

    requests = read_request_stream(spark, str(tmp_path / "in"))
    args = (requests, artifacts, str(tmp_path / "scores"), str(tmp_path / "rejected"), str(tmp_path / "state"), REF)
    monkeypatch.setattr(feed, "split_valid", half)
    with pytest.raises(Exception, match="killed"):
        score_stream(*args).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "scores")).count() > 0
    assert read_published(spark, str(tmp_path / "scores"), str(tmp_path / "scores")).count() == 0
    monkeypatch.setattr(feed, "split_valid", plain)
    monkeypatch.setattr(feed, "_COMMIT", "batch_id long, attempt int")
    with pytest.raises(Exception):
        score_stream(*args).awaitTermination(120)
    monkeypatch.setattr(feed, "_COMMIT", "batch_id long, attempt string")
    assert all(frame.count() == 0 for frame in published(spark, tmp_path))
    score_stream(*args).awaitTermination(120)
    counts = [frame.count() for frame in published(spark, tmp_path)]
    assert counts == [3, 2] and spark.read.parquet(str(tmp_path / "scores")).count() == 9
    # The same batch once more, as after a loss of the stream's own state: it is left alone.
    again = args[:4] + (str(tmp_path / "other-state"), REF)
    score_stream(*again).awaitTermination(120)
    assert [frame.count() for frame in published(spark, tmp_path)] == counts
