import math

import numpy as np
import pytest

from txrisk.operators import profile
from txrisk.operators.quantiles import exact_quantiles

RNG = np.random.default_rng(7)
SHARES = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
SAMPLES = {
    "even": RNG.uniform(-5, 5, 801),
    "long tail": np.exp(RNG.normal(3, 4, 700)),
    "narrow band": 1e9 + RNG.uniform(0, 1e-3, 500),
    "one value owns a third": np.concatenate([np.full(300, 2.5), RNG.normal(2.5, 1, 600)]),
    "constant": np.full(40, -3.25),
    "single": np.array([4.0]),
    "two": np.array([1.0, 2.0]),
    "signed zeros": np.array([-0.0, 0.0, -1e-9, 1e-9, 0.0]),
    "huge": np.array([-1e300, -1.0, 0.0, 1.0, 1e300, 5e299]),
}


@pytest.fixture(scope="module")
def samples(spark):
    size = max(map(len, SAMPLES.values()))
    columns = list(SAMPLES)
    rows = [[float(SAMPLES[c][i]) if i < len(SAMPLES[c]) else None for c in columns] for i in range(size)]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in columns)).repartition(5)


def test_quantiles_are_exact(samples):
    found = exact_quantiles(samples, list(SAMPLES), SHARES)
    assert found.keys() == SAMPLES.keys()
    for column, values in SAMPLES.items():
        assert found[column] == pytest.approx(np.quantile(values, SHARES).tolist(), rel=1e-12, abs=1e-15)


def test_quantiles_of_nothing(spark):
    assert exact_quantiles(spark.createDataFrame([(None,)], "x double"), ["x"], [0.5]) == {}


def test_describe(samples):
    columns = ["even", "long tail", "one value owns a third", "single"]
    for row in profile.describe(samples, columns).collect():
        values = SAMPLES[row["column"]]
        assert row["count"] == len(values)
        assert (row["min"], row["max"]) == (values.min(), values.max())
        assert row["mean"] == pytest.approx(values.mean())
        assert row["p50"] == pytest.approx(np.median(values))
        if len(values) == 1:
            assert row["std"] is None
        else:
            assert row["std"] == pytest.approx(values.std(ddof=1))


def test_describe_keeps_empty_columns_and_approximates(spark, samples):
    empty = spark.createDataFrame([(None,)], "x double")
    assert [(r["count"], r["p50"]) for r in profile.describe(empty, ["x"]).collect()] == [(0, None)]
    row = profile.describe(samples, ["even"], approx=True).first()
    assert row["p50"] == pytest.approx(np.median(SAMPLES["even"]), abs=0.05)


def test_histogram(samples):
    columns = ["even", "long tail", "constant"]
    rows = profile.histogram(samples, columns, 10).collect()
    assert len(rows) == 30
    for column in columns:
        counts, edges = np.histogram(SAMPLES[column], bins=10)
        mine = sorted((r for r in rows if r["column"] == column), key=lambda r: r["bin"])
        assert [r["n"] for r in mine] == counts.tolist()
        assert [r["lower"] for r in mine] == pytest.approx(edges[:-1].tolist())
        assert mine[-1]["upper"] == pytest.approx(edges[-1])


@pytest.mark.parametrize("column", ["even", "one value owns a third", "long tail"])
def test_density_is_close_to_the_direct_sum(samples, column):
    values = SAMPLES[column]
    h = values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(values.min(), values.max(), 50)
    direct = np.exp(-(((grid[:, None] - values[None, :]) / h) ** 2) / 2).sum(axis=1) / (
        len(values) * h * math.sqrt(2 * math.pi)
    )
    rows = sorted(profile.density_curve(samples, [column], 50).collect(), key=lambda r: r["point"])
    assert [r["x"] for r in rows] == pytest.approx(grid.tolist())
    assert np.abs(np.array([r["density"] for r in rows]) - direct).max() < 1e-9 * direct.max()


def test_box_stats(samples):
    for row in profile.box_stats(samples, ["even", "long tail"]).collect():
        values = SAMPLES[row["column"]]
        q1, median, q3 = np.quantile(values, [0.25, 0.5, 0.75])
        inside = values[(values >= q1 - 1.5 * (q3 - q1)) & (values <= q3 + 1.5 * (q3 - q1))]
        assert [row["q1"], row["median"], row["q3"]] == pytest.approx([q1, median, q3])
        assert row["whisker_low"] == pytest.approx(min(inside.min(), q1)) and row["whisker_high"] == pytest.approx(max(inside.max(), q3))
        assert row["outliers"] == len(values) - len(inside)


def test_shape_and_info(make_tx):
    tx = make_tx({}, {"Amount": None})
    assert tuple(profile.shape(tx).first()) == (2, 16)
    info = {r["column"]: (r["type"], r["non_null"]) for r in profile.column_info(tx).collect()}
    assert info["Amount"] == ("double", 1) and info["CustomerId"] == ("string", 2) and info["BatchId"] == ("string", 0)


def test_id_uniqueness(make_tx):
    tx = make_tx({"AccountId": "a"}, {"AccountId": "a"}, {"AccountId": None})
    rows = {r["column"]: tuple(r)[1:] for r in profile.id_uniqueness(tx, ["TransactionId", "AccountId"]).collect()}
    assert rows == {"TransactionId": (3, 3, 0, True), "AccountId": (1, 3, 2, False)}


def test_value_counts_and_balance(make_tx):
    tx = make_tx(*({"FraudResult": f, "ChannelId": 1} for f in (0, 0, 1, None)))
    counts = profile.value_counts(tx, ["FraudResult", "ChannelId"]).collect()
    assert [tuple(r) for r in counts] == [("ChannelId", "1", 4), ("FraudResult", "0", 2), ("FraudResult", "1", 1)]
    shares = {r["FraudResult"]: r["share"] for r in profile.class_balance(tx, "FraudResult").collect()}
    assert shares == pytest.approx({0: 2 / 3, 1: 1 / 3})


def test_top_values(make_tx):
    tx = make_tx(*({"ProductId": p} for p in ["b", "b", "c", "c", "a", "d", None, None, None]))
    assert [tuple(r) for r in profile.top_values(tx, "ProductId", 3).collect()] == [("b", 2), ("c", 2), ("a", 1)]
    assert profile.filter_top_values(tx, "ProductId", 2).count() == 4


def test_relations(make_tx):
    tx = make_tx(
        {"AccountId": "a1", "CustomerId": "c1"},
        {"AccountId": "a1", "CustomerId": "c2"},
        {"AccountId": "a2", "CustomerId": "c1"},
        {"AccountId": "a3", "CustomerId": None},
        {"AccountId": None, "CustomerId": "c3"},
    )
    checks = profile.relation_checks(tx, [("AccountId", "CustomerId"), ("CustomerId", "AccountId")]).collect()
    assert [tuple(r) for r in checks] == [
        ("AccountId->CustomerId", 3, 1, False),
        ("CustomerId->AccountId", 3, 1, False),
    ]
    assert [tuple(r) for r in profile.keys_with_many(tx, "AccountId", "CustomerId").collect()] == [("a1", 2)]
    assert profile.pair_counts(tx, [("AccountId", "CustomerId")]).first()["n"] == 5


def test_shared_account_samples(many_tx):
    rows = many_tx.collect()
    customers = {}
    for r in rows:
        customers.setdefault(r["AccountId"], set()).add(r["CustomerId"])
    expected = set()
    for account, members in customers.items():
        if len(members) > 1:
            mine = sorted(
                (r for r in rows if r["AccountId"] == account), key=lambda r: (r["TransactionStartTime"], r["TransactionId"])
            )
            expected |= {r["TransactionId"] for r in mine[:5]}
    got = profile.shared_key_samples(many_tx.repartition(6)).collect()
    assert {r["TransactionId"] for r in got} == expected and len(got) == len(expected)


def test_a_hot_key_is_cut_before_the_shuffle(many_tx):
    plan = profile.shared_key_samples(many_tx)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    cut = next(i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line)
    shuffle = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(AccountId" in line)
    assert shuffle < cut  # plans print from the result down to the scan


def one_column(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "v double")


def test_histogram_of_values_on_edges(spark):
    values = [i / 10 for i in range(51)]
    rows = sorted(profile.histogram(one_column(spark, [*values, float("inf"), float("nan")]), ["v"], 50).collect(), key=lambda r: r["bin"])
    assert sum(r["n"] for r in rows) == 51
    for r in rows:
        assert r["n"] == sum(r["lower"] <= v and (v < r["upper"] or r["bin"] == 50) for v in values)


def test_whisker_ends_at_the_box(spark):
    row = profile.box_stats(one_column(spark, [1, 2, 3, 100]), ["v"]).first()
    assert (row["q3"], row["whisker_low"], row["whisker_high"], row["outliers"]) == (27.25, 1.0, 27.25, 1)


def test_quantiles_of_infinite_values(spark):
    found = profile.exact_quantiles(one_column(spark, [1, float("inf"), float("inf")]), ["v"], [0.0, 0.5, 1.0])
    assert found["v"] == [1.0, float("inf"), float("inf")]
