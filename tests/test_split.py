import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from txrisk.operators.split import stratified_folds, stratified_split


@pytest.fixture(scope="module")
def labelled(spark):
    """1,003 customers, one in seven of class 1, four without a label."""
    i = F.col("id")
    return spark.range(1003).select(
        F.concat(F.lit("C"), i).alias("CustomerId"), F.when(i >= 4, (i % 7 == 0).cast("int")).alias("is_high_risk")
    )


def ranks(rows):
    classes = defaultdict(list)
    for r in rows:
        if r["is_high_risk"] is not None:
            classes[r["is_high_risk"]].append(r["CustomerId"])
    return {
        label: sorted(ids, key=lambda c: hashlib.md5(f"{c}:42".encode()).hexdigest()) for label, ids in classes.items()
    }


def test_split_matches_ranking_by_hash(labelled):
    expected = {}
    for label, ids in ranks(labelled.collect()).items():
        cut = int(len(ids) * 0.2 + 0.5)
        expected |= {(c, label): "test" if i < cut else "train" for i, c in enumerate(ids)}
    got = stratified_split(labelled).collect()
    assert {(r["CustomerId"], r["is_high_risk"]): r["split"] for r in got} == expected
    assert len(got) == len(expected) == 999


def test_split_ignores_layout(labelled):
    first = {r["CustomerId"]: r["split"] for r in stratified_split(labelled).collect()}
    second = {r["CustomerId"]: r["split"] for r in stratified_split(labelled.repartition(9).orderBy("CustomerId")).collect()}
    assert first == second


def test_folds_are_even_within_classes(labelled):
    rows = stratified_folds(labelled, 3).collect()
    sizes = Counter((r["is_high_risk"], r["fold"]) for r in rows)
    assert set(sizes) == {(c, f) for c in (0, 1) for f in range(3)}
    for label in (0, 1):
        per_fold = [sizes[label, f] for f in range(3)]
        assert max(per_fold) - min(per_fold) <= 1


def test_tiny_classes(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1)], "CustomerId string, is_high_risk int")
    assert {r["split"] for r in stratified_split(df).collect()} == {"train"}
    folds = {r["CustomerId"]: r["fold"] for r in stratified_folds(df, 3).collect()}
    assert len(folds) == 3


def test_many_classes(spark):
    df = spark.range(10_000).selectExpr("cast(id as string) as CustomerId", "cast(id % 5000 as int) as label")
    out = stratified_split(df, label="label", test_share=0.5)
    assert out.groupBy("label").agg({"split": "count"}).count() == 5000
    assert out.where("split = 'test'").groupBy("label").count().where("count = 1").count() == 5000
