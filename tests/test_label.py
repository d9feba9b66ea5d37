import pytest

from txrisk.operators import label
from txrisk.operators.rollup import customer_features
from txrisk.plans.features import fit_features
from txrisk.schema import RFM_COLUMNS
from txrisk.session import materialise

SCHEMA = "CustomerId string, num__Amount_sum double, num__Frequency double, num__Recency double"


def test_nearest_centre_and_ties(spark):
    df = spark.createDataFrame([("a", 0.9, 0.0, 0.0), ("b", 0.1, 0.0, 0.0), ("tie", 0.5, 0.0, 0.0)], SCHEMA)
    assigned = label.assign_clusters(df, [[1.0, 0.0, 0.0], [0.0, 0.0, 0.0]])
    assert {r["CustomerId"]: r["cluster"] for r in assigned.collect()} == {"a": 0, "b": 1, "tie": 0}


def test_high_risk_is_the_least_frequent_cluster(spark):
    rows = [("a", 0.0, 1.0, 0.0, 0), ("b", 0.0, -1.0, 0.0, 1), ("c", 0.0, -1.0, 3.0, 2), ("d", 0.0, -1.0, 1.0, 2)]
    assigned = spark.createDataFrame(rows, SCHEMA + ", cluster int")
    # Clusters 1 and 2 tie on frequency; 2 has the higher mean recency.
    assert label.high_risk_cluster(label.cluster_summary(assigned)).first()["cluster"] == 2
    by_rule = {r["CustomerId"]: r["is_high_risk"] for r in label.label_from_cluster(assigned).collect()}
    assert by_rule == {"a": 0, "b": 0, "c": 1, "d": 1}
    given = {r["CustomerId"]: r["is_high_risk"] for r in label.label_from_cluster(assigned, cluster=0).collect()}
    assert given == {"a": 1, "b": 0, "c": 0, "d": 0}


def test_rfm_clusters(many_tx):
    matrix = materialise(fit_features(materialise(customer_features(many_tx)), "A").matrix)
    model = label.fit_rfm_clusters(matrix)
    centres = label.centres_of(model)
    assigned = label.assign_clusters(matrix, centres).collect()
    assert len(centres) == 3 and {r["cluster"] for r in assigned} == {0, 1, 2}
    assert len(assigned) == len({r["CustomerId"] for r in assigned}) == matrix.count()
    for r in assigned:
        gaps = [sum((r[c] - x) ** 2 for c, x in zip(RFM_COLUMNS, centre, strict=True)) for centre in centres]
        assert gaps[r["cluster"]] == pytest.approx(min(gaps))
    again = label.centres_of(label.fit_rfm_clusters(matrix))
    assert [x for c in again for x in c] == pytest.approx([x for c in centres for x in c])
