"""Every registered query against DuckDB on the generated tables, and what their plans must not contain."""

import math
import os

import pytest

import __spark_entry__ as driver
from txrisk.plans.oracle import ORACLE
from txrisk.plans.queries import QUERIES

duckdb = pytest.importorskip("duckdb")

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="generated tables not found")

TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "timestamp": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF_DIR):
        con.execute(f"create view {name.removesuffix('.parquet')} as select * from '{SF_DIR}/{name}'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(value):
        return "null" if value is None or (isinstance(value, float) and math.isnan(value)) else repr(value)

    return sorted([text(row[i]) for i in order] for row in rows)


def test_names():
    assert set(ORACLE) == set(QUERIES)
    # The entry may add those of optional subpackages.
    assert QUERIES.items() <= driver.queries().items() and ORACLE.items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLE[name])
    types = {d[0]: str(d[1]) for d in result.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    assert canonical(map(tuple, df.collect()), df.columns) == canonical(result.fetchall(), list(types))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns[0] == "CustomerId" and df.count() > 0
