"""Queries of this subpackage against their DuckDB equivalents."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from txrisk.llm.queries import ORACLE, QUERIES

SF = Path("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", ["op3_warc", "op6_near_duplicates"])
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    expected = con.sql(ORACLE[name])
    found = QUERIES[name](spark, str(SF))
    assert sorted(found.columns) == sorted(expected.columns)
    rows = [tuple(r) for r in found.select(*expected.columns).collect()]
    assert rows and sorted(rows, key=str) == sorted(expected.fetchall(), key=str)
