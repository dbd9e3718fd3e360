"""The queries that SQL can express against their DuckDB statements."""

import os

import duckdb
import pytest

from refinery.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_statement(spark, name):
    if not os.path.isdir(SF):
        pytest.skip("test tables not present")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    found = con.execute(queries.ORACLE[name])
    names = [d[0] for d in found.description]
    want = sorted(map(tuple, found.fetchall()))
    out = queries.QUERIES[name](spark, SF)
    assert sorted(out.columns) == sorted(names)
    assert sorted(map(tuple, out.select(*names).collect())) == want
