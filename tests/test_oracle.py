"""Every registered query against its DuckDB statement on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

from oracle_check import TABLES, digest  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from refinery.plans import catalog  # noqa: E402

SF = "/root/testdata/sf0.001"
ORACLE = catalog.ORACLE


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("test tables not present")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_library_query_has_an_oracle():
    qs = entry.queries()
    assert len(qs) >= 65
    assert set(entry.oracle_sql()) <= set(qs)
    assert set(catalog.QUERIES) == set(catalog.ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    hs, cs, _ = digest(df.columns, srows)
    hd, cd, _ = digest(dcols, drows)
    assert (len(srows), cs) == (len(drows), cd)
    assert hs == hd
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan          # no row-at-a-time Python anywhere


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["order_number", "product_key", "customer_key"]
    assert df.count() > 0
