"""Property tests: rules against plain-Python definitions on generated data."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from refinery.functions import dates, values
from refinery.operators import aggregates
from crosschecks import naive_dense_key
from refinery.operators.keys import dense_key


def python_yyyymmdd(v):
    if v is None or v == 0 or len(str(v)) != 8:
        return None
    try:
        return dt.datetime.strptime(str(v), "%Y%m%d").date()
    except ValueError:
        return None


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-99999999, 99999999),
                          st.integers(19000101, 20991231)), min_size=1, max_size=300))
def test_parse_yyyymmdd_matches_python(spark, values_):
    df = spark.createDataFrame([(v,) for v in values_], "v int")
    got = [r[0] for r in df.select(dates.parse_yyyymmdd("v")).collect()]
    assert got == [python_yyyymmdd(v) for v in values_]


def python_repair(price, sales, qty):
    if price is None or price <= 0:
        return None if qty is None or qty == 0 or sales is None else sales / qty
    return float(price)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-50, 50)), st.one_of(st.none(), st.integers(-500, 500)),
                          st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=200))
def test_repair_price_matches_python(spark, rows):
    df = spark.createDataFrame(rows, "p int, s int, q int")
    got = [r[0] for r in df.select(values.repair_price("p", "s", "q")).collect()]
    assert got == [python_repair(*r) for r in rows]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.sampled_from(["a", "b", None])),
                min_size=0, max_size=150))
def test_dense_key_equals_row_number_with_heavy_duplication(spark, rows):
    df = spark.createDataFrame(rows, "x int, y string")
    got = sorted(map(tuple, dense_key(df, ["x"], "k").collect()))
    want = sorted(map(tuple, naive_dense_key(df, ["x"], "k").collect()))
    assert got == want


def test_coverage_ratio_on_empty_and_null_predicates(spark):
    empty = spark.createDataFrame([], "c string")
    row = aggregates.coverage_ratio(empty, F.col("c").isNotNull()).collect()[0]
    assert (row.covered, row.total, row.ratio_pct, row.below) == (0, 0, None, 0)
    df = spark.createDataFrame([("x",), (None,), ("n/a",), ("y",)], "c string")
    row = aggregates.coverage_ratio(df, F.col("c").isNotNull() & (F.col("c") != "n/a")).collect()[0]
    assert (row.covered, row.total, row.ratio_pct, row.below) == (2, 4, 50.0, 0)   # exactly 50 passes


def test_count_if_multi_skips_null_predicates(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "v int")
    row = aggregates.count_if_multi(df, {"neg": F.col("v") < 0, "null": F.col("v").isNull()}).collect()[0]
    assert (row.neg, row.null) == (1, 1)


def test_paired_counts_and_differences(spark):
    a, b = spark.range(7), spark.range(4)
    assert tuple(aggregates.rowcount_difference(a, b).collect()[0]) == (7, 4, 3)
    assert tuple(aggregates.rowcount_not_greater(a, b).collect()[0]) == (7, 4, 1)
    assert tuple(aggregates.rowcount_not_greater(b, a).collect()[0]) == (4, 7, 0)
