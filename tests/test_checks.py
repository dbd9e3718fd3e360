"""Declared checks: every rule against plain counts, fused scans, free SQL."""

import json

import pytest
from pyspark.sql import functions as F

from refinery.plans.checks import (Check, Compare, Count, Query, Reference, Rows, Share, Sum, Total, Unique, from_dicts, report,
                                   sums_of)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("checks")
    parent = spark.createDataFrame([(1, "a", 10.0), (2, "b", -1.0), (2, "b2", None), (None, "c", 4.0), (None, "d", 0.0)], "id int, name string, amount double")
    child = spark.createDataFrame([(1, 1, "x"), (2, 2, "x"), (3, 9, "y"), (4, 9, None), (5, None, "x"), (5, None, "x")], "n int, parent_id int, tag string")
    pair = spark.createDataFrame([(1, "x"), (2, "x"), (9, "z")], "p int, t string")
    out = {}
    for name, df in {"a.parent": parent, "a.child": child, "b.pair": pair, "b.empty": pair.limit(0)}.items():
        df.write.parquet(f"{root}/{name}")
        out[name] = spark.read.parquet(f"{root}/{name}")
    return out


RULES = [
    (Rows("a.parent"), 5), (Rows("b.empty"), 0),
    (Count("a.parent", "amount < 0"), 1), (Count("a.parent", "amount IS NULL"), 1), (Count("a.child", "tag NOT IN ('y')"), 4),
    (Total("a.child", "n * 10"), 200), (Total(("a.child", "b.pair", "b.empty"), "1"), 9),
    (Compare("a.parent", "=", "a.child"), 1), (Compare("a.parent", "<=", "a.child"), 0), (Compare("a.child", "<=", "a.parent"), 1),
    (Share("a.child", "tag = 'x'", 60), 0), (Share("a.child", "tag = 'x'", 70), 1), (Share("b.empty", "t = 'x'", 50), 0),
    (Unique("a.parent", "id"), 2), (Unique("a.child", "parent_id"), 2), (Unique("a.child", ("n", "tag")), 1), (Unique("b.pair", "p"), 0),
    (Reference("a.child", "parent_id", "a.parent", "id"), 2), (Reference("a.parent", "id", "a.child", "parent_id"), 0),
    (Reference("a.child", ("parent_id", "tag"), "b.pair", ("p", "t")), 1), (Reference("a.child", "n", "b.empty", "p"), 6),
    (Query("SELECT count(DISTINCT tag) FROM {a.child}"), 2), (Query("SELECT p FROM {b.empty}"), 0),
    (Query("SELECT 7 AS seven, 8 AS eight"), 7),
    (Query("SELECT max(c.n) - count(p.id) FROM {a.child} c LEFT JOIN {a.parent} p ON c.parent_id = p.id"), 2),
]


def test_every_rule(tables):
    checks = [Check(i, f"check {i}: it's \\ a rule", rule) for i, (rule, _) in enumerate(RULES)]
    got = report(checks, tables).orderBy("check_id").collect()
    assert [(r.check_id, r.value) for r in got] == [(i, v) for i, (_, v) in enumerate(RULES)]
    assert got[0].check_name == "check 0: it's \\ a rule"


def test_each_rule_alone_gives_the_same(tables):
    for rule, value in RULES:
        assert report([Check(1, "alone", rule)], tables).first()["value"] == value, rule


@pytest.mark.parametrize("value,expect_zero,warn_only,status", [
    ("0", True, False, "pass"), ("0", False, False, "fail"), ("3", True, False, "fail"), ("3", True, True, "warn"),
    ("3", False, False, "pass"), ("-3", True, False, "fail"), ("-3", False, True, "warn")])
def test_status(tables, value, expect_zero, warn_only, status):
    row = report([Check(1, "s", Query(f"SELECT {value}"), expect_zero, warn_only, "why")], tables).first()
    assert (row.status, row.severity, row.value, row.about) == (status, "warn" if warn_only else "error", int(value), "why")


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("parquet")


def test_checks_share_scans(tables):
    sums = [Check(1, "", Rows("a.child")), Check(2, "", Count("a.child", "n > 1")), Check(3, "", Share("a.child", "tag = 'x'", 10))]
    assert scans(report(sums, tables)) == 1
    one_key = [*sums, Check(4, "", Unique("a.child", "parent_id")), Check(5, "", Reference("a.child", "parent_id", "a.parent", "id"))]
    plan = report(one_key, tables)
    assert scans(plan) == 2 and "Join" not in plan._jdf.queryExecution().optimizedPlan().toString()
    assert scans(report([*one_key, Check(6, "", Unique("a.child", "n"))], tables)) == 3


def test_known_sums_cost_no_scan(tables):
    checks = [Check(1, "", Rows("a.child"), expect_zero=False), Check(2, "", Count("a.child", "n > 1"))]
    known = {s: 40 + i for i, s in enumerate(sums_of(checks, "a.child"))}
    df = report(checks, tables, known)
    assert scans(df) == 0 and [r.value for r in df.orderBy("check_id").collect()] == [40, 41]
    mixed = report([*checks, Check(3, "", Unique("a.child", "n"))], tables, known)
    assert scans(mixed) == 1 and [r.value for r in mixed.orderBy("check_id").collect()] == [40, 41, 1]
    assert Sum("a.child", "1") in known


def test_checks_from_json(tables):
    text = json.dumps([{"rule": "count", "table": "a.parent", "predicate": "amount < 0", "name": "no negative amounts", "warn_only": True},
                       {"rule": "reference", "table": "a.child", "key": ["parent_id", "tag"], "parent": "b.pair", "parent_key": ["p", "t"],
                        "name": "pairs exist", "id": 7},
                       {"rule": "query", "sql": "SELECT count(*) FROM {a.child}", "name": "rows", "expect_zero": False}])
    got = {r.check_id: (r.value, r.status) for r in report(from_dicts(json.loads(text)), tables).collect()}
    assert got == {1001: (1, "warn"), 7: (1, "fail"), 1003: (6, "pass")}
    with pytest.raises(ValueError, match="rule must be one of"):
        from_dicts([{"rule": "guess", "name": "x"}])


def test_a_bad_declaration_is_refused(tables):
    with pytest.raises(ValueError, match="share an id"):
        report([Check(1, "", Rows("a.child")), Check(1, "", Rows("a.parent"))], tables)
    with pytest.raises(ValueError, match="same number of columns"):
        report([Check(1, "", Reference("a.child", ("n", "tag"), "a.parent", "id"))], tables)
    with pytest.raises(ValueError, match="compare by"):
        report([Check(1, "", Compare("a.child", ">", "a.parent"))], tables)


def test_a_hot_key_is_combined_before_the_shuffle(spark):
    child = spark.range(200000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"))
    df = report([Check(1, "", Unique("c", "k")), Check(2, "", Reference("c", "k", "p"))], {"c": child, "p": spark.range(10).select(F.col("id").alias("k"))})
    assert [r.value for r in df.orderBy("check_id").collect()] == [1, 66664 - 1]
    assert "partial_sum" in df._jdf.queryExecution().executedPlan().toString()
