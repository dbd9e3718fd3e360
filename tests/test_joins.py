"""Lookup joins and orphan detection on literal rows."""

import pytest

from pyspark.sql import functions as F

from refinery.operators import joins
from refinery.operators.joins import hot_keys, left_lookup, orphans


def test_left_lookup_keeps_unmatched_and_multiplies_repeated_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], "k int, w string")
    got = sorted(map(tuple, left_lookup(left, right, "k", right_cols=["w"], prefix="r_").collect()), key=str)
    assert got == sorted([(1, "a", "x"), (1, "a", "y"), (2, "b", None), (None, "c", None)], key=str)


def test_orphans_ignore_null_keys_by_default(spark):
    child = spark.createDataFrame([(1,), (2,), (None,), (4,)], "k int")
    parent = spark.createDataFrame([(1,), (4,), (None,)], "k int")
    assert sorted(r.k for r in orphans(child, parent, "k").collect()) == [2]
    assert sorted((r.k for r in orphans(child, parent, "k", ignore_null=False).collect()),
                  key=lambda x: (x is not None, x)) == [None, 2]


def test_hot_keys_need_a_share(spark):
    df = spark.createDataFrame([(1,)] * 6 + [(2,)] * 3 + [(None,)] * 11, "k int")
    assert sorted(r.k for r in hot_keys(df, "k", 0.15).collect()) == [1, 2]
    assert [r.k for r in hot_keys(df, "k", 0.3).collect()] == [1]
    for bad in (0, -1, 1.5):
        with pytest.raises(ValueError):
            hot_keys(df, "k", bad)
    assert hot_keys(df.limit(0), "k", 0.5).count() == 0


def test_salted_lookup_without_hot_keys_is_the_plain_join(spark):
    from refinery.operators.joins import salted_left_lookup
    from pyspark.sql import functions as F
    left = spark.range(2000).select((F.col("id") % 500).alias("k"))
    right = spark.range(500).withColumnRenamed("id", "k")
    got = sorted(r.k for r in salted_left_lookup(left, right, "k", salts=4, min_share=0.5).collect())
    assert got == sorted(r.k for r in left.join(right, "k", "left").collect())


def test_top_key_share_on_an_empty_table(spark):
    from refinery.operators.aggregates import top_key_share
    row = top_key_share(spark.createDataFrame([], "k int"), "k").collect()[0]
    assert row.top_rows is None and row.share is None


def test_guarded_lookup_keeps_one_row_per_left_row(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None), (5, "a"), (6, "e")], "n int, k string")
    right = spark.createDataFrame([("a", 2, "x"), ("a", 2, "x"), ("b", 5, None), ("b", 1, "y"), ("b", None, "z"), (None, 9, "n"), ("e", None, None),
                                   ("e", None, None)], "k string, v int, w string")
    got = joins.guarded_lookup(left, right, "k", right_cols=["v", "w"], prefix="r_")
    assert got.columns == ["n", "k", "r_v", "r_w", "matches", "conflict"]
    assert sorted(map(tuple, got.collect())) == [
        (1, "a", 2, "x", 2, False), (2, "b", None, "z", 3, True), (3, "c", None, None, 0, False),
        (4, None, None, None, 0, False), (5, "a", 2, "x", 2, False), (6, "e", None, None, 2, False)]
    one = joins.guarded_lookup(left, right, "k", right_cols=["w"]).filter("k = 'b'").first()
    assert (one.w, one.matches, one.conflict) == (None, 3, True)


def test_guarded_lookup_can_refuse_a_conflict(spark):
    right = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", 2)], "k string, v int")
    agree = spark.createDataFrame([(1, "a"), (2, "z")], "n int, k string")
    assert joins.guarded_lookup(agree, right, "k", right_cols=["v"], fail_on_conflict=True).count() == 2
    with pytest.raises(Exception, match="rows of one k differ: b"):
        joins.guarded_lookup(agree.union(spark.createDataFrame([(3, "b")], "n int, k string")), right, "k", right_cols=["v"],
                             fail_on_conflict=True).collect()


def test_guarded_lookup_where_one_key_holds_the_lookup_side(spark):
    right = spark.range(30000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    left = spark.range(2000).select(F.lit("hot").alias("k"), F.col("id"))
    got = joins.guarded_lookup(left, right, "k", right_cols=["v"])
    assert got.groupBy("v", "matches", "conflict").count().collect() == [(1, 20000, True, 2000)]
