"""Dense surrogate keys and latest-version selection."""

from pyspark.sql import functions as F

from crosschecks import latest_per_key_window, naive_dense_key
from refinery.operators import keys
from refinery.operators.keys import dense_key, latest_per_key, ranked_partitions
from refinery.plans import catalog
from refinery.session import materialize


def rows(df, order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_dense_key_matches_row_number_on_orders(spark, sf_small):
    orders = catalog.orders_by_date(spark, sf_small)
    got = dense_key(orders, ["o_orderdate", "o_orderkey"], "k", distinct=True)
    want = naive_dense_key(orders, ["o_orderdate", "o_orderkey"], "k")
    assert rows(got, ["k"]) == rows(want, ["k"])


def test_dense_key_general_path_matches_on_orders(spark, sf_small):
    orders = catalog.orders_by_date(spark, sf_small)
    got = dense_key(orders, ["o_orderdate"], "k")          # ties on the date: all columns break them
    want = naive_dense_key(orders, ["o_orderdate"], "k")
    assert rows(got, ["k"]) == rows(want, ["k"])


def test_dense_key_with_copies_and_nulls(spark):
    base = [(None, "a"), (1, "b"), (1, "b"), (2, None), (1, "a")]
    hot = [(3, "hot")] * 70
    df = spark.createDataFrame(base + hot, "id int, v string")
    got = dense_key(df, ["id"], "k")
    keys = sorted(r.k for r in got.collect())
    assert keys == list(range(1, len(base) + len(hot) + 1))
    want = naive_dense_key(df, ["id"], "k")
    assert rows(got, ["k"]) == rows(want, ["k"])


def test_dense_key_empty_input(spark):
    df = spark.createDataFrame([], "id int, v string")
    assert dense_key(df, ["id"], "k").count() == 0


def test_dense_key_data_path_has_no_single_partition(spark, sf_small):
    """Only the per-partition offsets (one row per partition) may pass
    through a single partition; the rows themselves never do."""
    orders = catalog.orders_by_date(spark, sf_small)
    plan = dense_key(orders, ["o_orderdate"], "k")._jdf.queryExecution().executedPlan().toString()
    naive = naive_dense_key(orders, ["o_orderdate"], "k")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" in naive
    for line in plan.splitlines():
        if "SinglePartition" in line:
            assert "o_orderkey" not in line


def test_dense_key_range_sort_splits_hot_leading_value(spark):
    """One leading value holding most rows is still spread over many
    partitions because the range bounds are on the full tuple."""
    df = spark.range(0, 20000).select(F.lit(1).alias("lead"), F.col("id").alias("tail"))
    tagged = df.groupBy("lead", "tail").count().orderBy("lead", "tail") \
        .select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(tagged) > 1
    assert max(r["count"] for r in tagged) < 20000 * 0.5


def test_latest_per_key_matches_window_form(spark, sf_small):
    products = catalog.s_products(spark, sf_small)
    a = latest_per_key(products, ["product_number"], ["start_date"], ["product_id"])
    b = latest_per_key_window(products, ["product_number"], ["start_date"], ["product_id"])
    assert rows(a, ["product_number"]) == rows(b, ["product_number"])


def test_latest_per_key_null_dates_are_oldest(spark):
    df = spark.createDataFrame([("p", None, 1), ("p", "2020-01-01", 2), ("q", None, 3)],
                               "k string, d string, id int")
    got = {r.k: r.id for r in latest_per_key(df, ["k"], ["d"], ["id"]).collect()}
    assert got == {"p": 2, "q": 3}


def test_latest_per_key_null_key_group_and_ties(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 3, "b"), ("k", 2, "x"), ("k", 2, "y"), ("k", None, "z")],
                               "k string, d int, v string")
    got = sorted(map(tuple, latest_per_key(df, ["k"], ["d"], ["v"]).collect()), key=str)
    want = sorted(map(tuple, latest_per_key_window(df, ["k"], ["d"], ["v"]).collect()), key=str)
    assert got == want == sorted([(None, 3, "b"), ("k", 2, "y")], key=str)


def test_dense_key_orders_descending_columns(spark):
    df = spark.createDataFrame([(1, "a"), (3, "b"), (2, "c"), (None, "d")], "x int, y string")
    got = {r.y: r.k for r in dense_key(df, [F.col("x").desc_nulls_last()], "k").collect()}
    assert got == {"b": 1, "c": 2, "a": 3, "d": 4}


def test_dense_key_leaves_values_as_they_are(spark):
    df = spark.createDataFrame([(-0.0, 1), (0.0, 2), (float("nan"), 3), (None, 4)], "x double, y int")
    got = {r.y: r.x for r in dense_key(df, ["y"], "k").collect()}
    assert str(got[1]) == "-0.0" and str(got[2]) == "0.0" and got[3] != got[3] and got[4] is None


def test_dense_key_runs_no_python_in_any_stage(spark, monkeypatch):
    from refinery.operators import keys
    plans, write = [], keys.materialize
    monkeypatch.setattr(keys, "materialize", lambda df, name: plans.append((name, df._jdf.queryExecution().toString())) or write(df, name))
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "x int, y string")
    out = dense_key(df, ["x"], "k")
    plans.append(("result", out._jdf.queryExecution().toString()))
    assert [n for n, _ in plans] == ["dense-key-rows", "dense-key", "dense-key-offsets", "result"]
    assert not any(w in p for _, p in plans for w in ("Python", "Arrow", "Pandas"))


def test_dense_key_splits_a_large_group_of_identical_rows(spark):
    df = spark.range(30000).select(F.lit(1).alias("x"), F.lit("same").alias("y"))
    rows_ = df.withColumn("__row", F.monotonically_increasing_id())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")     # else so few rows end up in one
    try:
        parts = ranked_partitions(rows_, ["x"]).groupBy("__part").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) > 1 and max(r["count"] for r in parts) < 15000
    assert dense_key(df, ["x"], "k").agg(F.count_distinct("k"), F.min("k"), F.max("k")).first() == (30000, 1, 30000)


def kept(spark, rows, known=None):
    df = spark.createDataFrame(rows, "a int, b string, v int").repartition(3)
    keyed, known = keys.kept_key(df, ["a", "b"], "k", known)
    known = materialize(known, "known")          # as a table between two runs
    return {tuple(r)[1:]: r.k for r in keyed.collect()}, known, keyed


def test_known_rows_keep_their_keys(spark):
    first, known, _ = kept(spark, [(2, "x", 1), (1, "y", 1), (None, "z", 1), (3, None, 1)])
    assert first == {(None, "z", 1): 1, (1, "y", 1): 2, (2, "x", 1): 3, (3, None, 1): 4}
    # attributes change, rows are added before and between, one is gone
    again, known, _ = kept(spark, [(2, "x", 7), (1, "y", 1), (3, None, 1), (0, "n", 1), (2, "a", 1), (None, None, 1)], known)
    assert again == {(2, "x", 7): 3, (1, "y", 1): 2, (3, None, 1): 4, (None, None, 1): 5, (0, "n", 1): 6, (2, "a", 1): 7}
    # what was gone comes back with its key; the map has 1..N
    back, known, keyed = kept(spark, [(None, "z", 9), (9, "q", 1)], known)
    assert back == {(None, "z", 9): 1, (9, "q", 1): 8}
    assert sorted(r.k for r in known.collect()) == list(range(1, 9)) and keyed.columns == ["k", "a", "b", "v"]


def test_rows_that_share_an_identity_keep_the_keys_of_their_places(spark):
    first, known, _ = kept(spark, [(1, "x", 1), (1, "x", 2), (2, "y", 1), (1, "x", 2)])
    assert first[(1, "x", 1)] == 1 and first[(2, "y", 1)] == 4
    df = spark.createDataFrame([(1, "x", 0), (1, "x", 1), (1, "x", 2), (1, "x", 3), (2, "y", 1)], "a int, b string, v int")
    keyed, known = keys.kept_key(df, ["a", "b"], "k", known)
    assert [tuple(r) for r in keyed.orderBy("v", "a").collect()] == [(1, 1, "x", 0), (2, 1, "x", 1), (4, 2, "y", 1), (3, 1, "x", 2), (5, 1, "x", 3)]
    assert sorted(map(tuple, known.collect())) == [(1, "x", 1, 1), (1, "x", 2, 2), (1, "x", 3, 3), (1, "x", 4, 5), (2, "y", 1, 4)]


def test_kept_keys_of_empty_tables(spark):
    got, known, _ = kept(spark, [])
    assert got == {} and known.count() == 0
    got, known, _ = kept(spark, [(1, "x", 1)], known)
    assert got == {(1, "x", 1): 1}
    got, known, _ = kept(spark, [], known)
    assert got == {} and [tuple(r) for r in known.collect()] == [(1, "x", 1, 1)]


def test_kept_keys_of_a_large_identity_are_dense(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id").cast("int")).alias("a"), F.col("id").alias("v"))
    keyed, known = keys.kept_key(df.filter("v < 15000"), ["a"], "k")
    known = materialize(known, "known")
    more, known = keys.kept_key(df, ["a"], "k", known)
    stats = more.agg(F.min("k"), F.max("k"), F.countDistinct("k")).first()
    assert tuple(stats) == (1, 20000, 20000)
    same = keyed.filter("a != 7").join(more, "a").filter(keyed["k"] != more["k"])
    assert same.count() == 0
