"""A key (or a group of copies) holding a third of all rows."""

from pyspark.sql import functions as F

from refinery.operators.keys import dense_key, latest_per_key
from refinery.plans import gold


def executed_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_combines_hot_key_before_shuffle(spark):
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        .alias("k"), F.col("id").alias("v"), (F.col("id") % 97).alias("d"))
    got = latest_per_key(df, ["k"], ["d"], ["v"])
    plan = executed_plan(got)
    exchange_at = plan.index("Exchange hashpartitioning")
    assert "partial_max" in plan[exchange_at:]          # the partial aggregate sits below the shuffle
    hot = got.filter("k = 'HOT'").collect()[0]
    assert (hot.d, hot.v) == (96, max(i for i in range(0, n, 3) if i % 97 == 96))


def test_dense_key_with_a_third_of_rows_as_copies(spark):
    n = 9000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("a"),
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.lit("x")).alias("b"))
    got = dense_key(df, ["a"], "k")
    ks = got.select("k").collect()
    assert sorted(r.k for r in ks) == list(range(1, n + 1))
    copies = got.filter("a = -1").agg(F.min("k"), F.max("k"), F.count("*")).collect()[0]
    assert tuple(copies) == (1, n // 3, n // 3)        # -1 sorts first; copies take consecutive keys


def test_fact_join_splits_a_hot_customer(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 60000
        sales = spark.range(n).select(
            F.concat(F.lit("SO"), F.col("id").cast("string")).alias("order_number"),
            F.concat(F.lit("P"), (F.col("id") % 50).cast("string")).alias("product_number"),
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("customer_id"),
            F.lit(None).cast("date").alias("order_date"), F.lit(None).cast("date").alias("ship_date"),
            F.lit(None).cast("date").alias("due_date"), F.lit(1).alias("sales_amount"),
            F.lit(1).alias("quantity"), F.lit(1.0).alias("price"))
        dim_c = spark.range(5000).select((F.col("id") + 1).alias("customer_key"), F.col("id").alias("customer_id"))
        dim_p = spark.range(50).select((F.col("id") + 1).alias("product_key"),
                                       F.concat(F.lit("P"), F.col("id").cast("string")).alias("product_number"))
        fact = gold.fact_sales(sales, dim_p, dim_c)
        assert len(fact.collect()) == n
        final = fact._jdf.queryExecution().executedPlan().toString()     # AQE's final plan
        assert "SortMergeJoin" in final
        assert "SortMergeJoin(skew=true)" in final and "AQEShuffleRead skewed" in final   # hot key split
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_salted_lookup_spreads_identical_rows(spark):
    from refinery.operators.joins import salted_left_lookup
    left = spark.range(0, 20000, numPartitions=40).select(F.lit(7).alias("k"), F.lit("same").alias("v"))
    right = spark.createDataFrame([(7, "w")], "k int, w string")
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = salted_left_lookup(left, right, "k", salts=16)
        parts = out.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert sum(r["count"] for r in parts) == 20000 and max(r["count"] for r in parts) < 10000
        assert out.filter("w = 'w'").count() == 20000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_salted_lookup_equals_plain_join_and_spreads_a_hot_key(spark):
    from refinery.operators.joins import salted_left_lookup
    n = 40000
    left = spark.range(n).select(
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("k"), F.col("id").alias("v"))
    right = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w")) \
        .unionByName(spark.createDataFrame([(7, -1)], "k long, w long"))         # the hot key has two rows
    plain = left.join(right, "k", "left")
    salted = salted_left_lookup(left, right, "k", salts=8)
    assert sorted(map(tuple, salted.select("k", "v", "w").collect())) == \
        sorted(map(tuple, plain.select("k", "v", "w").collect()))

    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")        # no AQE split: only the salt can balance
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def max_share(df):
            parts = df.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
            return max(r["count"] for r in parts) / sum(r["count"] for r in parts)
        assert max_share(plain) > 0.6                             # the hot key sits in one task
        assert max_share(salted) < 0.4                            # spread over the salts
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_salted_lookup_spreads_a_hot_null_key(spark):
    from refinery.operators.joins import salted_left_lookup
    left = spark.range(30000).select(
        F.when(F.col("id") % 3 != 0, F.lit(None)).otherwise(F.col("id") % 500).cast("long").alias("k"),
        F.col("id").alias("v"))
    right = spark.range(500).select(F.col("id").alias("k"), F.lit("x").alias("w"))
    salted = salted_left_lookup(left, right, "k", salts=8)
    assert salted.count() == 30000 and salted.filter("k IS NULL AND w IS NOT NULL").count() == 0
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = salted.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert max(r["count"] for r in parts) / 30000 < 0.4      # two thirds are NULL keys, yet spread
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
