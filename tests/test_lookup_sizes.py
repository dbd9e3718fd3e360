"""What the planner knows of a lookup side, and the order of the fact's lookups."""

import datetime as dt

from pyspark.sql import functions as F

from refinery.operators.joins import salted_left_lookup
from refinery.operators.keys import dense_key
from refinery.plans import gold


def planned_bytes(df):
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def joins_of(df):
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [line.strip() for line in text.splitlines() if "Join" in line]


def dims(spark, n=2000):
    dim_c = dense_key(spark.range(n).select((F.col("id") % (n - 3)).alias("customer_id"), F.repeat(F.lit("x"), 90).alias("name")), ["customer_id"], "customer_key")
    dim_p = dense_key(spark.range(300).select(F.concat(F.lit("P"), (F.col("id") % 100).cast("string")).alias("product_number"), "id"),
                      ["product_number"], "product_key")
    return dim_c, dim_p


def sales_of(spark, n=5000):
    day = F.lit(dt.date(2020, 1, 1))
    return spark.range(n).select(
        F.concat(F.lit("SO"), F.col("id").cast("string")).alias("order_number"), F.concat(F.lit("P"), (F.col("id") % 101).cast("string")).alias("product_number"),
        F.when(F.col("id") % 7 > 0, F.col("id") % 2001).alias("customer_id"), day.alias("order_date"), day.alias("ship_date"), day.alias("due_date"),
        F.lit(1).alias("sales_amount"), F.lit(1).alias("quantity"), F.lit(1.0).alias("price"))


def test_keyed_rows_are_sized_like_the_rows(spark):
    rows = spark.range(20000).select("id", F.repeat(F.lit("x"), 40).alias("name"))
    keyed = dense_key(rows, ["id"], "key")
    assert planned_bytes(keyed.select("id", "key")) < 1 << 20                 # as written, under a MB
    assert keyed.agg(F.count_distinct("key"), F.min("key"), F.max("key")).first() == (20000, 1, 20000)


def test_salted_lookup_broadcasts_a_small_side(spark):
    left = spark.range(4000).select((F.col("id") % 50).alias("k"), "id")
    dim_c, _ = dims(spark)
    small = dim_c.select(F.col("customer_id").alias("k"), F.col("customer_key").alias("w"))
    out = salted_left_lookup(left, small, "k", salts=4, min_share=0.01)
    (last, *_) = joins_of(out)
    assert "BroadcastHashJoin" in last and "__salt" in last
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, left.join(small, "k", "left").collect()))


def test_versions_multiply_the_lines_after_every_other_lookup(spark):
    dim_c, dim_p = dims(spark)
    sales = sales_of(spark)
    want = sorted(map(tuple, sales.join(dim_p.select("product_number", "product_key"), "product_number", "left")
                      .join(dim_c.select("customer_id", "customer_key"), "customer_id", "left").select(*gold.FACT_COLUMNS).collect()), key=str)
    for salts in (None, 4):
        fact = gold.fact_sales(sales, dim_p, dim_c, salt_customers=salts, salt_min_share=0.001 if salts else None)
        assert "product_number" in joins_of(fact)[0]
        assert sorted(map(tuple, fact.collect()), key=str) == want
