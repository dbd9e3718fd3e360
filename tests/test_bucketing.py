"""Bucketed sales and customer tables: the fact's customer join needs no shuffle."""

from pyspark.sql import functions as F

from refinery.plans import gold, layers
from refinery.session import scratch_path
from refinery.sources import files, schemas
from refinery.sources.fixtures import fixture


def test_customer_lookup_on_bucketed_tables_has_no_exchange(spark, sf_small):
    landing = scratch_path(spark, "test-bucket-landing")
    files.land_sources({s.fixture: fixture(spark, sf_small, s.fixture) for s in schemas.SOURCES}, landing)
    names = layers.Layers.with_prefix("bk_", customer_buckets=4)
    layers.run_all(spark, landing, names, scratch_path(spark, "test-bucket-wh"), "2024-01-01").collect()

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")       # a customer table too big to broadcast
    try:
        sales = spark.table(names.table("silver", "crm_sales"))
        dim_p = F.broadcast(spark.table(names.table("gold", "dim_products")))   # products stay broadcast
        dim_c = spark.table(names.table("gold", "dim_customers"))
        fact = gold.fact_sales(sales, dim_p, dim_c)
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan
        assert "Exchange hashpartitioning(customer_id" not in plan
        assert fact.count() == spark.table(names.table("gold", "fact_sales")).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        files.drop_layer_schemas(spark, prefix="bk_")


def test_bucketing_is_written_as_asked(spark, sf_small):
    landing = scratch_path(spark, "test-hot-landing")
    inputs = {s.fixture: fixture(spark, sf_small, s.fixture) for s in schemas.SOURCES}
    inputs["f_sales"] = inputs["f_sales"].withColumn("sls_cust_id", F.lit(7).cast("long"))     # one customer holds all sales
    files.land_sources(inputs, landing)
    names = layers.Layers.with_prefix("hot_", customer_buckets=2)
    layers.run_all(spark, landing, names, scratch_path(spark, "test-hot-wh"), "2024-01-01").collect()
    detail = {r[0]: r[1] for r in spark.sql("DESCRIBE TABLE EXTENDED hot_silver.crm_sales").collect()}
    assert detail["Num Buckets"] == "2"
    files.drop_layer_schemas(spark, prefix="hot_")


def test_top_key_share(spark):
    from refinery.operators.aggregates import top_key_share
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "k int")
    row = top_key_share(df, "k").collect()[0]
    assert (row.top_key, row.top_rows, row.total_rows, row.share) == (1, 3, 6, 0.5)


def test_fact_partitioned_by_month_prunes_on_date_filters(spark, sf_small):
    import datetime as dt
    landing = scratch_path(spark, "test-month-landing")
    files.land_sources({s.fixture: fixture(spark, sf_small, s.fixture) for s in schemas.SOURCES}, landing)
    names = layers.Layers.with_prefix("pm_", fact_by_month=True)
    report = {r.check_id: r for r in
              layers.run_all(spark, landing, names, scratch_path(spark, "test-month-wh"), "2024-01-01").collect()}
    fact = spark.table(names.table("gold", "fact_sales"))
    assert report[3].value == fact.count() > 0
    one_month = fact.filter(F.col("order_month") == F.lit(dt.date(1995, 3, 1)))
    plan = one_month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan
    assert one_month.count() == fact.filter("order_date >= DATE '1995-03-01' AND order_date < DATE '1995-04-01'").count()
    files.drop_layer_schemas(spark, prefix="pm_")


def test_layer_run_with_salted_customer_join_writes_the_same_fact(spark, sf_small):
    landing = scratch_path(spark, "test-salt-landing")
    files.land_sources({s.fixture: fixture(spark, sf_small, s.fixture) for s in schemas.SOURCES}, landing)
    plain, salted = layers.Layers.with_prefix("sp_"), layers.Layers.with_prefix("ss_", salt_customers=4)
    for names in (plain, salted):
        layers.run_all(spark, landing, names, scratch_path(spark, "test-salt-wh"), "2024-01-01").collect()
    a = spark.table(plain.table("gold", "fact_sales"))
    b = spark.table(salted.table("gold", "fact_sales"))
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    files.drop_layer_schemas(spark, prefix="sp_")
    files.drop_layer_schemas(spark, prefix="ss_")
