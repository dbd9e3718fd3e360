"""Tables that are written beside the ones in use: failed writes, layout changes, whole runs."""

import os

import pytest
from pyspark.sql import functions as F

from refinery.plans import gold, layers, quality
from refinery.session import scratch_path
from refinery.sources import files
from refinery.sources.files import Staging
from refinery.sources.fixtures import bronze_inputs


@pytest.fixture
def schema(spark):
    name, root = "t_stage", scratch_path(spark, "staging")
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{root}'")
    yield name, root.removeprefix("file:")
    files.drop_layer_schemas(spark, [name])
    assert not os.path.isdir(root.removeprefix("file:")) or not folders(root.removeprefix("file:"))


def folders(root):
    return sorted(f for f in os.listdir(root) if os.path.isdir(f"{root}/{f}"))


def failing(df):
    return df.withColumn("n", F.when(F.col("n") == 50, F.raise_error(F.lit("stop"))).otherwise(F.col("n")).cast("int"))


def numbers(spark, lo, hi):
    return spark.range(lo, hi).select(F.col("id").cast("int").alias("n"), F.concat(F.lit("v"), F.col("id")).alias("v"))


@pytest.mark.parametrize("layout", [{}, {"bucket_by": "n", "buckets": 2}, {"partition_by": "v"}])
def test_a_failed_write_leaves_the_old_table(spark, schema, layout):
    name, root = schema
    files.write_table(numbers(spark, 0, 5), f"{name}.t", **layout)
    before = folders(root)
    with pytest.raises(Exception, match="stop"):
        files.write_table(failing(numbers(spark, 40, 60)), f"{name}.t", **layout)
    assert sorted(r.n for r in spark.table(f"{name}.t").collect()) == list(range(5))
    assert folders(root) == before
    assert [t.name for t in spark.catalog.listTables(name)] == ["t"]


def test_a_refresh_replaces_rows_and_folder(spark, schema):
    name, root = schema
    for lo in (0, 10, 20):
        files.write_table(numbers(spark, lo, lo + 5), f"`{name}`.`t`")
        assert sorted(r.n for r in spark.table(f"{name}.t").collect()) == list(range(lo, lo + 5))
        assert len(folders(root)) == 1


def test_a_table_can_be_made_from_itself(spark, schema):
    name, _ = schema
    files.write_table(numbers(spark, 0, 5), f"{name}.t")
    files.write_table(spark.table(f"{name}.t").withColumn("n", (F.col("n") + 100).cast("int")), f"{name}.t")
    assert sorted(r.n for r in spark.table(f"{name}.t").collect()) == list(range(100, 105))


def test_layout_and_columns_may_change(spark, schema):
    name, root = schema
    files.write_table(numbers(spark, 0, 5), f"{name}.t")
    files.write_table(numbers(spark, 0, 6).withColumn("more", F.lit(1)), f"{name}.t")
    assert spark.table(f"{name}.t").columns == ["n", "v", "more"]
    files.write_table(numbers(spark, 0, 7), f"{name}.t", bucket_by="n", buckets=4)
    files.write_table(numbers(spark, 0, 8), f"{name}.t", bucket_by="n", buckets=4)
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}.t").collect()}
    assert told["Num Buckets"] == "4" and spark.table(f"{name}.t").count() == 8
    for n in (9, 3):
        files.write_table(numbers(spark, 0, n), f"{name}.t", partition_by="v")
        assert spark.table(f"{name}.t").count() == n and spark.table(f"{name}.t").filter("v = 'v1'").count() == 1
    assert len(folders(root)) == 1 and [t.name for t in spark.catalog.listTables(name)] == ["t"]


def test_a_managed_table_of_before_is_taken_over(spark, schema):
    name, root = schema
    numbers(spark, 0, 3).write.saveAsTable(f"{name}.t")
    assert folders(root) == ["t"]
    files.write_table(numbers(spark, 5, 7), f"{name}.t")
    assert sorted(r.n for r in spark.table(f"{name}.t").collect()) == [5, 6] and len(folders(root)) == 1
    numbers(spark, 0, 3).write.saveAsTable(f"{name}.u")
    files.write_table(numbers(spark, 5, 7).select("n"), f"{name}.u")
    assert sorted(r.n for r in spark.table(f"{name}.u").collect()) == [5, 6] and len(folders(root)) == 2


@pytest.mark.parametrize("at", [1, 2, 3])
def test_a_failed_publish_switches_back(spark, schema, monkeypatch, at):
    """Tables of an equal layout, of another layout, and new ones."""
    name, root = schema
    files.write_table(numbers(spark, 0, 3), f"{name}.same")
    files.write_table(numbers(spark, 0, 3), f"{name}.other")
    before = folders(root)
    switch, done = Staging._switch, []

    def stopping(self, t):
        if len(done) == at:
            raise RuntimeError("catalog gone")
        done.append(t)
        switch(self, t)

    monkeypatch.setattr(Staging, "_switch", stopping)
    with pytest.raises(RuntimeError, match="catalog gone"), Staging(spark) as stage:
        stage.write(numbers(spark, 10, 12), f"{name}.same")
        stage.write(numbers(spark, 10, 12).select("n"), f"{name}.other")
        stage.write(numbers(spark, 10, 12), f"{name}.new")
        stage.write(numbers(spark, 10, 12), f"{name}.never")
        assert stage.read(f"{name}.same").count() == 2 and spark.table(f"{name}.same").count() == 3
        stage.publish()
    for t in ("same", "other"):
        assert sorted(map(tuple, spark.table(f"{name}.{t}").collect())) == [(i, f"v{i}") for i in range(3)]
    assert folders(root) == before and sorted(t.name for t in spark.catalog.listTables(name)) == ["other", "same"]


def test_leaving_without_publish_changes_nothing(spark, schema):
    name, root = schema
    with Staging(spark) as stage:
        stage.write(numbers(spark, 0, 3), f"{name}.t")
        with pytest.raises(ValueError, match="already staged"):
            stage.write(numbers(spark, 0, 3), f"{name}.t")
    assert folders(root) == [] and not spark.catalog.tableExists(f"{name}.t")


@pytest.mark.parametrize("layout", [{}, {"bucket_by": "n", "buckets": 3}, {"partition_by": "v"}])
def test_sums_taken_while_writing(spark, schema, layout):
    name, _ = schema
    sums = {"rows": F.count(F.lit(1)), "odd": F.count_if(F.col("n") % 2 == 1), "total": F.sum("n")}
    with Staging(spark) as stage:
        stage.write(numbers(spark, 0, 101).repartition(7), f"{name}.t", measures=sums, **layout)
        stage.write(numbers(spark, 0, 0), f"{name}.none", measures={"rows": F.count(F.lit(1))}, **layout)
        assert {n: v for (t, n), v in stage.measured.items() if t == f"{name}.t"} == {"rows": 101, "odd": 50, "total": 5050}
        assert stage.measured.get((f"{name}.none", "rows"), 0) == 0
        stage.publish()


# --- whole runs -------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def landing(spark, sf_small):
    root = scratch_path(spark, "staging-landing")
    files.land_sources(bronze_inputs(spark, sf_small), root)
    return root


@pytest.fixture
def names(spark):
    names = layers.Layers.with_prefix("st_")
    yield names
    files.drop_layer_schemas(spark, [names.bronze, names.silver, names.gold])


def state(spark, names, root):
    """Rows of every table as a multiset hash, and the folders there are."""
    sums = {}
    for t in layers.table_names():
        df = spark.table(names.table(*t.split(".")))
        sums[t] = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
    return sums, sorted(f for d in os.listdir(root) for f in os.listdir(f"{root}/{d}"))


@pytest.mark.parametrize("broken", ["fact_sales", "dim_products"])
def test_a_run_that_fails_in_gold_leaves_all_layers(spark, landing, names, tmp_path, monkeypatch, broken):
    other = scratch_path(spark, "staging-landing-2")
    files.land_sources({k: df.limit(50) if k != "f_px_cat" else df for k, df in bronze_inputs(spark, "/root/testdata/sf0.001").items()}, other)
    root = str(tmp_path / "wh")
    layers.build(spark, other, names, root, "2024-01-01")
    before = state(spark, names, root)

    def stop(*a, **k):
        raise RuntimeError("gold is broken")

    with monkeypatch.context() as m:
        m.setattr(gold, broken, stop)
        with pytest.raises(RuntimeError, match="gold is broken"):
            layers.run_all(spark, landing, names, root, "2024-01-01")
    assert state(spark, names, root) == before
    layers.run_all(spark, landing, names, root, "2024-01-01")
    after = state(spark, names, root)
    assert all(after[0][t] != before[0][t] for t in before[0] if "category" not in t and "px_cat" not in t)
    assert len(after[1]) == len(before[1])


def test_a_run_with_failed_checks_is_not_published(spark, landing, names, tmp_path):
    root = str(tmp_path / "wh")
    with pytest.raises(layers.ChecksFailed, match="quantity positive") as stopped:
        layers.run_all(spark, landing, names, root, "2024-01-01", only_if_passed=True)
    assert stopped.value.report.filter("status = 'fail'").count() == 1
    assert not spark.catalog.listTables(names.gold) and not spark.catalog.listTables(names.bronze)
    lenient = [c for c in quality.CHECKS if c.check_id != 21]
    rows = layers.run_all(spark, landing, names, root, "2024-01-01", lenient, only_if_passed=True).collect()
    assert len(rows) == 29 and spark.table(names.table("gold", "fact_sales")).count() > 0


def test_the_run_counts_while_it_writes(spark, landing, names, tmp_path):
    """With the counts of the writes the report reads only tables with key
    checks: fact and customer dimension twice, the others once."""
    known = layers.build(spark, landing, names, str(tmp_path / "wh"), "2024-01-01")
    told, read = layers.report(spark, names, known=known), layers.report(spark, names)
    count = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("parquet")
    assert (count(told), count(read)) == (8, 16)
    assert sorted(map(tuple, told.collect())) == sorted(map(tuple, read.collect()))


def test_the_steps_alone_give_the_same_tables(spark, landing, names, tmp_path):
    root = str(tmp_path / "wh")
    layers.build(spark, landing, names, root, "2024-01-01")
    whole = state(spark, names, root)
    layers.run_bronze(spark, landing, names)
    layers.run_silver(spark, names, "2024-01-01")
    layers.run_gold(spark, names)
    assert state(spark, names, root)[0] == whole[0]


def test_a_refresh_can_keep_the_keys(spark, landing, tmp_path):
    """The second landing has the first one's rows and more; known rows keep
    their keys, new ones follow, and the fact uses them."""
    few = scratch_path(spark, "staging-landing-few")
    cut = {"f_cust_info": "cst_id % 3 <> 0", "f_prd_info": "prd_id % 2 = 0"}
    files.land_sources({k: df.filter(cut[k]) if k in cut else df for k, df in bronze_inputs(spark, "/root/testdata/sf0.001").items()}, few)
    plain, keeping = layers.Layers.with_prefix("kn_"), layers.Layers.with_prefix("kk_", keep_keys=True)
    keyed = lambda n, t, k: {tuple(r)[1:]: r[k] for r in spark.table(n.table("gold", t)).collect()}
    dims = [("dim_customers", "customer_key"), ("dim_products", "product_key")]
    try:
        layers.build(spark, few, plain, str(tmp_path / "p"), "2024-01-01")
        layers.build(spark, few, keeping, str(tmp_path / "k"), "2024-01-01")
        first = {d: keyed(keeping, d, k) for d, k in dims}
        assert first == {d: keyed(plain, d, k) for d, k in dims}            # the first run numbers as without the option
        layers.build(spark, landing, plain, str(tmp_path / "p"), "2024-01-01")
        layers.build(spark, landing, keeping, str(tmp_path / "k"), "2024-01-01")
        for d, k in dims:
            now, anew = keyed(keeping, d, k), keyed(plain, d, k)
            assert set(now) == set(anew) and set(first[d]) < set(now)
            assert {r: now[r] for r in first[d]} == first[d] != {r: anew[r] for r in first[d]}
            assert sorted(now.values()) == sorted(anew.values())            # 1..N
        fact = [r[0] for r in spark.table(keeping.table("gold", "fact_sales")).select("product_key").distinct().collect() if r[0]]
        assert set(fact) <= set(keyed(keeping, "dim_products", "product_key").values())
    finally:
        for n in (plain, keeping):
            files.drop_layer_schemas(spark, [n.bronze, n.silver, n.gold])
