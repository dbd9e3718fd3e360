"""Ingest, table writes, layer DDL."""

import pytest
from pyspark.sql import functions as F

from refinery.operators.frames import rename_strict
from refinery.session import scratch_path
from refinery.sources import files, schemas
from refinery.sources.fixtures import fixture


def test_csv_round_trip_keeps_padding_and_nulls(spark, sf_small):
    """Padding survives the landing round trip.  CSV cannot tell an empty
    string from a missing value: both read back as NULL (the raw extracts
    have only unquoted empty fields, and every cleaning rule maps '' and
    NULL alike)."""
    src = fixture(spark, sf_small, "f_cust_info")
    root = scratch_path(spark, "test-landing")
    files.write_csv(src, f"{root}/cust")
    back = files.ingest_csv(spark, f"{root}/cust", schemas.CUST_INFO)
    expected = src.select([F.when(F.col(c) == "", None).otherwise(F.col(c)).alias(c) if t == "string"
                           else F.col(c) for c, t in src.dtypes])
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)
    assert back.filter(F.col("cst_firstname").startswith("  ")).count() == src.count()


def test_strings_first_ingest_nulls_bad_numbers(spark):
    root = scratch_path(spark, "test-bad")
    raw = spark.createDataFrame([("SO1", "P1", "12", "20200101", "20200102", "20200103", "10", "1", "10"),
                                 ("SO2", "P2", "x", "2020/01/01", "", "0", "1e3", "-", "7")],
                                ", ".join(f"{f.name} string" for f in schemas.SALES_DETAILS.fields))
    files.write_csv(raw, f"{root}/sales")
    got = {r.sls_ord_num: r for r in files.ingest_csv_strings(spark, f"{root}/sales", schemas.SALES_DETAILS).collect()}
    assert got["SO1"].sls_cust_id == 12 and got["SO1"].sls_order_dt == 20200101
    assert got["SO2"].sls_cust_id is None and got["SO2"].sls_order_dt is None
    assert got["SO2"].sls_quantity is None and got["SO2"].sls_price == 7


def test_rename_strict_raises_on_missing_column(spark):
    df = spark.createDataFrame([(1, "a")], "ID int, cat string")
    assert rename_strict(df, {"id": "category_id", "CAT": "category"}).columns == ["category_id", "category"]
    with pytest.raises(KeyError):
        rename_strict(df, {"subcat": "subcategory"})


def test_layer_ddl_and_dry_run(spark):
    root = scratch_path(spark, "test-layers")
    made = files.create_layer_schemas(spark, root, prefix="t_")
    assert made == ["t_bronze", "t_silver", "t_gold"]
    names = {r[0] for r in spark.sql("SHOW SCHEMAS").collect()}
    assert {"t_bronze", "t_silver", "t_gold"} <= names
    stmts = files.drop_layer_schemas(spark, dry_run=True, prefix="t_")
    assert stmts[0] == "DROP SCHEMA IF EXISTS `t_bronze` CASCADE"
    assert {"t_bronze"} <= {r[0] for r in spark.sql("SHOW SCHEMAS").collect()}   # dry run drops nothing
    files.drop_layer_schemas(spark, prefix="t_")
    assert not ({"t_bronze", "t_silver", "t_gold"} & {r[0] for r in spark.sql("SHOW SCHEMAS").collect()})


def test_overwrite_is_idempotent(spark, sf_small):
    root = scratch_path(spark, "test-tables")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS t_io LOCATION '{root}'")
    src = fixture(spark, sf_small, "f_px_cat")
    files.write_table(src, "t_io.cat")
    files.write_table(src, "t_io.cat")
    assert spark.table("t_io.cat").count() == src.count()
    files.drop_layer_schemas(spark, ["t_io"])


def test_landing_listing_has_files_without_rows(spark, sf_small):
    root = scratch_path(spark, "test-list")
    cats = fixture(spark, sf_small, "f_px_cat")
    files.write_csv(cats.coalesce(1), f"{root}/source_erp/PX_CAT_G1V2")
    files.write_csv(cats.limit(0).coalesce(1), f"{root}/source_erp/EMPTY")
    listing = files.landing_files(spark, root).collect()
    assert len(listing) == 2 and all(r.file_name.endswith(".csv") and r.file_size > 0 for r in listing)
    assert "content" not in files.landing_files(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.rows for r in files.landing_rows(spark, root).collect()) == [0, cats.count()]


CSV = {"plain": "cid,bdate,gen\nA,1980-01-01,F\n", "reordered": "gen,cid,bdate\nF,A,1980-01-01\n",
       "upper": "CID,BDATE,GEN\nA,1980-01-01,F\n"}


@pytest.mark.parametrize("read", [files.ingest_csv, files.ingest_csv_strings])
def test_columns_are_taken_by_header_name(spark, tmp_path, read):
    for name, text in CSV.items():
        (tmp_path / f"{name}.csv").write_text(text)
        got = read(spark, str(tmp_path / f"{name}.csv"), schemas.CUST_AZ12)
        assert got.schema == schemas.CUST_AZ12
        assert [(r.cid, str(r.bdate), r.gen) for r in got.collect()] == [("A", "1980-01-01", "F")], name


@pytest.mark.parametrize("read", [files.ingest_csv, files.ingest_csv_strings])
@pytest.mark.parametrize("header", ["cid,birthday,gen", "cid,bdate", "cid,bdate,gen,more", "cid,bdate,bdate"])
def test_another_header_is_refused(spark, tmp_path, read, header):
    (tmp_path / "x.csv").write_text(header + "\n" + ",".join("A" for _ in header.split(",")) + "\n")
    with pytest.raises(ValueError, match="expected columns"):
        read(spark, str(tmp_path / "x.csv"), schemas.CUST_AZ12)


def test_files_of_a_folder_must_agree(spark, tmp_path):
    for name in ("plain", "reordered"):
        (tmp_path / f"{name}.csv").write_text(CSV[name] * 1)
    with pytest.raises(Exception, match="(?i)header"):
        files.ingest_csv_strings(spark, str(tmp_path), schemas.CUST_AZ12).collect()


def test_bad_values_fail_or_are_kept(spark, tmp_path):
    (tmp_path / "x.csv").write_text("cid,bdate,gen\nA,1980-01-01,F\nB,soon,M\nC,,\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.ingest_csv(spark, str(tmp_path / "x.csv"), schemas.CUST_AZ12).collect()
    got = files.ingest_csv_strings(spark, str(tmp_path / "x.csv"), schemas.CUST_AZ12, keep_rejected=True)
    kept = {r.cid: [tuple(x) for x in r["_rejected"]] for r in got.collect()}
    assert kept == {"A": [], "B": [("bdate", "soon")], "C": []}
    assert [tuple(r) for r in files.rejected_values([got]).collect()] == [("bdate", "soon", 1)]


def test_stream_that_does_not_finish_raises_and_stops(spark, sf_small):
    from refinery.streaming import run_incremental
    spec = schemas.SOURCE_BY_TABLE["erp_px_cat_g1v2"]
    root, out = scratch_path(spark, "test-slow"), scratch_path(spark, "test-slow-out")
    files.write_csv(fixture(spark, sf_small, "f_px_cat"), f"{root}/{spec.path}")
    with pytest.raises(TimeoutError):
        run_incremental(spark, spec, root, f"{out}/t", f"{out}/_ck", timeout_s=0.001)
    assert not spark.streams.active


def test_scratch_scope_and_discard_leave_nothing(spark):
    import os
    from refinery.session import checkpoint_dir, discard, materialize, scratch_scope
    base = checkpoint_dir(spark).removeprefix("file:") + "/refinery-scratch"
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    with scratch_scope(spark):
        copy = materialize(spark.range(5), "scoped")
        assert copy.count() == 5 and len(set(os.listdir(base)) - before) == 1
        other = materialize(spark.range(3), "discarded")
        discard(other)
        assert len(set(os.listdir(base)) - before) == 1
    assert set(os.listdir(base)) == before


@pytest.mark.parametrize("name", ["table_overwrite", "ingest_catalog", "layer_run"])
def test_queries_leave_no_database(spark, sf_small, name):
    from refinery.plans import catalog
    before = {r[0] for r in spark.sql("SHOW SCHEMAS").collect()}
    assert catalog.QUERIES[name](spark, sf_small).count() > 0
    assert {r[0] for r in spark.sql("SHOW SCHEMAS").collect()} == before


def test_checkpoint_dir_is_shared_setting(spark):
    from refinery.session import checkpoint_dir
    assert checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()
    assert F is not None


def test_incremental_load_takes_each_file_once(spark, sf_small):
    from refinery.plans import silver
    from refinery.streaming import run_incremental
    spec = schemas.SOURCE_BY_TABLE["crm_sales_details"]
    sales = fixture(spark, sf_small, "f_sales")
    first, second = sales.filter("sls_cust_id % 2 = 0"), sales.filter("sls_cust_id % 2 = 1")
    root = scratch_path(spark, "test-stream")
    out = scratch_path(spark, "test-stream-out")
    files.write_csv(first, f"{root}/{spec.path}/batch=1")
    a = run_incremental(spark, spec, root, f"{out}/t", f"{out}/_ck", silver.silver_sales).count()
    assert a == first.count()
    files.write_csv(second, f"{root}/{spec.path}/batch=2")
    b = run_incremental(spark, spec, root, f"{out}/t", f"{out}/_ck", silver.silver_sales).count()
    assert b == sales.count()                      # new files only; nothing loaded twice
    c = run_incremental(spark, spec, root, f"{out}/t", f"{out}/_ck", silver.silver_sales).count()
    assert c == b                                  # a run with nothing new adds nothing


def test_layer_rerun_is_idempotent(spark, sf_small):
    from refinery.plans import layers
    root = scratch_path(spark, "test-layer-landing")
    files.land_sources({s.fixture: fixture(spark, sf_small, s.fixture) for s in schemas.SOURCES}, root)
    names = layers.Layers.with_prefix("rr_")
    warehouse = scratch_path(spark, "test-layer-wh")
    first = sorted(map(tuple, layers.run_all(spark, root, names, warehouse, "2024-01-01").collect()))
    again = sorted(map(tuple, layers.run_all(spark, root, names, warehouse, "2024-01-01").collect()))
    assert first == again
    assert spark.table("rr_gold.fact_sales").count() == dict((r[0], r[3]) for r in first)[3]
    files.drop_layer_schemas(spark, prefix="rr_")


def test_use_layer_sets_current_schema(spark):
    root = scratch_path(spark, "test-use")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS t_use LOCATION '{root}'")
    before = spark.catalog.currentDatabase()
    files.use_layer(spark, "t_use")
    assert spark.catalog.currentDatabase() == "t_use"
    files.use_layer(spark, before)
    files.drop_layer_schemas(spark, ["t_use"])


def test_inferred_types_of_the_product_extract(spark):
    import os
    path = os.path.join(os.environ.get("REFINERY_SOURCE_EXTRACTS", ""), "engineering/source_crm/prd_info.csv")
    if not os.environ.get("REFINERY_SOURCE_EXTRACTS") or not os.path.exists(path):
        pytest.skip("REFINERY_SOURCE_EXTRACTS not set")
    df = files.read_csv(spark, path, infer=True)
    assert [t for _, t in df.dtypes] == ["int", "string", "string", "int", "string", "date", "date"]
    assert df.filter("prd_cost IS NULL").count() == 2


def test_incremental_load_of_all_extracts_matches_batch_silver(spark, sf_small):
    from refinery.plans import silver
    from refinery.streaming import run_incremental_all
    landing = scratch_path(spark, "test-stream-all")
    inputs = {s.fixture: fixture(spark, sf_small, s.fixture) for s in schemas.SOURCES}
    files.land_sources(inputs, landing)
    out = run_incremental_all(spark, landing, scratch_path(spark, "test-stream-all-out"), as_of="2024-01-01")
    assert set(out) == set(silver.SILVER_JOBS)
    for target, (source, job) in silver.SILVER_JOBS.items():
        spec = schemas.SOURCE_BY_TABLE[source]
        batch_in = files.ingest_csv(spark, f"{landing}/{spec.path}", spec.schema)
        batch = job(batch_in, "2024-01-01") if job is silver.silver_erp_customers else job(batch_in)
        streamed = spark.read.parquet(out[target])
        assert sorted(map(tuple, streamed.collect()), key=str) == sorted(map(tuple, batch.collect()), key=str), target


def test_concurrently_keeps_order_and_raises_first_failure():
    import time as _t

    from refinery.session import concurrently
    assert concurrently(lambda: (_t.sleep(0.2), 1)[1], lambda: 2, lambda: 3) == [1, 2, 3]
    assert concurrently() == [] and concurrently(lambda: 5) == [5]

    def boom():
        raise ValueError("bad step")
    with pytest.raises(ValueError, match="bad step"):
        concurrently(lambda: 1, boom)


def test_concurrently_threads_inherit_the_job_group(spark):
    from refinery.session import concurrently
    sc = spark.sparkContext
    sc.setJobGroup("refinery-test-group", "inherit check")
    try:
        seen = concurrently(lambda: sc.getLocalProperty("spark.jobGroup.id"),
                            lambda: sc.getLocalProperty("spark.jobGroup.id"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)
    assert seen == ["refinery-test-group", "refinery-test-group"]


def test_rejected_list_is_built_only_for_rows_with_bad_values(spark, tmp_path):
    from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructField, StructType
    schema = StructType([StructField("a", LongType()), StructField("b", IntegerType()), StructField("c", DateType()), StructField("d", StringType())])
    (tmp_path / "a.csv").write_text('a,b,c,d\n1,2,2020-01-01,x\n,"  ",,\n1x,3,2020-13-01,y\n5,9999999999,,z\n')
    df = files.ingest_csv_strings(spark, str(tmp_path), schema, keep_rejected=True)
    got = {r.d: [tuple(v) for v in r[files.REJECTED]] for r in df.collect()}
    assert got == {"x": [], None: [], "y": [("a", "1x"), ("c", "2020-13-01")], "z": [("b", "9999999999")]}
    assert df.select(files.REJECTED)._jdf.queryExecution().optimizedPlan().toString().split("[", 1)[1].startswith("CASE WHEN")
