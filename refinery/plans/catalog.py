"""Registered queries: one per operator / job, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the whole test tables of ``sf_dir`` (through the dirty
projections of ``sources.fixtures``), so its work grows with the scale
factor.  ``ORACLE`` holds the DuckDB statement of each query that SQL can
express.  Queries that write (ingest, dimensions, facts, report, layer order) do
so while they are called, to fresh folders under the shared checkpoint
directory, and return a frame that reads the result.  Databases they create are
dropped again.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.functions import codes, dates, values
from refinery.operators import aggregates, frames, joins, keys
from refinery.plans import gold, layers, quality, silver
from refinery.plans.checks import Check, Compare, Count, Reference, Rows, Share, Total, Unique
from refinery.plans.checks import Query as Sql
from refinery.plans.checks import report as check_report
from refinery.plans.oracle_sql import dq_report_sql, with_ctes
from refinery.session import concurrently, discard, materialize, release_shuffles, remove_folder, scratch_path
from refinery.sources import files, inference, schemas
from refinery.sources.fixtures import base_table, fixture
from refinery.streaming import run_incremental

AS_OF = _dt.date(2024, 1, 1)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return wrap


# ---- layer helpers ---------------------------------------------------------

def s_customers(spark, sf):
    return silver.silver_customers(fixture(spark, sf, "f_cust_info"))


def s_products(spark, sf):
    return silver.silver_products(fixture(spark, sf, "f_prd_info"))


def s_sales(spark, sf):
    return silver.silver_sales(fixture(spark, sf, "f_sales"))


def s_erp_customers(spark, sf):
    return silver.silver_erp_customers(fixture(spark, sf, "f_cust_az12"), AS_OF)


def s_locations(spark, sf):
    return silver.silver_locations(fixture(spark, sf, "f_loc_a101"))


def s_categories(spark, sf):
    return silver.silver_categories(fixture(spark, sf, "f_px_cat"))


def d_customers(spark, sf):
    return gold.dim_customers(s_customers(spark, sf), s_erp_customers(spark, sf), s_locations(spark, sf))


def d_products(spark, sf):
    return gold.dim_products(s_products(spark, sf), s_categories(spark, sf))


# ---- projections and predicates -------------------------------------------

@register("trim_all_strings", with_ctes("""
SELECT cst_id, trim(cst_key) AS cst_key, trim(cst_firstname) AS cst_firstname, trim(cst_lastname) AS cst_lastname,
  trim(cst_marital_status) AS cst_marital_status, trim(cst_gndr) AS cst_gndr, cst_create_date FROM f_cust_info""",
                                          "f_cust_info"))
def q_trim_all_strings(spark, sf):
    return frames.trim_all_strings(fixture(spark, sf, "f_cust_info"))


@register("rename_columns", with_ctes("""
SELECT cst_id AS customer_id, cst_key AS customer_number, cst_firstname AS first_name, cst_lastname AS last_name,
  cst_marital_status AS marital_status, cst_gndr AS gender, cst_create_date AS created_date FROM f_cust_info""",
                                      "f_cust_info"))
def q_rename_columns(spark, sf):
    return frames.rename_strict(fixture(spark, sf, "f_cust_info"), schemas.RENAME_CUSTOMERS)


@register("filter_not_null_key", with_ctes("SELECT * FROM f_cust_info WHERE cst_id IS NOT NULL", "f_cust_info"))
def q_filter_not_null_key(spark, sf):
    return frames.filter_not_null(fixture(spark, sf, "f_cust_info"), "cst_id")


@register("filter_current_rows", with_ctes("SELECT * FROM s_products WHERE end_date IS NULL", "s_products"))
def q_filter_current_rows(spark, sf):
    return frames.filter_current_rows(s_products(spark, sf), "end_date")


@register("pred_compare", with_ctes("""
SELECT sls_ord_num, sls_price, sls_price <= 0 AS price_le_0, sls_price > 0 AS price_gt_0,
  sls_quantity <> 0 AS qty_ne_0, sls_quantity = 0 AS qty_eq_0, sls_sales < 0 AS sales_lt_0,
  sls_order_dt = 0 AS order_dt_zero FROM f_sales""", "f_sales"))
def q_pred_compare(spark, sf):
    s = fixture(spark, sf, "f_sales")
    return s.select("sls_ord_num", "sls_price",
                    (F.col("sls_price") <= 0).alias("price_le_0"), (F.col("sls_price") > 0).alias("price_gt_0"),
                    (F.col("sls_quantity") != 0).alias("qty_ne_0"), (F.col("sls_quantity") == 0).alias("qty_eq_0"),
                    (F.col("sls_sales") < 0).alias("sales_lt_0"), (F.col("sls_order_dt") == 0).alias("order_dt_zero"))


@register("pred_not_in", with_ctes("""
SELECT cst_key, cst_gndr FROM f_cust_info WHERE upper(trim(cst_gndr)) NOT IN ('F', 'M')""", "f_cust_info"))
def q_pred_not_in(spark, sf):
    c = fixture(spark, sf, "f_cust_info")
    return c.filter(~codes.code_key("cst_gndr").isin("F", "M")).select("cst_key", "cst_gndr")


@register("pred_null_or_empty", with_ctes("""
SELECT cid, cntry FROM f_loc_a101 WHERE cntry IS NULL OR cntry = ''""", "f_loc_a101"))
def q_pred_null_or_empty(spark, sf):
    return fixture(spark, sf, "f_loc_a101").filter(values.null_or_empty("cntry"))


@register("pred_or_and", with_ctes("""
SELECT sls_ord_num, sls_price, sls_quantity FROM f_sales
WHERE (sls_price IS NULL OR sls_price <= 0) AND sls_quantity <> 0""", "f_sales"))
def q_pred_or_and(spark, sf):
    s = fixture(spark, sf, "f_sales")
    p = F.col("sls_price")
    return s.filter((p.isNull() | (p <= 0)) & (F.col("sls_quantity") != 0)) \
        .select("sls_ord_num", "sls_price", "sls_quantity")


# ---- code normalisation ----------------------------------------------------

_MARITAL_SQL = "CASE upper(trim(cst_marital_status)) WHEN 'S' THEN 'Single' WHEN 'M' THEN 'Married' ELSE 'n/a' END"
_GENDER_CRM_SQL = "CASE upper(trim(cst_gndr)) WHEN 'F' THEN 'Female' WHEN 'M' THEN 'Male' ELSE 'n/a' END"


@register("normalize_codes", with_ctes(f"""
SELECT cst_id, cst_key, {_MARITAL_SQL} AS marital_status, {_GENDER_CRM_SQL} AS gender FROM f_cust_info""",
                                       "f_cust_info"))
def q_normalize_codes(spark, sf):
    c = fixture(spark, sf, "f_cust_info")
    return c.select("cst_id", "cst_key",
                    codes.map_codes("cst_marital_status", codes.MARITAL_STATUS_CODES).alias("marital_status"),
                    codes.map_codes("cst_gndr", codes.GENDER_CODES_CRM).alias("gender"))


@register("normalize_marital_status", with_ctes(f"""
SELECT cst_key, cst_marital_status, {_MARITAL_SQL} AS marital_status FROM f_cust_info""", "f_cust_info"))
def q_normalize_marital_status(spark, sf):
    c = fixture(spark, sf, "f_cust_info")
    return c.select("cst_key", "cst_marital_status",
                    codes.normalize_marital_status("cst_marital_status").alias("marital_status"))


@register("normalize_gender_crm", with_ctes(f"""
SELECT cst_key, cst_gndr, {_GENDER_CRM_SQL} AS gender FROM f_cust_info""", "f_cust_info"))
def q_normalize_gender_crm(spark, sf):
    c = fixture(spark, sf, "f_cust_info")
    return c.select("cst_key", "cst_gndr", codes.normalize_gender_crm("cst_gndr").alias("gender"))


@register("normalize_gender_erp", with_ctes("""
SELECT cid, gen, CASE WHEN upper(trim(gen)) IN ('F', 'FEMALE') THEN 'Female'
  WHEN upper(trim(gen)) IN ('M', 'MALE') THEN 'Male' ELSE 'n/a' END AS gender FROM f_cust_az12""", "f_cust_az12"))
def q_normalize_gender_erp(spark, sf):
    c = fixture(spark, sf, "f_cust_az12")
    return c.select("cid", "gen", codes.normalize_gender_erp("gen").alias("gender"))


@register("normalize_product_line", with_ctes("""
SELECT prd_id, prd_line, CASE upper(trim(prd_line)) WHEN 'M' THEN 'Mountain' WHEN 'R' THEN 'Road'
  WHEN 'S' THEN 'Other Sales' WHEN 'T' THEN 'Touring' ELSE 'n/a' END AS product_line FROM f_prd_info""",
                                              "f_prd_info"))
def q_normalize_product_line(spark, sf):
    p = fixture(spark, sf, "f_prd_info")
    return p.select("prd_id", "prd_line", codes.normalize_product_line("prd_line").alias("product_line"))


@register("normalize_country", with_ctes("""
SELECT cid, cntry, CASE WHEN trim(cntry) = 'DE' THEN 'Germany' WHEN trim(cntry) IN ('US', 'USA') THEN 'United States'
  WHEN trim(cntry) IS NULL OR trim(cntry) = '' THEN 'n/a' ELSE trim(cntry) END AS country FROM f_loc_a101""",
                                         "f_loc_a101"))
def q_normalize_country(spark, sf):
    loc = fixture(spark, sf, "f_loc_a101")
    return loc.select("cid", "cntry", codes.normalize_country("cntry").alias("country"))


@register("flag_to_boolean", with_ctes("""
SELECT id, maintenance, CASE WHEN upper(trim(maintenance)) = 'YES' THEN true
  WHEN upper(trim(maintenance)) = 'NO' THEN false END AS maintenance_flag FROM f_px_cat""", "f_px_cat"))
def q_flag_to_boolean(spark, sf):
    c = fixture(spark, sf, "f_px_cat")
    return c.select("id", "maintenance", codes.flag_to_boolean("maintenance").alias("maintenance_flag"))


@register("merge_gender", with_ctes("""
SELECT ci.customer_number, ci.gender AS crm_gender, ca.gender AS erp_gender,
  CASE WHEN ci.gender <> 'n/a' THEN ci.gender ELSE coalesce(ca.gender, 'n/a') END AS gender
FROM s_customers ci LEFT JOIN s_erp_customers ca ON ci.customer_number = ca.customer_number""",
                                    "s_customers", "s_erp_customers"))
def q_merge_gender(spark, sf):
    ci, ca = s_customers(spark, sf).alias("ci"), s_erp_customers(spark, sf).alias("ca")
    j = ci.join(ca, F.col("ci.customer_number") == F.col("ca.customer_number"), "left")
    return j.select(F.col("ci.customer_number").alias("customer_number"), F.col("ci.gender").alias("crm_gender"),
                    F.col("ca.gender").alias("erp_gender"),
                    codes.merge_gender(F.col("ci.gender"), F.col("ca.gender")).alias("gender"))


# ---- identifiers, dates, measures -----------------------------------------

@register("parse_product_key", with_ctes("""
SELECT prd_id, prd_key, replace(substring(prd_key, 1, 5), '-', '_') AS category_id,
  substring(prd_key, 7) AS product_number FROM f_prd_info""", "f_prd_info"))
def q_parse_product_key(spark, sf):
    p = fixture(spark, sf, "f_prd_info")
    return p.select("prd_id", "prd_key", values.category_id_from_key("prd_key").alias("category_id"),
                    values.product_number_from_key("prd_key").alias("product_number"))


@register("strip_id_prefix", with_ctes("""
SELECT cid, CASE WHEN starts_with(cid, 'NAS') THEN substring(cid, 4) ELSE cid END AS customer_number
FROM f_cust_az12""", "f_cust_az12"))
def q_strip_id_prefix(spark, sf):
    c = fixture(spark, sf, "f_cust_az12")
    return c.select("cid", values.strip_id_prefix("cid").alias("customer_number"))


@register("strip_hyphens", with_ctes("""
SELECT cid, replace(cid, '-', '') AS customer_number FROM f_loc_a101""", "f_loc_a101"))
def q_strip_hyphens(spark, sf):
    loc = fixture(spark, sf, "f_loc_a101")
    return loc.select("cid", values.strip_hyphens("cid").alias("customer_number"))


@register("coalesce_default", with_ctes("""
SELECT prd_id, prd_cost, coalesce(prd_cost, 0) AS product_cost FROM f_prd_info""", "f_prd_info"))
def q_coalesce_default(spark, sf):
    p = fixture(spark, sf, "f_prd_info")
    return p.select("prd_id", "prd_cost", values.coalesce_default("prd_cost", 0).alias("product_cost"))


def _yyyymmdd_sql(c: str) -> str:
    return (f"CASE WHEN {c} = 0 OR length(CAST({c} AS VARCHAR)) <> 8 THEN NULL "
            f"ELSE CAST(try_strptime(CAST({c} AS VARCHAR), '%Y%m%d') AS DATE) END")


@register("parse_yyyymmdd", with_ctes(f"""
SELECT sls_ord_num, sls_order_dt, sls_ship_dt, sls_due_dt, {_yyyymmdd_sql('sls_order_dt')} AS order_date,
  {_yyyymmdd_sql('sls_ship_dt')} AS ship_date, {_yyyymmdd_sql('sls_due_dt')} AS due_date FROM f_sales""", "f_sales"))
def q_parse_yyyymmdd(spark, sf):
    s = fixture(spark, sf, "f_sales")
    return s.select("sls_ord_num", "sls_order_dt", "sls_ship_dt", "sls_due_dt",
                    dates.parse_yyyymmdd("sls_order_dt").alias("order_date"),
                    dates.parse_yyyymmdd("sls_ship_dt").alias("ship_date"),
                    dates.parse_yyyymmdd("sls_due_dt").alias("due_date"))


@register("parse_mdy_date", with_ctes("""
SELECT cid, concat(CAST(month(bdate) AS VARCHAR), '/', CAST(day(bdate) AS VARCHAR), '/', CAST(year(bdate) AS VARCHAR))
  AS bdate_text, bdate AS birth_date FROM f_cust_az12""", "f_cust_az12"))
def q_parse_mdy_date(spark, sf):
    c = fixture(spark, sf, "f_cust_az12")
    text = F.concat_ws("/", F.month("bdate").cast("string"), F.dayofmonth("bdate").cast("string"),
                       F.year("bdate").cast("string"))
    return c.select("cid", text.alias("bdate_text")).select(
        "cid", "bdate_text", dates.parse_mdy_date("bdate_text").alias("birth_date"))


@register("cast_date", with_ctes("""
SELECT prd_id, CAST(prd_start_dt AS VARCHAR) AS start_text, TRY_CAST(CAST(prd_start_dt AS VARCHAR) AS DATE) AS start_date,
  TRY_CAST(concat(CAST(prd_start_dt AS VARCHAR), '?') AS DATE) AS bad_date,
  TRY_CAST(CAST(prd_end_dt AS VARCHAR) AS DATE) AS end_date FROM f_prd_info""", "f_prd_info"))
def q_cast_date(spark, sf):
    p = fixture(spark, sf, "f_prd_info")
    t = p.select("prd_id", F.col("prd_start_dt").cast("string").alias("start_text"),
                 F.col("prd_end_dt").cast("string").alias("end_text"))
    return t.select("prd_id", "start_text", dates.cast_date("start_text").alias("start_date"),
                    dates.cast_date(F.concat(F.col("start_text"), F.lit("?"))).alias("bad_date"),
                    dates.cast_date("end_text").alias("end_date"))


@register("cast_decimal", with_ctes("""
SELECT order_number, price, TRY_CAST(CAST(price AS VARCHAR) AS DECIMAL(10,2)) AS price_dec FROM s_sales""", "s_sales"))
def q_cast_decimal(spark, sf):
    s = s_sales(spark, sf)
    return s.select("order_number", "price", values.cast_decimal("price", 10, 2).alias("price_dec"))


@register("null_future_dates", with_ctes(f"""
SELECT cid, bdate, CASE WHEN bdate > DATE '{AS_OF.isoformat()}' THEN NULL ELSE bdate END AS birth_date
FROM f_cust_az12""", "f_cust_az12"))
def q_null_future_dates(spark, sf):
    c = fixture(spark, sf, "f_cust_az12")
    return c.select("cid", "bdate", dates.null_future_dates("bdate", AS_OF).alias("birth_date"))


@register("repair_price", with_ctes("""
SELECT sls_ord_num, sls_price, sls_sales, sls_quantity,
  CASE WHEN sls_price IS NULL OR sls_price <= 0
    THEN CASE WHEN sls_quantity <> 0 THEN CAST(sls_sales AS DOUBLE) / sls_quantity END
    ELSE CAST(sls_price AS DOUBLE) END AS price FROM f_sales""", "f_sales"))
def q_repair_price(spark, sf):
    s = fixture(spark, sf, "f_sales")
    return s.select("sls_ord_num", "sls_price", "sls_sales", "sls_quantity",
                    values.repair_price("sls_price", "sls_sales", "sls_quantity").alias("price"))


# ---- joins -------------------------------------------------------------------

@register("left_join_chain", with_ctes("""
SELECT ci.customer_id, ci.customer_number, ci.gender AS crm_gender, ca.gender AS erp_gender, ca.birth_date, la.country
FROM s_customers ci LEFT JOIN s_erp_customers ca ON ci.customer_number = ca.customer_number
LEFT JOIN s_locations la ON ci.customer_number = la.customer_number""",
                                       "s_customers", "s_erp_customers", "s_locations"))
def q_left_join_chain(spark, sf):
    ci = s_customers(spark, sf).select("customer_id", "customer_number", F.col("gender").alias("crm_gender"))
    ca = s_erp_customers(spark, sf).select("customer_number", F.col("gender").alias("erp_gender"), "birth_date")
    la = s_locations(spark, sf)
    j = joins.left_lookup(ci, ca, "customer_number", right_cols=["erp_gender", "birth_date"])
    return joins.left_lookup(j, la, "customer_number", right_cols=["country"])


@register("left_join_lookup", with_ctes("""
SELECT pn.product_id, pn.product_number, pn.category_id, pc.category, pc.subcategory, pc.maintenance_flag
FROM s_products pn LEFT JOIN s_categories pc ON pn.category_id = pc.category_id""", "s_products", "s_categories"))
def q_left_join_lookup(spark, sf):
    pn = s_products(spark, sf).select("product_id", "product_number", "category_id")
    return joins.left_lookup(pn, s_categories(spark, sf), "category_id", right_cols=["category", "subcategory", "maintenance_flag"])


@register("left_join_guarded", with_ctes("""
SELECT * FROM (WITH versions AS (SELECT product_number, product_name, product_cost, start_date,
    row_number() OVER (PARTITION BY product_number ORDER BY product_name NULLS FIRST, product_cost NULLS FIRST, start_date NULLS FIRST) AS nth
  FROM s_products WHERE product_number IS NOT NULL),
  counted AS (SELECT product_number, count(*) AS n,
    count(DISTINCT (coalesce(product_name, '-'), coalesce(product_cost, -1), coalesce(start_date, DATE '1-01-01'))) AS kinds
  FROM versions GROUP BY product_number)
SELECT order_number, s.product_number, product_name, product_cost, start_date, coalesce(n, 0) AS matches, coalesce(kinds > 1, false) AS conflict
FROM s_sales s LEFT JOIN versions v ON v.product_number = s.product_number AND nth = 1
LEFT JOIN counted c ON c.product_number = s.product_number)""", "s_sales", "s_products"))
def q_left_join_guarded(spark, sf):
    """Sales lines with their product's attributes, where a product has several
    versions: one row per line all the same, and the conflict is told."""
    sales = s_sales(spark, sf).select("order_number", "product_number")
    return joins.guarded_lookup(sales, s_products(spark, sf), "product_number", right_cols=["product_name", "product_cost", "start_date"])


@register("fact_key_lookup", with_ctes("""
SELECT sd.order_number, sd.product_number, pr.product_key, sd.customer_id
FROM s_sales sd LEFT JOIN dim_products pr ON sd.product_number = pr.product_number""", "s_sales", "dim_products"))
def q_fact_key_lookup(spark, sf):
    return gold.fact_key_lookup(s_sales(spark, sf), d_products(spark, sf))


@register("orphan_anti_join", with_ctes("""
SELECT sd.order_number, sd.customer_id FROM s_sales sd
WHERE sd.customer_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM s_customers c WHERE c.customer_id = sd.customer_id)""",
                                        "s_sales", "s_customers"))
def q_orphan_anti_join(spark, sf):
    sales = s_sales(spark, sf).select("order_number", "customer_id")
    return joins.orphans(sales, s_customers(spark, sf), "customer_id")


# ---- aggregates ----------------------------------------------------------------

_BRONZE = [("crm_cust_info", "f_cust_info"), ("crm_prd_info", "f_prd_info"), ("crm_sales_details", "f_sales"),
           ("erp_cust_az12", "f_cust_az12"), ("erp_loc_a101", "f_loc_a101"), ("erp_px_cat_g1v2", "f_px_cat")]
_COUNTS_SQL = with_ctes("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {f}" for t, f in _BRONZE), *[f for _, f in _BRONZE])


def _count_tables(frames_by_name: dict[str, DataFrame]) -> DataFrame:
    tagged = None
    for name, df in frames_by_name.items():
        part = df.select(F.lit(name).alias("table_name"))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy("table_name").agg(F.count(F.lit(1)).alias("row_count"))


@register("count_rows", _COUNTS_SQL)
def q_count_rows(spark, sf):
    return _count_tables({t: fixture(spark, sf, f) for t, f in _BRONZE})


@register("count_if_multi", with_ctes("""
SELECT count(*) FILTER (WHERE order_number IS NULL) AS order_number_null,
  count(*) FILTER (WHERE sales_amount < 0) AS sales_negative,
  count(*) FILTER (WHERE quantity <= 0) AS quantity_not_positive,
  count(*) FILTER (WHERE price IS NULL) AS price_null,
  count(*) FILTER (WHERE order_date IS NULL) AS order_date_null,
  count(*) FILTER (WHERE due_date IS NULL) AS due_date_null FROM s_sales""", "s_sales"))
def q_count_if_multi(spark, sf):
    s = s_sales(spark, sf)
    return aggregates.count_if_multi(s, {
        "order_number_null": F.col("order_number").isNull(),
        "sales_negative": F.col("sales_amount") < 0,
        "quantity_not_positive": F.col("quantity") <= 0,
        "price_null": F.col("price").isNull(),
        "order_date_null": F.col("order_date").isNull(),
        "due_date_null": F.col("due_date").isNull(),
    })


@register("duplicate_keys", with_ctes("""
SELECT customer_id, count(*) AS n FROM s_customers GROUP BY customer_id HAVING count(*) > 1""", "s_customers"))
def q_duplicate_keys(spark, sf):
    return aggregates.duplicate_keys(s_customers(spark, sf), ["customer_id"])


@register("rowcount_not_greater", with_ctes("""
SELECT (SELECT count(*) FROM s_customers) AS child_rows, (SELECT count(*) FROM f_cust_info) AS parent_rows,
  CASE WHEN (SELECT count(*) FROM s_customers) > (SELECT count(*) FROM f_cust_info) THEN 1 ELSE 0 END AS violation""",
                                            "s_customers"))
def q_rowcount_not_greater(spark, sf):
    return aggregates.rowcount_not_greater(s_customers(spark, sf), fixture(spark, sf, "f_cust_info"))


@register("rowcount_difference", with_ctes("""
SELECT (SELECT count(*) FROM s_sales) AS a_rows, (SELECT count(*) FROM f_sales) AS b_rows,
  abs((SELECT count(*) FROM s_sales) - (SELECT count(*) FROM f_sales)) AS difference""", "s_sales"))
def q_rowcount_difference(spark, sf):
    return aggregates.rowcount_difference(s_sales(spark, sf), fixture(spark, sf, "f_sales"))


@register("coverage_ratio", with_ctes("""
SELECT covered, total, CAST(covered AS DOUBLE) * 100.0 / CAST(nullif(total, 0) AS DOUBLE) AS ratio_pct,
  CASE WHEN CAST(covered AS DOUBLE) * 100.0 / CAST(nullif(total, 0) AS DOUBLE) < 50 THEN 1 ELSE 0 END AS below
FROM (SELECT count(*) FILTER (WHERE country IS NOT NULL AND country <> 'n/a') AS covered, count(*) AS total
      FROM dim_customers)""", "dim_customers"))
def q_coverage_ratio(spark, sf):
    d = gold.customer_attributes(s_customers(spark, sf), s_erp_customers(spark, sf), s_locations(spark, sf))
    return aggregates.coverage_ratio(d, F.col("country").isNotNull() & (F.col("country") != "n/a"))


@register("drop_duplicates", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def q_drop_duplicates(spark, sf):
    li = base_table(spark, sf, "lineitem")
    return frames.drop_duplicates(li, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber")


# ---- windows ---------------------------------------------------------------------

@register("latest_per_key", with_ctes("SELECT * FROM s_products_latest", "s_products_latest"))
def q_latest_per_key(spark, sf):
    return gold.latest_products(s_products(spark, sf))


_ORDERS_SQL = """
SELECT CAST(row_number() OVER (ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST, o_custkey NULLS FIRST,
  o_orderstatus NULLS FIRST, o_totalprice NULLS FIRST, o_orderpriority NULLS FIRST) AS BIGINT) AS order_key,
  o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
        o_orderpriority FROM orders)"""


def orders_by_date(spark, sf):
    o = base_table(spark, sf, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                    F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority")


@register("surrogate_key_global", _ORDERS_SQL)
def q_surrogate_key_global(spark, sf):
    # o_orderkey is the primary key of orders, so the order (date, key) is total
    return keys.dense_key(orders_by_date(spark, sf), ["o_orderdate", "o_orderkey"], "order_key", distinct=True)


@register("surrogate_key_kept", """
SELECT CAST(row_number() OVER (ORDER BY o_orderdate >= DATE '1996-01-01', o_orderdate, o_orderkey) AS BIGINT) AS order_key,
  o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM (SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders)""")
def q_surrogate_key_kept(spark, sf):
    """Two runs: the orders before 1996, then all of them.  The second run keeps
    the keys of the first and numbers the other orders after them."""
    orders = orders_by_date(spark, sf)
    order = ["o_orderdate", "o_orderkey"]
    _, known = keys.kept_key(orders.filter("o_orderdate < DATE '1996-01-01'"), order, "order_key")
    return keys.kept_key(orders, order, "order_key", known)[0]


@register("preview_ordered", "SELECT * FROM customer ORDER BY c_custkey LIMIT 10")
def q_preview_ordered(spark, sf):
    return frames.preview_ordered(base_table(spark, sf, "customer"), ["c_custkey"], 10)


# ---- sources and sinks -------------------------------------------------------------

def _landed(spark, sf, names=("f_sales",), compression=None) -> str:
    root = scratch_path(spark, "landing")
    specs = [s for s in schemas.SOURCES if s.fixture in names]
    files.land_sources({s.fixture: fixture(spark, sf, s.fixture) for s in specs}, root, specs, compression)
    return root


ALL_EXTRACTS = tuple(s.fixture for s in schemas.SOURCES)


@register("ingest_csv", with_ctes("SELECT * FROM f_sales", "f_sales"))
def q_ingest_csv(spark, sf):
    root = _landed(spark, sf)
    return files.ingest_csv(spark, f"{root}/source_crm/sales_details", schemas.SALES_DETAILS)


@register("ingest_csv_inferred", with_ctes("""
SELECT sls_ord_num, sls_prd_key, CAST(sls_cust_id AS INTEGER) AS sls_cust_id, sls_order_dt, sls_ship_dt, sls_due_dt,
  sls_sales, sls_quantity, sls_price FROM f_sales""", "f_sales"))
def q_ingest_csv_inferred(spark, sf):
    """Type inference (an extra pass over the files): customer ids that fit
    in 32 bits come back as INT."""
    root = _landed(spark, sf)
    return inference.ingest_csv_inferred(spark, f"{root}/source_crm/sales_details")


def _type_counts(column: str, position: int) -> str:
    text = f"CAST({column} AS VARCHAR)"
    whole = f"regexp_full_match({text}, '[+-]?[0-9]+') AND try_cast({text} AS INTEGER) IS NOT NULL"
    return f"""SELECT {position} AS position, '{column}' AS "column", count(*) FILTER ({column} IS NULL) AS n_null,
  count(*) FILTER ({whole}) AS n_int, count(*) FILTER ({column} IS NOT NULL AND NOT ({whole})) AS n_string,
  max({text}) FILTER ({column} IS NOT NULL AND NOT ({whole})) AS text, max({text}) FILTER ({whole}) AS whole FROM f_sales"""


@register("csv_column_types", with_ctes(
    """SELECT position, "column", if(n_string > 0, 'string', 'int') AS type, n_null, n_int, 0 AS n_long, 0 AS n_decimal, 0 AS n_double,
  0 AS n_date, 0 AS n_timestamp, 0 AS n_boolean, n_string, coalesce(text, whole) AS forced_by FROM ("""
    + "\nUNION ALL\n".join(_type_counts(f.name, i) for i, f in enumerate(schemas.SALES_DETAILS.fields)) + ")", "f_sales"))
def q_csv_column_types(spark, sf):
    """Which values make each column of the sales extract the type it is (all
    its values are integers or text)."""
    root = _landed(spark, sf)
    text = files.read_csv(spark, f"{root}/source_crm/sales_details")
    return inference.column_types(text)


@register("ingest_csv_strings", with_ctes("SELECT * FROM f_sales", "f_sales"))
def q_ingest_csv_strings(spark, sf):
    root = _landed(spark, sf)
    return files.ingest_csv_strings(spark, f"{root}/source_crm/sales_details", schemas.SALES_DETAILS)


@contextlib.contextmanager
def _layers(spark):
    """Layer schemas of a run of its own, dropped with their tables at the end."""
    root = scratch_path(spark, "layers")
    names = layers.Layers.with_prefix("l" + root.rsplit("-", 1)[-1] + "_")
    layers.create_layers(spark, names, root)
    try:
        yield names, root
    finally:
        for db in (names.bronze, names.silver, names.gold):
            spark.sql(f"DROP SCHEMA IF EXISTS `{db}` CASCADE")


@register("ingest_catalog", _COUNTS_SQL)
def q_ingest_catalog(spark, sf):
    root = _landed(spark, sf, ALL_EXTRACTS)
    with _layers(spark) as (names, _):
        loaded = files.ingest_catalog(spark, root, names.bronze)
        return materialize(_count_tables({t: spark.table(name) for t, name in loaded.items()}), "ingest-catalog")


@register("table_overwrite", with_ctes("SELECT * FROM f_cust_info", "f_cust_info"))
def q_table_overwrite(spark, sf):
    src = fixture(spark, sf, "f_cust_info")
    with _layers(spark) as (names, _):
        name = names.table("bronze", "crm_cust_info")
        files.write_table(src, name)
        files.write_table(src, name)      # a re-run replaces, it does not append
        return materialize(spark.table(name), "table-overwrite")


@register("landing_sources", with_ctes("\nUNION ALL\n".join(
    f"SELECT '{s.path}' AS source, count(*) AS row_count FROM {s.fixture}" for s in schemas.SOURCES),
    *ALL_EXTRACTS))
def q_landing_sources(spark, sf):
    """The landing listing summed per extract folder (file names differ per
    run; the folders and their row totals do not)."""
    root = _landed(spark, sf, ALL_EXTRACTS)
    folder = F.regexp_extract("file_path", r"(source_[a-z]+/[^/]+)/[^/]+$", 1)
    return files.landing_rows(spark, root).groupBy(folder.alias("source")).agg(F.sum("rows").alias("row_count"))


# ---- silver and gold jobs ----------------------------------------------------------

for _name, _fn, _cte in [
    ("silver_customers", s_customers, "s_customers"),
    ("silver_products", s_products, "s_products"),
    ("silver_sales", s_sales, "s_sales"),
    ("silver_erp_customers", s_erp_customers, "s_erp_customers"),
    ("silver_locations", s_locations, "s_locations"),
    ("silver_categories", s_categories, "s_categories"),
]:
    register(_name, with_ctes(f"SELECT * FROM {_cte}", _cte))(_fn)


@register("dim_customers", with_ctes("SELECT * FROM dim_customers", "dim_customers"))
def q_dim_customers(spark, sf):
    return d_customers(spark, sf)


@register("dim_customers_current", with_ctes("SELECT * FROM dim_customers_current", "dim_customers_current"))
def q_dim_customers_current(spark, sf):
    return gold.dim_customers_current(s_customers(spark, sf), s_erp_customers(spark, sf), s_locations(spark, sf))


@register("dim_products", with_ctes("SELECT * FROM dim_products", "dim_products"))
def q_dim_products(spark, sf):
    return d_products(spark, sf)


@register("dim_products_current", with_ctes("SELECT * FROM dim_products_current", "dim_products_current"))
def q_dim_products_current(spark, sf):
    return gold.dim_products_current(s_products(spark, sf), s_categories(spark, sf))


def both_dims(spark, sf):
    """Customer and product dimensions, built side by side (independent jobs)."""
    return concurrently(lambda: d_customers(spark, sf), lambda: d_products(spark, sf))


@register("fact_sales", with_ctes("SELECT * FROM fact_sales", "fact_sales"))
def q_fact_sales(spark, sf):
    dc, dp = both_dims(spark, sf)
    return gold.fact_sales(s_sales(spark, sf), dp, dc)


@register("fact_sales_salted", with_ctes("SELECT * FROM fact_sales", "fact_sales"))
def q_fact_sales_salted(spark, sf):
    """The sales fact with the customer join salted for hot customers (same
    rows).  The test data has no customer near the default threshold, so this
    uses 0.1 %: many customers then take the salted path (at most 1,000 keys
    are broadcast) and the SQL check covers it."""
    dc, dp = both_dims(spark, sf)
    return gold.fact_sales(s_sales(spark, sf), dp, dc, salt_customers=8, salt_min_share=0.001)


@register("fact_sales_current", with_ctes("SELECT * FROM fact_sales_current", "fact_sales_current"))
def q_fact_sales_current(spark, sf):
    dc, dp = concurrently(
        lambda: gold.dim_customers_current(s_customers(spark, sf), s_erp_customers(spark, sf), s_locations(spark, sf)),
        lambda: gold.dim_products_current(s_products(spark, sf), s_categories(spark, sf)))
    return gold.fact_sales(s_sales(spark, sf), dp, dc)


REPORT = ["check_id", "check_name", "severity", "value", "status"]


@register("dq_report", dq_report_sql())
def q_dq_report(spark, sf):
    # silver sales and the fact are read twice, the dimensions are written by their keys
    sales, (dc, dp) = concurrently(lambda: materialize(s_sales(spark, sf), "silver-sales"),
                                   lambda: both_dims(spark, sf))
    fact = materialize(gold.fact_sales(sales, dp, dc), "fact-sales")    # the gold fact table
    report = materialize(quality.dq_report({
        quality.BRONZE_CUSTOMERS: fixture(spark, sf, "f_cust_info"), quality.BRONZE_SALES: fixture(spark, sf, "f_sales"),
        quality.CUSTOMERS: s_customers(spark, sf), quality.SALES: sales, quality.ERP_CUSTOMERS: s_erp_customers(spark, sf),
        quality.LOCATIONS: s_locations(spark, sf), quality.CATEGORIES: s_categories(spark, sf),
        quality.DIM_CUSTOMERS: dc, quality.DIM_PRODUCTS: dp, quality.FACT: fact}, quality.NOTHING_REJECTED).select(*REPORT), "report")
    discard(sales, fact)
    return report


# Checks that a user declares over tables of their own: every kind of rule.
DECLARED = [
    Check(1, "orders have rows", Rows("tpch.orders"), expect_zero=False),
    Check(2, "orders not dearer than 300,000", Count("tpch.orders", "o_totalprice > 300000"), warn_only=True),
    Check(3, "quantity in all", Total("tpch.lineitem", "CAST(l_quantity AS BIGINT)"), expect_zero=False),
    Check(4, "no more customers than orders", Compare("tpch.customer", "<=", "tpch.orders")),
    Check(5, "as many lines as orders", Compare("tpch.lineitem", "=", "tpch.orders"), warn_only=True),
    Check(6, "a tenth of the orders are open", Share("tpch.orders", "o_orderstatus = 'O'", 10)),
    Check(7, "order keys unique", Unique("tpch.orders", "o_orderkey")),
    Check(8, "lines unique by part and supplier", Unique("tpch.lineitem", ("l_partkey", "l_suppkey")), warn_only=True),
    Check(9, "lines have an order", Reference("tpch.lineitem", "l_orderkey", "tpch.orders", "o_orderkey")),
    Check(10, "suppliers are also customers", Reference("tpch.supplier", "s_suppkey", "tpch.customer", "c_custkey"), warn_only=True),
    Check(11, "nations that sell", Sql("SELECT count(DISTINCT s_nationkey) FROM {tpch.supplier}"), expect_zero=False,
          about="no supplier has a nation"),
]


@register("declared_checks", """
WITH v AS (
  SELECT 1 AS check_id, 'orders have rows' AS check_name, 'error' AS severity, false AS zero, (SELECT count(*) FROM orders) AS value
  UNION ALL SELECT 2, 'orders not dearer than 300,000', 'warn', true, (SELECT count(*) FROM orders WHERE o_totalprice > 300000)
  UNION ALL SELECT 3, 'quantity in all', 'error', false, (SELECT CAST(sum(CAST(trunc(l_quantity) AS BIGINT)) AS BIGINT) FROM lineitem)
  UNION ALL SELECT 4, 'no more customers than orders', 'error', true,
    (SELECT CAST((SELECT count(*) FROM customer) > (SELECT count(*) FROM orders) AS BIGINT))
  UNION ALL SELECT 5, 'as many lines as orders', 'warn', true, (SELECT abs((SELECT count(*) FROM lineitem) - (SELECT count(*) FROM orders)))
  UNION ALL SELECT 6, 'a tenth of the orders are open', 'error', true,
    (SELECT CAST(10 * count(*) FILTER (WHERE o_orderstatus = 'O') < count(*) AS BIGINT) FROM orders)
  UNION ALL SELECT 7, 'order keys unique', 'error', true,
    (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1))
  UNION ALL SELECT 8, 'lines unique by part and supplier', 'warn', true,
    (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_partkey, l_suppkey HAVING count(*) > 1))
  UNION ALL SELECT 9, 'lines have an order', 'error', true,
    (SELECT count(*) FROM lineitem WHERE NOT EXISTS (FROM orders WHERE o_orderkey = l_orderkey))
  UNION ALL SELECT 10, 'suppliers are also customers', 'warn', true,
    (SELECT count(*) FROM supplier WHERE NOT EXISTS (FROM customer WHERE c_custkey = s_suppkey))
  UNION ALL SELECT 11, 'nations that sell', 'error', false, (SELECT count(DISTINCT s_nationkey) FROM supplier))
SELECT CAST(check_id AS INTEGER) AS check_id, check_name, severity, CAST(value AS BIGINT) AS value,
  if(if(zero, value = 0, value > 0), 'pass', if(severity = 'warn', 'warn', 'fail')) AS status,
  if(check_id = 11, 'no supplier has a nation', '') AS about FROM v""")
def q_declared_checks(spark, sf):
    """Checks declared by a user over tables of their own, in one query."""
    return check_report(DECLARED, {f"tpch.{t}": base_table(spark, sf, t) for t in ("orders", "lineitem", "customer", "supplier")})


# ---- layer order and incremental load --------------------------------------------

def _built(spark, sf, read):
    """Landing CSV -> bronze, silver, gold tables; what ``read`` makes of them,
    in a folder of its own.  What is no longer needed does not stay on disk: the
    shuffles of the landing, its files (compressed) once they are bronze, and
    the other tables at the end."""
    landed = _landed(spark, sf, ALL_EXTRACTS, "lz4")
    release_shuffles(spark)
    try:
        with _layers(spark) as (names, root):
            known = layers.build(spark, landed, names, root, AS_OF, keep_landing=False)
            return read(names, known)
    finally:
        remove_folder(spark, landed)


@register("layer_run", dq_report_sql())
def q_layer_run(spark, sf):
    """The layers from landing files to the report: whole-table counts from
    the writes, keys read from the tables."""
    return _built(spark, sf, lambda names, known: materialize(layers.report(spark, names, known=known).select(*REPORT), "layer-result"))


def _written(table: str) -> Query:
    """A gold table as the layer run wrote it (its files, not a copy)."""
    def query(spark, sf):
        return _built(spark, sf, lambda names, _: files.detach_table(spark, names.table("gold", table), scratch_path(spark, "layer-result")))
    return query


for _table in ("dim_customers", "dim_products", "fact_sales"):
    register(f"layer_{_table}", with_ctes(f"SELECT * FROM {_table}", _table))(_written(_table))


@register("silver_sales_stream", with_ctes("SELECT * FROM s_sales", "s_sales"))
def q_silver_sales_stream(spark, sf):
    """Sales extract landed as files, loaded and cleaned by an availableNow stream."""
    root = _landed(spark, sf)
    out = scratch_path(spark, "stream-silver-sales")
    spec = schemas.SOURCE_BY_TABLE["crm_sales_details"]
    return run_incremental(spark, spec, root, f"{out}/table", f"{out}/_checkpoint", silver.silver_sales)
