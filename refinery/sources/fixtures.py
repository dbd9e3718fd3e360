"""Stand-ins for the six raw extracts, derived by Spark from the test tables.

The driver's tables are clean (no NULLs, no orphans, unique keys), so each
extract is a projection that injects the defects the cleaning rules exist for:
padded and mixed-case codes, NULL and repeated ids, impossible dates, zero
quantities, negative sales, product versions.  The category extract is four
fixed rows (the categories the product keys point to, one of them unused, and
one product category missing) plus one padded, mixed-case row per product
group of ``part``, so that it too grows with the tables.  The same SQL text runs in
Spark (tables bound as DataFrames) and in DuckDB (tables as views), which is
what makes it usable for the cross-engine oracle.  Every projection reads the
whole base table and keeps every row, so its size grows with the scale factor;
customers that a lookup must miss have an outdated number there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# The dirty projections (placeholders in braces are base tables).
FIXTURE_SQL = {
    "f_cust_info": """
SELECT CASE WHEN c_custkey % 97 = 0 THEN NULL WHEN c_custkey % 50 = 1 THEN c_custkey + 1 ELSE c_custkey END AS cst_id,
  concat('AW', lpad(CAST(c_custkey AS STRING), 8, '0')) AS cst_key, concat('  ', c_name, ' ') AS cst_firstname, concat(c_mktsegment, '  ') AS cst_lastname,
  CASE c_custkey % 5 WHEN 0 THEN 'S ' WHEN 1 THEN 'm' WHEN 2 THEN NULL WHEN 3 THEN ' M' ELSE 'x' END AS cst_marital_status,
  CASE c_custkey % 7 WHEN 0 THEN 'F' WHEN 1 THEN ' m ' WHEN 2 THEN NULL WHEN 3 THEN '' ELSE 'M' END AS cst_gndr,
  make_date(CAST(2020 + c_custkey % 5 AS INT), CAST(1 + c_custkey % 12 AS INT), CAST(1 + c_custkey % 28 AS INT)) AS cst_create_date FROM {customer}
""",
    "f_cust_az12": """
SELECT concat(CASE WHEN c_custkey % 3 = 0 THEN 'NAS' ELSE '' END, CASE WHEN c_custkey % 13 = 0 THEN 'OLD' ELSE 'AW' END, lpad(CAST(c_custkey AS STRING), 8, '0')) AS cid,
  make_date(CAST(CASE WHEN c_custkey % 41 = 0 THEN 2999 ELSE 1950 + c_custkey % 50 END AS INT), CAST(1 + c_custkey % 12 AS INT), CAST(1 + c_custkey % 28 AS INT)) AS bdate,
  CASE c_custkey % 6 WHEN 0 THEN 'Female' WHEN 1 THEN 'F ' WHEN 2 THEN 'male' WHEN 3 THEN 'M' WHEN 4 THEN '' ELSE NULL END AS gen FROM {customer}
""",
    "f_loc_a101": """
SELECT concat(CASE WHEN c_custkey % 17 = 0 THEN 'OLD-' ELSE 'AW-' END, lpad(CAST(c_custkey AS STRING), 8, '0')) AS cid,
  CASE c_nationkey % 6 WHEN 0 THEN 'DE' WHEN 1 THEN 'US' WHEN 2 THEN 'USA ' WHEN 3 THEN '' WHEN 4 THEN NULL ELSE n_name END AS cntry FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
""",
    "f_prd_info": """
SELECT p_partkey AS prd_id,
  concat(CASE CAST(floor(p_partkey / 3) AS BIGINT) % 4 WHEN 0 THEN 'CO-RF' WHEN 1 THEN 'BI-MB' WHEN 2 THEN 'AC-HE' ELSE 'CO-PE' END, '-P', lpad(CAST(CAST(floor(p_partkey / 3) AS BIGINT) AS STRING), 6, '0')) AS prd_key,
  concat(p_name, ' ') AS prd_nm, CAST(CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE floor(p_retailprice) END AS INT) AS prd_cost,
  CASE CAST(floor(p_partkey / 3) AS BIGINT) % 6 WHEN 0 THEN 'M ' WHEN 1 THEN 'r' WHEN 2 THEN 'S ' WHEN 3 THEN ' T' WHEN 4 THEN NULL ELSE 'Q' END AS prd_line,
  make_date(CAST(2011 + p_partkey % 3 AS INT), 7, 1) AS prd_start_dt,
  CASE WHEN p_partkey % 3 = 2 THEN NULL ELSE make_date(CAST(2007 + p_partkey % 3 AS INT), 12, 28) END AS prd_end_dt FROM {part}
""",
    "f_px_cat": """
SELECT * FROM (VALUES ('CO_RF','Components','Road Frames','Yes'),('BI_MB','Bikes','Mountain Bikes','yes '),('AC_HE','Accessories','Helmets','No'),('CO_PD','Components','Pedals','?')) AS t(id, cat, subcat, maintenance)
UNION ALL
SELECT DISTINCT concat('PG_', CAST(g AS STRING)) AS id,
  concat(' ', CASE g % 3 WHEN 0 THEN 'Components' WHEN 1 THEN 'Bikes' ELSE 'Accessories' END) AS cat,
  concat('Group ', CAST(g AS STRING), ' ') AS subcat,
  CASE g % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no ' WHEN 2 THEN ' YES' WHEN 3 THEN '?' ELSE NULL END AS maintenance
FROM (SELECT CAST(floor(p_partkey / 3) AS BIGINT) AS g FROM {part}) AS groups
""",
    "f_sales": """
SELECT concat('SO', CAST(l_orderkey AS STRING)) AS sls_ord_num, concat('P', lpad(CAST(CAST(floor(l_partkey / 3) AS BIGINT) AS STRING), 6, '0'), ' ') AS sls_prd_key, o_custkey AS sls_cust_id,
  CAST(CASE WHEN l_orderkey % 89 = 0 THEN 0 WHEN l_orderkey % 89 = 1 THEN 5489 WHEN l_orderkey % 89 = 2 THEN 20101340 WHEN l_orderkey % 89 = 3 THEN NULL ELSE year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) END AS INT) AS sls_order_dt,
  CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INT) AS sls_ship_dt,
  CAST(CASE WHEN l_linenumber = 7 THEN 0 ELSE year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) END AS INT) AS sls_due_dt,
  CAST(CASE WHEN l_orderkey % 71 = 0 THEN -1 ELSE 1 END * floor(l_extendedprice) AS INT) AS sls_sales,
  CAST(CASE WHEN l_orderkey % 67 = 0 THEN 0 ELSE l_quantity END AS INT) AS sls_quantity,
  CAST(CASE WHEN l_partkey % 19 = 0 THEN NULL WHEN l_partkey % 19 = 1 THEN 0 WHEN l_partkey % 19 = 2 THEN -5 ELSE floor(l_extendedprice / l_quantity) END AS INT) AS sls_price
  FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
""",
}

FIXTURES = tuple(FIXTURE_SQL)


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The projection ``name`` over the tables in ``sf_dir`` (lazy)."""
    text = FIXTURE_SQL[name]
    used = {t: base_table(spark, sf_dir, t) for t in BASE_TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def fixture_sql_for_duckdb(name: str) -> str:
    """The same projection with the base tables as plain view names."""
    return FIXTURE_SQL[name].format(**{t: t for t in BASE_TABLES}).strip()


def bronze_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All six stand-in extracts keyed by fixture name."""
    return {n: fixture(spark, sf_dir, n) for n in FIXTURES}
