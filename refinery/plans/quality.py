"""The warehouse's data-quality report, as declared checks.

The 22 checks of the validation notebook (row counts, layer consistency,
NULL keys, value domains, key uniqueness, orphan keys, business rules) plus
the ones the gold design calls for (fact rows vs sales rows, NULL surrogate
keys, uniqueness of every lookup side, products without a category) and one for
the values that the ingest could not convert.  ``plans.checks`` compiles them;
a run with other checks passes ``CHECKS + (...)`` or a list of its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from refinery.functions.codes import GENDER_DOMAIN, MARITAL_STATUS_DOMAIN
from refinery.plans.checks import Check, Compare, Count, Metric, Reference, Rows, Share, Sum, Total, Unique, report
from refinery.sources.schemas import SOURCES

BRONZE_CUSTOMERS, BRONZE_SALES = "bronze.crm_cust_info", "bronze.crm_sales_details"
CUSTOMERS, SALES = "silver.crm_customers", "silver.crm_sales"
ERP_CUSTOMERS, LOCATIONS, CATEGORIES = "silver.erp_customers", "silver.erp_customer_location", "silver.erp_product_category"
DIM_CUSTOMERS, DIM_PRODUCTS, FACT = "gold.dim_customers", "gold.dim_products", "gold.fact_sales"
BRONZE_TABLES = tuple(f"bronze.{s.table}" for s in SOURCES)
_REJECTED = "size(_rejected)"


def _outside(column: str, domain: Sequence[str]) -> str:
    return f"{column} NOT IN ({', '.join(repr(v) for v in domain)})"


# The report's checks, in report order.
CHECKS = (
    Check(1, "bronze crm_cust_info has rows", Rows(BRONZE_CUSTOMERS), expect_zero=False, about="the customer extract is empty"),
    Check(2, "bronze crm_sales_details has rows", Rows(BRONZE_SALES), expect_zero=False, about="the sales extract is empty"),
    Check(3, "gold fact_sales has rows", Rows(FACT), expect_zero=False, about="the fact is empty"),
    Check(4, "silver crm_customers rows <= bronze crm_cust_info rows", Compare(CUSTOMERS, "<=", BRONZE_CUSTOMERS),
          about="cleaning added customers"),
    Check(5, "silver crm_sales rows = bronze crm_sales_details rows", Compare(SALES, "=", BRONZE_SALES),
          about="cleaning lost or added sales lines"),
    Check(6, "silver crm_customers.customer_id not NULL", Count(CUSTOMERS, "customer_id IS NULL"),
          about="customers that no sale can refer to"),
    Check(7, "silver crm_customers.customer_number not NULL", Count(CUSTOMERS, "customer_number IS NULL"),
          about="customers that no ERP row can refer to"),
    Check(8, "silver crm_sales.order_number not NULL", Count(SALES, "order_number IS NULL"), about="sales lines that cannot be traced"),
    Check(9, "gold dim_customers.customer_key not NULL", Count(DIM_CUSTOMERS, "customer_key IS NULL"), about="key assignment left a gap"),
    Check(10, "gold dim_products.product_key not NULL", Count(DIM_PRODUCTS, "product_key IS NULL"), about="key assignment left a gap"),
    Check(11, "crm_customers.gender within domain", Count(CUSTOMERS, _outside("gender", GENDER_DOMAIN)),
          about="a gender code is not mapped"),
    Check(12, "crm_customers.marital_status within domain", Count(CUSTOMERS, _outside("marital_status", MARITAL_STATUS_DOMAIN)),
          about="a marital status code is not mapped"),
    Check(13, "erp_customers.gender within domain", Count(ERP_CUSTOMERS, _outside("gender", GENDER_DOMAIN)),
          about="an ERP gender code is not mapped"),
    Check(14, "erp_customer_location.country not empty", Count(LOCATIONS, "country = ''"), about="a blank country was not replaced"),
    Check(15, "dim_customers.customer_key unique", Unique(DIM_CUSTOMERS, "customer_key"), about="two customers share a key"),
    Check(16, "dim_products.product_key unique", Unique(DIM_PRODUCTS, "product_key"), about="two products share a key"),
    Check(17, "dim_customers.customer_id unique", Unique(DIM_CUSTOMERS, "customer_id"), warn_only=True,
          about="repeated ids multiply sales lines in the fact"),
    Check(18, "fact_sales.product_key exists in dim_products", Reference(FACT, "product_key", DIM_PRODUCTS),
          about="sales refer to a product that is not there"),
    Check(19, "fact_sales.customer_key exists in dim_customers", Reference(FACT, "customer_key", DIM_CUSTOMERS),
          about="sales refer to a customer that is not there"),
    Check(20, "crm_sales.sales_amount not negative", Count(SALES, "sales_amount < 0"), warn_only=True, about="returns or wrong amounts"),
    Check(21, "crm_sales.quantity positive", Count(SALES, "quantity <= 0"), about="lines without goods"),
    Check(22, "dim_customers with a country >= 50 percent", Share(DIM_CUSTOMERS, "country <> 'n/a'", 50),
          about="most customers have no country"),
    Check(23, "fact_sales rows = silver crm_sales rows", Compare(FACT, "=", SALES), warn_only=True,
          about="product versions or repeated customers multiply lines"),
    Check(24, "fact_sales.product_key resolved", Count(FACT, "product_key IS NULL"), warn_only=True,
          about="sales of products that the dimension lacks"),
    Check(25, "fact_sales.customer_key resolved", Count(FACT, "customer_key IS NULL"), warn_only=True,
          about="sales of customers that the dimension lacks"),
    Check(26, "erp_customers.customer_number unique", Unique(ERP_CUSTOMERS, "customer_number"), warn_only=True,
          about="a repeated number multiplies customers"),
    Check(27, "erp_customer_location.customer_number unique", Unique(LOCATIONS, "customer_number"), warn_only=True,
          about="a repeated number multiplies customers"),
    Check(28, "erp_product_category.category_id unique", Unique(CATEGORIES, "category_id"), warn_only=True,
          about="a repeated id multiplies products"),
    Check(29, "dim_products.category resolved", Count(DIM_PRODUCTS, "category IS NULL"), warn_only=True,
          about="the product's category is not in the lookup"),
    Check(30, "bronze values all fit their types", Total(BRONZE_TABLES, _REJECTED), warn_only=True,
          about="kept in the bronze tables' _rejected, NULL in their columns"),
)

# What a bronze layer without ``_rejected`` columns (a strict load) knows about check 30.
NOTHING_REJECTED: dict[Metric, int] = {Sum(t, _REJECTED): 0 for t in BRONZE_TABLES}


def dq_report(tables: Mapping[str, DataFrame], known: Mapping[Metric, int] | None = None,
              checks: Sequence[Check] = CHECKS) -> DataFrame:
    """The report: one row per check (check_id, check_name, severity, value,
    status, about) over ``tables`` (``layer.table`` -> frame)."""
    return report(checks, tables, known)
