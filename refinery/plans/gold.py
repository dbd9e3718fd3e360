"""Gold star schema: customer and product dimensions, sales fact.

Join strategy is left to Catalyst and AQE.  The dimensions come out of
``dense_key`` as projections of scans of written Parquet, so the planner sizes the
(natural key, surrogate key) lookup projections from real file bytes: broadcast below
``spark.sql.autoBroadcastJoinThreshold``, otherwise a sort-merge join where AQE
splits partitions of a hot key on the fact side.  The customers are looked up
before the products, whose versions multiply the lines, so no join shuffles the
multiplied lines.

Two facts are offered.  ``fact_sales`` is the faithful form: the product
dimension keeps every version, so a sale of a product with three versions
becomes three fact rows.  ``fact_sales_current`` joins latest-version
dimensions, whose natural keys are unique, so fact rows = sales rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.functions.codes import boolean_to_flag, merge_gender
from refinery.operators.joins import left_lookup, salted_left_lookup
from refinery.operators.keys import dense_key, latest_per_key

Numbering = Callable[[DataFrame, Sequence[str], str], DataFrame]

# The output columns of the gold tables, in order.
DIM_CUSTOMER_COLUMNS = ["customer_key", "customer_id", "customer_number", "first_name", "last_name",
                        "country", "marital_status", "gender", "birthdate", "create_date"]
DIM_PRODUCT_COLUMNS = ["product_key", "product_id", "product_number", "product_name", "category_id",
                       "category", "subcategory", "maintenance_flag", "product_line", "start_date"]
DIM_PRODUCT_CURRENT_COLUMNS = ["product_key", "product_id", "product_number", "product_name", "category_id",
                               "category", "subcategory", "maintenance", "cost", "product_line", "start_date"]
FACT_COLUMNS = ["order_number", "product_key", "customer_key", "order_date", "ship_date", "due_date",
                "sales_amount", "quantity", "price"]


def customer_attributes(customers: DataFrame, erp_customers: DataFrame, locations: DataFrame) -> DataFrame:
    """CRM customers with the ERP birth date, the country, and one gender out of
    the two sources.  Both lookups are on the customer number, so the CRM side
    shuffles once; a repeated number on the ERP side repeats the customer."""
    both = left_lookup(customers, erp_customers, "customer_number", right_cols=["gender", "birth_date"], prefix="erp_")
    both = left_lookup(both, locations, "customer_number", right_cols=["country"])
    merged = merge_gender(F.col("gender"), F.col("erp_gender"))
    named = {"gender": merged, "birthdate": F.col("erp_birth_date"), "create_date": F.col("created_date")}
    return both.select(*[named.get(c, F.col(c)).alias(c) for c in DIM_CUSTOMER_COLUMNS if c != "customer_key"])


def dim_customers(customers: DataFrame, erp_customers: DataFrame, locations: DataFrame, numbering: Numbering = dense_key) -> DataFrame:
    """Customer dimension; key order: customer id, then customer number (the
    id alone has ties in the source), then the remaining columns.  ``numbering``
    gives the keys: anew, or as a run before did (``operators.keys.kept_key``)."""
    attrs = customer_attributes(customers, erp_customers, locations)
    return numbering(attrs, ["customer_id", "customer_number"], "customer_key").select(*DIM_CUSTOMER_COLUMNS)


def latest_customers(customers: DataFrame) -> DataFrame:
    """One CRM row per customer id: the latest created, ties by customer number."""
    return latest_per_key(customers, ["customer_id"], ["created_date"], ["customer_number"])


def dim_customers_current(customers: DataFrame, erp_customers: DataFrame, locations: DataFrame) -> DataFrame:
    """Customer dimension on unique customer ids."""
    return dim_customers(latest_customers(customers), erp_customers, locations)


def product_attributes(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Products with their category's columns (NULL where it is not known)."""
    return left_lookup(products, categories, "category_id", right_cols=["category", "subcategory", "maintenance_flag"])


def dim_products(products: DataFrame, categories: DataFrame, numbering: Numbering = dense_key) -> DataFrame:
    """Product dimension with full history (every version is a row)."""
    attrs = product_attributes(products, categories).select(*[c for c in DIM_PRODUCT_COLUMNS if c != "product_key"])
    return numbering(attrs, ["start_date", "product_number"], "product_key").select(*DIM_PRODUCT_COLUMNS)


def latest_products(products: DataFrame) -> DataFrame:
    """One row per product number: the latest start date, ties by product id."""
    return latest_per_key(products, ["product_number"], ["start_date"], ["product_id"])


def dim_products_current(products: DataFrame, categories: DataFrame) -> DataFrame:
    """The analysts' product dimension: latest version per product number,
    category attributes, maintenance as Yes/No text, cost kept."""
    attrs = product_attributes(latest_products(products), categories)
    named = {"maintenance": boolean_to_flag(F.col("maintenance_flag")), "cost": F.col("product_cost")}
    attrs = attrs.select(*[named.get(c, F.col(c)).alias(c) for c in DIM_PRODUCT_CURRENT_COLUMNS if c != "product_key"])
    return dense_key(attrs, ["start_date", "product_number"], "product_key").select(*DIM_PRODUCT_CURRENT_COLUMNS)


def _key_lookup(dim: DataFrame, natural: str, surrogate: str) -> DataFrame:
    """The two columns a fact needs from a dimension (no hint: sized by the
    planner).  The natural key keeps its name, so a dimension table bucketed
    on it still satisfies the join's distribution without a shuffle."""
    return dim.select(F.col(natural), F.col(surrogate))


def fact_key_lookup(sales: DataFrame, dim_p: DataFrame) -> DataFrame:
    """Sales lines with the product surrogate key (NULL when unmatched; a
    product number with several versions multiplies the line)."""
    p = _key_lookup(dim_p, "product_number", "product_key")
    return sales.join(p, "product_number", "left").select("order_number", "product_number", "product_key",
                                                          "customer_id")


def fact_sales(sales: DataFrame, dim_p: DataFrame, dim_c: DataFrame,
               salt_customers: int | None = None, salt_min_share: float | None = None) -> DataFrame:
    """Sales fact: the silver sales lines with product and customer surrogate
    keys.  ``salt_customers`` splits customers that hold a large share of the
    sales over that many sub-keys for the customer join (see
    ``salted_left_lookup``) instead of relying on AQE's skew split."""
    p = _key_lookup(dim_p, "product_number", "product_key")
    c = _key_lookup(dim_c, "customer_id", "customer_key")
    if salt_customers:
        with_customer = salted_left_lookup(sales, c, "customer_id", salts=salt_customers, min_share=salt_min_share)
    else:
        with_customer = sales.join(c, "customer_id", "left")
    return with_customer.join(p, "product_number", "left").select(*FACT_COLUMNS)
