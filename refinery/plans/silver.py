"""The six silver cleaning jobs (bronze extract -> cleaned, renamed table).

Each job is a pure ``DataFrame -> DataFrame`` function and map-only: one
projection (trim, clean, rename) and at most one filter, so Catalyst fuses it
into the scan's whole-stage-codegen span and pushes the key filter to the
reader (the optional customer de-duplication is the one aggregate).  The order of rules is part of the contract: trimming comes first
(codes carry trailing blanks), the product key is split before it is replaced.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.functions import codes, dates, values
from refinery.operators.frames import rename_strict, resolve_column, trim_all_strings
from refinery.operators.keys import latest_per_key
from refinery.sources import schemas


def _with(df: DataFrame, changes: dict[str, Column]) -> DataFrame:
    """Replace / add columns in one projection (case-insensitive match on
    existing names, as Spark resolves them)."""
    resolved = {}
    for name, expr in changes.items():
        try:
            resolved[resolve_column(df, name)] = expr
        except KeyError:
            resolved[name] = expr
    return df.withColumns(resolved)


def silver_customers(bronze: DataFrame, dedupe: bool = False) -> DataFrame:
    """CRM customers: trim, normalise marital status and gender, drop rows
    without an id, rename.  Repeated ids are kept by default, as in the
    source jobs; ``dedupe=True`` keeps the latest created row per id (ties
    by customer number), an aggregate with map-side combine."""
    df = trim_all_strings(bronze)
    df = _with(df, {
        "cst_marital_status": codes.normalize_marital_status("cst_marital_status"),
        "cst_gndr": codes.normalize_gender_crm("cst_gndr"),
    })
    df = df.filter(F.col("cst_id").isNotNull())
    df = rename_strict(df, schemas.RENAME_CUSTOMERS)
    return latest_per_key(df, ["customer_id"], ["created_date"], ["customer_number"]) if dedupe else df


def silver_products(bronze: DataFrame) -> DataFrame:
    """CRM products: split the product key into category id and product
    number, default a missing cost to 0, normalise the product line, type the
    start date, rename."""
    df = trim_all_strings(bronze)
    key = F.col(resolve_column(df, "prd_key"))
    df = _with(df, {
        "prd_key": values.product_number_from_key(key),
        "prd_cost": values.coalesce_default("prd_cost", 0),
        "prd_line": codes.normalize_product_line("prd_line"),
        "prd_start_dt": dates.cast_date("prd_start_dt"),
        "cat_id": values.category_id_from_key(key),
    })
    df = rename_strict(df, schemas.RENAME_PRODUCTS)
    order = ["product_id", "category_id", "product_number", "product_name", "product_cost",
             "product_line", "start_date", "end_date"]
    return df.select(*order)


def silver_sales(bronze: DataFrame) -> DataFrame:
    """CRM sales lines: three yyyymmdd integers to dates, repair the price,
    rename.  No row is dropped (silver rows = bronze rows)."""
    df = trim_all_strings(bronze)
    df = _with(df, {
        "sls_order_dt": dates.parse_yyyymmdd("sls_order_dt"),
        "sls_ship_dt": dates.parse_yyyymmdd("sls_ship_dt"),
        "sls_due_dt": dates.parse_yyyymmdd("sls_due_dt"),
        "sls_price": values.repair_price("sls_price", "sls_sales", "sls_quantity"),
    })
    return rename_strict(df, schemas.RENAME_SALES)


def silver_erp_customers(bronze: DataFrame, as_of: _dt.date | str | None = None) -> DataFrame:
    """ERP customers: strip the legacy id prefix, NULL birth dates after the
    reference day (``as_of``, default the run day), normalise gender, rename."""
    df = trim_all_strings(bronze)
    df = _with(df, {
        "cid": values.strip_id_prefix("cid"),
        "bdate": dates.null_future_dates("bdate", as_of),
        "gen": codes.normalize_gender_erp("gen"),
    })
    return rename_strict(df, schemas.RENAME_ERP_CUSTOMERS)


def silver_locations(bronze: DataFrame) -> DataFrame:
    """ERP customer locations: remove hyphens from ids, normalise country."""
    df = trim_all_strings(bronze)
    df = _with(df, {
        "cid": values.strip_hyphens("cid"),
        "cntry": codes.normalize_country("cntry"),
    })
    return rename_strict(df, schemas.RENAME_LOCATIONS)


def silver_categories(bronze: DataFrame) -> DataFrame:
    """ERP product categories: maintenance Yes/No text to a three-valued boolean."""
    df = trim_all_strings(bronze)
    df = _with(df, {"maintenance": codes.flag_to_boolean("maintenance")})
    return rename_strict(df, schemas.RENAME_CATEGORIES)


SILVER_JOBS = {
    "crm_customers": ("crm_cust_info", silver_customers),
    "crm_products": ("crm_prd_info", silver_products),
    "crm_sales": ("crm_sales_details", silver_sales),
    "erp_customers": ("erp_cust_az12", silver_erp_customers),
    "erp_customer_location": ("erp_loc_a101", silver_locations),
    "erp_product_category": ("erp_px_cat_g1v2", silver_categories),
}
