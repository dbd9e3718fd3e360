"""Measure repair and identifier clean-up rules (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# The layout of the CRM product key and the ERP id prefix.
# A product key reads  <category: 5 chars> '-' <product number ...>,
# e.g. 'CO-RF-FR-R92B-58' -> category 'CO_RF', product number 'FR-R92B-58'.
CATEGORY_PREFIX_LEN = 5
PRODUCT_NUMBER_START = 7
LEGACY_ID_PREFIX = "NAS"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coalesce_default(c: ColumnOrName, default: object = 0) -> Column:
    """NULL -> default (the type of the column is kept)."""
    return F.coalesce(_col(c), F.lit(default))


def repair_price(price: ColumnOrName, sales: ColumnOrName, quantity: ColumnOrName) -> Column:
    """A missing or non-positive price is derived as sales / quantity when the
    quantity is non-zero, otherwise NULL; a positive price is kept.  Only the
    price is repaired, never the sales amount, so a negative sale gives a
    negative price.  The result is DOUBLE."""
    p, s, q = _col(price), _col(sales), _col(quantity)
    derived = F.when(q != 0, F.try_divide(s.cast("double"), q.cast("double")))
    return F.when(p.isNull() | (p <= 0), derived).otherwise(p.cast("double"))


def cast_decimal(c: ColumnOrName, precision: int = 10, scale: int = 2) -> Column:
    """To DECIMAL(p, s) rounding half up; a value that does not fit gives NULL."""
    return _col(c).try_cast(f"decimal({precision},{scale})")


def category_id_from_key(key: ColumnOrName) -> Column:
    """First five characters of the product key with every '-' turned into '_'."""
    return F.regexp_replace(F.substring(_col(key), 1, CATEGORY_PREFIX_LEN), "-", "_")


def product_number_from_key(key: ColumnOrName) -> Column:
    """The product key from its seventh character to the end."""
    k = _col(key)
    return F.substring(k, F.lit(PRODUCT_NUMBER_START), F.length(k))


def strip_id_prefix(c: ColumnOrName, prefix: str = LEGACY_ID_PREFIX) -> Column:
    """Remove a leading legacy prefix (case-sensitive); other ids are unchanged."""
    v = _col(c)
    return F.when(v.startswith(prefix), F.substring(v, F.lit(len(prefix) + 1), F.length(v))).otherwise(v)


def strip_hyphens(c: ColumnOrName) -> Column:
    """Remove every '-' from an id."""
    return F.regexp_replace(_col(c), "-", "")


def null_or_empty(c: ColumnOrName) -> Column:
    v = _col(c)
    return v.isNull() | (v == "")
