"""Code normalisation: short source codes to readable labels.

Every function takes and returns a ``Column`` so it serves batch and
streaming frames alike and stays inside whole-stage codegen (a chain of
``CASE WHEN`` on literals, no UDF).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# ---------------------------------------------------------------------------
# Code tables and labels that the cleaned data must carry.
# Keys are compared after trim + upper case (case-insensitive rules).
# ---------------------------------------------------------------------------
NOT_AVAILABLE = "n/a"
MARITAL_STATUS_CODES = {"S": "Single", "M": "Married"}
GENDER_CODES_CRM = {"F": "Female", "M": "Male"}
GENDER_CODES_ERP = {"F": "Female", "FEMALE": "Female", "M": "Male", "MALE": "Male"}
PRODUCT_LINE_CODES = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
# Country rules are case-sensitive and keep unknown values unchanged.
COUNTRY_CODES = {"DE": "Germany", "US": "United States", "USA": "United States"}
YES_NO_FLAGS = {"YES": True, "NO": False}
# Allowed label domains (used by the quality report).
GENDER_DOMAIN = ("Male", "Female", NOT_AVAILABLE)
MARITAL_STATUS_DOMAIN = ("Single", "Married", NOT_AVAILABLE)


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def code_key(c: ColumnOrName) -> Column:
    """The comparison form of a raw code: trimmed, upper case."""
    return F.upper(F.trim(_col(c)))


def map_codes(c: ColumnOrName, mapping: Mapping[str, object], default: object = NOT_AVAILABLE,
              key: Column | None = None) -> Column:
    """Table-driven ``CASE``: first matching code wins, NULL and unknown codes
    fall to ``default`` (a literal, a Column, or None for a typed NULL).

    Codes that map to the same label are folded into one ``isin`` branch.
    """
    k = code_key(c) if key is None else key
    by_label: dict[object, list[str]] = {}
    for code, label in mapping.items():
        by_label.setdefault(label, []).append(code)
    expr = None
    for label, codes in by_label.items():
        cond = k == codes[0] if len(codes) == 1 else k.isin(*codes)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return default if isinstance(default, Column) else F.lit(default)
    if default is None:
        return expr
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def normalize_marital_status(c: ColumnOrName) -> Column:
    """S -> Single, M -> Married, anything else (NULL too) -> n/a."""
    return map_codes(c, MARITAL_STATUS_CODES)


def normalize_gender_crm(c: ColumnOrName) -> Column:
    """F -> Female, M -> Male, else n/a (single-letter CRM codes)."""
    return map_codes(c, GENDER_CODES_CRM)


def normalize_gender_erp(c: ColumnOrName) -> Column:
    """F/FEMALE -> Female, M/MALE -> Male, else n/a (ERP long and short forms)."""
    return map_codes(c, GENDER_CODES_ERP)


def normalize_product_line(c: ColumnOrName) -> Column:
    """M/R/S/T -> Mountain/Road/Other Sales/Touring, else n/a."""
    return map_codes(c, PRODUCT_LINE_CODES)


def normalize_country(c: ColumnOrName) -> Column:
    """Case-sensitive: DE -> Germany; US, USA -> United States; NULL or '' -> n/a;
    any other (trimmed) value is kept as it is."""
    t = F.trim(_col(c))
    known = map_codes(t, COUNTRY_CODES, default=None, key=t)
    return known.when(t.isNull() | (t == ""), F.lit(NOT_AVAILABLE)).otherwise(t)


def flag_to_boolean(c: ColumnOrName) -> Column:
    """YES -> true, NO -> false, anything else -> NULL (case-insensitive)."""
    return map_codes(c, YES_NO_FLAGS, default=None)


def boolean_to_flag(c: ColumnOrName) -> Column:
    """The inverse rendering used by the analysts' product file: Yes / No / NULL."""
    b = _col(c)
    return F.when(b, F.lit("Yes")).when(~b, F.lit("No"))


def merge_gender(primary: ColumnOrName, secondary: ColumnOrName) -> Column:
    """Two-source precedence: the primary (CRM) label unless it is n/a, then the
    secondary (ERP) label, then n/a.  A NULL primary counts as unknown."""
    p, s = _col(primary), _col(secondary)
    return F.when(p != NOT_AVAILABLE, p).otherwise(F.coalesce(s, F.lit(NOT_AVAILABLE)))
