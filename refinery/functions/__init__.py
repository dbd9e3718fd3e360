"""Column -> Column cleaning rules; all built-in expressions, no UDF."""

from refinery.functions.codes import (  # noqa: F401
    boolean_to_flag, flag_to_boolean, map_codes, merge_gender, normalize_country,
    normalize_gender_crm, normalize_gender_erp, normalize_marital_status, normalize_product_line,
)
from refinery.functions.dates import (  # noqa: F401
    cast_date, null_future_dates, parse_mdy_date, parse_yyyymmdd,
)
from refinery.functions.values import (  # noqa: F401
    cast_decimal, category_id_from_key, coalesce_default, null_or_empty, product_number_from_key,
    repair_price, strip_hyphens, strip_id_prefix,
)
