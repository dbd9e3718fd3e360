"""DataFrame -> DataFrame building blocks."""

from refinery.operators.aggregates import (  # noqa: F401
    count_duplicate_groups, count_if_multi, count_rows, coverage_ratio, duplicate_keys, paired_counts,
    rowcount_difference, rowcount_not_greater, top_key_share,
)
from refinery.operators.frames import (  # noqa: F401
    drop_duplicates, filter_current_rows, filter_not_null, preview_ordered, rename_strict, trim_all_strings,
)
from refinery.operators.joins import (  # noqa: F401
    hot_keys, left_lookup, orphans, salted_left_lookup,
)
from refinery.operators.keys import dense_key, latest_per_key  # noqa: F401
