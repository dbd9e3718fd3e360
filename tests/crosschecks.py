"""Textbook forms that the library's operators are compared with (tests and bench)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from refinery.functions.dates import YYYYMMDD
from refinery.operators.keys import sort_columns


def naive_dense_key(df, order_by, key, tiebreak=None):
    """``row_number()`` over an unpartitioned window: every row goes through one task."""
    w = Window.orderBy(*sort_columns(df, order_by, tiebreak))
    return df.select(F.row_number().over(w).cast("long").alias(key), *[F.col(f"`{c}`") for c in df.columns])


def latest_per_key_window(df, keys, order_by, tiebreak=None):
    """``latest_per_key`` as a window and a filter."""
    order = [F.col(c).desc_nulls_last() for c in order_by]
    order += [F.col(c).desc_nulls_last() for c in (tiebreak or []) if c not in order_by]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def parse_yyyymmdd_text(c):
    """``parse_yyyymmdd`` by pattern."""
    text = F.col(c).cast("string")
    return (F.when((F.col(c).try_cast("long") == 0) | (F.length(text) != 8), F.lit(None).cast("date"))
            .otherwise(F.try_to_date(text, YYYYMMDD)))
