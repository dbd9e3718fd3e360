"""Counting operators of the data-quality checks.

Each returns a small DataFrame (one row, or one row per offending key) and
does one scan: many conditional counts share a single aggregate, and
comparisons of two tables use a union and one aggregate instead of a join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_rows(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def count_if_multi(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """One row: for each named predicate the number of rows where it is TRUE
    (a NULL predicate is not counted, as in ``WHERE``)."""
    return df.agg(*[F.count_if(F.coalesce(p, F.lit(False))).alias(n) for n, p in predicates.items()])


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_name: str = "n") -> DataFrame:
    """Keys that occur more than once, with their counts (partial counts are
    combined on the map side, so a hot key costs one row per map task)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name)).filter(F.col(count_name) > 1)


def count_duplicate_groups(df: DataFrame, keys: Sequence[str], name: str = "groups") -> DataFrame:
    return count_rows(duplicate_keys(df, keys), name)


def paired_counts(a: DataFrame, b: DataFrame, a_name: str = "a_rows", b_name: str = "b_rows") -> DataFrame:
    """One row with the row counts of two tables, from one union and one aggregate."""
    sides = (a.select(F.lit(0).alias("__side"))
             .unionByName(b.select(F.lit(1).alias("__side"))))
    return sides.agg(F.count_if(F.col("__side") == 0).alias(a_name),
                     F.count_if(F.col("__side") == 1).alias(b_name))


def rowcount_not_greater(child: DataFrame, parent: DataFrame) -> DataFrame:
    """1 when the child table has more rows than its parent, else 0."""
    c = paired_counts(child, parent, "child_rows", "parent_rows")
    return c.select("child_rows", "parent_rows",
                    F.when(F.col("child_rows") > F.col("parent_rows"), 1).otherwise(0).alias("violation"))


def rowcount_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    c = paired_counts(a, b, "a_rows", "b_rows")
    return c.select("a_rows", "b_rows", F.abs(F.col("a_rows") - F.col("b_rows")).alias("difference"))


def coverage_ratio(df: DataFrame, covered: Column, threshold_pct: float = 50.0) -> DataFrame:
    """Share (in percent, DOUBLE) of rows where ``covered`` holds; NULL for an
    empty table.  ``below`` is 1 when the share is under the threshold."""
    c = df.agg(F.count_if(F.coalesce(covered, F.lit(False))).alias("covered"),
               F.count(F.lit(1)).alias("total"))
    ratio = (F.col("covered").cast("double") * 100.0) / F.nullif(F.col("total"), F.lit(0)).cast("double")
    return c.select("covered", "total", ratio.alias("ratio_pct"),
                    F.when(ratio < threshold_pct, 1).otherwise(0).alias("below"))


def top_key_share(df: DataFrame, key: str) -> DataFrame:
    """One row: the most frequent value of ``key`` (NULL included), its row
    count, the total and its share.  Counts per key are combined on the map
    side, so a hot key costs one row per map task."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    top = per_key.agg(F.max_by(F.col(key), F.col("rows")).alias("top_key"), F.max("rows").alias("top_rows"),
                      F.sum("rows").alias("total_rows"))
    return top.select("top_key", "top_rows", "total_rows",
                      (F.col("top_rows") / F.nullif(F.col("total_rows"), F.lit(0))).alias("share"))
