"""Lookup joins.

No side is forced to be broadcast: Catalyst and AQE choose from measured bytes,
and AQE splits the partitions of a hot key in a sort-merge join.  The salted
form does the same split where AQE is off.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.session import materialize


def left_lookup(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None,
                right_cols: Sequence[str] = (), prefix: str = "") -> DataFrame:
    """``left LEFT JOIN right ON left.k = right.k`` keeping every left column
    and the chosen right columns (renamed with ``prefix``).  Unmatched rows get
    NULLs; a repeated right key multiplies the left row, as in SQL."""
    rk = right_key or left_key
    r = right.select(F.col(rk).alias("__rk"), *[F.col(c).alias(prefix + c) for c in right_cols])
    return left.join(r, left[left_key] == r["__rk"], "left").drop("__rk")


def one_per_key(right: DataFrame, key: str, columns: Sequence[str], matches: str = "matches", conflict: str = "conflict") -> DataFrame:
    """A lookup side with one row per key: ``columns`` of the key's smallest row
    (in their order, NULL first), ``matches``, the number of its rows, and
    ``conflict``, whether they differ in these columns.  One aggregate, combined
    in the map tasks; NULL keys, which match nothing, are left out."""
    row = F.struct(*[F.col(c) for c in columns])
    groups = right.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.min(row).alias("__least"), F.max(row).alias("__most"), F.count(F.lit(1)).alias(matches))
    return groups.select(key, *[F.col(f"__least.{c}").alias(c) for c in columns], matches,
                         (~F.col("__least").eqNullSafe(F.col("__most"))).alias(conflict))


def guarded_lookup(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None, right_cols: Sequence[str] = (),
                   prefix: str = "", matches: str = "matches", conflict: str = "conflict", fail_on_conflict: bool = False) -> DataFrame:
    """``left_lookup`` that keeps exactly one row per left row, whatever the
    lookup side holds, and says what it met: ``matches`` (0 when the key is not
    there) and ``conflict`` (true when the key's rows differ in ``right_cols``, of
    which the smallest is taken).  With ``fail_on_conflict`` a left row that meets
    such a key fails the query."""
    rk = right_key or left_key
    side = one_per_key(right, rk, right_cols, "__matches", "__conflict")
    side = side.select(F.col(rk).alias("__rk"), *[F.col(c).alias(prefix + c) for c in right_cols], "__matches", "__conflict")
    joined = left.join(side, left[left_key] == side["__rk"], "left")
    differ = F.coalesce("__conflict", F.lit(False))
    if fail_on_conflict:
        said = F.concat(F.lit(f"rows of one {rk} differ: "), F.col("__rk").cast("string"))
        differ = F.when(differ, F.raise_error(said).cast("boolean")).otherwise(False)
    return joined.select(*[F.col(f"`{c}`") for c in left.columns], *[F.col(f"`{prefix}{c}`") for c in right_cols],
                         F.coalesce("__matches", F.lit(0).cast("long")).alias(matches), differ.alias(conflict))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None,
            ignore_null: bool = True) -> DataFrame:
    """Child rows whose key has no parent row (a left anti join).  NULL child
    keys are not orphans when ``ignore_null`` (an unknown key is not a broken
    reference)."""
    pk = parent_key or child_key
    c = child.filter(F.col(child_key).isNotNull()) if ignore_null else child
    p = parent.select(F.col(pk).alias("__pk")).filter(F.col("__pk").isNotNull())
    return c.join(p, c[child_key] == p["__pk"], "left_anti")


def hot_keys(df: DataFrame, key: str, min_share: float) -> DataFrame:
    """The keys that hold at least ``min_share`` of the rows of ``df``: at most
    1 / min_share of them.  Counts are combined in the map tasks, written once,
    and serve for the total and the list."""
    if not 0 < min_share <= 1:
        raise ValueError(f"min_share must be above 0 and at most 1, not {min_share}")
    counts = materialize(df.groupBy(key).agg(F.count(F.lit(1)).alias("__n")), "hot-keys")
    total = counts.agg(F.sum("__n")).first()[0] or 0                # one number
    return counts.filter((F.col("__n") >= F.lit(min_share * total)) & F.col(key).isNotNull()).select(key)


def salted_left_lookup(left: DataFrame, right: DataFrame, key: str, salts: int = 16,
                       min_share: float | None = None, counted: DataFrame | None = None) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` that stays balanced when a few keys
    hold a large share of ``left``, without AQE.

    Keys holding at least ``min_share`` of the rows of ``counted`` (``left``
    itself by default; pass the frame before a fan-out when there is one) are
    split: each left row of such a key gets a salt from a hash of its columns
    and its partition, so rows that are identical spread too, and the key's
    right rows are repeated once per salt.  Every left row still meets exactly
    the right rows it would have met; other keys keep salt 0, except NULL keys,
    which match nothing and are spread as well.  ``min_share`` is 1 / (4 *
    salts) by default; it bounds the list of hot keys, which is broadcast."""
    share = 1.0 / (4 * salts) if min_share is None else min_share
    hot = F.broadcast(hot_keys(left if counted is None else counted, key, share).withColumn("__hot", F.lit(True)))
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns], F.spark_partition_id()), F.lit(salts))
    # NULL keys never match, so spreading them is free (and NULL is a common hot key)
    spread = F.col("__hot") | F.col(key).isNull()
    lft = (left.join(hot, key, "left")
               .withColumn("__salt", F.when(spread, salt).otherwise(F.lit(0).cast("long")))
               .drop("__hot"))
    # semi and anti joins: the planner takes them to be no larger than ``right``, so a small side can still be broadcast
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
    rgt = right.join(hot, key, "left_semi").withColumn("__salt", every).unionByName(
        right.join(hot, key, "left_anti").withColumn("__salt", F.lit(0).cast("long")))
    return lft.join(rgt, [key, "__salt"], "left").drop("__salt")
