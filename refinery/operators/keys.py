"""Surrogate keys and version selection.

``dense_key`` gives the same numbers as ``ROW_NUMBER() OVER (ORDER BY ...)``
over the whole table, without that window's single partition and without
Python:

1. the input is written once with a row number, which the write fixes; as the
   last sort column it makes the order total, so even a large group of
   identical rows is split across partitions (skipped when the order columns
   are already unique);
2. the rows are range-partitioned and sorted on the full order, and each gets
   its partition and its position there;
3. that result is written as Parquet under the shared checkpoint folder, so
   partitions and positions are fixed facts even if executors are lost later;
4. the partitions' sizes (one number per partition) become offsets by a running
   sum, and key = offset + position + 1.

The keyed rows are thus a projection of a scan, which the planner sizes from the
written bytes; a join with the offsets would multiply the two sizes, and no
lookup of the keys would ever be small.

Rows are carried through unchanged: nothing is grouped by value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refinery.session import materialize

_ROW = "__row"
_PID = "__part"
_BEFORE = "__before"
_OFF = "__offset"
_POS, _NTH = "__pos", "__nth"


def sort_columns(df: DataFrame, order_by: Sequence[Column | str], tiebreak: Sequence[str] | None) -> list[Column]:
    """The full order: the requested columns, then the tie-break (default all
    other columns), NULLs first."""
    named = [o for o in order_by if isinstance(o, str)]
    exprs = [F.col(o).asc_nulls_first() if isinstance(o, str) else o for o in order_by]
    rest = tiebreak if tiebreak is not None else [c for c in df.columns if c not in named]
    exprs += [F.col(f"`{c}`").asc_nulls_first() for c in rest if c not in named]
    return exprs


def ranked_partitions(df: DataFrame, order_by: Sequence[Column | str], tiebreak: Sequence[str] | None = None,
                      distinct: bool = False) -> DataFrame:
    """Step 2 of ``dense_key``: the rows range-sorted, each with its partition
    and its position there.  Must be materialised before use (both are only
    meaningful for this one evaluation)."""
    sort = sort_columns(df, order_by, [] if distinct and tiebreak is None else tiebreak)
    pid = F.spark_partition_id()
    position = F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)
    return df.orderBy(*sort).select("*", pid.alias(_PID), position.alias(_BEFORE))


def dense_key(df: DataFrame, order_by: Sequence[Column | str], key: str,
              tiebreak: Sequence[str] | None = None, distinct: bool = False) -> DataFrame:
    """Add ``key`` (BIGINT, 1..N, dense, no gaps) in the global order
    ``order_by`` + ``tiebreak`` (default: all other columns, ascending, NULLs
    first).  Rows that are equal in every column are interchangeable and get
    consecutive keys.  Output: ``key`` followed by the input columns.

    ``distinct=True`` states that ``order_by`` already holds a unique key (no
    two rows share it): the first write is skipped."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    rows = df
    if not distinct:
        rows = materialize(df.withColumn(_ROW, F.monotonically_increasing_id()), "dense-key-rows")
        if tiebreak is not None:
            tiebreak = [*tiebreak, _ROW]
    tagged = materialize(ranked_partitions(rows, order_by, tiebreak, distinct), "dense-key")
    sizes = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias("__size"))
    upto = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(sizes.select(_PID, F.coalesce(F.sum("__size").over(upto), F.lit(0)).alias(_OFF)), "dense-key-offsets")
    before = {r[_PID]: r[_OFF] for r in offsets.collect()}                   # one number per range partition
    at = F.expr(f"array({', '.join(f'{before.get(p, 0)}L' for p in range(max(before, default=0) + 1))})")
    return tagged.select((F.coalesce(F.get(at, F.col(_PID)), F.lit(0)) + F.col(_BEFORE) + 1).cast("long").alias(key), *cols)


def kept_key(df: DataFrame, identity: Sequence[str], key: str, known: DataFrame | None = None,
             tiebreak: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``dense_key`` that survives a refresh: a row that is known keeps its key,
    others are numbered after the last one, in the order of ``identity`` and
    ``tiebreak`` (default: all other columns).  Returns the rows with ``key`` in
    front, and the map to hand in as ``known`` next time (``identity``, ``nth``,
    ``key``; it keeps the keys of rows that are gone, so no key is given twice).

    A row is known by its identity columns (NULL is a value); of several rows with
    one identity the n-th in order keeps the key of the n-th.  The keys of the map
    are 1..N without gaps.  Positions come from ``dense_key``, and what precedes an
    identity from one minimum per identity, so no group is sorted in one task."""
    placed = dense_key(df, identity, _POS, tiebreak)
    first = placed.groupBy(*identity).agg(F.min(_POS).alias("__first"))
    rows = _with_same(placed, first, identity, ["__first"]).withColumn(_NTH, (F.col(_POS) - F.col("__first") + 1).cast("long")).drop("__first")
    if known is None:
        keyed = rows.withColumn(key, F.col(_POS))
        old, last = None, 0
    else:
        old = materialize(known.select(*identity, F.col("nth").alias(_NTH), F.col(key)), "kept-keys")
        last = old.agg(F.max(key)).first()[0] or 0                    # one number
        met = materialize(_with_same(rows, old, [*identity, _NTH], [key]), "kept-rows")
        new = dense_key(met.filter(F.col(key).isNull()).select(_POS), [_POS], "__new", distinct=True)
        keyed = met.join(new.withColumnRenamed(_POS, "__at"), F.col(_POS) == F.col("__at"), "left")
        keyed = keyed.withColumn(key, F.coalesce(key, F.col("__new") + F.lit(last)).cast("long"))
    keyed = materialize(keyed.select(key, *[F.col(f"`{c}`") for c in df.columns], _NTH), "kept-keyed")
    map_columns = [*[F.col(f"`{c}`") for c in identity], F.col(_NTH).alias("nth"), F.col(key)]
    fresh = keyed.filter(F.col(key) > last).select(*map_columns)
    kept = fresh if old is None else old.select(*map_columns).unionByName(fresh)
    return keyed.drop(_NTH), kept


def _with_same(left: DataFrame, right: DataFrame, on: Sequence[str], take: Sequence[str]) -> DataFrame:
    """``left`` with ``take`` of the row of ``right`` that has the same values in
    ``on``, NULL meeting NULL (NULL columns where there is none)."""
    side = right.select(*[F.col(f"`{c}`").alias(f"__on{i}") for i, c in enumerate(on)], *take)
    same = F.lit(True)
    for i, c in enumerate(on):
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"__on{i}"))
    return left.join(side, same, "left").drop(*[f"__on{i}" for i in range(len(on))])


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                   tiebreak: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the row with the greatest ``order_by`` (NULLs count as
    oldest), ties broken by the greatest ``tiebreak`` and then by the other
    columns.  Same rows as ``row_number() OVER (PARTITION BY keys ORDER BY
    order_by DESC NULLS LAST, tiebreak DESC) = 1`` but planned as an aggregate
    (max of a struct), so each map task pre-reduces its rows per key before
    the shuffle and a hot key cannot pile up in one task."""
    rank = list(order_by) + [c for c in (tiebreak or []) if c not in order_by]
    rest = [c for c in df.columns if c not in keys and c not in rank]
    packed = rank + rest
    best = F.max(F.struct(*[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(packed)])).alias("__best")
    agg = df.groupBy(*keys).agg(best)
    pos = {c: i for i, c in enumerate(packed)}
    return agg.select(*[F.col(f"`{c}`") if c in keys else F.col(f"__best.f{pos[c]}").alias(c)
                        for c in df.columns])
