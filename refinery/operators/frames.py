"""DataFrame -> DataFrame building blocks that keep one pass over the data.

All of these are map-only (no shuffle) except ``drop_duplicates``, which is an
aggregate with map-side partial combine, and ``preview_ordered``, a bounded
top-k.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def trim_all_strings(df: DataFrame) -> DataFrame:
    """Trim blanks from both ends of every string column, in one projection
    built from the schema (a chain of withColumn calls would grow the plan
    with the number of columns).  Names, order and types are kept."""
    return df.select([
        F.trim(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, StringType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def resolve_column(df: DataFrame, name: str) -> str:
    """The actual column name matching ``name`` case-insensitively (Spark's
    default resolution); raises when it is absent."""
    exact = [c for c in df.columns if c == name]
    if exact:
        return exact[0]
    folded = [c for c in df.columns if c.lower() == name.lower()]
    if len(folded) != 1:
        raise KeyError(f"column {name!r} not found (or ambiguous) in {df.columns}")
    return folded[0]


def rename_strict(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map in one projection.  Unlike ``withColumnsRenamed``, a
    source column that is missing raises instead of being ignored, so schema
    drift in a raw extract is caught at plan time."""
    resolved = {resolve_column(df, old): new for old, new in mapping.items()}
    return df.withColumnsRenamed(resolved)


def filter_not_null(df: DataFrame, *keys: str) -> DataFrame:
    """Drop rows whose key is NULL (pushed to the scan by Catalyst)."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond)


def filter_current_rows(df: DataFrame, end_col: str = "end_date") -> DataFrame:
    """Keep rows without an end date (open versions).  Off by default in the
    product dimension: raw end dates precede their start dates in the source,
    so latest-version selection (``latest_per_key``) is the reliable rule."""
    return df.filter(F.col(end_col).isNull())


def drop_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One arbitrary row per key.  Spark plans this as an aggregate with a
    partial combine before the shuffle, so a key holding a large share of the
    rows collapses on the map side.  Use ``latest_per_key`` when the survivor
    matters."""
    return df.dropDuplicates(list(keys))


def preview_ordered(df: DataFrame, order_by: Sequence[Column | str], n: int = 10) -> DataFrame:
    """A defined preview: ``ORDER BY ... LIMIT n`` (a per-partition top-n, then
    a merge of n rows per partition; never a full sort)."""
    return df.orderBy(*order_by).limit(n)
