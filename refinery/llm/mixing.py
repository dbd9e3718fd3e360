"""Mix sources to target weights by capped water-filling.

Each source's target is its weight's share of all words, but never more than
``max_epochs`` times what the source holds; the excess is shared again by
weight until no target is above its cap.  A target of 2.4 times the source's
size then means: every document twice, and a seeded 40 % of the words a third
time.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refinery.llm.common import numbered
from refinery.session import materialize

ROWS_PER_BUCKET = 5_000


def thirds(position: Column) -> Column:
    """Weights 1, 2, 3, 1, 2, 3, ... by the source's position (from 0)."""
    return (position % 3 + 1).cast("double")


def water_fill(sources: DataFrame, max_epochs: float) -> DataFrame:
    """Add ``target`` to ``sources`` (source, size, weight).  With level L a
    source gets min(L * weight, cap); each round takes the sources above their
    cap out and shares the rest anew, until a round takes out none.  Only two
    sums and a count come to the driver per round."""
    total = sources.agg(F.sum("size")).first()[0] or 0
    cap = F.col("size") * F.lit(float(max_epochs))
    level, capped = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > cap
        free, held, n = sources.agg(F.sum(F.when(~over, F.col("weight")).otherwise(0.0)),
                                    F.sum(F.when(over, cap).otherwise(0.0)),
                                    F.sum(over.cast("long"))).first()
        if n == capped or not free:
            break
        capped, level = n, (total - held) / free
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), cap))


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
        weight_of: Callable[[Column], Column] = thirds, max_epochs: float = 3.0, seed: int = 17,
        rows_per_bucket: int = ROWS_PER_BUCKET, row_column: str | None = None) -> DataFrame:
    """One row per document: ``row``, ``id``, ``source``, ``size`` (words),
    ``source_size``, ``target``, ``times`` (how often the mix takes it).

    Sources are in code point order with null last; null is a source like the
    others.  ``row`` is ``row_column`` (a unique number) or, without it, made
    here.  A null or empty text has no words; it follows its place in the
    seeded order.  Repeated rows are documents of their own.

    The fractional repetition takes a source's documents in a seeded hash
    order until its words are near the target.  The order is cut into hash
    buckets: bucket totals find the bucket in which the cut lies, and only
    that bucket's rows (about ``rows_per_bucket``) are gone through one by one,
    so a source with a third of all rows is no one task's work.  The same
    input gives the same mix."""
    size = F.regexp_count(F.coalesce(F.col(text_column), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    draw = F.xxhash64(F.lit(seed), F.col(id_column), F.xxhash64(F.col(text_column)))
    columns = {"id": F.col(id_column), "source": F.col(source_column), "size": size, "draw": draw}
    if row_column is None:
        rows = numbered(docs, columns, "mix-rows")
    else:
        rows = materialize(docs.select(*[c.alias(n) for n, c in columns.items()], F.col(row_column).alias("row")), "mix-rows")

    per_source = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
    ordered = Window.orderBy(F.col("source").asc_nulls_last())          # one row per source
    sources = materialize(per_source.withColumn("weight", weight_of(F.row_number().over(ordered) - 1)), "mix-sources")
    plan = materialize(_plan(sources, max_epochs, rows_per_bucket), "mix-plan")

    spread = rows.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    spread = spread.withColumn("bucket", F.pmod(F.shiftright("draw", 20), F.col("buckets")))

    # in which bucket the seeded order reaches the fractional target
    totals = spread.groupBy("source", "bucket", "extra").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    cuts = materialize(totals.filter((F.col("before") < F.col("extra")) & (F.col("before") + F.col("words") >= F.col("extra")))
                       .groupBy("source").agg(F.min(F.struct("bucket", "before")).alias("cut"))
                       .select("source", "cut.bucket", "cut.before"), "mix-cuts")
    marked = spread.join(cuts.select(F.col("source").alias("s"), F.col("bucket").alias("cut"), "before"),
                         F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    edge = (marked.filter(F.col("bucket") == F.col("cut")).groupBy("source")
            .applyInPandas(fill_edge, marked.withColumn("more", F.lit(0).cast("long")).schema))
    # without a cut the extra words are none, or (up to rounding) all of the source
    rest = marked.filter(F.col("cut").isNull() | (F.col("bucket") != F.col("cut"))).withColumn(
        "more", F.when(F.col("cut").isNotNull(), F.col("bucket") < F.col("cut")).otherwise(F.col("extra") > 0).cast("long"))
    cols = ["row", "id", "source", "size", "source_size", "target", (F.col("whole") + F.col("more")).alias("times")]
    return rest.select(*cols).unionByName(edge.select(*cols))


def fill_edge(bucket: pd.DataFrame) -> pd.DataFrame:
    """``more`` = 1 for the documents of a cut bucket that the fractional
    repetition takes: in seeded order each one that still fits, then the one
    that brings the sum nearer to the target, if there is one."""
    bucket = bucket.sort_values(["draw", "id", "row"]).assign(more=0)
    gap = bucket["extra"].iloc[0] - bucket["before"].iloc[0]
    sizes, take = bucket["size"].to_numpy(), np.zeros(len(bucket), np.int64)
    for i, n in enumerate(sizes):
        if n <= gap:
            take[i], gap = 1, gap - n
    rest = np.flatnonzero((take == 0) & (sizes < 2 * gap))
    if len(rest):
        take[rest[np.argmin(np.abs(sizes[rest] - gap))]] = 1
    return bucket.assign(more=take)


def _plan(sources: DataFrame, max_epochs: float, rows_per_bucket: int) -> DataFrame:
    """Per source: target, whole repetitions, words of the fractional one, and
    into how many buckets its rows are cut."""
    filled = water_fill(sources, max_epochs)
    whole = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size") + 1e-12)).otherwise(0).cast("long")
    filled = filled.withColumn("whole", whole)
    left = F.col("target") - F.col("whole") * F.col("size")
    return filled.select("source", F.col("size").alias("source_size"), "target", "whole",
                         F.when(left >= 0.5, left).otherwise(0.0).alias("extra"),         # sizes are whole words
                         F.ceil(F.col("n") / rows_per_bucket).alias("buckets"))
