"""Shards balanced in bytes, tokens and rows at once, by vector bin packing.

An item is a group of equal texts; its size is a vector (bytes, tokens, rows).
Each item goes to the shard whose residual capacity has the highest dot product
with it.  Two levels keep that parallel:

* Items over a set share of a shard's capacity in some dimension are few by
  arithmetic: with share s, at most ``3 * shards / s`` of them exist.  They
  are placed first, in one small step.  A group stays whole as long as one
  shard can hold it; only a group that exceeds a whole shard's capacity (the
  mean of all shards) in some dimension is split, into pieces of about
  ``piece_share`` of a shard by a hash of its rows' ids.
* All other items are hash-spread over cells.  Every cell fills an equal part
  of what the large items left of each shard, largest items first, so the
  cells' loads add up to balanced shards.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refinery.llm.common import numbered
from refinery.session import materialize

LARGE_SHARE = 1 / 100      # of a shard's capacity: placed one by one beforehand
PIECE_SHARE = 1 / 10       # of a shard's capacity: a piece of a group that no shard can hold
CELL_ITEMS = 5_000         # items in a cell, about
SLOT_ROWS = 20_000         # rows that one window task numbers, about
DIMS = ("bytes", "tokens", "rows")


def place(sizes: np.ndarray, capacity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shard of each item (rows of ``sizes``, already scaled to a shard's
    capacity) and the residual capacity left.  Larger items choose first."""
    left = capacity.copy()
    shard = np.zeros(len(sizes), np.int32)
    # a balanced item scores the mean residual; ties go to the lowest shard
    for i in np.argsort(-sizes.max(axis=1), kind="stable"):
        shard[i] = best = int(np.argmax(left @ sizes[i]))
        left[best] -= sizes[i]
    return shard, left


def pack(docs: DataFrame, shards: int, id_column: str = "doc_id", text_column: str = "text", overhead: int = 0,
         large_share: float = LARGE_SHARE, piece_share: float = PIECE_SHARE, cell_items: int = CELL_ITEMS,
         slot_rows: int = SLOT_ROWS) -> DataFrame:
    """One row per input row: ``row``, ``id``, ``bytes`` (UTF-8 bytes of the
    text plus ``overhead``), ``tokens`` (words), ``crc32`` of the text,
    ``shard`` (0 to shards - 1), ``slot`` (0, 1, 2, ... in its shard),
    ``pieces`` (into how many the row's group is cut, 1: whole) and
    ``split_groups`` (how many groups of the table are cut).

    A null text has no bytes and is equal to the empty text.  Ids may repeat or
    be null, each row is placed.  Shards are near equal in bytes, tokens and
    rows; an empty table gives an empty result."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = numbered(docs, {"id": F.col(id_column), "bytes": (F.octet_length(text) + overhead).cast("long"),
                           "tokens": F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"),
                           "crc32": F.crc32(text.cast("binary")), "item": F.unhex(F.md5(text.cast("binary")))}, "shard-rows")
    total = np.array([float(x or 0) for x in rows.agg(F.sum("bytes"), F.sum("tokens"), F.count(F.lit(1))).first()])
    scale = np.maximum(total / shards, 1e-9)                  # one shard's capacity

    def share(df: DataFrame):                                 # largest share of a shard in any dimension
        return F.greatest(*[F.col(d) / F.lit(float(s)) for d, s in zip(DIMS, scale)])

    sums = [F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    whole = materialize(rows.groupBy("item").agg(*sums), "shard-items")
    big = whole.filter(share(whole) > 1).select("item", F.ceil(share(whole) / piece_share).alias("pieces"))
    big = materialize(big, "shard-big")                       # fewer than 3 * shards rows
    rows = rows.join(big, "item", "left").withColumn(
        "piece", F.when(F.col("pieces").isNull(), 0).otherwise(F.pmod(F.xxhash64("id", "row"), F.col("pieces"))).cast("long"))
    pieces = rows.filter(F.col("pieces").isNotNull()).groupBy("item", "piece").agg(*sums)
    items = whole.join(big, "item", "left_anti").withColumn("piece", F.lit(0).cast("long")).unionByName(pieces)
    items = materialize(items, "shard-pieces")

    # the large ones: their number is bounded by large_share, whatever the input
    large = items.filter(share(items) > large_share).orderBy("item", "piece").toPandas()
    shard, left = place(large[list(DIMS)].to_numpy(float) / scale, np.ones((shards, 3)))
    large["shard"] = shard
    placed = spark.createDataFrame(large[["item", "piece", "shard"]].astype({"shard": int}).values.tolist() if len(large) else [],
                                   "item binary, piece long, shard int")

    small = items.filter(share(items) <= large_share)
    cells = max(1, -(-small.count() // cell_items))
    room = left / cells
    names = list(DIMS)

    def fill(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values(["item", "piece"], kind="stable")
        to, _ = place(cell[names].to_numpy(float) / scale, room)
        return pd.DataFrame({"item": cell["item"], "piece": cell["piece"], "shard": to})

    packed = (small.withColumn("cell", F.pmod(F.xxhash64("item", "piece"), F.lit(cells))).groupBy("cell")
              .applyInPandas(fill, "item binary, piece long, shard int"))
    placement = materialize(packed.unionByName(placed), "shard-placement")
    out = materialize(rows.join(placement, ["item", "piece"])
                      .select("row", "id", "bytes", "tokens", "crc32", "shard", F.coalesce("pieces", F.lit(1)).cast("long").alias("pieces"),
                              F.lit(big.count()).cast("long").alias("split_groups")), "shard-placed")
    return slots(out, slot_rows)


def slots(placed: DataFrame, slot_rows: int) -> DataFrame:
    """Add ``slot``: 0, 1, 2, ... within each shard without gaps.  A shard is
    cut into hash buckets; a bucket's rows are numbered in one window task and
    start after the earlier buckets' rows."""
    buckets = max(1, -(-placed.count() // slot_rows))
    cut = placed.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    counts = cut.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    start = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    at = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("id", "row")) - 1
    return (cut.withColumn("at", at).join(start, ["shard", "bucket"])
            .withColumn("slot", F.col("start") + F.col("at")).drop("bucket", "at", "start"))


def balance(packed: DataFrame) -> DataFrame:
    """Bytes, tokens and rows of each shard, for a look at the balance."""
    return packed.groupBy("shard").agg(F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"),
                                       F.count(F.lit(1)).alias("rows")).orderBy("shard")


