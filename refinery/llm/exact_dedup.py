"""Exact duplicates by progressive refinement, in DataFrame operations only.

Rows are grouped by length first; rows whose length occurs again are grouped
by a hash of their first bytes; only rows that still share a group have their
whole content hashed.  The first two steps run on counts per (length, prefix
hash), combined in the map tasks before they are shuffled, so a text or a
length that makes up a third of the table is one row per task and prefix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import numbered
from refinery.session import materialize

PREFIX_CHARS = 64


def refine(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
           prefix_chars: int = PREFIX_CHARS, digest_all: bool = False) -> DataFrame:
    """One row per input row: ``id``, ``row`` (unique), ``n_bytes``,
    ``content_hash`` (sha256, null for rows that an earlier step proved
    unique), ``keep_id``, ``group_size``, ``kept``, and ``digest`` (the same
    sha256; with ``digest_all`` also of the rows that need none to be told apart).

    A null text counts as empty.  Of equal texts the row with the largest id
    stays; null ids are smaller than all others, and of rows that share both
    text and id exactly one stays.  Only the id and the text are used, other
    columns may have any name."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).alias("id"), text.alias("text"))

    # 1 length, 2 prefix hash: one count of both, whose sums are the counts by length
    counts = materialize(rows.groupBy(F.octet_length("text").alias("n_bytes"),
                                      F.xxhash64(F.substring("text", 1, prefix_chars)).alias("prefix"))
                         .agg(F.count(F.lit(1)).alias("n")), "refine-counts")
    lengths = counts.groupBy("n_bytes").agg(F.sum("n").alias("n")).filter("n > 1").select("n_bytes")
    shared = materialize(counts.filter("n > 1").join(lengths, "n_bytes", "left_semi").select("n_bytes", "prefix"), "refine-groups")

    # 3 full content, of the rows that are left in a group
    survivor = F.col("again").isNotNull()
    wide = rows.withColumns({"n_bytes": F.octet_length("text"),
                             "prefix": F.xxhash64(F.substring("text", 1, prefix_chars))})
    hashed = wide.join(shared.withColumn("again", F.lit(True)), ["n_bytes", "prefix"], "left")
    hashed = numbered(hashed, {"id": F.col("id"), "n_bytes": F.col("n_bytes").cast("long"),
                               "survivor": survivor, "digest": F.sha2("text", 256) if digest_all else F.when(survivor, F.sha2("text", 256))}, "refine-hashed")
    groups = hashed.filter("survivor").groupBy(F.col("digest").alias("content_hash"), F.col("n_bytes").alias("bytes")).agg(
        F.max(F.struct("id", "row")).alias("last"), F.count(F.lit(1)).alias("n"))
    joined = hashed.join(groups, F.col("survivor") & (F.col("digest") == F.col("content_hash"))
                         & (F.col("n_bytes") == F.col("bytes")), "left")
    alone = F.col("n").isNull()
    return joined.select(
        "id", "row", "n_bytes", "content_hash",
        F.when(alone, F.col("id")).otherwise(F.col("last.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("last.row") == F.col("row"))).alias("kept"), "digest")
