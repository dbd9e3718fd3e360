"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from refinery.session import discard, materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; the root is the smallest node
    of its component.  Edges may repeat in either direction.  Every round is
    written, aggregates are combined in the map tasks, and a node with many
    neighbours meets only one row of minima.  ``edges`` is read a few times: hand in
    a written table."""
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v")
    now, seen = edges, None
    while True:
        # large star: every larger neighbour of a node goes to the node's smallest neighbour
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: a node and its smaller neighbours go to the smallest of them
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # two rounds that give the same edges give the same for ever; the sums are taken by the write
        sums = Observation()
        small = small.observe(sums, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))
        before, now = now, materialize(small, "components")
        del both, low, large, small
        if before is not edges:
            discard(before)
        found = sums.get
        if found == seen or not found.get("n"):
            break
        seen = found
    roots = now.select("v").distinct().select(F.col("v").alias("u"), "v")
    return now.unionByName(roots).select(F.col("u").alias("node"), F.col("v").alias("root"))
