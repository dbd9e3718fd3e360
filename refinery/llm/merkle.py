"""Merkle manifest of a table: a leaf per row, a tree per group, a tree over the groups.

Leaves of a group ascend by id; every ``FANOUT`` consecutive nodes become one
node until one is left.  Nobody sorts the rows for that.  A row's place is a
rank query on a bitmap index:

1. ids become bits of 64-bit words, merged per (group, word) with ``bit_or`` in
   the map tasks; only words with a set bit exist, which is the compression;
2. a popcount directory adds, level by level over up to 2^10 or 2^16 neighbours,
   how many leaves lie before a word (``_SHIFTS``).  Each level's sums go up as
   one row per parent, so no window ever sees more than 65,537 rows, whatever
   the size of the group and however sparse its ids;
3. rank = directory entry + bits below the id's own in its word.

The rank gives coordinates (run, slot).  Each run is an array of at most
``FANOUT`` slots, gathered by the key (group, run), and each level is a sixteenth
of the one below.  Going back down, every run hands its nodes the siblings to
the left and right on the way to the root: that is a leaf's inclusion proof.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refinery.operators.keys import dense_key
from refinery.session import discard, materialize

_LOG = 4
FANOUT = 1 << _LOG
# Bits from one directory level to the next: words of 64 ids, then 2^16, 2^32 and 2^48 ids; above that the group.
_SHIFTS = (10, 16, 16)
_PATH = "array<struct<left: string, right: string>>"


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def ranked(rows: DataFrame, group: str, value: str, weight: str) -> DataFrame:
    """``rows`` with ``before``, the sum of ``weight`` over the rows of the same
    group (a column without nulls) with a smaller ``value`` (long, null first),
    ``equal``, the sum over those with the same value, and ``total``, the sum
    over the group: rank queries on a bitmap and its popcount directory."""
    # a null value has a word of its own before that of the smallest long
    word = F.coalesce(F.shiftright(value, 6), F.lit(-(1 << 57) - 1)).alias("c")
    bit_no = F.coalesce(F.col(value).bitwiseAND(63), F.lit(0).cast("long")).cast("int").alias("bit_no")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit_no"))
    values = rows.groupBy(F.col(group).alias("grp"), word, bit_no).agg(F.sum(weight).alias("w"))
    # the bits, and of values with more than one row what a popcount does not tell
    more = F.collect_list(F.when(F.col("w") > 1, F.struct("bit_no", (F.col("w") - 1).alias("more"))))
    words = values.groupBy("grp", "c").agg(F.bit_or(bit).alias("bits"), more.alias("extra"), F.sum("w").alias("w"))
    levels = [materialize(words, "merkle-words")]
    for shift in _SHIFTS:
        up = levels[-1].groupBy("grp", F.shiftright("c", shift).alias("c")).agg(F.sum("w").alias("w"))
        levels.append(materialize(up, "merkle-directory"))
    # downwards: what lies before a word is what lies before its parent and in its elder siblings
    known = levels[-1].groupBy("grp").agg(F.sum("w").alias("total")).select(
        "grp", F.lit(0).cast("long").alias("parent"), F.lit(0).cast("long").alias("base"), "total")
    for depth in range(len(levels) - 1, -1, -1):
        parent = F.shiftright("c", _SHIFTS[depth]) if depth < len(_SHIFTS) else F.lit(0).cast("long")
        elder = F.sum("w").over(Window.partitionBy("grp", "parent").orderBy("c").rowsBetween(Window.unboundedPreceding, -1))
        told = levels[depth].withColumn("parent", parent).withColumn("elder", F.coalesce(elder, F.lit(0)))
        told = told.join(known, ["grp", "parent"])
        known = told.select("grp", F.col("c").alias("parent"), (F.col("base") + F.col("elder")).alias("base"), "total",
                            *(["bits", "extra"] if depth == 0 else []))
    directory = materialize(known.withColumnRenamed("parent", "c"), "merkle-directory")

    query = rows.select("*", F.col(group).alias("grp"), word, bit_no).join(directory, ["grp", "c"])
    lower = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), F.col("bit_no")))
    below = F.bit_count(F.col("bits").bitwiseAND(lower))
    zero = F.lit(0).cast("long")
    less = F.reduce(F.filter("extra", lambda x: x["bit_no"] < F.col("bit_no")), zero, lambda a, x: a + x["more"])
    here = F.reduce(F.filter("extra", lambda x: x["bit_no"] == F.col("bit_no")), zero, lambda a, x: a + x["more"])
    out = materialize(query.select(*rows.columns, (F.col("base") + below + less).alias("before"), (here + 1).alias("equal"), "total"),
                      "merkle-ranked")
    discard(directory, *levels)
    return out


def placed(leaves: DataFrame) -> DataFrame:
    """Leaves (g, id, digest, altered) with ``place``, their number in the group,
    and ``total``.  Leaves of equal ids are in the order of the first 15 hex digits
    of their digests; rows with the same digest are interchangeable."""
    names = ["g", "id", "digest", "altered", "copies"]
    once = materialize(leaves.groupBy(*names[:4]).agg(F.count(F.lit(1)).alias("copies")), "merkle-once")
    by_id = ranked(once, "g", "id", "copies")
    tied = F.col("equal") > F.col("copies")
    order = by_id.filter(~tied).select(*names, "before", "total")
    if by_id.filter(tied).take(1):
        same = by_id.filter(tied).select(*names, F.col("before").alias("start"), F.col("total").alias("size"),
                                         F.concat("g", F.lit("/"), encoded(F.col("id"))).alias("tie"),
                                         F.conv(F.substring("digest", 1, 15), 16, 10).cast("long").alias("digits"))
        within = ranked(same, "tie", "digits", "copies")
        order = order.unionByName(within.select(*names, (F.col("start") + F.col("before")).alias("before"), F.col("size").alias("total")))
    places = F.explode(F.sequence("before", F.col("before") + F.col("copies") - 1)).alias("place")
    return order.select("g", places, "total", "digest", "id", "altered")


def reduced(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Every level's runs (g, run, total, kids, digest), the lowest first, from
    nodes (g, place, total, digest and what else a node carries).  A group of one
    node has one run, which hands the node on unhashed."""
    def runs_of(level: DataFrame, place: str, carried: list[str]) -> DataFrame:
        kid = F.struct(F.col(place).bitwiseAND(FANOUT - 1).alias("slot"), "digest", *carried)
        kids = level.groupBy("g", F.shiftright(place, _LOG).alias("run"), "total").agg(F.sort_array(F.collect_list(kid)).alias("kids"))
        joined = F.sha2(F.array_join("kids.digest", ""), 256)
        return kids.withColumn("digest", F.when(F.col("total") == 1, F.col("kids")[0]["digest"]).otherwise(joined))

    levels = [materialize(runs_of(nodes, "place", [c for c in nodes.columns if c not in ("g", "place", "total", "digest")]),
                          f"merkle-{name}-0")]
    while (more := levels[-1].filter(F.col("total") > FANOUT ** len(levels))).take(1):
        levels.append(materialize(runs_of(more, "run", []), f"merkle-{name}-{len(levels)}"))
    return levels


def last_nodes(levels: list[DataFrame]) -> DataFrame:
    """(g, digest): the node that is left of each group."""
    ends = [runs.filter(F.col("total") <= FANOUT ** (i + 1)).select("g", "digest") for i, runs in enumerate(levels)]
    out = ends[0]
    for e in ends[1:]:
        out = out.unionByName(e)
    return out


def proven(levels: list[DataFrame], above: DataFrame, name: str) -> DataFrame:
    """The nodes below the lowest runs: g, ``kid`` (digest and what it carries),
    the other columns of ``above`` and ``path``, the digests to the left and right
    at each step up.  ``above`` (g, path, ...) goes on from each group's last node."""
    rest = [c for c in above.columns if c not in ("g", "path")]
    i = F.col("at")
    step = F.struct(F.array_join(F.slice("kids.digest", F.lit(1), i), "").alias("left"),
                    F.array_join(F.slice("kids.digest", i + 2, F.lit(FANOUT)), "").alias("right"))
    path = F.when(F.col("total") == 1, F.col("path")).otherwise(F.concat(F.array(step).cast(_PATH), F.col("path")))
    nodes = None
    for depth in range(len(levels) - 1, -1, -1):
        ends = levels[depth].filter(F.col("total") <= FANOUT ** (depth + 1)).select("g", "run").join(above, "g")
        up = ends if nodes is None else ends.unionByName(nodes)
        kids = levels[depth].join(up, ["g", "run"]).select("g", "run", "total", "path", "kids", *rest,
                                                          F.explode(F.sequence(F.lit(0), F.size("kids") - 1)).alias("at"))
        if depth == 0:
            return kids.select("g", F.col("kids")[i].alias("kid"), path.alias("path"), *rest)
        place = (F.col("run") * FANOUT + i).alias("run")
        nodes = materialize(kids.select("g", place, path.alias("path"), *rest), f"merkle-{name}-paths-{depth}")


def manifest(docs: DataFrame, id_column: str, group_column: str, leaf: Column, altered: Column | None = None) -> DataFrame:
    """One row per input row: ``id``, ``leaf``, ``subroot`` of its group, ``root``,
    ``path`` (the digests left and right of it, step by step to the root) and
    ``altered``: another leaf hash to try against the path (null: none).

    A null group is a group, the first one; groups follow in the order of their
    UTF-8 bytes.  Ids are longs; a null id comes before all others, rows that
    share an id are ordered by their leaves, and rows that repeat as a whole have
    leaves of their own.  An empty table gives no rows.  Only the named columns
    and what ``leaf`` and ``altered`` read are used."""
    other = F.lit(None).cast("string") if altered is None else altered
    leaves = materialize(docs.select(encoded(F.col(group_column)).alias("g"), F.col(id_column).cast("long").alias("id"),
                                     leaf.alias("digest"), other.alias("altered")), "merkle-leaves")
    levels = reduced(placed(leaves), "rows")
    # the groups are the leaves of the last tree, numbered in their order
    value = F.when(F.col("g") != "-", F.regexp_replace("g", "^[0-9]+:", "")).alias("value")
    groups = dense_key(last_nodes(levels).select(value, "g", "digest"), ["value"], "key", distinct=True)
    groups = materialize(groups.select(F.lit("").alias("g"), (F.col("key") - 1).alias("place"), "digest", F.col("g").alias("member")),
                         "merkle-groups")
    upper = reduced(groups.withColumn("total", F.lit(groups.count())), "groups")
    root = last_nodes(upper).select("g", F.array().cast(_PATH).alias("path"), F.col("digest").alias("root"))
    above = proven(upper, root, "groups").select(F.col("kid.member").alias("g"), "path", "root", F.col("kid.digest").alias("subroot"))
    return proven(levels, materialize(above, "merkle-subroots"), "rows").select(
        F.col("kid.id").alias("id"), F.col("kid.digest").alias("leaf"), "subroot", "root", "path", F.col("kid.altered").alias("altered"))


def proof_digest(path: str = "path") -> Column:
    """Hash of all siblings on the way up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(leaf: Column, path: str = "path") -> Column:
    """The root that a leaf and the siblings of a path give."""
    return F.reduce(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))
