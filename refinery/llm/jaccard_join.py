"""Exact Jaccard join of documents on word shingles, by set-relation skipping.

1. Documents with equal shingle sets are one class; copies are not looked at
   again.
2. Prefix index: with a global order of shingles, two sets that link share a
   shingle among the first ``n - ceil(t * n) + 1`` of each.  The order is by
   hash, with shingles that are frequent among the prefixes put last (a bitmap
   of a fixed size says which; any such bitmap gives a valid order).  An index
   list holds the classes that have a shingle in their prefix, with set size
   and position, and lists with one class are dropped.
3. Block skipping: a list is cut into blocks by set size (``BAND``).  From an
   entry's size and position follows which sizes can link with it and are not
   larger than it (a late position leaves few shingles to share), and only the
   blocks of these sizes are joined with it; the other blocks are passed over
   whole.  Within a block size and position are checked once more, pair by pair.
4. Answer-level skipping: in a few rounds each class meets the leaders (first
   entries) of its lists and is compared with the most promising; if they link,
   it becomes a member of the leader's star.  In lists that are still crowded
   classes then meet, in a few rounds, some of the list's largest component, so
   that a large group falls into few components before its stars are paired.
   Then only leaders of stars of different components are compared.  A member's
   overlap with anything is at most its leader's overlap plus what the member
   does not share with the leader, so pairs of members are verified only where
   that bound leaves a link open.
   Before any comparison a parity sketch (a bit per shingle, about) bounds the
   overlap from above, so full sets are read only for pairs near a link.
5. Links give components.

All sums of work follow the input: a group of near copies costs a comparison
per member, not per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import (
    PACKED, SPACED_WORD, SpanHash, bitmap_of, bitmaps_over, buckets_for, gram_hashes, in_bitmap, lean, mix, packed, repeated,
    small_batches, text_steps, words_of,
)
from refinery.llm.components import components
from refinery.session import discard, materialize

SHINGLE = 5
SIMILARITY = (3, 4)          # 0.75 as a fraction
FREQUENT = (4, 8, 16, 64)    # numbers of classes from which a shingle comes later; two and more come after one
STAR_ROUNDS = 1
CROWD = 16                   # classes outside stars from which a list is crowded
CROWD_ROUNDS = 2
DRAWN = 64                   # members of a star that meet the leader of another first
FILTER_BITS = 27
SET_STEP = 1 << 18           # bytes of text that a task hashes at once
BAND = 1.1                   # ratio of the sizes at the ends of a block


def shingle_sets(batch: pa.RecordBatch, column: str, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct 64-bit shingle hashes) of each text.  A text of
    fewer than ``k`` words is one shingle, one without words has none."""
    for lo, hi, data, off in text_steps(batch, column, SET_STEP):
        low, starts, ends, text = words_of(data, off, SPACED_WORD)
        h = mix(SpanHash(low)(starts, ends))
        grams = gram_hashes(h, k)
        first = np.searchsorted(text, np.arange(hi - lo + 1))
        for t in range(hi - lo):
            a, b = first[t], first[t + 1]
            if b - a >= k:
                yield lo + t, np.unique(grams[a:b - k + 1])
            elif b > a:
                yield lo + t, gram_hashes(h[a:b], int(b - a)) ^ np.uint64(b - a)
            else:
                yield lo + t, np.zeros(0, np.uint64)


def class_of(shingles: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(shingles.tobytes()) - (1 << 63)


def scan(docs: DataFrame, k: int, schema: str, emit) -> DataFrame:
    """``emit(id hashes, [(row, class, set), ...])`` gives the columns of a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                yield emit(part, [(i, class_of(s), s) for i, s in shingle_sets(part, "text", k)])

    return docs.mapInArrow(lambda batches: lean(run(batches)), schema)


def prefix_length(n: int, num: int, den: int) -> int:
    return n - -(-num * n // den) + 1


def once(sets: list) -> list:
    """One entry per class of a batch, without the empty set."""
    seen = set()
    return [x for x in sets if len(x[2]) and not (x[1] in seen or seen.add(x[1]))]


def signed(parts: list[np.ndarray]) -> pa.Array:
    return pa.array((np.concatenate(parts) if parts else np.zeros(0, np.uint64)).view(np.int64))


def repeat(values: list[int], parts: list[np.ndarray], kind) -> pa.Array:
    return pa.array(np.repeat(np.array(values, kind), [len(p) for p in parts]))


def classes(docs: DataFrame, k: int) -> DataFrame:
    """(id, text_hash, n_shingles, class) of every row."""
    id_type = dict(docs.dtypes)["id"]

    def emit(batch, sets):
        return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text_hash"), pa.array([len(s) for _, _, s in sets], pa.int64()),
                                           pa.array([c for _, c, _ in sets], pa.int64())], ["id", "text_hash", "n_shingles", "class"])

    return scan(docs, k, f"id {id_type}, text_hash long, n_shingles long, class long", emit)


def shingle_counts(docs: DataFrame, k: int, buckets: int) -> DataFrame:
    """(s, n) of the shingles that more than one class has."""
    def emit(batch, sets):
        every = [s for _, _, s in once(sets)]
        return packed(np.concatenate(every) if every else np.zeros(0, np.uint64), buckets)

    return repeated(scan(docs, k, PACKED, emit))


def final_prefix(s: np.ndarray, tiers: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Places (in hash order) of the set's prefix, rare shingles first."""
    tier = sum((in_bitmap(t, s).astype(np.int8) for t in tiers), np.zeros(len(s), np.int8))
    return np.argsort(tier, kind="stable")[:prefix_length(len(s), num, den)]


def index_entries(docs: DataFrame, k: int, num: int, den: int, tiers: list[np.ndarray]) -> DataFrame:
    """(s, class, n, position) of the prefixes, for shingles in the first of the
    bitmaps (others have no one to meet)."""
    shared = docs.sparkSession.sparkContext.broadcast(tiers)        # of a fixed size

    def emit(batch, sets):
        cls, size, parts, pos = [], [], [], []
        for _, c, s in once(sets):
            order = final_prefix(s, shared.value, num, den)
            at = np.flatnonzero(in_bitmap(shared.value[0], s[order]))
            if len(at):
                cls.append(c), size.append(len(s)), parts.append(s[order[at]]), pos.append(at)
        return pa.RecordBatch.from_arrays(
            [signed(parts), repeat(cls, parts, np.int64), repeat(size, parts, np.int32),
             pa.array((np.concatenate(pos) if pos else np.zeros(0)).astype(np.int32))], ["s", "class", "n", "position"])

    entries = scan(docs, k, "s long, class long, n int, position int", emit).distinct()
    return released(entries, "jaccard-entries", shared)


def released(df: DataFrame, name: str, *sent: Broadcast) -> DataFrame:
    """``df`` written; what was sent to the tasks for it is dropped everywhere."""
    out = materialize(df, name)
    for b in sent:
        b.destroy()
    return out


def sketch(s: np.ndarray) -> bytes:
    """Parity of the shingles in each of m slots, m the power of two from the set's size up."""
    m = 1 << max(6, (len(s) - 1).bit_length())
    odd = np.bincount((s & np.uint64(m - 1)).astype(np.int64), minlength=m) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def most_common(na: int, nb: int, x: bytes, y: bytes) -> int:
    """Upper bound of two sets' overlap: every odd slot of the folded
    difference holds a shingle that only one of them has."""
    a, b = sorted((np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)), key=len)
    while len(b) > len(a):
        b = b[:len(b) // 2] ^ b[len(b) // 2:]
    return (na + nb - int(np.unpackbits(a ^ b).sum())) // 2


def needed_sets(docs: DataFrame, k: int, wanted: np.ndarray, holders: np.ndarray) -> DataFrame:
    """(class, n, set, sketch) of the classes in the bitmap ``wanted``, from the
    rows whose id is in ``holders`` (the first id of a class); written."""
    sc = docs.sparkSession.sparkContext
    cls, ids = sc.broadcast(wanted), sc.broadcast(holders)          # both of a fixed size

    def emit(batch, sets):
        held = in_bitmap(ids.value, batch.column("id_hash").to_numpy(zero_copy_only=False).view(np.uint64))
        sets = once([x for x in sets if held[x[0]]])
        keep = in_bitmap(cls.value, np.array([c for _, c, _ in sets], np.int64).view(np.uint64))
        sets = [x for x, y in zip(sets, keep) if y]
        return pa.RecordBatch.from_arrays(
            [pa.array([c for _, c, _ in sets], pa.int64()), pa.array([len(s) for _, _, s in sets], pa.int32()),
             pa.array([s.tobytes() for _, _, s in sets], pa.binary()), pa.array([sketch(s) for _, _, s in sets], pa.binary())],
            ["class", "n", "set", "sketch"])

    return released(scan(docs, k, "class long, n int, set binary, sketch binary", emit), "jaccard-sets", cls, ids)


def both_sides(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` with each side's size and set."""
    for c in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("class").alias(c), F.col("n").alias(f"n{c}"), F.col("set").alias(f"s{c}")), c)
    return pairs


def bounded(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """(a, b, na, nb, common) of pairs of classes; ``common`` is an upper bound."""
    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb, sa, sb = (batch.column(c).to_pylist() for c in ("na", "nb", "sa", "sb"))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("a", "b", "na", "nb")],
                                              pa.array([most_common(*x) for x in zip(na, nb, sa, sb)], pa.int64())],
                                             ["a", "b", "na", "nb", "common"])

    return both_sides(pairs.select("a", "b"), sketches).mapInArrow(bound, "a long, b long, na int, nb int, common long").distinct()


def links(common, na, nb, num: int, den: int):
    return common * (num + den) >= (na + nb) * num


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, na, nb, common) of pairs of classes."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = ([np.frombuffer(v.as_py(), np.uint64) for v in batch.column(c)] for c in ("sa", "sb"))
            common = [len(np.intersect1d(p, q, assume_unique=True)) for p, q in zip(x, y)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("a", "b", "na", "nb")], pa.array(common, pa.int64())],
                                             ["a", "b", "na", "nb", "common"])

    return both_sides(pairs.select("a", "b"), sets).mapInArrow(count, "a long, b long, na int, nb int, common long").distinct()


class Verifier:
    """Compares pairs of the index's classes: by their sketches, and near a
    link by their sets."""

    def __init__(self, docs: DataFrame, k: int, first: DataFrame, index: DataFrame, num: int, den: int):
        self.num, self.den = num, den
        wanted = materialize(index.select("class").distinct(), "jaccard-wanted")
        holders = first.join(wanted, "class").select(F.xxhash64("first.id").alias("h"))
        written = needed_sets(docs, k, bitmap_of(wanted, "class"), bitmap_of(holders, "h"))
        self.written, self.sets = written, written.select("class", "n", "set")
        self.sketches = written.select("class", "n", F.col("sketch").alias("set"))

    def bound(self, pairs: DataFrame) -> DataFrame:
        """(a, b, na, nb, common, open): ``open`` where the bound allows a link."""
        found = bounded(pairs, self.sketches)
        return found.withColumn("open", links(F.col("common"), F.col("na"), F.col("nb"), self.num, self.den))

    def compare(self, pairs: DataFrame, name: str) -> DataFrame:
        """(a, b, na, nb, common, link) of pairs, from their sets; written."""
        found = overlaps(pairs.select("a", "b").distinct(), self.sets)
        return materialize(found.withColumn("link", links(F.col("common"), F.col("na"), F.col("nb"), self.num, self.den)), name)


def may_link(na: Column, ra: Column, nb: Column, rb: Column, num: int, den: int) -> Column:
    """Whether two sets of sizes na, nb with ra, rb shingles from a shared one on
    (itself included, the first they share) can reach the similarity."""
    return ((na * den >= nb * num) & (nb * den >= na * num)
            & (F.least(ra, rb).cast("long") * (num + den) >= (na + nb).cast("long") * num))


def stars(index: DataFrame, verify: Verifier, rounds: int) -> DataFrame:
    """(class, leader, missing) of the members of stars, where ``missing`` is
    how many of its shingles the leader lacks.

    One order of classes says who leads: the first class of a list, and of the
    leaders that a class may link with the first one it has not yet tried.  So
    a group of similar classes gathers around few leaders."""
    spark, num, den = index.sparkSession, verify.num, verify.den
    none = spark.range(0)                       # rows made in Python would start workers of another kind on every executor
    members = none.select(*[F.col("id").alias(c) for c in ("class", "leader", "missing")])
    tried = none.select(*[F.col("id").alias(c) for c in ("a", "b")])
    for _ in range(rounds):
        active = index.join(members.select("class"), "class", "left_anti")
        first = F.struct(F.xxhash64("class").alias("rank"), "class", "n", (F.col("n") - F.col("position")).alias("r"))
        top = active.groupBy("s").agg(F.min(first).alias("top"), F.count(F.lit(1)).alias("c")).filter("c > 1")
        top = top.select("s", F.col("top.class").alias("leader"), F.col("top.n").alias("ln"), F.col("top.r").alias("lr"))
        met = active.join(top, "s").filter((F.col("class") != F.col("leader")) & may_link(
            F.col("n"), F.col("n") - F.col("position"), F.col("ln"), F.col("lr"), num, den))
        met = met.select(F.col("class").alias("a"), F.col("leader").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
        best = verify.bound(met).filter("open").groupBy("a").agg(F.min(F.struct(F.xxhash64("b").alias("rank"), "b")).alias("best"))
        compared = verify.compare(best.select("a", F.col("best.b").alias("b")), "jaccard-stars")
        found = compared.filter("link")
        tried = tried.unionByName(compared.filter("not link").select("a", "b"))
        # a leader that itself joined a star in this round leads none; its followers try again
        joined = found.join(found.select(F.col("a").alias("b")), "b", "left_anti")
        members = materialize(members.unionByName(joined.select(
            F.col("a").alias("class"), F.col("b").alias("leader"), (F.col("na") - F.col("common")).alias("missing"))), "jaccard-members")
    return members


def crowd_links(index: DataFrame, verify: Verifier, members: DataFrame, rounds: int = CROWD_ROUNDS) -> DataFrame:
    """(node, root) of the classes linked by stars and, in crowded lists, by
    rounds in which a list's classes meet some of the component that has most of
    it, others each round: the fewer classes are left to ask, the more of them
    answer, so that a round's rows are about twice the lists' entries at most.
    The links are some of all."""
    num, den = verify.num, verify.den
    root = components(members.select(F.col("class").alias("a"), F.col("leader").alias("b")))
    outside = index.join(members.select("class"), "class", "left_anti")
    crowded = outside.groupBy("s").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") >= CROWD).select("s")
    crowded = index.join(crowded, "s", "left_semi").select("s", "class", "n", (F.col("n") - F.col("position")).alias("r"))
    crowded = materialize(crowded, "jaccard-crowded")
    for i in range(rounds if crowded.take(1) else 0):
        held = with_root(crowded, root, "class")
        parts = held.groupBy("s", "root").agg(F.count(F.lit(1)).alias("c"))
        main = parts.groupBy("s").agg(F.max(F.struct("c", "root")).alias("main"), F.sum("c").alias("all"))
        main = main.select("s", F.col("main.c").alias("c"), F.col("main.root").alias("main"), "all").filter("c < all")
        held = held.join(main, "s")
        chosen = F.pmod(F.xxhash64("class", "s", F.lit(i)), F.col("c")) < F.ceil(F.col("all") / (F.col("all") - F.col("c")))
        chosen = held.filter((F.col("root") == F.col("main")) & chosen).select("s", *[F.col(c).alias(f"main_{c}") for c in ("class", "n", "r")])
        met = held.filter(F.col("root") != F.col("main")).join(chosen, "s").filter(may_link(
            F.col("n"), F.col("r"), F.col("main_n"), F.col("main_r"), num, den))
        met = met.select(F.col("class").alias("a"), F.col("main_class").alias("b")).distinct()
        compared = verify.compare(verify.bound(met).filter("open"), "jaccard-crowd-links")
        edges = materialize(edges_of(root).unionByName(compared.filter("link").select("a", "b")), "jaccard-crowd-edges")
        del held, parts, main, chosen, met, root       # their shuffle files go with the next discard
        discard(compared)
        root = components(edges)
        discard(edges)
    discard(crowded)
    return root


def with_root(rows: DataFrame, root: DataFrame, column: str) -> DataFrame:
    """``rows`` with the root of the class in ``column``: itself where nothing links it."""
    named = root.select(F.col("node").alias(column), F.col("root"))
    return rows.join(named, column, "left").withColumn("root", F.coalesce("root", column))


def joined_classes(index: DataFrame, verify: Verifier, members: DataFrame) -> DataFrame:
    """(node, root) of the linked classes, from the links of the stars, those of
    crowded lists and those between stars: stars of one component are not
    compared again."""
    num, den = verify.num, verify.den
    root = crowd_links(index, verify, members)
    led = index.join(members, "class", "left").select(
        "s", F.coalesce("leader", "class").alias("star"), "n", (F.col("n") - F.col("position")).alias("r"), band(F.col("n")).alias("block"))
    lists = led.groupBy("s", "block", "star").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max("r").alias("r"))
    lists = with_root(lists, root, "star")
    apart = lists.groupBy("s").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("s")
    lists = materialize(lists.join(apart, "s", "left_semi"), "jaccard-lists")
    side = lambda t, s: t.select(*[F.col(c).alias(f"{c}_{s}") for c in t.columns])
    # the smaller partner's size is at least ``num / den`` of the entry's, and the shared rest bounds both sizes together
    least = F.ceil(F.col("low") * num / den)
    most = F.least(F.col("high").cast("long"), F.floor(F.col("r").cast("long") * (num + den) / num).cast("long") - F.col("low"))
    asking = lists.withColumns({"most": most, "own": F.col("block")}).filter(F.col("most") >= least)
    asking = asking.withColumn("block", F.explode(F.sequence(band(least), band(F.col("most")))))
    x = asking.select("s", "block", "own", *[F.col(c).alias(f"{c}_a") for c in ("star", "low", "high", "r", "root")])
    y = lists.select("s", "block", *[F.col(c).alias(f"{c}_b") for c in ("star", "low", "high", "r", "root")])
    total = (F.col("low_a") + F.col("low_b")).cast("long") * num
    open_ = ((F.col("high_a") * den >= F.col("low_b") * num) & (F.col("high_b") * den >= F.col("low_a") * num)
             & (F.least("r_a", "r_b").cast("long") * (num + den) >= total))
    once = (F.col("own") > F.col("block")) | (F.col("star_a") < F.col("star_b"))      # in one block both sides ask
    pairs = x.join(y, ["s", "block"]).filter((F.col("root_a") != F.col("root_b")) & once & open_).select(
        F.least("star_a", "star_b").alias("a"), F.greatest("star_a", "star_b").alias("b")).distinct()
    leaders = materialize(verify.bound(pairs), "jaccard-leaders")
    discard(lists)
    compared = verify.compare(leaders.filter("open"), "jaccard-leader-links")
    linked = compared.filter("link").select("a", "b")

    # members of two stars that are still apart: only where the bound leaves a link open
    root = components(edges_of(root).unionByName(linked))
    apart = leaders.filter("not open").select("a", "b", "common").unionByName(compared.filter("not link").select("a", "b", "common"))
    own = verify.sketches.select("class", "n").distinct().join(members, "class", "left").select(
        "class", "n", F.coalesce("leader", "class").alias("star"), F.coalesce("missing", F.lit(0)).alias("missing"))
    own = materialize(own, "jaccard-own")
    most = own.groupBy("star").agg(F.max("missing").alias("most"), F.min("n").alias("low"), F.count(F.lit(1)).alias("size"))
    apart = still_apart(apart, root).join(side(most, "a"), F.col("a") == F.col("star_a")).join(side(most, "b"), F.col("b") == F.col("star_b"))
    apart = apart.filter(links(F.col("common") + F.col("most_a") + F.col("most_b"), F.col("low_a"), F.col("low_b"), num, den))
    apart = materialize(apart.drop("star_a", "star_b"), "jaccard-apart")

    # a few members drawn from each star, with the other star's leader: most stars that are linked meet here
    every = own.groupBy("star").agg(F.ceil(F.count(F.lit(1)) / DRAWN).alias("every"))
    drawn = own.join(every, "star").filter(F.pmod(F.xxhash64("class", F.lit(1)), F.col("every")) == 0).drop("every")

    def facing(x: str, y: str) -> DataFrame:
        rows = apart.join(side(drawn, x), F.col(x) == F.col(f"star_{x}")).filter(F.col(f"class_{x}") != F.col(x))
        return rows.select(F.col(f"class_{x}").alias("a"), F.col(y).alias("b"))

    compared = verify.compare(verify.bound(facing("a", "b").unionByName(facing("b", "a"))).filter("open"), "jaccard-drawn")
    root = components(edges_of(root).unionByName(compared.filter("link").select("a", "b")))
    apart = materialize(still_apart(apart, root), "jaccard-apart")
    # of the stars that are still apart every two members that meet in a list, where size, position and bound leave a link open
    entries = index.select("s", "class", (F.col("n") - F.col("position")).alias("r")).join(own, "class")
    held = entries.select("s", "star").distinct()
    swap = F.col("size_a") > F.col("size_b")            # the members of the smaller star ask, those of the larger one answer
    ask = apart.select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("b"),
                       *[F.when(swap, F.col(f"{c}_a")).otherwise(F.col(f"{c}_b")).alias(f"{c}_b") for c in ("most", "low")], "common")
    met = ask.join(held.select(F.col("star").alias("a"), "s"), "a").join(held.select(F.col("star").alias("b"), "s"), ["b", "s"])
    x, y = (entries.select("s", F.col("star").alias(c), *[F.col(v).alias(f"{v}_{c}") for v in ("class", "n", "r", "missing")]) for c in ("a", "b"))
    bound = links(F.col("common") + F.col("missing_a") + F.col("missing_b"), F.col("n_a"), F.col("n_b"), num, den)
    fits = may_link(F.col("n_a"), F.col("r_a"), F.col("n_b"), F.col("r_b"), num, den)
    other = (F.col("class_a") != F.col("a")) | (F.col("class_b") != F.col("b"))     # the leaders are compared already
    some = (links(F.col("common") + F.col("missing_a") + F.col("most_b"), F.col("n_a"), F.col("low_b"), num, den)
            & (F.col("r_a").cast("long") * (num + den) >= (F.col("n_a") + F.col("low_b")).cast("long") * num))
    asking = met.join(x, ["a", "s"]).filter(some).drop("most_b", "low_b")
    rest = asking.join(y, ["b", "s"]).filter(bound & fits & other).select(
        F.col("class_a").alias("a"), F.col("class_b").alias("b")).distinct()
    more = verify.compare(verify.bound(rest).filter("open"), "jaccard-members-links")
    more = more.filter("link").select("a", "b")
    return components(edges_of(root).unionByName(more)) if more.take(1) else root


def still_apart(pairs: DataFrame, root: DataFrame) -> DataFrame:
    """The pairs of stars (a, b, ...) that are not of one component."""
    columns = pairs.columns
    for c in ("a", "b"):
        pairs = pairs.join(root.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")), c, "left")
    return pairs.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select(*columns)


def edges_of(root: DataFrame) -> DataFrame:
    return root.select(F.col("node").alias("a"), F.col("root").alias("b"))


def band(size: Column) -> Column:
    """The block that holds sets of this size."""
    return F.floor(F.log(size.cast("double")) / float(np.log(BAND))).cast("int")


def similar_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = SHINGLE,
                   similarity: tuple[int, int] = SIMILARITY, frequent: tuple[int, ...] = FREQUENT, rounds: int = STAR_ROUNDS) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``text_hash``, ``n_shingles``, ``class`` (equal
    for equal shingle sets), ``component`` (the smallest id that links reach)
    and ``component_text`` (the text hash of that row).

    Words are runs without ASCII white space, A-Z in lower case.  A null or
    empty text has no shingles and its row is alone.  Rows may repeat; null ids
    never name a component unless all its ids are null.  Sets are compared by
    64-bit shingle hashes and classes by a 64-bit hash of the set."""
    with small_batches(docs.sparkSession):
        return _similar_groups(docs, id_column, text_column, k, similarity, frequent, rounds)


def _similar_groups(docs: DataFrame, id_column: str, text_column: str, k: int, similarity: tuple[int, int],
                    frequent: tuple[int, ...], rounds: int) -> DataFrame:
    num, den = similarity
    docs = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.xxhash64(id_column).alias("id_hash"),
                       F.xxhash64(text_column).alias("text_hash"))
    rows = materialize(classes(docs, k), "jaccard-rows")
    lowest = F.min(F.struct(F.col("id").isNull().alias("null"), "id", "text_hash"))
    first = materialize(rows.filter("n_shingles > 0").groupBy("class").agg(lowest.alias("first")), "jaccard-classes")

    shingles = rows.agg(F.sum("n_shingles")).first()[0] or 0
    counts = materialize(shingle_counts(docs, k, buckets_for(shingles)), "jaccard-counts")
    tiers = [bitmap_of(counts, "s", FILTER_BITS), *bitmaps_over(counts, "s", "n", frequent)]
    discard(counts)
    entries = index_entries(docs, k, num, den, tiers)
    del tiers                    # some 50 MB of the driver
    pa.default_memory_pool().release_unused()
    several = entries.groupBy("s").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("s")
    index = materialize(entries.join(several, "s"), "jaccard-index")
    del several
    discard(entries)

    verify = Verifier(docs, k, first, index, num, den)
    members = stars(index, verify, rounds)
    root = joined_classes(index, verify, members)
    discard(index, verify.written, members)
    named = first.join(root, F.col("class") == F.col("node"), "left").withColumn("root", F.coalesce("root", "class"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component"))
    label = named.join(smallest, "root").select("class", "component")
    full, some = rows.join(label, "class", "left"), F.col("n_shingles") > 0
    return full.select("id", "text_hash", "n_shingles", "class",
                       F.when(some, F.col("component.id")).otherwise(F.col("id")).alias("component"),
                       F.when(some, F.col("component.text_hash")).otherwise(F.col("text_hash")).alias("component_text"))
