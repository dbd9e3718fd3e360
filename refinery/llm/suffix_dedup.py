"""Repeated byte spans by distributed prefix doubling.

Every byte that lies in a ``length``-byte string which also starts elsewhere is
found, exactly, without a rank for every byte of the corpus:

1. Anchors.  Of each run of ``WINDOW`` positions the one with the smallest
   gram hash (the last of equals) is an anchor; equal strings of ``length``
   bytes have their first anchor at the same place.  ``next(p)`` is the anchor
   of the run that starts after p; it depends only on what follows p.
2. Prefix doubling over anchors.  An anchor's first rank names its first
   ``WINDOW + GRAM`` bytes.  Each round gathers the pairs (rank of p, rank of the
   anchor 1, 2, 4, ... steps on), gives equal pairs one new rank, and drops
   anchors whose pair is unique.  A pair that would reach past the bytes which
   all strings with that anchor share is left as it is.  A rank is a name (a
   64-bit hash of its pair): only equality is needed, so no rank has to be sent
   back from a sorted order, and which pairs recur comes back as a bitmap.
3. Cells.  The strings with the same anchor start next to each other; a cell is
   their union.  Cells that occur twice are repeated whole.  Only a cell that is
   unique while its rank is not (the rim of a repeated span) is looked at string
   by string, against the other cells of its rank.

The texts are scanned, never shuffled, until the end, when the rows with
something to remove meet their spans.  Cells are told apart by 128 bits; two
strings by 64 bits of their bytes and the 64 bits of their anchor's first rank.
An error in a rank could only make more of them be compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import PACKED, SpanHash, bitmap_of, buckets_for, in_bitmap, mix, packed, repeated, sent, small_batches, text_steps
from refinery.session import discard, materialize

LENGTH = 400
WINDOW, GRAM = 96, 16
RANK_BITS = 27
SEEN_CELLS = 1 << 18      # cells that a task remembers having given
_POSITION = np.uint64((1 << 31) - 1)


class Anchors:
    """Anchors of a step's texts.  All positions count from the step's start;
    ``text`` is the text number and ``begin``/``end`` are its bounds."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int, window: int = WINDOW, gram: int = GRAM):
        self.one = SpanHash(data, 1)
        reach, n = window + gram, len(data)
        m = n - reach + 2                                   # starts of runs whose grams all fit
        if m <= 0:
            self.p = self.begin = self.end = self.low = self.high = self.next = self.text = np.zeros(0, np.int64)
            self.rank = np.zeros(0, np.uint64)
            return
        at = np.arange(n - gram + 1, dtype=np.int64)
        key = (mix(self.one(at, at + gram)) & ~_POSITION) | (_POSITION - at.astype(np.uint64))
        width = 1
        while width * 2 <= window:                           # minimum of 2, 4, 8, ... positions
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        if width < window:
            key = np.minimum(key[:len(key) - (window - width)], key[window - width:])
        anchor = (_POSITION - (key & _POSITION)).astype(np.int64)[:m]
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:m]
        end = offsets[1:][text]
        size = np.diff(offsets)[text]
        a = np.flatnonzero((np.arange(m) + reach - 1 <= end) & (size >= length))
        of = anchor[a]
        new = np.flatnonzero(np.concatenate(([True], (of[1:] != of[:-1]) | (a[1:] != a[:-1] + 1))) if len(a) else np.zeros(0, bool))
        last = np.concatenate((new[1:] - 1, [len(a) - 1])) if len(a) else new
        self.p, self.low, self.text = of[new], a[new], text[a[new]]
        self.begin, self.end = offsets[self.text], offsets[self.text + 1]
        self.high = np.minimum(a[last], self.end - length)    # below ``low``: no string of full length
        ranked = self.p + reach <= self.end
        self.next = np.where(ranked, anchor[np.minimum(self.p + 1, m - 1)], -1)
        self.rank = np.where(ranked, self.one(self.p, np.minimum(self.p + reach, n)), np.uint64(0))
        keep = np.flatnonzero(ranked)
        for name in ("p", "low", "high", "begin", "end", "next", "rank", "text"):
            setattr(self, name, getattr(self, name)[keep])

    def pick(self, keep: np.ndarray) -> None:
        for name in ("p", "low", "high", "begin", "end", "next", "rank", "text"):
            setattr(self, name, getattr(self, name)[keep])


def keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(key, id, text): the key names the row's id and text."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return docs.select(F.xxhash64(F.col(id_column), text).alias("key"), F.col(id_column).alias("id"), text.alias("text"))


def scan(rows: DataFrame, length: int, schema: str, emit) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            for lo, _, data, off in text_steps(batch, "text"):
                if np.diff(off).max() >= length:
                    yield emit(keys[lo:], data, Anchors(data, off, length))

    return rows.select("key", "text").mapInArrow(run, schema)


def long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def first_ranks(rows: DataFrame, length: int, buckets: int) -> DataFrame:
    """First ranks that occur more than once, as ``s``."""
    return repeated(scan(rows, length, PACKED, lambda keys, data, a: packed(a.rank, buckets)))


ANCHORS = ("key long, pos array<int>, follows array<int>, next array<int>, rank array<long>, low array<int>, high array<int>, "
           "c1 array<long>, c2 array<long>")


def candidate_anchors(rows: DataFrame, length: int, shared: Broadcast) -> DataFrame:
    """The anchors of each text whose first rank may be repeated (bitmap
    ``shared``), with their cells, in text order: position, place of the next
    anchor in this list (-1 where it is not in it) and its position, first rank,
    cell bounds and name."""

    def emit(keys, data, a):
        a.pick(np.flatnonzero(in_bitmap(shared.value, a.rank)))
        c1, c2 = cell_hashes(a, data, length)
        texts, first = np.unique(a.text, return_index=True)
        ends = np.append(first, len(a.p))
        at = np.searchsorted(a.p, a.next)
        here = (at < len(a.p)) & (a.p[np.minimum(at, max(0, len(a.p) - 1))] == a.next)
        begin = np.repeat(first, np.diff(ends))
        lists = lambda x, t: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x.astype(t)))
        return pa.RecordBatch.from_arrays(
            [long(keys[texts]), lists(a.p - a.begin, np.int32), lists(np.where(here, at - begin, -1), np.int32),
             lists(a.next - a.begin, np.int32), lists(a.rank.view(np.int64), np.int64), lists(a.low - a.begin, np.int32),
             lists(a.high - a.begin, np.int32), lists(c1.view(np.int64), np.int64), lists(c2.view(np.int64), np.int64)],
            ["key", "pos", "follows", "next", "rank", "low", "high", "c1", "c2"])

    return scan(rows, length, ANCHORS, emit)


def cell_hashes(a: Anchors, data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name each cell: its bytes and where its anchor lies."""
    has = a.high >= a.low
    end = np.where(has, a.high + length, a.low)
    place = ((a.p - a.low).astype(np.uint64) << np.uint64(32)) | (end - a.low).astype(np.uint64)
    one = mix(a.one(a.low, end) ^ mix(place))
    return one, mix(SpanHash(data, 2)(a.low, end) + place) if len(a.p) else one


class Doubling:
    """The anchors of a batch of texts, after some rounds of doubling.

    A rank covers 2**round steps.  Whether an anchor takes part in a round
    depends only on its first ``core`` bytes: the steps of the doubled rank must
    end within them (then those of every anchor on the way do, too); otherwise
    it is ``done`` and keeps its rank.  ``size`` of a dropped anchor is how many
    of its bytes occur nowhere else."""

    def __init__(self, batch: pa.RecordBatch, core: int, first_length: int):
        flat = {c: batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in batch.schema.names if c != "key"}
        count = batch.column("pos").value_lengths().to_numpy(zero_copy_only=False)
        self.text = np.repeat(np.arange(batch.num_rows), count)
        self.flat, self.core = flat, core
        begin = np.repeat(np.cumsum(count) - count, count)
        self.pos, self.next = flat["pos"].astype(np.int64), flat["next"].astype(np.int64)
        self.follows = np.where(flat["follows"] >= 0, flat["follows"] + begin, -1)
        self.rank, n = flat["rank"].view(np.uint64), len(begin)
        self.size = np.full(n, first_length)
        self.alive, self.done, self.first_length = np.ones(n, bool), np.zeros(n, bool), first_length

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchors to look up, their rank, the rank that follows): 0 follows
        where the pair would reach too far."""
        f = self.follows
        has = f >= 0
        self.reach = self.next - self.pos + np.where(has, self.size[f], self.first_length)
        self.past = self.done | (has & self.done[f]) | (self.reach > self.core)
        self.open = np.flatnonzero(self.alive & ~self.done & (self.past | (has & self.alive[f])))
        second = np.where(self.past, np.uint64(0), self.rank[f])
        return self.open, self.rank[self.open], second[self.open]

    def apply(self, again: np.ndarray) -> None:
        """One round: ``again`` is the bitmap of the pairs that occur again."""
        at, one, two = self.pairs()
        name = pair_name(one, two)
        back = in_bitmap(again, name)
        f, new = self.follows, ~self.past
        alive = self.done.copy() & self.alive
        alive[at[back]] = True
        rank = self.rank.copy()
        rank[at] = name
        size = np.where(new, self.reach, np.where(alive, self.size, self.core))
        step = new & (f >= 0)
        self.next, self.follows = np.where(step, self.next[f], self.next), np.where(step, f[f], np.where(new, -1, f))
        self.rank, self.size, self.done, self.alive = rank, size, self.past, alive


def pair_name(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return mix(one * np.uint64(0xD6E8FEB86659FD93) + mix(two))


def shared_cells(anchors: DataFrame, core: int, first_length: int) -> DataFrame:
    """Prefix doubling to its end: (key, rank, low, high, c1, c2) of the cells
    whose anchor's rank is shared.  Each round reads the anchors, brings them up
    to date with the bitmaps of the rounds before, and hands the rank pairs to
    Spark, which finds the ones that recur by grouping."""
    spark = anchors.sparkSession
    bitmaps: list[np.ndarray] = []

    def up_to_date(batch: pa.RecordBatch, known: list[np.ndarray]) -> Doubling:
        d = Doubling(batch, core, first_length)
        for again in known:
            d.apply(again)
        return d

    while True:
        with sent(spark, bitmaps) as shared:                        # of a fixed size each

            def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    _, one, two = up_to_date(batch, shared.value).pairs()
                    yield pa.RecordBatch.from_arrays([long(one), long(two)], ["rank", "rank2"])

            pairs = anchors.mapInArrow(run, "rank long, rank2 long").groupBy("rank", "rank2").agg(F.count(F.lit(1)).alias("n"))
            again = materialize(pairs.filter("n > 1"), "suffix-pairs")
        more = bool(again.filter("rank2 <> 0").take(1))

        def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                one, two = (b.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("rank", "rank2"))
                yield pa.RecordBatch.from_arrays([long(pair_name(one, two))], ["s"])

        bitmaps.append(bitmap_of(again.select("rank", "rank2").mapInArrow(name, "s long"), "s"))
        del pairs
        discard(again)
        if not more:
            break

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = up_to_date(batch, shared.value)
            at = np.flatnonzero(d.alive & (d.flat["high"] >= d.flat["low"]))
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([long(keys[d.text[at]]), long(d.rank[at]), *[pa.array(d.flat[c][at]) for c in ("low", "high", "c1", "c2")]],
                                             ["key", "rank", "low", "high", "c1", "c2"])

    with sent(spark, bitmaps) as shared:
        return materialize(anchors.mapInArrow(cells, "key long, rank long, low int, high int, c1 long, c2 long"), "suffix-cells")


CELLS = "c1 long, c2 long, first long, lone boolean, h binary"
STRINGS = "c1 long, c2 long, first long, off int, h long, lone boolean"


def strings_of_cells(rows: DataFrame, length: int, wanted: Broadcast, lone: Broadcast) -> DataFrame:
    """The cells in the bitmap ``wanted``, a row each: the hashes of the cell's
    strings in text order (8 bytes each, so a string's place is its offset from
    the cell's start), the anchor's first rank, and whether the bitmap ``lone``
    has the cell.  A cell may come more than once."""
    seen: set[int] = set()                                          # spares most rows of hot cells; forgotten when it is large

    def emit(keys, data, a):
        a.pick(np.flatnonzero(a.high >= a.low))
        c1, c2 = cell_hashes(a, data, length)
        at = np.flatnonzero(in_bitmap(wanted.value, c1))
        names, first = np.unique(c1[at], return_index=True)
        new = [i for i, c in zip(first.tolist(), names.tolist()) if c not in seen]
        if len(seen) > SEEN_CELLS:
            seen.clear()
        seen.update(c1[at[new]].tolist())
        hit = at[np.sort(np.array(new, np.int64))]
        n = (a.high - a.low + 1)[hit]
        ends = np.concatenate(([0], np.cumsum(n)))
        at = np.repeat(a.low[hit], n) + np.arange(ends[-1]) - np.repeat(ends[:-1], n)
        h = pa.Array.from_buffers(pa.binary(), len(hit), [None, pa.py_buffer((ends * 8).astype(np.int32)), pa.py_buffer(a.one(at, at + length))])
        return pa.RecordBatch.from_arrays(
            [long(c1[hit]), long(c2[hit]), long(a.rank[hit]), pa.array(in_bitmap(lone.value, c1[hit])), h], ["c1", "c2", "first", "lone", "h"])

    return scan(rows, length, CELLS, emit)


def hashes_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(all string hashes of a batch of cells, strings of each cell)."""
    h = batch.column("h")
    return np.frombuffer(b"".join(h.to_pylist()), np.uint64), pc.binary_length(h).to_numpy(zero_copy_only=False) // 8


def repeated_strings(strings: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(hashes_of(b)[0])
            n += len(held[-1])
            if n >= 1 << 19:
                yield packed(np.concatenate(held), buckets)
                held, n = [], 0
        yield packed(np.concatenate([*held, np.zeros(0, np.uint64)]), buckets)

    return repeated(strings.select("h").mapInArrow(run, PACKED))


def in_both(strings: DataFrame, shared: Broadcast) -> DataFrame:
    """A row for each string whose hash is in the bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, n = hashes_of(b)
            at = np.flatnonzero(in_bitmap(shared.value, h))
            begin = np.cumsum(n) - n
            cell = np.repeat(np.arange(b.num_rows), n)[at]
            c1, c2, first, lone = (b.column(c).take(pa.array(cell)) for c in ("c1", "c2", "first", "lone"))
            yield pa.RecordBatch.from_arrays([c1, c2, first, pa.array((at - begin[cell]).astype(np.int32)), long(h[at]), lone],
                                             ["c1", "c2", "first", "off", "h", "lone"])

    return strings.mapInArrow(run, STRINGS)


def repeated_spans(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """(key, spans): sorted byte ranges to remove, which may overlap."""
    spark, window, gram = rows.sparkSession, WINDOW, GRAM
    buckets = buckets_for((rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) * 2 // window)
    ranks = materialize(first_ranks(rows, length, buckets), "suffix-first")
    with sent(spark, bitmap_of(ranks, "s", RANK_BITS)) as known:
        anchors = materialize(candidate_anchors(rows, length, known), "suffix-anchors")
    discard(ranks)
    cells = shared_cells(anchors, length - window + 1, window + gram)
    discard(anchors)

    kinds = materialize(cells.groupBy("rank", "c1", "c2").agg(F.count(F.lit(1)).alias("n")), "suffix-kinds")
    mixed = kinds.groupBy("rank").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least")).filter("kinds > 1 and least = 1")
    look = materialize(kinds.join(mixed.select("rank"), "rank"), "suffix-mixed")
    lone = kinds.filter("n = 1").select("c1", "c2")
    with sent(spark, bitmap_of(look, "c1")) as wanted, sent(spark, bitmap_of(look.filter("n = 1"), "c1")) as single:
        strings = materialize(strings_of_cells(rows, length, wanted, single), "suffix-strings")
    discard(look)
    # a cell that occurs once gives each of its strings once: a second row is another cell's
    again = materialize(repeated_strings(strings, buckets), "suffix-again")
    with sent(spark, bitmap_of(again, "s", RANK_BITS)) as known:
        twofold = materialize(in_both(strings, known), "suffix-twofold")
    discard(strings, again)
    equal = twofold.groupBy("h", "first").agg(F.min("c1").alias("lo"), F.max("c1").alias("hi")).filter("lo <> hi").select("h", "first")
    found = materialize(twofold.filter("lone").join(equal, ["h", "first"]).join(lone, ["c1", "c2"]).groupBy("c1", "c2").agg(
        F.collect_set("off").alias("offs")), "suffix-found")           # at most WINDOW offsets to a cell
    discard(twofold)
    part = cells.join(found, ["c1", "c2"]).select("key", F.explode(F.transform(
        "offs", lambda o: F.struct((F.col("low") + o).alias("start"), (F.col("low") + o + length).alias("end")))).alias("span"))
    whole = cells.join(kinds.filter("n > 1").select("rank", "c1", "c2"), ["rank", "c1", "c2"]).select(
        "key", F.struct(F.col("low").alias("start"), (F.col("high") + length).alias("end")).alias("span"))
    spans = materialize(whole.unionByName(part).groupBy("key").agg(F.sort_array(F.collect_set("span")).alias("spans")), "suffix-spans")
    del part, whole, equal, mixed, lone
    discard(cells, kinds, found)
    return spans


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_bytes``, ``n_removed``,
    ``spans`` (maximal removed byte ranges, as start and end) and ``kept`` (the
    remaining bytes, binary since a cut may fall inside a character).

    A null or empty text has no bytes.  Rows that repeat id and text are
    places of their own.  Matches never cross rows; texts shorter than
    ``length`` bytes are kept.  Other columns are not read."""
    if length < 2 * (WINDOW + GRAM):
        raise ValueError(f"length must be at least {2 * (WINDOW + GRAM)} bytes")
    rows = keyed(docs, id_column, text_column)
    with small_batches(rows.sparkSession):
        spans = repeated_spans(rows, length)
    touched = rows.sparkSession.sparkContext.broadcast(bitmap_of(spans, "key"))
    id_type = dict(rows.dtypes)["id"]
    result = f"id {id_type}, n_bytes long, n_removed long, spans array<struct<start:int,end:int>>, kept binary, kept_sha256 string"

    def part(batches: Iterator[pa.RecordBatch], hit: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
            yield batch.filter(pa.array(in_bitmap(touched.value, keys) == hit))

    empty = F.array().cast("array<struct<start:int,end:int>>")
    hit = rows.mapInArrow(lambda batches: part(batches, True), f"key long, id {id_type}, text string")
    cut = hit.join(spans, "key", "left").select("id", "text", F.coalesce("spans", empty).alias("spans")).mapInArrow(_cut, result)
    return cut.unionByName(rows.mapInArrow(lambda batches: _cut(part(batches, False)), result))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their ``spans``; without that column nothing is cut."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        if "spans" not in batch.schema.names:
            batch = batch.append_column("spans", pa.array([[]] * batch.num_rows, span))
        for at in range(0, batch.num_rows, 512):
            b, out = batch.slice(at, 512), []
            for text, spans in zip(b.column("text"), b.column("spans").to_pylist()):
                data = text.as_py().encode()
                merged: list[dict] = []
                for s in spans:
                    if merged and s["start"] <= merged[-1]["end"]:
                        merged[-1]["end"] = max(merged[-1]["end"], s["end"])
                    else:
                        merged.append(dict(s))
                edges = [0, *[x for s in merged for x in (s["start"], s["end"])], len(data)]
                kept = b"".join(data[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2))
                out.append((len(data), len(data) - len(kept), merged, kept, hashlib.sha256(kept).hexdigest()))
            n, gone, spans, kept, sha = zip(*out) if out else ([],) * 5
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, span),
                                              pa.array(kept, pa.binary()), pa.array(sha, pa.string())],
                                             ["id", "n_bytes", "n_removed", "spans", "kept", "kept_sha256"])
