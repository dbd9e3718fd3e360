"""Shared pieces: table access, stable row numbers, a fixed-size membership
bitmap, and numpy views of Arrow text batches."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.session import materialize

# Bytes of text that one numpy step looks at; a longer single text is a step of its own.
STEP_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


ARROW_ROWS = 2048         # rows of documents that go to a Python worker at once


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> Iterator[None]:
    """Jobs run inside send at most ``rows`` rows to a Python worker at once:
    Spark's default of 10,000 documents takes tens of MB in every buffer on the way
    there and back.  The session's own setting is put back at the end."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches`` of a task.  At their end the Python worker, which Spark keeps
    for later tasks, gives the system back what it has freed."""
    try:
        yield from batches
    finally:
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):        # a C library without it
            ctypes.CDLL(None).malloc_trim(0)


@contextlib.contextmanager
def sent(spark: SparkSession, value: object) -> Iterator[Broadcast]:
    """``value`` (of a bounded size) at all tasks, for the jobs run inside."""
    shared = spark.sparkContext.broadcast(value)
    try:
        yield shared
    finally:
        shared.unpersist()


def numbered(df: DataFrame, columns: dict[str, Column], name: str) -> DataFrame:
    """``columns`` of ``df``, written once, with a row number ``row`` that the
    write fixes (unique, not dense).  Later stages can join on it even where
    ids are repeated or null, and a lost executor re-reads the same numbers."""
    picked = df.select(*[c.alias(n) for n, c in columns.items()], F.monotonically_increasing_id().alias("row"))
    return materialize(picked, name)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is.  Where every character is one byte
    the built-in ``lower`` does just that, and faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


# --- a membership bitmap of a fixed size ---------------------------------------------------------

BITMAP_BITS = 26          # 2**26 bits are 8 MB, whatever the input


def bitmap_of(df: DataFrame, hash_column: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """Bitmap (uint64 words) of the 64-bit hashes in ``df``.  Its size is
    ``2**bits`` bits for every input, so it can go to the driver and to every
    task; a set bit may be a coincidence, a clear bit is proof of absence."""
    slot = F.col(hash_column).bitwiseAND((1 << bits) - 1)
    # 64 slots to a word; words are gathered 512 to a row, so the driver gets at most 2**(bits-15) rows
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int"))
    words = df.select(F.shiftright(slot, 6).alias("w"), bit.alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    out = np.zeros(1 << (bits - 6), np.uint64)
    packed = words.groupBy(F.shiftright("w", 9).alias("g")).agg(
        F.collect_list("w").alias("w"), F.collect_list("b").alias("b"))
    found = packed.select("w", "b").toArrow()                 # at most the size of the bitmap, twice
    at, bits_set = (found.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("w", "b"))
    out[at.astype(np.int64)] = bits_set.astype(np.int64).view(np.uint64)
    return out


def bitmaps_over(df: DataFrame, hash_column: str, count_column: str, limits: tuple[int, ...], bits: int = BITMAP_BITS) -> list[np.ndarray]:
    """For each limit the bitmap of the hashes whose count reaches it, all from
    one pass and of a fixed size each."""
    if not limits:
        return []
    slot = F.col(hash_column).bitwiseAND((1 << bits) - 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int"))
    rows = df.filter(F.col(count_column) >= min(limits)).select(F.shiftright(slot, 6).alias("w"), bit.alias("b"), F.col(count_column).alias("n"))
    names = [f"b{i}" for i in range(len(limits))]
    words = rows.groupBy("w").agg(*[F.coalesce(F.bit_or(F.when(F.col("n") >= f, F.col("b"))), F.lit(0).cast("long")).alias(c)
                                    for c, f in zip(names, limits)])
    packed = words.groupBy(F.shiftright("w", 9).alias("g")).agg(F.collect_list("w").alias("w"), *[F.collect_list(c).alias(c) for c in names])
    found = packed.select("w", *names).toArrow()              # at most the size of the bitmaps and once more
    at = found.column("w").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = []
    for c in names:
        out.append(np.zeros(1 << (bits - 6), np.uint64))
        out[-1][at] = found.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return out


def in_bitmap(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the 64-bit ``hashes`` (uint64) have their bit set."""
    slot = hashes & np.uint64(len(words) * 64 - 1)
    return ((words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1)).astype(bool)


# --- counting hashes ------------------------------------------------------------------------------

PACKED = "bucket int, s binary, n binary"
BUCKET_HASHES = 1 << 20      # hashes that one group of a count has, about


def buckets_for(hashes: int) -> int:
    return max(64, hashes // BUCKET_HASHES)


def packed(hashes: np.ndarray, buckets: int) -> pa.RecordBatch:
    """The distinct hashes (uint64) with their counts, cut by hash range: what
    is shuffled is 8 bytes a hash, and a very frequent one is one entry."""
    s, n = np.unique(hashes, return_counts=True)
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)
    cut = np.concatenate(([0], np.searchsorted(s, edges), [len(s)]))
    some, n = np.flatnonzero(cut[1:] > cut[:-1]), n.astype(np.uint32)
    return pa.RecordBatch.from_arrays(
        [pa.array(some, pa.int32()), pa.array([s[cut[b]:cut[b + 1]].tobytes() for b in some], pa.binary()),
         pa.array([n[cut[b]:cut[b + 1]].tobytes() for b in some], pa.binary())], ["bucket", "s", "n"])


def repeated(packs: DataFrame) -> DataFrame:
    """(s, n) of the hashes in ``packed`` rows that occur more than once."""
    def add(table: pa.Table) -> pa.Table:
        s, n = (np.concatenate([np.frombuffer(v.as_py(), t) for v in table.column(c)]) for c, t in (("s", np.uint64), ("n", np.uint32)))
        order = np.argsort(s, kind="stable")
        s, first = np.unique(s[order], return_index=True)
        total = np.add.reduceat(n[order].astype(np.int64), first)
        return pa.table({"s": s[total > 1].view(np.int64), "n": total[total > 1]})

    return packs.groupBy("bucket").applyInArrow(add, "s long, n long")


# --- numpy over Arrow text ------------------------------------------------------------------------

def text_steps(batch: pa.RecordBatch, column: str, limit: int = STEP_BYTES) -> Iterator[tuple]:
    """(first row, end row, bytes, offsets) over consecutive rows of a batch;
    null texts are empty.  The bytes are a view of the batch, not a copy."""
    arr = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
    if len(arr) == 0:
        return
    _, off, data = arr.buffers()
    off = np.frombuffer(off, np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(arr):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of uint64 (multiply and xor-shift steps)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SpanHash:
    """64-bit polynomial hash of any byte span of ``data`` from prefix sums
    (arithmetic modulo 2**64; bytes are replaced by random numbers first)."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, seed: int = 1):
        self.power, self.inverse = self._table(seed, len(data) + 1)
        byte = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(byte[data] * self.power[:len(data)], out=self.prefix[1:])

    @classmethod
    def _table(cls, seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        if seed not in cls._powers or len(cls._powers[seed][0]) < n:
            size = max(n, min(1 << n.bit_length(), STEP_BYTES + 1))       # kept, so no larger than the steps need
            base = (0x5851F42D4C957F2D + 2 * 0x632BE59BD9B4E019 * seed) % (1 << 64) | 1
            back = pow(base, -1, 1 << 64)
            tables = []
            for b in (base, back):
                t = np.full(size, b, np.uint64)
                t[0] = 1
                tables.append(np.multiply.accumulate(t))
            if size > STEP_BYTES + 1:        # for one very long text: not kept
                return tables[0], tables[1]
            cls._powers[seed] = (tables[0], tables[1])
        return cls._powers[seed]

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.prefix[end] - self.prefix[start]) * self.inverse[start]


def byte_classes(is_word) -> np.ndarray:
    return np.array([bool(is_word(b)) for b in range(256)])


LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
# Words of letters and digits: every code point from U+0080 on is part of a word.
ALNUM_WORD = byte_classes(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)
# Words between white space.
SPACED_WORD = byte_classes(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))


def words_of(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray) -> tuple:
    """(lower-cased bytes, word starts, word ends, text number of each word)."""
    low = LOWER[data]
    inside = word_bytes[low]
    n = len(inside)
    if n == 0:
        none = np.zeros(0, np.int64)
        return low, none, none, none
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    starts = np.flatnonzero(inside & (first[:n] | ~np.concatenate(([False], inside[:-1]))))
    ends = np.flatnonzero(inside & (first[1:] | ~np.concatenate((inside[1:], [False])))) + 1
    return low, starts, ends, np.searchsorted(offsets, starts, "right") - 1


def gram_hashes(word_hash: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words (the caller masks grams over a text's end)."""
    n = len(word_hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = word_hash[:n].copy()
    for j in range(1, k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + word_hash[j:j + n]
    return mix(out)
