"""Benchmark passages in documents, found by winnowing.

A window is ``WINDOW`` consecutive words of a benchmark item (an item of fewer
words is one window).  Winnowing keeps, of every run of ``WINDOW - GRAM + 1``
word grams, the one with the smallest hash (the last one of equals).  Both
sides choose from a window's words alone, so a shared window always shares its
chosen gram.  Document fingerprints that may be in the benchmark are joined
with the benchmark's, and each hit is extended: the words around it must be
those of the window, so hash coincidences drop out.

A bitmap of a fixed size, made from all benchmark fingerprints, lets the scan
of the documents drop most fingerprints before anything is shuffled; neither
the benchmark nor the documents need to fit anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import ALNUM_WORD, SpanHash, bitmap_of, gram_hashes, in_bitmap, lean, mix, text_steps, words_of
from refinery.session import materialize

WINDOW, GRAM = 10, 5
SCAN_STEP = 1 << 18          # bytes of documents that a task cuts into words at once


class Words:
    """Words of a step's texts and their hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.low, self.starts, self.ends, self.text = words_of(data, offsets, ALNUM_WORD)
        self.hash = mix(SpanHash(self.low)(self.starts, self.ends))
        self.first = np.searchsorted(self.text, np.arange(len(offsets)))       # first word of each text, and the end
        self.first[-1] = len(self.text)

    def grams(self, k: int, domain: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k-gram at each word, and whether it lies in one text."""
        g = gram_hashes(self.hash, k) ^ mix(np.array([domain], np.uint64))
        return g, self.text[:len(g)] == self.text[k - 1:k - 1 + len(g)]

    def chosen(self, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start of every whole window, its chosen gram, and all gram hashes."""
        g, _ = self.grams(gram, 0)
        n = len(self.hash) - window + 1
        if n <= 0:
            none = np.zeros(0, np.int64)
            return none, none, g
        best, at = g[:n].copy(), np.arange(n)
        for j in range(1, window - gram + 1):
            better = g[j:j + n] <= best
            best[better] = g[j:j + n][better]
            at[better] = np.flatnonzero(better) + j
        whole = np.flatnonzero(self.text[:n] == self.text[window - 1:window - 1 + n])
        return whole, at[whole], g

    def strings(self, lo: int, hi: int) -> list[str]:
        return [self.low[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(self.starts[lo:hi], self.ends[lo:hi])]


def signed(x) -> int:
    return int(np.uint64(x).astype(np.int64))


def benchmark_windows(benchmark: DataFrame, id_column: str, text_column: str, window: int, gram: int) -> DataFrame:
    """(item, hash, lead, words) of every window: the chosen gram's hash and
    how many words of the window come before it."""
    items = benchmark.select(F.col(id_column).cast("string").alias("item"), F.col(text_column).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in text_steps(batch, "text"):
                w, rows = Words(data, off), []
                starts, chosen, g = w.chosen(window, gram)
                for s, c in zip(starts, chosen):
                    rows.append((lo + w.text[s], signed(g[c]), c - s, w.strings(s, s + window)))
                for t in range(hi - lo):
                    n = int(w.first[t + 1] - w.first[t])
                    if 0 < n < window:
                        h = w.grams(n, 100 + n)[0][w.first[t]]
                        rows.append((lo + t, signed(h), 0, w.strings(w.first[t], w.first[t] + n)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item").take(pa.array([r[0] for r in rows], pa.int64())), pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.list_(pa.string()))],
                    ["item", "hash", "lead", "words"])

    return items.mapInArrow(cut, "item string, hash long, lead int, words array<string>")


def fingerprints(docs: DataFrame, id_column: str, text_column: str, known: np.ndarray, short: list[int],
                 window: int, gram: int) -> DataFrame:
    """One row per document (``n_words``) and one per fingerprint that the
    bitmap knows (``hash``, its word position, the words around it and how many
    of them come before it)."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.xxhash64(text_column).alias("text_hash"),
                       F.monotonically_increasing_id().alias("row"))
    id_type = dict(rows.dtypes)["id"]
    shared = docs.sparkSession.sparkContext.broadcast(known)       # of a fixed size

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in text_steps(batch, "text", SCAN_STEP):
                w, n = Words(data, off), hi - lo
                found = []
                _, chosen, g = w.chosen(window, gram)
                at = np.unique(chosen)
                at = at[in_bitmap(shared.value, g[at])]
                before = np.minimum(at - w.first[w.text[at]], window - gram)
                found += zip(at.tolist(), g[at].tolist(), before.tolist(),
                             np.minimum(at + window, w.first[w.text[at] + 1]).tolist())
                for k in short:
                    g, whole = w.grams(k, 100 + k)
                    at = np.flatnonzero(whole)
                    at = at[in_bitmap(shared.value, g[at])]
                    found += zip(at.tolist(), g[at].tolist(), [0] * len(at), (at + k).tolist())
                of = np.array([w.text[p] for p, *_ in found], np.int64)
                take = pa.array(np.concatenate((np.arange(n), of)) + lo)
                nulls = [None] * n
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(take), batch.column("text_hash").take(take), batch.column("row").take(take),
                     pa.array(np.diff(w.first).tolist() + [None] * len(found), pa.int64()),
                     pa.array(nulls + [signed(h) for _, h, _, _ in found], pa.int64()),
                     pa.array(nulls + [int(p - w.first[t]) for (p, *_), t in zip(found, of)], pa.int32()),
                     pa.array(nulls + [b for _, _, b, _ in found], pa.int32()),
                     pa.array(nulls + [w.strings(p - b, e) for p, _, b, e in found], pa.list_(pa.string()))],
                    ["id", "text_hash", "row", "n_words", "hash", "position", "before", "around"])

    schema = f"id {id_type}, text_hash long, row long, n_words long, hash long, position int, before int, around array<string>"
    return rows.mapInArrow(lambda batches: lean(scan(batches)), schema)


def covered(spans: Column) -> Column:
    """Words in the union of an array of (start, end)."""
    def step(acc, s):
        more = F.greatest(s["end"] - F.greatest(s["start"], acc["upto"]), F.lit(0))
        return F.struct((acc["n"] + more).alias("n"), F.greatest(acc["upto"], s["end"]).alias("upto"))

    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    return F.aggregate(F.array_sort(spans), start, step, lambda acc: acc["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  item_column: str = "item_id", item_text_column: str = "text", window: int = WINDOW,
                  gram: int = GRAM) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``text_hash``, ``row``,
    ``n_words``, ``n_hit`` (words inside any occurrence of a window) and
    ``items`` (sorted distinct ids, as strings, of the items with a window in
    the text).

    A null or empty text has no words, on either side.  Repeated document rows
    are judged one by one; repeated item ids count once; an item without an id
    marks words but is not listed.  Only the named columns are read."""
    windows = benchmark_windows(benchmark, item_column, item_text_column, window, gram)
    windows = materialize(windows, "decontaminate-windows")
    unique = materialize(windows.groupBy("words").agg(F.first("hash").alias("hash"), F.first("lead").alias("lead"))
                         .withColumn("wid", F.monotonically_increasing_id()), "decontaminate-unique")
    listed = materialize(windows.filter(F.col("item").isNotNull()).join(unique.select("words", "wid"), "words")
                         .select("wid", "item").distinct(), "decontaminate-items")
    short = sorted(r[0] for r in unique.select(F.size("words").alias("k")).filter(F.col("k") < window).distinct().collect())
    found = materialize(fingerprints(docs, id_column, text_column, bitmap_of(unique, "hash"), short, window, gram),
                        "decontaminate-fingerprints")

    size = F.size("words")
    same = F.col("before") >= F.col("lead")
    at = F.col("before") - F.col("lead") + 1
    hits = (found.filter(F.col("hash").isNotNull()).join(unique, "hash")
            .filter(same & F.when(same, F.slice("around", at, size) == F.col("words")).otherwise(F.lit(False)))
            .select("row", "wid", (F.col("position") - F.col("lead")).cast("long").alias("start"),
                    (F.col("position") - F.col("lead") + size).cast("long").alias("end")))
    hits = materialize(hits, "decontaminate-hits")
    spans = hits.groupBy("row").agg(covered(F.collect_set(F.struct("start", "end"))).alias("n_hit"))
    items = hits.select("row", "wid").distinct().join(listed, "wid").groupBy("row").agg(
        F.array_sort(F.collect_set("item")).alias("items"))
    return (found.filter(F.col("hash").isNull()).select("row", "id", "text_hash", "n_words")
            .join(spans, "row", "left").join(items, "row", "left")
            .withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long")))
            .withColumn("items", F.coalesce("items", F.array().cast("array<string>"))))
