"""Periodic runs of words: stretches that repeat one phrase at least three times.

A run is a maximal stretch of consecutive words with smallest period q (words
q apart are identical) that is at least ``min_words`` and ``min_exponent`` * q
words long.  They are found by enumerating maximal pairs.  Two positions i < j
are a maximal pair of length l when l words agree from both, the words to the
left differ and the words to the right differ.  If the distance d = j - i is at
most l / 2, the stretch from i to j + l has period d and cannot be extended, so
the pair is a run as it stands; the smallest distance for a stretch is its
period.  No candidate is extended word by word.

Per step of about a megabyte of text (a longer text is a step of its own):

1. words become exact numbers (dictionary) and suffixes are sorted by prefix
   doubling, within each document, only as far as they still recur there;
2. suffixes whose first words recur as long as any run demands (16 words for
   the defaults) form the LCP intervals, walked bottom-up with a stack;
3. a node keeps its positions in order, labelled by left word.  Children of one
   and the same left word meet without a search.  Otherwise each position of the
   smaller child looks at two neighbours in the larger one.  That is enough:
   occurrences of an l-word string within l / 2 of each other lie one period
   apart and all but the first follow the same word, so only the first position
   of that window can have another left word, and at most one position above
   can agree in exactly l words.

Documents never meet, so nothing is shuffled.  Time is O(n log^2 n) a text.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import SPACED_WORD, text_steps

RUN = "struct<start: bigint, length: bigint, period: bigint>"
_RUN_ARROW = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class Words:
    """The words of a step: number, bounds in the bytes, text, first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        inside = SPACED_WORD[data]
        n = len(inside)
        first = np.zeros(n + 1, bool)
        first[offsets] = True
        self.data = data
        self.starts = np.flatnonzero(inside & (first[:n] | ~np.concatenate(([False], inside[:-1]))[:n]))
        self.ends = np.flatnonzero(inside & (first[1:] | ~np.concatenate((inside[1:], [False]))[:n])) + 1
        self.text = np.searchsorted(offsets, self.starts, "right") - 1
        self.first = np.searchsorted(self.starts, offsets)            # one more than there are texts
        bounds = np.concatenate(([0], np.cumsum(self.ends - self.starts)))
        words = pa.Array.from_buffers(pa.large_binary(), len(self.starts), [None, pa.py_buffer(bounds), pa.py_buffer(data[inside])])
        self.number = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)

    def pick(self, at: np.ndarray) -> None:
        """Word i becomes what word ``at[i]`` was; texts keep their lengths."""
        self.starts, self.ends, self.number = self.starts[at], self.ends[at], self.number[at]

    def joined(self, keep: np.ndarray) -> pa.Array:
        """The kept words of each text, joined by one space."""
        at = np.flatnonzero(keep)
        text, size = self.text[at], self.ends[at] - self.starts[at]
        gap = np.zeros(len(at), np.int64)
        gap[:-1] = text[1:] == text[:-1]                               # a space after all but the last
        room = size + gap
        upto = np.cumsum(room)
        out = np.full(int(upto[-1]) if len(at) else 0, 0x20, np.uint8)
        source = np.repeat(self.starts[at] - (upto - room), room) + np.arange(len(out))
        letter = np.ones(len(out), bool)
        letter[upto[gap > 0] - 1] = False
        out[letter] = self.data[source[letter]]
        last = np.searchsorted(text, np.arange(len(self.first) - 1), "right")
        bounds = np.concatenate(([0], np.concatenate(([0], upto))[last]))
        return pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(out)])


def looped(words: Words, seeds: np.ndarray) -> np.ndarray:
    """Word order in which texts with a seed (not negative) end in a loop: from
    word a = seed % n on, p = 1 + (n - a) // (3 + seed % 8) words repeat."""
    at = np.arange(len(words.starts))
    for t in np.flatnonzero((seeds >= 0) & (words.first[1:] > words.first[:-1])):
        lo, hi, seed = int(words.first[t]), int(words.first[t + 1]), int(seeds[t])
        a = seed % (hi - lo)
        p = 1 + (hi - lo - a) // (3 + seed % 8)
        at[lo + a:hi] = lo + a + np.arange(hi - lo - a) % p
    return at


def suffixes(number: np.ndarray, text: np.ndarray, depth: int) -> tuple:
    """(positions, agreement with the next one) of the suffixes whose first
    ``depth`` words (a power of two) recur in their text, in order."""
    n = len(number)
    key = text * (int(number.max()) + 1) + number
    order = np.argsort(key, kind="stable")
    head = np.ones(n, bool)
    head[1:] = np.diff(key[order]) != 0
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    names, at, k = [rank], np.arange(n), 1
    deep = None
    while True:
        at = at[~(head & np.concatenate((head[1:], [True])))]          # what still shares its rank
        if k == depth:
            deep = at
        if not len(at):
            break
        pos = order[at]
        after = np.where(pos + k < n, rank[np.minimum(pos + k, n - 1)], -1)
        pair = rank[pos] * (n + 1) + after + 1
        by = np.argsort(pair)
        pos, pair = pos[by], pair[by]
        order[at] = pos
        head = np.ones(len(at), bool)
        head[1:] = np.diff(pair) != 0
        rank = rank.copy()
        rank[pos] = np.maximum.accumulate(np.where(head, at, 0))
        names.append(rank)
        k *= 2
    if deep is None or not len(deep):
        none = np.zeros(0, np.int64)
        return none, none
    pos = order[deep]
    a, b, agree = pos[:-1], pos[1:], np.zeros(len(pos), np.int64)
    for level in range(len(names) - 1, -1, -1):
        x, y = a + agree[:-1], b + agree[:-1]
        same = (x < n) & (y < n)
        same[same] = names[level][x[same]] == names[level][y[same]]
        agree[:-1][same] += 1 << level
    return pos, agree


def maximal_pairs(pos: list, agree: list, left: np.ndarray, least: int, min_words: int, times: int) -> list:
    """(start, distance, length) of the maximal pairs with a distance of at
    most length / ``times`` that give a stretch of ``min_words``."""
    found = []

    def meet(a: tuple, b: tuple, l: int) -> tuple:
        (large, x_left), (small, y_left) = (a, b) if len(a[0]) >= len(b[0]) else (b, a)
        if x_left != y_left or x_left is None:
            reach = l // times
            for x in small:
                i = bisect_left(large, x - reach)
                if i < len(large):
                    y = large[i]
                    if y < x:
                        if left[y] != left[x] and x - y + l >= min_words:
                            found.append((y, x - y, l))
                        i = bisect_right(large, x, i)
                        y = large[i] if i < len(large) else x
                    if x < y <= x + reach and left[y] != left[x] and y - x + l >= min_words:
                        found.append((x, y - x, l))
        if len(small) < 8:
            for x in small:
                insort(large, x)
        else:
            large.extend(small)
            large.sort()
        return large, x_left if x_left == y_left else None

    left = left.tolist()
    stack: list = []
    for p, l in zip(pos, agree):
        node = ([p], left[p])
        while stack and stack[-1][0] > l:
            deeper, opened = stack.pop()
            node = meet(opened, node, deeper)
        if l >= least:
            if stack and stack[-1][0] == l:
                node = meet(stack.pop()[1], node, l)
            stack.append((l, node))
    return found


def runs_of(words: Words, min_words: int, min_exponent: int) -> tuple:
    """(start, length, period) arrays, starts counted over the step, by start and period."""
    none = np.zeros(0, np.int64)
    least = -(-min_words * (min_exponent - 1) // min_exponent)        # words that any run's pair agrees in
    if not len(words.number):
        return none, none, none
    pos, agree = suffixes(words.number, words.text, 1 << (least.bit_length() - 1))
    if not len(pos):
        return none, none, none
    left = np.full(len(words.number), -1, np.int64)
    inner = words.text[1:] == words.text[:-1]
    left[1:][inner] = words.number[:-1][inner]
    period: dict = {}
    for start, d, l in maximal_pairs(pos.tolist(), agree.tolist(), left, least, min_words, min_exponent - 1):
        at = (start, start + d + l)
        period[at] = min(d, period.get(at, d))
    rows = np.array(sorted((s, q, e - s) for (s, e), q in period.items()), np.int64).reshape(-1, 3)
    return rows[:, 0], rows[:, 2], rows[:, 1]


def collapse_runs(docs: DataFrame, text_column: str = "text", carry: dict[str, Column] | None = None,
                  min_words: int = 24, min_exponent: int = 3, loop_seed: Column | None = None) -> DataFrame:
    """One row per input row: the columns of ``carry``, ``n_words``, ``runs``
    (start, length, period; by start, then period) and ``collapsed``: the words
    that no run holds after its first period, joined by one space.

    Words are what lies between white space and are compared byte by byte.  A
    null or empty text has no words, no runs and collapses to the empty string.
    Only the text and what ``carry`` names are read, so other columns may have
    any name; repeated rows are rows like any other.  ``loop_seed`` (null: no
    change) plants a loop in a text before the search, to try a detector on
    texts whose loops are known (see ``looped``)."""
    if min_exponent < 3 or min_words < 4:
        raise ValueError("min_exponent must be at least 3 and min_words at least 4")
    carry = dict(carry or {"doc_id": F.col("doc_id")})
    seed = F.lit(None) if loop_seed is None else loop_seed
    rows = docs.select(*[c.alias(n) for n, c in carry.items()], F.col(text_column).alias("__text"),
                       F.coalesce(seed.cast("long"), F.lit(-1).cast("long")).alias("__seed"))
    names = list(carry)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_steps(batch, "__text"):
                words = Words(data, offsets)
                seeds = batch.column("__seed")[lo:hi].to_numpy(zero_copy_only=False)
                if (seeds >= 0).any():
                    words.pick(looped(words, seeds))
                start, length, period = runs_of(words, min_words, min_exponent)
                change = np.zeros(len(words.starts) + 1, np.int64)
                np.add.at(change, start + period, 1)
                np.add.at(change, start + length, -1)
                base = words.first[:-1]
                of = words.text[start] if len(start) else start
                found = pa.StructArray.from_arrays([pa.array(start - base[of]), pa.array(length), pa.array(period)],
                                                   fields=list(_RUN_ARROW))
                cut = np.searchsorted(of, np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c)[lo:hi] for c in names], pa.array(np.diff(words.first)),
                     pa.ListArray.from_arrays(pa.array(cut), found), words.joined(np.cumsum(change[:-1]) == 0).cast(pa.string())],
                    [*names, "n_words", "runs", "collapsed"])

    kept = rows.select(*names).schema.simpleString()[len("struct<"):-1]
    return rows.mapInArrow(find, f"{kept}, n_words: bigint, runs: array<{RUN}>, collapsed: string")
