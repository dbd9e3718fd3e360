"""Large groups of near copies, and what a Python worker keeps."""

import ctypes
import random

import numpy as np
import psutil
import pyarrow as pa
import pytest

from refinery.llm import jaccard_join
from refinery.llm.common import SpanHash, lean


def shingles(text):
    w = text.split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def linked(texts):
    """Smallest index that links reach, by all pairs."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                x, y = sorted((top(i), top(j)))
                root[y] = x
    return [top(i) for i in range(len(texts))]


def near_copies(n, seed=5):
    """Texts of one long passage with a few words changed: all are linked, most pairs are not."""
    r = random.Random(seed)
    base = [f"w{i}" for i in range(150)]
    out = []
    for i in range(n):
        words = list(base)
        for at in r.sample(range(150), r.choices((1, 2, 3), (1, 4, 5))[0]):
            words[at] = f"x{i}y{at}"
        out.append(" ".join(words))
    return out


def test_a_large_group_is_not_compared_pair_by_pair(spark, monkeypatch):
    texts, real, pairs = near_copies(300), jaccard_join.materialize, []

    def counted(df, name):
        out = real(df, name)
        if name == "jaccard-leaders":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "materialize", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["id"]: r["component"] for r in jaccard_join.similar_groups(docs).collect()}
    assert [got[i] for i in range(len(texts))] == linked(texts)
    assert pairs[0] < 2 * len(texts)


def test_a_worker_gives_freed_memory_back():
    if not hasattr(ctypes.CDLL(None), "malloc_trim"):
        pytest.skip("the C library has no malloc_trim")
    me, most = psutil.Process(), 0

    def batches():
        nonlocal most
        held = [bytes(1000) for _ in range(200_000)]
        most, last = me.memory_info().rss, held[-1]
        del held
        yield pa.RecordBatch.from_arrays([pa.array([len(last)])], ["n"])

    assert [b.num_rows for b in lean(batches())] == [1]
    assert most - me.memory_info().rss > 100_000_000


def test_groups_need_no_rows_made_in_python(spark, monkeypatch):
    """A frame of rows from the driver's Python keeps workers of another kind on every executor."""
    docs = spark.createDataFrame(list(enumerate(near_copies(5))), "doc_id long, text string")

    def refuse(*args, **options):
        raise AssertionError("rows made in Python")

    monkeypatch.setattr(type(spark), "createDataFrame", refuse)
    assert {r["component"] for r in jaccard_join.similar_groups(docs).collect()} == set(linked(near_copies(5)))


def test_hash_tables_are_no_larger_than_the_steps_need(monkeypatch):
    monkeypatch.setattr(SpanHash, "_powers", {})
    data = np.frombuffer(random.Random(2).randbytes(40_000), np.uint8)
    small = SpanHash(data[:1000])
    assert len(small.power) < 4_000
    at = np.arange(900)
    large = SpanHash(data)                       # the tables grow, the hashes stay
    assert (small(at, at + 100) == large(at, at + 100)).all()
    assert len(large.power) < 100_000
