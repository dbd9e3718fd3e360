"""Exact dedup, mixing and sharding on awkward rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest

from refinery.llm.exact_dedup import refine
from refinery.llm.mixing import mix
from refinery.llm.sharding import balance, pack, place


def test_refinement_keeps_one_row_of_each_text(awkward):
    rows, df = awkward
    out = refine(df, digest_all=True).collect()
    assert Counter(r["id"] for r in out) == Counter(r[0] for r in rows)
    texts = defaultdict(list)
    for d, t, *_ in rows:
        texts[hashlib.sha256((t or "").encode()).hexdigest()].append(d)
    assert Counter(r["digest"] for r in out) == Counter({k: len(v) for k, v in texts.items()})
    for r in out:
        ids = texts[r["digest"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max((d for d in ids if d is not None), default=None)
    assert Counter(r["digest"] for r in out if r["kept"]) == Counter(texts.keys())
    assert all(r["id"] == r["keep_id"] for r in out if r["kept"])


def test_refinement_hashes_whole_content_of_survivors_only(spark):
    same_start = "x" * 64
    df = spark.createDataFrame([(1, same_start + "a"), (2, same_start + "b"), (3, same_start + "b"), (4, "y" * 65), (5, "z")],
                               "doc_id long, text string")
    out = {r["id"]: r for r in refine(df).collect()}
    assert out[4]["digest"] is None and out[5]["digest"] is None          # told apart by prefix and by length
    assert out[1]["digest"] is not None and out[1]["group_size"] == 1
    assert (out[2]["kept"], out[3]["kept"], out[2]["keep_id"]) == (False, True, 3)


def test_mix_reaches_the_targets(awkward):
    rows, df = awkward
    out = mix(df).collect()
    assert len(out) == len(rows)
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len(brute.spaced_words(t))
    order = sorted((s for s in sizes if s is not None)) + [None]
    targets = dict(zip(order, brute.water_level([sizes[s] for s in order], [i % 3 + 1.0 for i in range(len(order))])))
    taken = defaultdict(int)
    for r in out:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert 0 <= r["times"] <= 3
        taken[r["source"]] += r["times"] * r["size"]
    for s in order:
        of = [len(brute.spaced_words(t)) for _, t, _, q in rows if q == s]
        assert abs(taken[s] - targets[s]) <= max(of) / 2 + 1
    key = lambda r: (str(r["id"]), str(r["source"]), r["size"], r["times"])
    assert sorted(map(key, out)) == sorted(map(key, mix(df).collect()))


def test_mix_caps_a_small_source(spark):
    rows = [(i, "w " * 50, "big") for i in range(200)] + [(1000 + i, "w " * 10, "small") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mix(df, rows_per_bucket=20).collect()
    small = [r for r in out if r["source"] == "small"]
    assert {r["times"] for r in small} == {3} and small[0]["target"] == pytest.approx(150)
    big = sum(r["times"] * r["size"] for r in out if r["source"] == "big")
    assert abs(big - (10050 - 150)) <= 50


def test_packing_is_balanced_and_keeps_groups_together(spark):
    rng = random.Random(4)
    texts = [brute.prose(rng, rng.randint(1, 60)) for _ in range(1500)]
    texts += [texts[0]] * 900 + [texts[1]] * 5 + [None, ""]              # a hot group, over a third of the rows
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(6)
    packed = pack(df, shards=8, overhead=16, cell_items=300, slot_rows=100).cache()
    out = packed.collect()
    assert sorted(r["id"] for r in out) == list(range(len(texts)))
    shards = defaultdict(set)
    for r in out:
        assert r["bytes"] == len((texts[r["id"]] or "").encode()) + 16
        assert r["crc32"] == zlib.crc32((texts[r["id"]] or "").encode())
        shards[texts[r["id"]] or ""].add(r["shard"])
    assert all(len(v) == 1 for t, v in shards.items() if t != texts[0])   # only the hot group is split
    assert {r["split_groups"] for r in out} == {1}
    assert {(texts[r["id"]] or "") for r in out if r["pieces"] > 1} == {texts[0]}
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    for dim in ("bytes", "tokens", "rows"):
        v = [r[dim] for r in balance(packed).collect()]
        assert len(v) == 8 and max(v) - min(v) <= 0.1 * sum(v) / 8


def test_a_group_that_a_shard_can_hold_stays_whole(spark):
    rng = random.Random(5)
    texts = [brute.prose(rng, rng.randint(20, 40)) for _ in range(2000)]
    texts += [texts[0]] * 240 + [texts[1]] * 200 + [texts[2]] * 100           # most of a shard
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    packed = pack(df, shards=7, overhead=16, cell_items=500).cache()
    shards = defaultdict(set)
    for r in packed.collect():
        shards[texts[r["id"]]].add(r["shard"])
        assert (r["pieces"], r["split_groups"]) == (1, 0)
    assert all(len(v) == 1 for v in shards.values())
    for dim in ("bytes", "tokens", "rows"):
        v = [r[dim] for r in balance(packed).collect()]
        assert len(v) == 7 and max(v) - min(v) <= 0.1 * sum(v) / 7


def test_placement_equals_a_plain_search():
    rng = random.Random(6)
    for _ in range(60):
        shards = rng.randint(1, 6)
        # eighths: sums and products are exact, so ties are ties on both sides
        items = [[rng.randint(0, 8) / 8 for _ in range(3)] for _ in range(rng.randint(0, 40))]
        left = [[1.0] * 3 for _ in range(shards)]
        want = [0] * len(items)
        for i in sorted(range(len(items)), key=lambda i: (-max(items[i]), i)):
            scores = [sum(a * b for a, b in zip(room, items[i])) for room in left]
            want[i] = scores.index(max(scores))
            left[want[i]] = [a - b for a, b in zip(left[want[i]], items[i])]
        got, room = place(np.array(items).reshape(-1, 3), np.ones((shards, 3)))
        assert got.tolist() == want and room.tolist() == left


def test_packing_places_every_awkward_row(awkward):
    rows, df = awkward
    out = pack(df, shards=4).collect()
    assert Counter(r["id"] for r in out) == Counter(r[0] for r in rows)
    assert {r["shard"] for r in out} <= {0, 1, 2, 3}


def test_empty_tables(nothing):
    assert refine(nothing).count() == mix(nothing).count() == pack(nothing, shards=3).count() == 0
