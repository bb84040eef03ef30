"""Shards: groups stay whole, sizes are near equal, slots are gapless."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

from flowlens.llm import sharding
from flowlens.llm.sharding import Tree, best_fit, shard_documents


def plain_best_fit(sizes, capacity):
    bins, out = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [b for b, left in enumerate(bins) if left >= sizes[i]]
        if fits:
            b = min(fits, key=lambda b: (bins[b], b))
        else:
            b = len(bins)
            bins.append(max(capacity, sizes[i]))
        bins[b] -= sizes[i]
        out[i] = b
    return out


def test_tree_is_a_sorted_set():
    rng, tree, kept = random.Random(1), Tree(), set()
    for _ in range(3000):
        key = (rng.randint(0, 200), rng.randint(0, 5))
        if key in kept:
            tree.remove(key)
            kept.discard(key)
        else:
            tree.add(key)
            kept.add(key)
        bound = (rng.randint(0, 210), -1)
        assert tree.ceiling(bound) == min((k for k in kept if k >= bound), default=None)
        assert tree.last() == max(kept, default=None)


def test_best_fit_is_the_plain_one():
    rng = random.Random(2)
    for _ in range(30):
        sizes = [rng.randint(1, 60) for _ in range(rng.randint(0, 80))]
        assert best_fit(sizes, 50) == plain_best_fit(sizes, 50)


def check(rows, out, shards):
    """The contract's laws over rows of (doc_id, text) and the operator's answer."""
    want = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == want
    assert all(r["grown_shard"] is None and 0 <= r["shard"] < shards for r in out)
    slots, of_text = defaultdict(list), defaultdict(set)
    for r in out:
        slots[r["shard"]].append(r["slot"])
        of_text[r["size"], r["text_crc32"]].add(r["shard"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert all(len(x) == 1 for x in of_text.values())
    return {s: sum(r["size"] for r in out if r["shard"] == s) for s in range(shards)}


@pytest.mark.parametrize("units", [4, 256])
def test_shards_of_documents(spark, units, monkeypatch):
    monkeypatch.setattr(sharding, "UNITS", units)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(5)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    sizes = check(rows, shard_documents(docs, 20).collect(), 20)
    mean = sum(sizes.values()) / 20
    assert max(sizes.values()) - min(sizes.values()) < (0.5 if units == 4 else 0.01) * mean


def test_a_large_group_has_a_shard_and_the_rest_is_even(spark):
    rows = [(i, "copy of a text that is everywhere" if i % 3 == 0 else f"text number {i} " * (i % 7 + 1)) for i in range(3000)]
    out = shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 10).collect()
    sizes = sorted(check(rows, out, 10).values())
    assert sizes[-2] - sizes[0] <= 200 and sizes[-1] == 1000 * 49


def test_fixed_capacity_needs_few_shards(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, "x" * rng.randint(0, 900)) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    least = sum(len(t) + 16 for _, t in rows) / 20_000
    for lane in (256, 8):
        monkeypatch.setattr(sharding, "LANE_SHARDS", lane)
        out = shard_documents(docs, capacity=20_000).collect()
        n = max(r["shard"] for r in out) + 1
        sizes = check(rows, out, n)
        assert max(sizes.values()) <= 20_000 and {r["law"] for r in out} == {"capacity"}
        assert n <= least + 1 + (0 if lane == 256 else -(-least // lane))


def test_hard_rows(hard, empty):
    rows = [(r["doc_id"], r["text"]) for r in hard.collect()]
    out = shard_documents(hard, 3).collect()
    check(rows, out, 3)
    assert {r["law"] for r in out} == {"bytes"}
    assert shard_documents(empty, 3).count() == 0 and shard_documents(empty, capacity=5).count() == 0
    with pytest.raises(ValueError):
        shard_documents(hard)
