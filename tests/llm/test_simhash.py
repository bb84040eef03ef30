"""SimHash near-dedup against all pairs."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from flowlens.llm import simhash_dedup
from flowlens.llm.components import components

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def check(rows, got, radius=3):
    fps = {(r.doc_id, r.text): brute_fingerprint(r.text) for r in rows}
    distinct = sorted(set(fps.values()))
    root = groups(distinct, [(a, b) for i, a in enumerate(distinct) for b in distinct[i + 1:] if (a ^ b).bit_count() <= radius])
    least = {}
    for (doc, _), fp in fps.items():
        if doc is not None:
            least[root[fp]] = min(least.get(root[fp], doc), doc)
    want = sorted((str(r.doc_id), f"{fps[r.doc_id, r.text]:016x}", str(least.get(root[fps[r.doc_id, r.text]]))) for r in rows)
    assert want == sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got)
    return root, fps


@pytest.mark.parametrize("limit", [20_000, 2])
def test_documents(spark, limit):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(docs.collect(), simhash_dedup.near_duplicates(docs, limit=limit).collect())


def test_hard_rows(hard, empty):
    root, fps = check(hard.collect(), simhash_dedup.near_duplicates(hard).collect())
    kept = simhash_dedup.deduplicate(hard)
    assert kept.columns == hard.columns
    rows = kept.collect()
    assert sorted(root[fps[r.doc_id, r.text]] for r in rows) == sorted(set(root.values()))
    assert simhash_dedup.near_duplicates(empty).count() == 0 and simhash_dedup.deduplicate(empty).count() == 0


def dense(n, flips, seed=0):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(6)]
    out = set()
    for i in range(n):
        x = centres[i % 6]
        for _ in range(rng.randint(0, flips)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("limit", [20_000, 40, 5])
def test_split_shards_lose_no_link(spark, limit):
    fps = dense(900, 5)
    frame = spark.createDataFrame([(int(x),) for x in np.array(fps, "u8").view("i8")], "fp long")
    links = (simhash_dedup.shards(frame, 3, limit).repartition("shard").sortWithinPartitions("shard", "fp")
             .mapInArrow(lambda it: simhash_dedup._search(it, 3), "a long, b long"))
    roots = {r.a % 2**64: r.root % 2**64 for r in components(links).collect()}
    got, want = defaultdict(set), defaultdict(set)
    expected = groups(fps, [(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if (a ^ b).bit_count() <= 3])
    for x in fps:
        got[roots.get(x, x)].add(x)
        want[expected[x]].add(x)
    assert {frozenset(v) for v in got.values()} == {frozenset(v) for v in want.values()}


def test_trees_find_all_within_radius():
    fps = np.array(dense(500, 8, 3), "u8")
    shard = np.sort(np.arange(len(fps)) % 7)
    forest = simhash_dedup.BKForest(shard, fps)
    found = {(int(a), int(b)) for x, y in forest.within(np.arange(len(fps)), 3) for a, b in zip(x, y, strict=True)}
    want = {(i, j) for i in range(len(fps)) for j in range(len(fps))
            if i != j and shard[i] == shard[j] and int(fps[i] ^ fps[j]).bit_count() <= 3}
    assert found == want


def test_components_of_a_long_chain(spark):
    n = 300
    order = random.Random(1).sample(range(n), n)
    links = spark.createDataFrame(list(zip(order, order[1:], strict=False)) + [(1000, 1001), (7, 7)], "a long, b long")
    got = {r.a: r.root for r in components(links).collect()}
    assert got == {i: 0 for i in range(1, n)} | {1001: 1000}
    assert components(links.limit(0)).count() == 0
