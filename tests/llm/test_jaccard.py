"""Near duplicates of five-word similarity 0.8 against all pairs."""

import random
from collections import Counter, defaultdict
from itertools import combinations

from pyspark.sql import functions as F
from test_simhash import groups

from flowlens.llm import jaccard_dedup

SF = "/root/testdata/sf0.01"


def shingled(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def near_pairs(sets):
    """Pairs of similarity 0.8 or more, by counting common shingles."""
    holders, common = defaultdict(list), Counter()
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for found in holders.values():
        common.update(combinations(found, 2))
    empty = [i for i, s in enumerate(sets) if not s]
    return [p for p, n in common.items() if 5 * n >= 4 * (len(sets[p[0]] | sets[p[1]]))] + list(zip(empty, empty[1:], strict=False))


def kept_by_brute_force(rows):
    rows = sorted(rows, key=lambda r: r.doc_id)
    root = groups(range(len(rows)), near_pairs([shingled(r.text) for r in rows]))
    return {rows[i].doc_id for i in root.values()}


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert {r.doc_id for r in jaccard_dedup.deduplicate(docs).collect()} == kept_by_brute_force(docs.collect())


def test_edited_copies_go_and_looser_ones_stay(spark):
    """12 changed words in 600 leave a similarity of about 0.8 to 0.82; 40 leave far less."""
    rng = random.Random(3)
    rows = []
    for i in range(60):
        words = [f"w{rng.randrange(10**6)}" for _ in range(600)]
        rows.append((10 * i, " ".join(words)))
        for k, edits in ((1, 12), (2, 40)):
            changed = list(words)
            for at in range(edits):
                changed[at * 600 // edits + 2] = f"x{rng.randrange(10**6)}"
            rows.append((10 * i + k, " ".join(changed)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in jaccard_dedup.deduplicate(docs).collect()}
    assert kept == kept_by_brute_force(docs.collect()) == {10 * i + k for i in range(60) for k in (0, 2)}


def test_large_bands_are_compared_exactly(spark):
    """Groups around one text, from loose to dense, chains and a shared passage, with two leaders a band."""
    rng = random.Random(11)
    text = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    rows, passage = [], text(120)
    for edits in (3, 5, 6, 7, 8, 12):
        base = text(300)
        for _ in range(30):
            words = list(base)
            for at in rng.sample(range(0, 300, 5), edits):
                words[at] = f"x{rng.randrange(10**6)}"
            rows.append(words)
    rows += [passage + text(rng.choice([20, 26, 40])) for _ in range(60)]
    chain = text(250)
    for at in range(0, 240, 6):
        chain = [*chain[:at], f"y{at}", *chain[at + 1:]]
        rows.append(chain)
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string").repartition(3)
    least = {r.doc_id: r.least.doc_id for r in jaccard_dedup.classes(docs, leaders=2).collect()}
    assert set(least.values()) == kept_by_brute_force(docs.collect())


def test_rare_shingles_lose_no_pair(spark):
    """All similar pairs share a key as the exact comparison reads it, of any size and with few counters."""
    rng = random.Random(5)
    base = [rng.randrange(1 << 63) for _ in range(400)]
    sets = {}
    for i in range(120):
        part = set(rng.sample(base[:rng.choice([12, 100, 400])], rng.choice([1, 5, 11, 12]))) if i % 4 == 0 else \
            set(base[:rng.choice([90, 100, 110])]) - set(rng.sample(base, rng.randrange(30))) | {rng.randrange(1 << 63) for _ in range(rng.randrange(9))}
        sets[i] = part
    data = spark.createDataFrame([(i, bytearray(b"".join(x.to_bytes(8, "little") for x in sorted(s)))) for i, s in sets.items()],
                                 "s long, data binary")
    rare = jaccard_dedup.rare_shingles(data, 0.8).withColumn("size", F.lit(10**6)).withColumn("root", F.col("s"))
    found = {(r.a, r.b) for r in jaccard_dedup.led(rare, 10**6, 0.8).collect()}
    want = {(a, b) for a, b in combinations(sorted(sets, reverse=True), 2) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    assert want and want <= found and len(found) < len(sets) * (len(sets) - 1) / 2


def test_hard_rows(spark, hard, empty):
    kept = jaccard_dedup.deduplicate(hard)
    assert kept.columns == hard.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "5", "7", "8", "None"]
    assert jaccard_dedup.deduplicate(empty).count() == 0
    named = hard.select("doc_id", "text", F.lit(1).alias("_id"), F.lit("x").alias("_h"), F.lit(2).alias("least"), F.lit(3).alias("s"))
    assert jaccard_dedup.deduplicate(named).columns == named.columns and jaccard_dedup.deduplicate(named).count() == 6


def test_fingerprints_are_searched(spark, monkeypatch):
    """The stage's candidates hold the links of the BK-trees: joined they are the groups of all pairs within the radius."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = jaccard_dedup.sketches(docs).collect()
    fps, sets = sorted({r.fp for r in rows}), sorted({r.s for r in rows})
    at = {s: i for i, s in enumerate(sets)}
    close = [(a, b) for a, b in combinations(fps, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= jaccard_dedup.RADIUS]
    of = defaultdict(list)
    for r in rows:
        of[r.fp].append(at[r.s])
    want = [(x, of[a][0]) for a in of for x in of[a]] + [(of[a][0], of[b][0]) for a, b in close]
    found = jaccard_dedup.fingerprint_pairs(spark.createDataFrame(rows)).collect()
    assert groups(range(len(sets)), [(at[r.a], at[r.b]) for r in found]) == groups(range(len(sets)), want)
    search, asked = jaccard_dedup.search, []
    monkeypatch.setattr(jaccard_dedup, "search", lambda *a: asked.append(a) or search(*a))
    assert {r.doc_id for r in jaccard_dedup.deduplicate(docs).collect()} == kept_by_brute_force(docs.collect())
    assert asked
