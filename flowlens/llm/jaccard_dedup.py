"""Near duplicates by exact Jaccard similarity of five-word shingles, found through SimHash fingerprints and MinHash bands.

Texts of equal shingle sets count as one. Fingerprints are searched in BK-trees as ``simhash_dedup`` does; the links
found there are candidates. At 0.8 most pairs differ in more bits than a search can reach, so sets that agree in a band
of MinHashes are candidates too: 20 bands of 6 find a pair of similarity 0.8 with a chance of 0.998, one of 0.85 with
0.9999. Candidates are verified by the shingles themselves, which are hashed once for all sets that have a candidate.
First every set meets those its fingerprint is linked to and one other of each of its bands; then sets of a band that are still in different components meet all of a small band, and about ``LEADERS``
random members of a large one. That joins a large group of near copies. Sets of large bands that are still apart are
then compared exactly: two similar sets share one of their rarest shingles, so those with a rare shingle in common meet,
all at once where such pairs are few, else in rounds of ever more leaders until every pair of different components with
such a shingle has been compared. Components grow by the links of each step alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import materialize, small_enough, text_of
from flowlens.llm.components import components
from flowlens.llm.simhash_dedup import RADIUS, SEED, SHARD_LIMIT, fingerprint, one_of_each, search

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 6
#: Members of a band that all its members still apart are compared with, before the exact comparison.
LEADERS = 8
#: Pairs by rare shingles that are made in one round; more are made in several, with the same result.
PAIRS_AT_ONCE = 50_000_000
#: Counters that tell rare shingles from frequent ones; their number decides the work only.
BUCKETS = 1 << 20
_DRAW = np.random.default_rng(SEED)
MASKS = _DRAW.integers(0, 1 << 64, (BANDS * ROWS, 1), "u8")
FACTORS = _DRAW.integers(0, 1 << 63, (BANDS * ROWS, 1), "u8") * np.uint64(2) + np.uint64(1)


def shingle_hashes(data: bytes) -> np.ndarray:
    """Different hashes of the runs of five words in order; fewer words are one run, none give none."""
    import xxhash

    words = data.lower().split()
    if not words:
        return np.zeros(0, "<u8")
    digest = xxhash.xxh64_intdigest
    runs = max(1, len(words) - SHINGLE + 1)
    return np.unique(np.array([digest(b" ".join(words[i:i + SHINGLE]), SEED) for i in range(runs)], "<u8"))


def band_keys(hashes: np.ndarray) -> list[int]:
    """One key for each band of the MinHashes."""
    import xxhash

    if not len(hashes):
        return []
    least = np.full(BANDS * ROWS, np.iinfo("u8").max, "u8")
    for i in range(0, len(hashes), 1 << 12):
        least = np.minimum(least, ((hashes[None, i:i + (1 << 12)] ^ MASKS) * FACTORS).min(axis=1))
    keys = [xxhash.xxh64_intdigest(b.tobytes(), i) for i, b in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(keys, "u8").view("i8").tolist()


def _set_id(hashes: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).view("i8"))


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, h (hash of the text), s (hash of the shingle set), fingerprint and band keys of every row."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).to_pylist()
            sets = [shingle_hashes(x) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([_set_id(x) for x in sets], pa.int64()),
                 pa.array(np.array([fingerprint(x) for x in texts], "u8").view("i8")),
                 pa.array([band_keys(x) for x in sets], pa.list_(pa.int64()))], names=["doc_id", "h", "s", "fp", "keys"])

    return (docs.select(F.col("doc_id").cast("long"), F.xxhash64(text_of()).alias("h"), text_of().cast("binary"))
            .mapInArrow(sketch, "doc_id long, h long, s long, fp long, keys array<long>"))


def shingle_data(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(s, data): the shingle hashes of ``sets`` (s, h), each from one of the texts of hash h."""
    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingle_hashes(x) for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_set_id(x) for x in found], pa.int64()), pa.array([x.tobytes() for x in found], pa.binary())],
                names=["s", "data"])

    texts = small_enough(materialize(sets.select(F.col("h").alias("_h")).distinct(), "used"))
    return materialize(docs.select(text_of().alias("text")).join(texts, F.xxhash64("text") == F.col("_h"), "left_semi")
                       .select(F.col("text").cast("binary")).mapInArrow(shingled, "s long, data binary")
                       .dropDuplicates(["s"]), "shingles")


def verified(data: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """The (a, b) of ``pairs`` whose shingle sets, of ``data`` (s, data), are at least so similar."""
    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                both = len(np.intersect1d(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), assume_unique=True))
                near.append(both >= similarity * ((len(x) + len(y)) // 8 - both) - 1e-9)
            kept = b.filter(pa.array(near, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], names=["a", "b"])

    first, second = (data.select(F.col("s").alias(k), F.col("data").alias(f"data_{k}")) for k in "ab")
    return (pairs.join(second, "b").join(first, "a").select("a", "b", "data_a", "data_b")
            .mapInArrow(similar, "a long, b long"))


def rare_shingles(data: DataFrame, similarity: float) -> DataFrame:
    """(key, s, n, at, short): the rarest shingles of each set of n, so many that similar sets share one of them.

    Shingles are ordered by how often their bucket occurs, then by hash. Let two sets of n <= m shingles have so many
    in common that they are similar. Their first common shingle has all others after it, so it stands at ``at`` <=
    n - least overlap in both; in the smaller set it is ``short``.
    """
    def occurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, seen = np.unique(_buckets(np.frombuffer(b"".join(b.column(0).to_pylist()), "<u8")), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(seen)], names=["bucket", "times"])

    counts = (data.select("data").mapInArrow(occurring, "bucket long, times long").groupBy("bucket")
              .agg(F.sum("times").alias("times")).toArrow())
    times = np.zeros(BUCKETS, "i8")
    times[counts["bucket"].to_numpy()] = counts["times"].to_numpy()
    shared = data.sparkSession.sparkContext.broadcast(times)  # BUCKETS numbers at every size

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for s, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                hashes = np.frombuffer(x, "<u8")
                n = len(hashes)
                few = n - math.ceil(similarity * n - 1e-9) + 1
                shortest = n - math.ceil(2 * similarity / (1 + similarity) * n - 1e-9) + 1
                keys = hashes[np.lexsort((hashes, shared.value[_buckets(hashes)]))[:few]].view("i8")
                at = np.arange(few)
                found.append((keys, np.full(few, s), np.full(few, n), at, at < shortest))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)],
                                                 names=["key", "s", "n", "at", "short"])

    return data.select("s", "data").mapInArrow(rarest, "key long, s long, n long, at long, short boolean")


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(BUCKETS)).astype("i8")


def grown(root: DataFrame, links: DataFrame) -> DataFrame:
    """The components ``root`` (a, root) after more ``links``: those of the links between roots, handed on to all below."""
    if links.isEmpty():
        return root
    for end in ("a", "b"):
        at = root.select(F.col("a").alias("node"), F.col("root").alias("top"))
        links = links.join(at, links[end] == at["node"], "left").withColumn(end, F.coalesce("top", end)).drop("node", "top")
    tops = components(links)
    moved = tops.select(F.col("a").alias("node"), F.col("root").alias("top"))
    below = root.join(moved, root["root"] == moved["node"], "left").select("a", F.coalesce("top", "root").alias("root"))
    return materialize(below.unionByName(tops), "roots")


def still_apart(members: DataFrame, root: DataFrame) -> DataFrame:
    """``members`` (key, s, …) with their ``root``, without the keys whose sets are all of one component."""
    placed = materialize(members.join(root, members["s"] == root["a"], "left").drop("a")
                         .withColumn("root", F.coalesce("root", "s")), "apart")
    several = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    return materialize(placed.join(several.select("key"), "key", "left_semi"), "apart")


def led(apart: DataFrame, leaders: int, least: float | None = None) -> DataFrame:
    """(a, b): sets of a key in different components, one of the two among its ``leaders`` or so; all, if it has no more.

    With ``least`` the keys are rare shingles: a leader is a short one, and pairs that cannot be so similar are left out.
    """
    heads = apart.where(F.pmod(F.xxhash64("s", "key"), "size") < leaders)
    fits = F.col("m.root") != F.col("l.root")
    if least is not None:
        heads = heads.where("short")
        overlap = least / (1 + least) * (F.col("l.n") + F.col("m.n")) - 1e-6
        fits &= (F.col("l.n") <= F.col("m.n")) & (F.least(F.expr("l.n - l.at"), F.expr("m.n - m.at")) >= overlap)
    return (apart.alias("m").join(heads.alias("l"), (F.col("m.key") == F.col("l.key")) & fits)
            .select(F.greatest("m.s", "l.s").alias("a"), F.least("m.s", "l.s").alias("b")).distinct())


def fingerprint_pairs(rows: DataFrame, radius: int = RADIUS, limit: int = SHARD_LIMIT) -> DataFrame:
    """(a, b): different sets of ``rows`` (s, fp) whose fingerprints the BK-trees link, or that share a fingerprint.

    Of the sets of one fingerprint the smallest stands for it, so pairs grow with the sets.
    """
    held = materialize(rows.select("fp", "s").distinct(), "fingerprints")
    first = materialize(held.groupBy("fp").agg(F.min("s").alias("s")), "distinct")
    links = search(first.select("fp"), radius, limit)
    heads = [first.select(F.col("fp").alias(f"fp_{k}"), F.col("s").alias(k)) for k in "ab"]
    linked = links.select(F.col("a").alias("fp_a"), F.col("b").alias("fp_b")).join(heads[0], "fp_a").join(heads[1], "fp_b")
    equal = held.withColumnRenamed("s", "a").join(first.withColumnRenamed("s", "b"), "fp")
    return linked.select("a", "b").unionByName(equal.select("a", "b")).where("a <> b").distinct()


def classes(docs: DataFrame, similarity: float = SIMILARITY, leaders: int = LEADERS) -> DataFrame:
    """doc_id, h and least of every row: least is the smallest (no id, doc_id, h) of the row's component.

    Other columns, of any name, are not read.
    """
    rows = materialize(sketches(docs), "sketches")
    own = F.struct(F.isnull("doc_id").alias("missing"), "doc_id", "h")
    sets = materialize(rows.groupBy("s").agg(F.min(own).alias("least"), F.first("keys").alias("keys"), F.min("h").alias("h")), "sets")
    texts = sets.select("s", "h")
    members = sets.select(F.explode("keys").alias("key"), "s")
    # The leader of a band differs from band to band.
    bands = materialize(members.groupBy("key").agg(F.count("*").alias("size"), F.min_by("s", F.xxhash64("s", "key")).alias("b"))
                        .where("size > 1"), "bands")
    shared = materialize(members.join(bands, "key"), "shared")
    near = materialize(fingerprint_pairs(rows), "near")
    met = shared.select("s").union(near.select("a")).union(near.select("b")).distinct()
    data = shingle_data(docs, texts.join(met, "s", "left_semi"))
    pairs = materialize(shared.where("s <> b").select(F.col("s").alias("a"), "b").unionByName(near).distinct(), "pairs")
    root = components(materialize(verified(data, pairs, similarity), "links"))

    apart = still_apart(shared.drop("b"), root)
    both = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    done = materialize(led(apart, leaders).join(both, ["a", "b"], "left_anti"), "pairs")
    root = grown(root, materialize(verified(data, done, similarity), "links"))

    large = still_apart(apart.where(F.col("size") > leaders).drop("root"), root).select("s").distinct()
    if not large.isEmpty():
        rare = materialize(rare_shingles(data.join(large, "s", "left_semi"), similarity), "rare")
        held = rare.groupBy("key").agg(F.count("*").alias("size"), F.count_if("short").alias("heads")).where("size > 1")
        shared, now, done = materialize(rare.join(held, "key"), "shared"), leaders, both.unionByName(done)
        while True:
            apart = still_apart(shared, root)
            largest = apart.agg(F.max("size")).first()[0]
            if largest is None:
                break
            if apart.agg(F.sum(F.col("heads").cast("double"))).first()[0] <= PAIRS_AT_ONCE:
                now = largest
            rest = materialize(led(apart, now, similarity).join(done, ["a", "b"], "left_anti"), "pairs")
            root = grown(root, materialize(verified(data, rest, similarity), "links"))
            if now >= largest:
                break
            shared, now, done = apart.drop("root"), now * max(leaders, 2), done.unionByName(rest)

    joined = (sets.join(root, sets["s"] == root["a"], "left").select("s", "least", F.coalesce("root", "s").alias("root")))
    least = joined.groupBy("root").agg(F.min("least").alias("least"))
    return rows.select("doc_id", "h", "s").join(joined.select("s", "root").join(least, "root").select("s", "least"), "s")


def deduplicate(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each component of similar texts, as ``simhash_dedup.deduplicate`` chooses it.

    Texts without words are similar to each other only.
    """
    return one_of_each(docs, materialize(classes(docs, similarity).select("doc_id", "h", "least"), "classes"))
