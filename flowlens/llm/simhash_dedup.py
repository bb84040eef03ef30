"""Near duplicates by SimHash fingerprints, searched in BK-trees.

Distinct fingerprints are dealt over shards such that any two within the radius share one: of radius + 1 bit
blocks, at least one is equal. Every shard becomes a BK-tree whose edges carry the Hamming distance between
child and parent; a search follows only edges within the radius around its own distance. Trees of one shard
and its searches meet in one task; a shard that many fingerprints share is split by blocks of its other bits,
and what is still large has its tree sent to several tasks, each searching for its own share. Sending all
trees to all tasks is not done, as they grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import free_names, materialize, small_enough, text_of
from flowlens.llm.components import components

SEED = 42
SHINGLE = 3
BITS = 64
RADIUS = 3
#: Fingerprints a shard may hold before it is split, and fingerprints a task searches at once.
SHARD_LIMIT = 20_000
BATCH = 60_000
#: Pairs of search and node that one step looks at.
FRONTIER = 2_000_000


def fingerprint(data: bytes) -> int:
    """Majority of the bits of the shingles' hashes; zero for a text without words."""
    import xxhash

    words = data.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    begins, ends = [0, *ends[:-1].tolist()], (ends - 1).tolist()
    if len(words) < SHINGLE:
        spans = [(0, ends[-1])]
    else:
        spans = zip(begins, ends[SHINGLE - 1:])  # noqa: B905  the last begins have no whole shingle
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
    ones = np.zeros(BITS, "i8")
    for i in range(0, len(h), 1 << 14):
        bits = np.unpackbits(h[i:i + (1 << 14)].view("u1").reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype="i8")
    return int.from_bytes(np.packbits(2 * ones > len(h), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, h (hash of the text) and fp, the fingerprint as a signed 64-bit integer, of every row."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(x) for x in b.column(2).to_pylist()], "u8").view("i8")
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)], names=["doc_id", "h", "fp"])

    return (docs.select(F.col("doc_id").cast("long"), F.xxhash64(text_of()).alias("h"),
                        text_of().cast("binary").alias("data"))
            .mapInArrow(hashed, "doc_id long, h long, fp long"))


class BKForest:
    """BK-trees over sorted (shard, fingerprint) rows, one for each shard, as flat arrays.

    Trees grow level by level for all shards at once: the first row of a set becomes its node, the others
    are sorted into its children by their distance to it.
    """

    def __init__(self, shard: np.ndarray, fp: np.ndarray):
        n = len(fp)
        self.fp = fp
        self.root = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if n else np.zeros(0, "i8")
        size = np.diff(np.concatenate([self.root, [n]]))
        self.tree_of = np.repeat(self.root, size)
        parent, edge = np.full(n, -1), np.zeros(n, "i8")
        node = self.tree_of.copy()  # the node each row now stands below
        rows = np.flatnonzero(node != np.arange(n))
        while len(rows):
            d = np.bitwise_count(fp[rows] ^ fp[node[rows]]).astype("i8")
            key = node[rows] * (BITS + 1) + d
            order = np.argsort(key, kind="stable")
            rows, key, d = rows[order], key[order], d[order]
            head = np.concatenate([[True], key[1:] != key[:-1]])
            first = rows[head]
            parent[first], edge[first] = node[first], d[head]
            node[rows] = first[np.cumsum(head) - 1]
            rows = rows[~head]
        self.child = np.lexsort((edge, parent))  # children of a node stand together, by edge
        self.slot = parent[self.child] * (BITS + 1) + edge[self.child]

    def within(self, query: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, row) pairs within the radius, for rows as queries in their own trees."""
        todo = [(query, self.tree_of[query])]
        while todo:
            q, node = todo.pop()
            if len(q) > FRONTIER:
                half = len(q) // 2
                todo += [(q[:half], node[:half]), (q[half:], node[half:])]
                continue
            d = np.bitwise_count(self.fp[q] ^ self.fp[node]).astype("i8")
            hit = (d <= radius) & (q != node)
            if hit.any():
                yield q[hit], node[hit]
            at = node * (BITS + 1) + d
            low = np.searchsorted(self.slot, np.maximum(at - radius, node * (BITS + 1)))
            high = np.searchsorted(self.slot, np.minimum(at + radius, node * (BITS + 1) + BITS), side="right")
            n = high - low
            if n.sum():
                inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                todo.append((np.repeat(q, n), self.child[np.repeat(low, n) + inside]))


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked rows the smaller of their labels until all links agree; labels point to smaller rows."""
    while len(a):
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(flat := label[label], label):
            label[:] = flat


def _search(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links that join the rows of each shard as all pairs within the radius would, one a row at most."""
    def solve(shard, fp, own):
        forest = BKForest(shard, fp.view("u8"))
        label = np.arange(len(fp))
        for a, b in forest.within(np.flatnonzero(own), radius):
            _merge(label, a, b)
        joined = label != np.arange(len(fp))
        return pa.RecordBatch.from_arrays([pa.array(fp[joined]), pa.array(fp[label[joined]])], names=["a", "b"])

    held: list[tuple] = []
    rows = 0
    for batch in batches:
        held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)))
        rows += batch.num_rows
        if rows >= BATCH:
            shard, fp, own = (np.concatenate(x) for x in zip(*held, strict=True))
            cut = int(np.searchsorted(shard, shard[-1]))  # the last shard may go on
            if cut:
                yield solve(shard[:cut], fp[:cut], own[:cut])
            held, rows = [(shard[cut:], fp[cut:], own[cut:])], len(shard) - cut
    if rows:
        yield solve(*(np.concatenate(x) for x in zip(*held, strict=True)))


def shards(fps: DataFrame, radius: int = RADIUS, limit: int = SHARD_LIMIT) -> DataFrame:
    """(shard, fp, own): every pair within the radius shares a shard in which one of them has ``own`` set."""
    blocks = radius + 1
    width = BITS // blocks
    fp = F.col("fp")
    # The last block takes the bits left over by the division.
    parts = [F.shiftrightunsigned(fp, width * i) for i in range(blocks)]
    values = [p.bitwiseAND((1 << width) - 1) if i < blocks - 1 else p for i, p in enumerate(parts)]
    first = fps.select("fp", F.posexplode(F.array(*values)).alias("block", "value")).select(
        F.xxhash64("block", "value").alias("shard"), "block", "fp")
    large = first.groupBy("shard").count().where(F.col("count") > limit).select("shard")
    large = small_enough(materialize(large, "large-shards"))
    plain = first.join(large, "shard", "left_anti").select("shard", "fp", F.lit(True).alias("own"))
    # Of the other bits, rotated to the low end, again at least one of radius + 1 blocks is equal.
    rest = BITS - width
    inner = rest // blocks
    turned = F.coalesce(*[F.when(F.col("block") == i, F.shiftrightunsigned(fp, width * (i + 1)).bitwiseOR(
        F.shiftleft(fp, BITS - width * (i + 1))) if i < blocks - 1 else fp) for i in range(blocks)])
    values = [F.shiftrightunsigned(turned, inner * i).bitwiseAND(
        (1 << (inner if i < blocks - 1 else rest - inner * i)) - 1) for i in range(blocks)]
    second = (first.join(large, "shard", "left_semi")
              .select("shard", "fp", F.posexplode(F.array(*values)).alias("inner", "value"))
              .select(F.xxhash64("shard", "inner", "value").alias("shard"), "fp"))
    # What still is large: the tree goes to so many tasks, each of which searches for its share.
    copies = second.groupBy("shard").agg(F.ceil(F.count("*") / limit).cast("int").alias("copies"))
    dealt = (second.join(copies, "shard")
             .select("shard", "fp", "copies", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
             .select(F.xxhash64("shard", "copy").alias("shard"), "fp",
                     (F.pmod(F.xxhash64("fp"), F.col("copies")) == F.col("copy")).alias("own")))
    return plain.unionByName(dealt)


def search(fps: DataFrame, radius: int = RADIUS, limit: int = SHARD_LIMIT) -> DataFrame:
    """(a, b): links that join the different fingerprints of ``fps`` (fp) as all pairs within the radius would."""
    return (shards(fps, radius, limit).repartition("shard").sortWithinPartitions("shard", "fp")
            .mapInArrow(lambda it: _search(it, radius), "a long, b long"))


def classes(docs: DataFrame, radius: int = RADIUS, limit: int = SHARD_LIMIT) -> DataFrame:
    """doc_id, h, fp and least of every row: least is the smallest (no id, doc_id, h) of the row's component."""
    rows = materialize(fingerprints(docs), "fingerprints")
    own = F.struct(F.isnull("doc_id").alias("missing"), "doc_id", "h")
    fps = materialize(rows.groupBy("fp").agg(F.min(own).alias("least")), "distinct")
    roots = components(search(fps.select("fp"), radius, limit))
    joined = (fps.join(roots, fps["fp"] == roots["a"], "left")
              .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    least = joined.groupBy("root").agg(F.min("least").alias("least"))
    return rows.join(joined.select("fp", "root").join(least, "root").select("fp", "least"), "fp")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, limit: int = SHARD_LIMIT) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id of every row.

    Rows whose fingerprints differ in at most ``radius`` bits are linked; component_id is the smallest doc_id
    reachable, and NULL where a component has no ids. A NULL or empty text has the fingerprint zero and is
    linked like any other; repeated rows each give a row; other columns are left out.
    """
    return classes(docs, radius, limit).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least.doc_id").alias("component_id"))


def deduplicate(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component, see ``one_of_each``."""
    return one_of_each(docs, materialize(classes(docs, radius).select("doc_id", "h", "least"), "classes"))


def one_of_each(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id, then of the smallest text hash.

    ``rows`` has doc_id, h and least of every row. Rows without an id come last. Of rows that repeat the chosen id
    and text one stays. Texts are not moved while the rows to drop are few enough to broadcast. Extra columns may
    have any name.
    """
    key_id, key_h = free_names(docs, "_id", "_h")
    chosen = (F.col("h") == F.col("least.h")) & F.col("doc_id").eqNullSafe(F.col("least.doc_id"))
    dropped = rows.where(~chosen).select("doc_id", "h").distinct()
    repeated = rows.where(chosen).groupBy("doc_id", "h").count().where("count > 1").select("doc_id", "h")

    def key(side: DataFrame) -> DataFrame:
        return small_enough(side).select(F.col("doc_id").alias(key_id), F.col("h").alias(key_h))

    same = (F.xxhash64(text_of()) == F.col(key_h)) & docs["doc_id"].cast("long").eqNullSafe(F.col(key_id))
    kept = docs.join(key(dropped), same, "left_anti")
    if repeated.isEmpty():
        return kept
    once = (docs.join(key(repeated), same, "left_semi").withColumn(key_h, F.xxhash64(text_of()))
            .dropDuplicates(["doc_id", key_h]).drop(key_h))
    return kept.join(key(repeated), same, "left_anti").unionByName(once)
