"""Shards of indivisible groups by best-fit-decreasing bin packing.

Groups of equal texts are never cut. Sorted by size they enter the bin with the tightest remaining capacity that
holds them, found in a balanced tree. Groups of less than a ``UNITS``-th of a shard travel in bundles by the hash
of their text, so the number of items to place follows from the number of shards and not from the table. Rows never
move: they look up the place of their item and take a slot by prefix sums over the written parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import materialize, small_enough, text_of

#: Bytes a row has beside its text; items a shard has at least, if they are bundles; shards placed by one task.
ROW_BYTES, UNITS, LANE_SHARDS = 16, 256, 256


class Tree:
    """Balanced search tree of different keys (a treap): add, remove, and the least key not below a bound."""

    def __init__(self):
        self.root, self.draw = None, np.random.default_rng(5)

    def add(self, key) -> None:
        low, high = self._split(self.root, key)
        self.root = self._join(self._join(low, [key, self.draw.random(), None, None]), high)

    def remove(self, key) -> None:
        def without(node):
            if node[0] == key:
                return self._join(node[2], node[3])
            side = 2 if key < node[0] else 3
            node[side] = without(node[side])
            return node

        self.root = without(self.root)

    def ceiling(self, bound):
        node, best = self.root, None
        while node is not None:
            node, best = (node[2], node[0]) if node[0] >= bound else (node[3], best)
        return best

    def last(self):
        node = self.root
        while node is not None and node[3] is not None:
            node = node[3]
        return node and node[0]

    def _split(self, node, key):
        """The nodes below ``key``, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], high = self._split(node[3], key)
            return node, high
        low, node[2] = self._split(node[2], key)
        return low, node

    def _join(self, low, high):
        if low is None or high is None:
            return low or high
        if low[1] > high[1]:
            low[3] = self._join(low[3], high)
            return low
        high[2] = self._join(low, high[2])
        return high


def best_fit(sizes: list[int], capacity: int, bins: int | None = None) -> list[int]:
    """The bin of each item. Items larger than ``capacity`` have a bin of their own.

    Without ``bins`` a new one is opened where an item fits nowhere. With ``bins`` there are so many from the start, as
    equal as can be: an item that fits nowhere enters the emptiest, and what oversized items do not take is the
    others' capacity.
    """
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    out, tree, used = [0] * len(sizes), Tree(), 0
    if bins is not None:
        rest, first = sum(sizes), 0
        while first < len(order) and used < bins - 1 and sizes[order[first]] * (bins - used) > rest:
            out[order[first]] = used
            rest, used, first = rest - sizes[order[first]], used + 1, first + 1
        order, capacity = order[first:], -(-rest // (bins - used))
        for b in range(used, bins):
            tree.add((capacity, b))
    for i in order:
        place = tree.ceiling((sizes[i], -1))
        if place is None and bins is not None:
            place = tree.last()
        if place is None:
            place, used = (max(capacity, sizes[i]), used), used + 1
        else:
            tree.remove(place)
        out[i] = place[1]
        tree.add((place[0] - sizes[i], place[1]))
    return out


def described(docs: DataFrame) -> DataFrame:
    """One narrow row for each document, with two hashes that stand for its text."""
    text = text_of()
    return materialize(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")), "rows")


def placed(rows: DataFrame, total: int, shards: int | None, capacity: int | None) -> DataFrame:
    """``rows`` with ``shard``."""
    share = capacity or -(-total // shards)
    lanes = 1 if shards else max(1, -(-total // (share * LANE_SHARDS)))
    buckets = UNITS * (shards or LANE_SHARDS * lanes)
    groups = rows.groupBy("k1", "k2").agg(F.sum("size").alias("bytes"))
    whole = F.col("bytes") * UNITS > share
    bucket = F.when(~whole, F.pmod("k1", F.lit(buckets)))
    items = (groups.groupBy(F.when(whole, F.col("k1")).alias("k1"), F.when(whole, F.col("k2")).alias("k2"), bucket.alias("bucket"))
             .agg(F.sum("bytes").alias("bytes")).withColumn("lane", F.pmod(F.xxhash64("k1", "k2", "bucket"), F.lit(lanes))))

    def lane(key: tuple, items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["bytes", "bucket", "k1", "k2"], ascending=False)  # its own order among equal sizes
        return items[["k1", "k2", "bucket", "lane"]].assign(bin=best_fit(items["bytes"].tolist(), share, shards))

    kept = items.select(F.coalesce("k1", F.lit(0)).alias("k1"), F.coalesce("k2", F.lit(0)).alias("k2"),
                        F.coalesce("bucket", F.lit(-1)).alias("bucket"), "bytes", "lane")
    plan = materialize(kept.groupBy("lane").applyInPandas(lane, "k1 long, k2 long, bucket long, lane long, bin int"), "plan")
    used = plan.groupBy("lane").agg((F.max("bin") + 1).alias("n"))
    base = used.select("lane", (F.sum("n").over(Window.orderBy("lane")) - F.col("n")).cast("int").alias("base"))  # one row a lane
    plan = materialize(plan.join(F.broadcast(base), "lane").withColumn("shard", F.col("bin") + F.col("base")), "plan")
    large = small_enough(plan.where("bucket = -1").select("k1", "k2", F.col("shard").alias("large")))
    small = small_enough(plan.where("bucket >= 0").select("bucket", F.col("shard").alias("small")))
    return (rows.join(large, ["k1", "k2"], "left").withColumn("bucket", F.pmod("k1", F.lit(buckets))).join(small, "bucket", "left")
            .select("doc_id", "size", "text_crc32", F.coalesce("large", "small").alias("shard")))


def slotted(rows: DataFrame) -> DataFrame:
    """``rows`` with ``slot``, gapless from 0 in every shard: counted in each task, then moved by prefix sums."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), {}
        for b in batches:
            shard = b.column(3).to_numpy()
            order = np.argsort(shard, kind="stable")
            kinds, first, times = np.unique(shard[order], return_index=True, return_counts=True)
            before = np.array([seen.get(k, 0) for k in kinds.tolist()], "i8")
            place = np.empty(len(shard), "i8")
            place[order] = np.arange(len(shard)) - np.repeat(first - before, times)
            seen.update(zip(kinds.tolist(), (before + times).tolist(), strict=True))
            yield b.append_column("place", pa.array(place)).append_column("part", pa.array(np.full(len(shard), part), pa.int32()))

    own = "doc_id long, size long, text_crc32 long, shard int"
    counted = materialize(rows.select("doc_id", "size", "text_crc32", "shard").mapInArrow(count, f"{own}, place long, part int"), "places")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = (counted.groupBy("part", "shard").agg(F.count("*").alias("n"))
            .select("part", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    return (counted.join(small_enough(materialize(base, "bases")), ["part", "shard"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("place")).alias("slot")))


def shard_documents(docs: DataFrame, shards: int | None = None, capacity: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row; equal texts share a shard.

    With ``shards`` there are so many, of sizes as equal as whole groups allow (law ``bytes``); a group of more than its
    share has a shard to itself and the others share the rest. With ``capacity`` there are as few shards of so many
    bytes as best fit decreasing needs in lanes of about ``LANE_SHARDS`` (law ``capacity``); a larger group has its own.
    NULL and empty texts are one group of rows of 16 bytes. Repeated rows have slots of their own. An empty table
    gives no rows; other columns are left out.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give either shards or capacity")
    rows = described(docs)
    total = rows.agg(F.sum("size")).first()[0] or 0
    out = slotted(placed(rows, total, shards, capacity) if total else rows.withColumn("shard", F.lit(0)))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes" if shards else "capacity").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
