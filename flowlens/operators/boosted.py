"""Boosted trees over binned features, for supervised checks and feature importances.

Features are binned once by quantiles and rows packed into blocks. A level of a tree needs one pass over the blocks:
gradient histograms per node, feature and bin are summed in each task, then over tasks; the loss of the held-out rows
comes from the same pass. Up to ``ONE_TASK_ROWS`` the blocks are few, and one task makes all passes by itself, by the
same code, as a Spark job for each level would cost more than the level. Beyond, blocks stay persisted with their
margins, to which each tree is added once, and a level is one job of one stage. It sums the rows of the lighter child of
each node only; the other child's sums are the node's less those. Only the columns of the tree are summed.
"""

from __future__ import annotations

import functools
import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlens.functions.columns import require
from flowlens.operators.evaluate import overfit_report
from flowlens.operators.forest import feature_value
from flowlens.operators.sampling import sample_n, split
from flowlens.sources.storage import materialize

# Settings of the two fits of the supervised job, of the quick fit that ranks features, and the rounds
# without a better held-out loss that end a fit.
FIRST = {"max_depth": 6, "rate": 0.1, "iterations": 200, "subsample": 0.8, "columns_share": 0.8}
TIGHTER = {"max_depth": 4, "rate": 0.05, "iterations": 300, "subsample": 0.7, "columns_share": 0.7}
QUICK = {"max_depth": 4, "rate": 0.1, "iterations": 50}
PATIENCE = 10

#: Bins of a feature, rows of a block, rows that one task fits, trees after which margins are written anew.
BINS, BLOCK_ROWS, ONE_TASK_ROWS, REFRESH = 64, 16_384, 200_000, 25
#: Rows of a block that stays persisted: each block on its way to Python or back waits for the one before.
KEPT_ROWS = 131_072
#: Rows for which a pass takes one more task, and tasks whose sums the driver adds by itself.
TASK_ROWS, FEW_TASKS = 50_000, 64
#: Penalty of leaf weights and least hessian of a leaf.
L2, LEAST = 1.0, 1.0

PARTS = {"bins": "u1", "y": "u1", "w": "<f8", "held": "u1", "draw": "<u8", "margin": "<f8"}
BLOCKS = ", ".join(f"{c} binary" for c in PARTS)
NODES = "tree int, node int, feature int, cut int, value double, gain double"


class Tree:
    """A tree as arrays in heap order: feature (-1 for a leaf), cut (bins up to it go left), value and gain."""

    def __init__(self, depth: int):
        size = 2 ** (depth + 1) - 1
        self.depth, self.feature, self.cut = depth, np.full(size, -1), np.zeros(size, int)
        self.value, self.gain = np.zeros(size), np.zeros(size)

    def places(self, bins: np.ndarray) -> np.ndarray:
        """The node where each row ends."""
        at, flat = np.zeros(len(bins), np.int64), bins.ravel()
        line = np.arange(len(bins)) * bins.shape[1]
        for _ in range(self.depth):
            feature = self.feature.take(at)
            at = np.where(feature < 0, at, 2 * at + 1 + (flat.take(line + np.maximum(feature, 0)) > self.cut.take(at)))
        return at


@dataclass
class Block:
    """Packed rows; ``margin`` holds the sum of the trees added, ``round`` the drawn rows of the tree that grows."""

    bins: np.ndarray
    y: np.ndarray
    w: np.ndarray
    held: np.ndarray
    draw: np.ndarray
    margin: np.ndarray
    round: tuple | None = None

    @classmethod
    def unpack(cls, row: dict, width: int) -> "Block":
        found = {c: np.frombuffer(row[c], t) for c, t in PARTS.items()}
        found["bins"] = found["bins"].reshape(-1, width)
        return cls(**{**found, "margin": found["margin"].copy()})

    @classmethod
    def merged(cls, blocks: list["Block"]) -> "Block":
        return cls(*(np.concatenate([getattr(b, c) for b in blocks]) for c in PARTS))

    def add(self, tree: Tree) -> "Block":
        return replace(self, margin=self.margin + tree.value[tree.places(self.bins)], round=None)

    def sums(self, into: tuple[np.ndarray, np.ndarray], number: int, tree: Tree, level: int, columns: np.ndarray, share: float,
             seed: int, sides: np.ndarray | None = None) -> None:
        """Add to (histograms, loss) for the tree of that number, when all before it are added.

        Histograms hold gradients and hessians by column of the tree, node of the level and bin; at the root the held-out
        loss and weight are added too. ``sides`` names the child of each node above whose rows count (all without).
        """
        out, loss = into
        if self.round is None or self.round[0] is not tree:
            held = self.held > 0
            if level == 0 and held.any():
                p, y, w = 1 / (1 + np.exp(-self.margin[held])), self.y[held], self.w[held]
                q = np.clip(np.where(y > 0, p, 1 - p), 1e-15, 1)
                loss += -(w * np.log(q)).sum(), w.sum()
            # A row is in a round's sample by a hash of its own key, whatever block it lies in.
            odd = np.uint64(np.random.default_rng([seed, number]).integers(1 << 62) * 2 + 1)
            drawn = ((self.draw * odd) >> np.uint64(40)).astype(float) < share * (1 << 24)
            line = np.flatnonzero(~held & drawn)
            p, w, y = 1 / (1 + np.exp(-self.margin[line])), self.w[line], self.y[line]
            self.round = tree, 0, line, np.zeros(len(line), np.int64), w * (p - y), w * p * (1 - p)
        _, reached, line, at, g, h = self.round
        flat, width = self.bins.ravel(), self.bins.shape[1]
        for _ in range(reached, level):
            further = np.flatnonzero(tree.feature.take(at) >= 0)  # a leaf stays one
            line, at, g, h = line[further], at[further], g[further], h[further]
            at = 2 * at + 1 + (flat.take(line * width + tree.feature.take(at)) > tree.cut.take(at))
        self.round = tree, level, line, at, g, h
        place = at - (2 ** level - 1)
        if sides is not None:
            rows = np.flatnonzero((place & 1) == sides[place >> 1])
            line, place, g, h = line[rows], place[rows], g[rows], h[rows]
        bins = self.bins.take(line, axis=0)
        node = place * BINS
        for i, f in enumerate(columns):
            cells = node + bins[:, f]
            out[i, 0] += np.bincount(cells, g, out.shape[2])
            out[i, 1] += np.bincount(cells, h, out.shape[2])


def no_sums(columns: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    return np.zeros((len(columns), 2, 2 ** level * BINS)), np.zeros(2)


def by_node(out: np.ndarray) -> np.ndarray:
    """Histograms by node, column, bin, and gradient or hessian."""
    return out.reshape(len(out), 2, -1, BINS).transpose(2, 0, 3, 1)


def lighter_sides(tree: Tree, level: int, above: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """For each node above the level, the child with the smaller hessian: 0 left, 1 right; the other's sums are what is left."""
    sides = np.zeros(2 ** (level - 1), int)
    for place in range(len(sides)):
        node = 2 ** (level - 1) - 1 + place
        if tree.feature[node] >= 0:
            part = above[place, np.searchsorted(columns, tree.feature[node]), :, 1]
            sides[place] = part[:tree.cut[node] + 1].sum() > part[tree.cut[node] + 1:].sum()
    return sides


def open_level(tree: Tree, level: int, sums: np.ndarray, columns: np.ndarray, rate: float) -> bool:
    """Split the nodes of a level where that gains; whether any was split."""
    found = False
    for place in range(2 ** level):
        node = 2 ** level - 1 + place
        if level and tree.feature[(node - 1) // 2] < 0:
            continue
        part = sums[place].cumsum(axis=1)
        left, whole = part[:, :-1], part[:, -1:]
        right = whole - left
        score = lambda x: x[..., 0] ** 2 / (x[..., 1] + L2)
        gain = np.where((left[..., 1] >= LEAST) & (right[..., 1] >= LEAST), score(left) + score(right) - score(whole), 0.0)
        if level == 0:
            tree.value[node] = -rate * whole[0, 0, 0] / (whole[0, 0, 1] + L2)
        best = int(gain.argmax())
        if gain.ravel()[best] <= 1e-9:
            continue
        f, cut = divmod(best, BINS - 1)
        tree.feature[node], tree.cut[node], tree.gain[node], found = columns[f], cut, gain.ravel()[best], True
        for child, side in ((2 * node + 1, left[f, cut]), (2 * node + 2, right[f, cut])):
            tree.value[child] = -rate * side[0] / (side[1] + L2)
    return found


def boost(gather, width: int, max_depth: int, rate: float, iterations: int, columns_share: float, seed: int) -> list[Tree]:
    """Grow trees until the held-out loss has not fallen for ``PATIENCE`` rounds; those up to the best round.

    ``gather(trees, tree, level, columns)`` sums the histograms of a level and the held-out loss over all rows.
    """
    trees, best, at = [], np.inf, 0
    for number in range(iterations):
        columns = np.sort(np.random.default_rng([seed, number, 1]).permutation(width)[:max(1, int(columns_share * width))])
        tree = Tree(max_depth)
        for level in range(max_depth):
            sums, loss = gather(trees, tree, level, columns)
            if level == 0 and loss[1] > 0:
                if loss[0] / loss[1] < best:
                    best, at = loss[0] / loss[1], number
                elif number - at >= PATIENCE:
                    return trees[:at]
            if not open_level(tree, level, sums, columns, rate):
                break
        trees.append(tree)
    return trees


def node_rows(trees: list[Tree]) -> pd.DataFrame:
    """The nodes of trees that are reached."""
    parts = []
    for number, t in enumerate(trees):
        used = np.array([n == 0 or t.feature[(n - 1) // 2] >= 0 for n in range(len(t.feature))])
        n = np.flatnonzero(used)
        parts.append(pd.DataFrame({"tree": number, "node": n, "feature": t.feature[n], "cut": t.cut[n], "value": t.value[n], "gain": t.gain[n]}))
    return pd.concat(parts) if parts else pd.DataFrame(columns=[c.split()[0] for c in NODES.split(", ")])


def trees_of(nodes: pd.DataFrame, depth: int) -> list[Tree]:
    out = []
    for _, part in nodes.groupby("tree"):
        tree, n = Tree(depth), part["node"].to_numpy(int)
        for c in ("feature", "cut", "value", "gain"):
            getattr(tree, c)[n] = part[c].to_numpy()
        out.append(tree)
    return out


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(edges)], axis=1).astype("u1")


@dataclass
class BoostedModel:
    columns: list[str]
    edges: list[np.ndarray]
    trees: list[Tree]

    def transform(self, df: DataFrame, out: str = "y_pred") -> DataFrame:
        """Add the predicted class and the probability of class 1."""
        shared = df.sparkSession.sparkContext.broadcast((self.edges, self.trees))  # at most rounds x 2^(depth + 1) nodes

        @F.pandas_udf("double")
        def chance(values: pd.DataFrame) -> pd.Series:
            edges, trees = shared.value
            bins, margin = binned(values.to_numpy(dtype=float), edges), np.zeros(len(values))
            for t in trees:
                margin += t.value[t.places(bins)]
            return pd.Series(1 / (1 + np.exp(-margin)))

        inputs = F.struct(*[feature_value(c).alias(f"c{i}") for i, c in enumerate(self.columns)])
        return df.withColumn("probability", chance(inputs)).withColumn(out, (F.col("probability") >= 0.5).cast("int"))

    def importances(self) -> DataFrame:
        """Total gain of each feature, as a share of all."""
        gains = np.zeros(len(self.columns))
        for t in self.trees:
            np.add.at(gains, t.feature[t.feature >= 0], t.gain[t.feature >= 0])
        gains /= gains.sum() or 1.0
        return SparkSession.active().createDataFrame(
            [(c, float(v)) for c, v in zip(self.columns, gains)], "feature string, importance double")

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        spark.createDataFrame(node_rows(self.trees), NODES).write.mode("overwrite").parquet(f"{path}/trees")
        meta = json.dumps([self.columns, [e.tolist() for e in self.edges], max((t.depth for t in self.trees), default=0)])
        spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").json(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "BoostedModel":
        columns, edges, depth = json.loads(spark.read.schema("meta string").json(f"{path}/meta").first()["meta"])
        nodes = spark.read.schema(NODES).parquet(f"{path}/trees").toPandas()  # the fitted model
        return cls(columns, [np.array(e) for e in edges], trees_of(nodes, depth))


def packed(rows: DataFrame, edges: list[np.ndarray]) -> DataFrame:
    """Rows (x, y, w, held, draw) as blocks of bins."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(i, BLOCK_ROWS)
                x = np.stack(part.column(0).to_numpy(zero_copy_only=False))
                y, w, held, draw = (part.column(k).to_numpy(zero_copy_only=False) for k in range(1, 5))
                values = (binned(x, edges), y.astype("u1"), w.astype("<f8"), held.astype("u1"), draw.view("u8"), np.zeros(len(x)))
                yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in values], names=list(PARTS))

    return rows.mapInArrow(pack, BLOCKS)


def fit_one_task(blocks: DataFrame, width: int, share: float, seed: int, settings: dict) -> list[Tree]:
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [Block.unpack(r, width) for b in batches for r in b.to_pylist()]
        state = {"block": Block.merged(own) if own else None, "done": 0}

        def gather(trees, tree, level, columns):
            if len(trees) > state["done"]:
                state.update(block=state["block"].add(trees[-1]), done=len(trees))
            into = no_sums(columns, level)
            state["block"].sums(into, len(trees), tree, level, columns, share, seed)
            return by_node(into[0]), into[1]

        if own:
            yield pa.RecordBatch.from_pandas(node_rows(boost(gather, width, seed=seed, **settings)), preserve_index=False,
                                             schema=pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()),
                                                               ("cut", pa.int32()), ("value", pa.float64()), ("gain", pa.float64())]))

    return trees_of(blocks.coalesce(1).mapInArrow(fit, NODES).toPandas(), settings["max_depth"])


def fit_many_tasks(blocks: DataFrame, width: int, share: float, seed: int, settings: dict, tasks: int) -> list[Tree]:
    spark = blocks.sparkSession

    def large(rows):
        held = []
        for r in rows:
            held.append(Block.unpack(r.asDict(), width))
            if sum(len(b.y) for b in held) >= KEPT_ROWS:
                yield Block.merged(held)
                held = []
        if held:
            yield Block.merged(held)

    def kept(df: DataFrame):
        return df.rdd.mapPartitions(large).persist(StorageLevel.MEMORY_AND_DISK_DESER)

    state = {"blocks": kept(blocks.repartition(tasks)), "old": None, "done": 0, "above": None}

    def gather(trees, tree, level, columns):
        number, above = len(trees), state["above"]
        sides = lighter_sides(tree, level, above, columns) if level else None
        if number > state["done"]:
            last, before = trees[-1], state["blocks"]
            now = before.map(lambda b: b.add(last)).persist(StorageLevel.MEMORY_AND_DISK_DESER)
            state.update(blocks=now, old=before, done=number)
            if number % REFRESH == 0:  # else the lineage would grow with the trees
                rows = now.map(lambda b: tuple(bytearray(getattr(b, c).astype(t).tobytes()) for c, t in PARTS.items()))
                state["blocks"] = kept(materialize(spark.createDataFrame(rows, BLOCKS), "margins"))
                now.unpersist()

        def part(own):
            into = no_sums(columns, level)
            for block in own:
                block.sums(into, number, tree, level, columns, share, seed, sides)
            yield into

        def both(a, b):
            return a[0] + b[0], a[1] + b[1]

        parts = state["blocks"].mapPartitions(part)  # one array a task, for the nodes of a level
        sums, loss = functools.reduce(both, parts.collect()) if tasks <= FEW_TASKS else parts.treeReduce(both)
        if state["old"] is not None:  # its successor is persisted now
            state["old"].unpersist()
            state["old"] = None
        sums = by_node(sums).copy()
        if level:
            each, split_nodes = np.arange(len(sides)), tree.feature[2 ** (level - 1) - 1:2 ** level - 1] >= 0
            sums[2 * each + 1 - sides] = np.where(split_nodes[:, None, None, None], above - sums[2 * each + sides], 0.0)
        state["above"] = sums
        return sums, loss

    try:
        return boost(gather, width, seed=seed, **settings)
    finally:
        state["blocks"].unpersist()


def class_weight(df: DataFrame, label: str) -> float:
    """Negatives over positives (1.0 without positives)."""
    r = df.agg(F.count_if(F.col(label) == 0).alias("n"), F.count_if(F.col(label) == 1).alias("p")).first()
    return r["n"] / r["p"] if r["p"] else 1.0


@dataclass
class BinnedRows:
    """What fits of other settings share: blocks of bins, the bins' edges and the number of rows that are fitted."""

    blocks: DataFrame
    edges: list[np.ndarray]
    fitted: int


def bin_rows(df: DataFrame, cols, label: str = "label_binary", key: str = "flow_id", test: float = 0.2, seed: int = 42,
             weight: float | None = None) -> BinnedRows:
    if not 0.0 < test < 1.0:
        raise ValueError(f"test must be between 0 and 1, got {test}")
    require(df, [label])
    cols = list(cols)
    weight = class_weight(df, label) if weight is None else weight
    kept = split(df.select(key, label, *[c for c in cols if c not in (key, label)]), key, label, test, seed=seed, few_strata=True)
    rows = materialize(kept.where(F.col(label).isNotNull()).select(
        F.array(*[feature_value(c) for c in cols]).alias("x"), F.col(label).cast("int").alias("y"),
        F.when(F.col(label) == 1, weight).otherwise(1.0).alias("w"), (F.col("split") == "test").alias("held"),
        F.xxhash64(F.col(key), F.lit(seed)).alias("draw")), "boosted-rows")
    places = [i / BINS for i in range(1, BINS)]
    found = rows.where("not held").agg(F.count("*"), *[F.percentile_approx(F.col("x")[i], places, 10_000) for i in range(len(cols))]).first()
    edges = [np.unique(np.array(e or [0.0])) for e in found[1:]]
    return BinnedRows(materialize(packed(rows, edges), "blocks"), edges, found[0])


def fit_boosted(df: DataFrame, cols, label: str = "label_binary", key: str = "flow_id", test: float = 0.2,
                seed: int = 42, weight: float | None = None, max_depth: int = 6, rate: float = 0.1,
                iterations: int = 100, subsample: float = 1.0, columns_share: float = 1.0,
                rows: BinnedRows | None = None) -> BoostedModel:
    """Boosted trees with a stratified hold-out that stops training early.

    ``weight`` is the weight of positive rows; by default both classes weigh the same in sum. ``rows`` are the same
    rows as binned before.
    """
    cols = list(cols)
    rows = rows or bin_rows(df, cols, label, key, test, seed, weight)
    settings = {"max_depth": max_depth, "rate": rate, "iterations": iterations, "columns_share": columns_share}
    given = rows.blocks, len(cols), subsample, seed, settings
    tasks = max(1, min(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows.fitted / TASK_ROWS)))
    trees = fit_one_task(*given) if rows.fitted <= ONE_TASK_ROWS else fit_many_tasks(*given, tasks)
    return BoostedModel(cols, rows.edges, trees)


def rank_features(df: DataFrame, cols, label: str = "label_binary", key: str = "flow_id", sample: int = 100_000,
                  weight: float = 1.0, seed: int = 42, **options) -> DataFrame:
    """Feature importances from a quick fit on a seeded sample."""
    rows = sample_n(df.select(key, label, *cols), key, sample, seed)
    return fit_boosted(rows, cols, label, key, weight=weight, seed=seed, **{**QUICK, **options}).importances()


def fit_with_guard(df: DataFrame, cols, label: str = "label_binary", key: str = "flow_id", seed: int = 42,
                   first=None, tighter=None) -> tuple[BoostedModel, DataFrame]:
    """Fit, and fit once more with tighter settings if the model overfits; model and reports."""
    report, binned_rows = None, None
    for settings in (first or FIRST, tighter or TIGHTER):
        own = {"test", "weight"} & set(settings)  # such rows are split or weighed in their own way
        if not own and binned_rows is None:
            binned_rows = bin_rows(df, cols, label, key, seed=seed)
        model = fit_boosted(df, cols, label, key, seed=seed, rows=None if own else binned_rows, **settings)
        rated = model.transform(split(df, key, label, 0.2, seed=seed, few_strata=True))
        found = overfit_report(rated, label)
        row = found.first()
        found = df.sparkSession.createDataFrame([row], found.schema)
        report = found if report is None else report.unionByName(found)
        if row["risk"] != "high":
            break
    return model, report
