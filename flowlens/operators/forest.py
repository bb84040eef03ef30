"""Isolation forest: trees grown in parallel tasks, scoring as a broadcast projection.

A tree needs only a few hundred rows, so fitting moves trees x samples rows once, whatever
the size of the table, and all groups (protocols) are fitted by the same job.

Every random choice is the MD5 of its place (seed, group, tree, node), so a forest does not depend on how rows
are spread, and any engine with that hash can grow the same one.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from flowlens.functions.quantiles import exact_quantiles
from flowlens.operators.sampling import ALL, hash_prefix, key_hash, rank_cuts, strata

NODE_SCHEMA = "grp string, tree int, node int, feature int, split double, child int, depth double"
EULER = 0.5772156649015329
ONE_GROUP = "all"


def expected_depth(n):
    """Mean path length of an unsuccessful search in a tree of n rows."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n - 1, 1.0)
    return np.where(n > 2, 2 * (np.log(safe) + EULER) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def feature_share(width: int) -> float:
    """Share of the features each tree sees, by the number of features."""
    return 1.0 if width <= 5 else 0.8 if width <= 10 else 0.6


#: Hex digits of an MD5 that make a number, and how many such numbers there are.
DRAW_DIGITS = 12
DRAWS = 1 << 4 * DRAW_DIGITS


def drawn(*place) -> int:
    """The random number, below ``DRAWS``, of a place."""
    return int(hashlib.md5("|".join(map(str, place)).encode()).hexdigest()[:DRAW_DIGITS], 16)


def drawn_column(*place) -> Column:
    """``drawn`` as a column."""
    text = F.concat_ws("|", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in place])
    return F.conv(F.substring(F.md5(text), 1, DRAW_DIGITS), 16, 10).cast("long")


def grow_tree(x: np.ndarray, columns: np.ndarray, *place) -> list[tuple]:
    """Random splits until rows are alone, alike or at the depth limit.

    A node is (feature, split, child, path length credited to rows that end there); the
    right child follows the left one, and a leaf is its own child with an endless split. For its
    draws node n, the root being 1, has the children 2n and 2n + 1.
    """
    limit = math.ceil(math.log2(max(len(x), 2)))
    nodes, todo = [None], [(0, np.arange(len(x)), 0, 1)]
    while todo:
        here, rows, depth, number = todo.pop()
        part = x[rows][:, columns]
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or len(usable) == 0:
            nodes[here] = (0, math.inf, here, depth + float(expected_depth(len(rows))))
            continue
        pick = usable[drawn(*place, number, "feature") % len(usable)]
        cut = low[pick] + (high[pick] - low[pick]) * (drawn(*place, number, "split") / DRAWS)
        goes_left = part[:, pick] <= cut
        if goes_left.all():  # the cut rounded up to the maximum
            cut = low[pick]
            goes_left = part[:, pick] <= cut
        nodes[here] = (int(columns[pick]), float(cut), len(nodes), 0.0)
        todo += [(len(nodes), rows[goes_left], depth + 1, 2 * number),
                 (len(nodes) + 1, rows[~goes_left], depth + 1, 2 * number + 1)]
        nodes += [None, None]
    return nodes


def walk(x: np.ndarray, trees, steps: int) -> np.ndarray:
    """Mean path length of each row over all trees, one small tree at a time."""
    flat, width = np.ascontiguousarray(x).ravel(), x.shape[1]
    line, total = np.arange(len(x)) * width, np.zeros(len(x))
    for feature, split, child, depth in trees:
        at = np.zeros(len(x), np.int64)
        for _ in range(steps):
            value = flat.take(line + feature.take(at))
            at = child.take(at) + (value > split.take(at))
        total += depth.take(at)
    return total / max(len(trees), 1)


@dataclass
class ForestModel:
    """Fitted trees as one table of nodes; scores are the model's only output."""

    columns: list[str]
    group: str | None
    sizes: dict  # group -> rows per tree
    nodes: pd.DataFrame
    contamination: dict = field(default_factory=dict)
    offsets: dict = field(default_factory=dict)

    def packed(self) -> dict:
        """Per group: its trees as node arrays, the depth limit and the depth scale."""
        out = {}
        for grp, part in self.nodes.sort_values(["tree", "node"]).groupby("grp"):
            trees = [tuple(t[c].to_numpy(kind) for c, kind in (
                ("feature", np.int64), ("split", float), ("child", np.int64), ("depth", float)))
                for _, t in part.groupby("tree")]
            size = self.sizes[grp]
            out[grp] = (trees, math.ceil(math.log2(max(size, 2))), float(expected_depth(size)))
        return out

    def transform(self, df: DataFrame, out: str = "raw_score") -> DataFrame:
        """Add the raw score in (-1, 0); lower is more anomalous. Groups without trees get NULL."""
        # At most groups x trees x 2 x 256 nodes: a fitted model of bounded size.
        shared = df.sparkSession.sparkContext.broadcast(self.packed())

        @F.pandas_udf("double")
        def score(grp: pd.Series, values: pd.DataFrame) -> pd.Series:
            result = np.full(len(grp), np.nan)
            x = values.to_numpy(dtype=float)
            names = grp.to_numpy()
            for name, (trees, steps, scale) in shared.value.items():
                rows = np.flatnonzero(names == name)
                for begin in range(0, len(rows), 4096):
                    part = rows[begin:begin + 4096]
                    result[part] = -np.exp2(-walk(x[part], trees, steps) / max(scale, 1e-12))
            return pd.Series(result)

        # Else a filter on the score would walk the trees once more, in a second Python worker of the same task.
        score = score.asNondeterministic()
        group = F.col(self.group).cast("string") if self.group else F.lit(ONE_GROUP)
        inputs = F.struct(*[feature_value(c).alias(f"c{i}") for i, c in enumerate(self.columns)])
        return df.withColumn(out, F.nanvl(score(F.coalesce(group, F.lit("")), inputs), F.lit(None).cast("double")))

    def fit_offsets(self, train: DataFrame, contamination: dict | float, raw: str = "raw_score") -> "ForestModel":
        """Learn, per group, the raw score below which the contamination share of rows lies."""
        scored = train if raw in train.columns else self.transform(train, raw)
        group = F.col(self.group).cast("string") if self.group else F.lit(ONE_GROUP)
        groups = list(self.sizes)
        shares = contamination if isinstance(contamination, dict) else {g: contamination for g in groups}
        wanted = sorted(set(shares.values()))
        rows = scored.select(group.alias("grp"), raw).where(F.col(raw).isNotNull())
        for r in exact_quantiles(rows, ["grp"], raw, wanted, few_groups=True).collect():
            self.offsets[r["grp"]] = r["q"][wanted.index(shares[r["grp"]])]
        self.contamination = shares
        return self

    def predict_labels(self, df: DataFrame, raw: str = "raw_score", out: str = "label") -> DataFrame:
        """-1 below the group's offset, else 1."""
        scored = df if raw in df.columns else self.transform(df, raw)
        group = F.col(self.group).cast("string") if self.group else F.lit(ONE_GROUP)
        offset = F.create_map(*[F.lit(v) for kv in self.offsets.items() for v in kv])[group]
        return scored.withColumn(out, F.when(F.col(raw) < offset, -1).otherwise(1))

    def save(self, path: str, spark: SparkSession | None = None) -> None:
        spark = spark or SparkSession.active()
        spark.createDataFrame(self.nodes, NODE_SCHEMA).write.mode("overwrite").parquet(f"{path}/nodes")
        rows = [(g, n, self.offsets.get(g), self.contamination.get(g)) for g, n in self.sizes.items()]
        (spark.createDataFrame(rows, "grp string, size int, offset double, contamination double")
         .withColumns({"columns": F.lit(list(self.columns)), "group_column": F.lit(self.group)})
         .coalesce(1).write.mode("overwrite").json(f"{path}/groups"))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ForestModel":
        groups = spark.read.schema(
            "grp string, size int, offset double, contamination double, columns array<string>, group_column string"
        ).json(f"{path}/groups").collect()
        nodes = spark.read.parquet(f"{path}/nodes").toPandas()  # the fitted model
        return cls(groups[0]["columns"], groups[0]["group_column"], {g["grp"]: g["size"] for g in groups}, nodes,
                   {g["grp"]: g["contamination"] for g in groups if g["contamination"] is not None},
                   {g["grp"]: g["offset"] for g in groups if g["offset"] is not None})


def feature_value(name: str) -> Column:
    return F.coalesce(F.nanvl(F.col(name).cast("double"), F.lit(0.0)), F.lit(0.0))


def fit_forest(df: DataFrame, cols, key: str = "flow_id", group: str | None = None, trees: int = 100,
               max_samples: int = 256, max_features: float | None = None, bootstrap: bool = False,
               min_rows: int = 1, seed: int = 42) -> ForestModel:
    """Fit a forest, or one forest per value of ``group`` with at least ``min_rows`` rows."""
    spark, cols = df.sparkSession, list(cols)
    counts = {r["_l"]: r["n"] for r in strata(df, group).where(F.col("n") >= max(min_rows, 1)).where(
        "_l IS NOT NULL").collect()}  # one row for each group that gets a forest
    if not counts:
        return ForestModel(cols, group, {}, pd.DataFrame(columns=[c.split()[0] for c in NODE_SCHEMA.split(", ")]))
    draws = {g: min(max_samples, n) for g, n in counts.items()}
    pool = {g: min(n, trees * draws[g]) for g, n in counts.items()}
    # Rows up to the hash prefix that fills the pool, as the rows' own hashes are: those of a training split may all be high.
    row_hash, least = key_hash(key, seed), dict.fromkeys(counts, ALL)
    if parts := [(g, n, [pool[g]]) for g, n in counts.items() if pool[g] < n]:
        sizes = spark.createDataFrame(parts, f"_l {dict(df.dtypes)[group] if group else 'int'}, n long, _sizes array<long>")
        least |= {r["_l"]: r["_p"] for r in rank_cuts(df, key, group, F.broadcast(sizes), seed).collect()}
    name = F.col(group).cast("string") if group else F.lit(ONE_GROUP)
    named = {g: str(g) if group else ONE_GROUP for g in counts}
    cuts = spark.createDataFrame([(named[g], p) for g, p in least.items()], "_cut_group string, _cut string")
    chosen = df.join(F.broadcast(cuts), (name == F.col("_cut_group")) & (hash_prefix(key, seed) <= F.col("_cut")))
    # At most trees x max_samples rows per group are ranked and joined.
    order = Window.partitionBy("grp").orderBy("_h", "x")
    chosen = (chosen.select(name.alias("grp"), row_hash.alias("_h"), F.array(*[feature_value(c) for c in cols]).alias("x"))
              .select("grp", "x", (F.row_number().over(order) - 1).cast("long").alias("pos")))

    # Which pool positions each tree draws: any with replacement; else a run of its own or, in a pool too small for
    # that, from a random place on.
    table = spark.createDataFrame([(named[g], draws[g], pool[g]) for g in counts], "grp string, draws long, pool long")
    table = table.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    draw = F.col("draw")
    start = F.when(F.col("pool") < trees * F.col("draws"), drawn_column(seed, F.col("grp"), F.col("tree"), "start")).otherwise(
        F.col("tree") * F.col("draws"))
    position = F.pmod(drawn_column(seed, F.col("grp"), F.col("tree"), draw) if bootstrap else start + draw, F.col("pool"))
    picked = (table.withColumn("draw", F.explode(F.sequence(F.lit(0).cast("long"), F.col("draws") - 1)))
              .select("grp", "tree", "draw", position.alias("pos")))
    # Few bytes but much work per row: one task per core, which coalescing would undo.
    tasks = max(1, min(len(counts) * trees, spark.sparkContext.defaultParallelism))
    dealt = picked.join(chosen, ["grp", "pos"]).repartition(tasks, "grp", "tree")
    width = max(1, int((max_features if max_features is not None else feature_share(len(cols))) * len(cols)))
    total = len(cols)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("draw")
        grp, tree = pdf["grp"].iloc[0], int(pdf["tree"].iloc[0])
        columns = np.array(sorted(sorted(range(total), key=lambda c: drawn(seed, grp, tree, f"c{c}"))[:width]))
        nodes = grow_tree(np.stack(pdf["x"].to_numpy()), columns, seed, grp, tree)
        out = pd.DataFrame(nodes, columns=["feature", "split", "child", "depth"])
        out.insert(0, "node", np.arange(len(out)))
        out.insert(0, "tree", tree)
        out.insert(0, "grp", grp)
        return out

    nodes = dealt.groupBy("grp", "tree").applyInPandas(build, NODE_SCHEMA).toPandas()  # the fitted model
    return ForestModel(cols, group, {named[g]: n for g, n in draws.items()}, nodes.sort_values(["grp", "tree", "node"], ignore_index=True))


def protocol_group(df: DataFrame, main=("tcp", "udp"), col: str = "Proto", out: str = "protocol_group") -> DataFrame:
    """tcp and udp flows by name, everything else (also a missing protocol) as 'other'."""
    name = F.lower(col)
    return df.withColumn(out, F.when(name.isin(list(main)), name).otherwise("other"))


def fit_grouped(df: DataFrame, cols, group: str = "protocol_group", label: str | None = "label_binary",
                min_rows: int = 1000, default_contamination: float = 0.1, **options) -> tuple[ForestModel, DataFrame]:
    """One forest per group in a single job, with a report of every group."""
    from flowlens.operators.thresholds import contamination

    model = fit_forest(df, cols, group=group, min_rows=min_rows, **options)  # checks the number of groups
    table = contamination(df, label or "", group, default=default_contamination).collect()
    model.contamination = {str(r[group]): r["contamination"] for r in table if str(r[group]) in model.sizes}
    report = df.sparkSession.createDataFrame(
        [(str(r[group]), r["rows"], r["contamination"], str(r[group]) in model.sizes) for r in table],
        "grp string, rows long, contamination double, trained boolean")
    return model, report


def group_score_stats(scored: DataFrame, group: str = "protocol_group", raw: str = "raw_score") -> DataFrame:
    """(group, mean, std): mean and population deviation of the negated raw score per group."""
    return (scored.where(F.col(raw).isNotNull()).groupBy(group)
            .agg(F.avg(-F.col(raw)).alias("mean"), F.stddev_pop(-F.col(raw)).alias("std")))


def score_grouped(scored: DataFrame, stats: DataFrame, group: str = "protocol_group", raw: str = "raw_score",
                  out: str = "anomaly_score", invert_score: bool = False) -> DataFrame:
    """Standardise the negated raw score per group and squash it to (0, 1); higher = more anomalous.

    A constant group scores 0; rows of a group without a model have no score. ``stats`` come
    from the training rows. ``invert_score`` flips the result, as older runs stored it.
    """
    table = stats.select(F.col(group).alias("_g"), F.col("mean").alias("_mean"), F.col("std").alias("_std"))
    z = (-F.col(raw) - F.col("_mean")) / F.col("_std")
    value = F.when(F.col("_std") > 1e-6, 1 / (1 + F.exp(-z))).when(F.col("_g_known"), 0.0)
    result = F.when(F.col(raw).isNotNull(), value)
    joined = scored.join(table.withColumn("_g_known", F.lit(True)), F.col(group).eqNullSafe(F.col("_g")), "left")
    return joined.withColumn("_score", -result if invert_score else result).select(
        *[c for c in scored.columns if c != out], F.col("_score").alias(out))


def ensemble(df: DataFrame, scores: dict[str, float], group: str | None = None, out: str = "ensemble_score") -> DataFrame:
    """Weighted mean of detectors' scores after min-max scaling per group.

    Weights are renormalised over the detectors that scored the row.
    """
    key = F.col(group) if group else F.lit(0)
    ranges = df.groupBy(key.alias("_g")).agg(*[
        F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(f"_r_{c}") for c in scores])
    joined = df.join(ranges, key.eqNullSafe(F.col("_g")))
    total, weight = F.lit(0.0), F.lit(0.0)
    for name, share in scores.items():
        low, high = F.col(f"_r_{name}.low"), F.col(f"_r_{name}.high")
        scaled = F.when(high > low, (F.col(name) - low) / (high - low)).otherwise(F.col(name))
        total = total + F.coalesce(scaled * share, F.lit(0.0))
        weight = weight + F.when(F.col(name).isNotNull(), F.lit(share)).otherwise(0.0)
    return joined.withColumn("_score", F.try_divide(total, weight)).select(
        *[c for c in df.columns if c != out], F.col("_score").alias(out))
