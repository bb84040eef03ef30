"""Exact nearest neighbours in a metric space, and the local outlier factor on tables of any size.

Different points (with their number of copies) are dealt to the nearest of a bounded number of pivots and, by their
distance to it, to rings of bounded size. A query first visits the nearest rings; its k-th distance so far and the
triangle inequality then tell which other rings can hold nearer points, and it visits only those. Rings next to each
other form blocks: a query is sent once to a block, with the names of the rings it visits there, and the queries of a
busy block are dealt over several tasks, so that a task holds a bounded number of points and queries. Points,
k-distances and densities stay tables; pivots and the rings' bounds, whose number is limited, are all that is broadcast.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from flowlens.functions.quantiles import exact_quantile
from flowlens.operators.forest import feature_value
from flowlens.sources.storage import materialize

#: Points of a ring and most queries that meet a block in a task; limits of pivots and rings; cuts of a pivot's distances.
RING, VISITS, PIVOTS, RINGS, CUTS = 2_048, 32_768, 1_024, 100_000, 32
#: Numbers of the vectors of a block of points, and of those that are sent on at once.
NUMBERS, SENT = 4_000_000, 250_000
#: Fewest queries for which a task of their own is worth its points.
FEW_VISITS = 1_024
#: Numbers of a matrix of distances, and what distances by matrix products may be off, by the points' size.
CELLS, SLACK = 1_000_000, 1e-6

POINTS = "id long, x array<double>, copies long, ring long, reach double, density double"


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances as matrix products give them."""
    return np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T, 0.0)


def nearest(queries: np.ndarray, bound: np.ndarray, rows: np.ndarray, spans: np.ndarray, train: np.ndarray,
            begins: np.ndarray, ids: np.ndarray, k: int):
    """Rows of queries, places of training rows and distances of the k nearest training rows within each query's bound.

    Query ``rows[i]`` (rising) looks through span ``spans[i]``, the training rows from ``begins[spans[i]]`` to the next
    begin. Matrix products, a limited number of cells at a time, find at most k candidates of a span; their distances
    are then taken directly, as the product form loses digits, and lower the bound for the next spans.
    """
    own, norms = (queries * queries).sum(axis=1), (train * train).sum(axis=1)
    slack = SLACK * (1 + np.sqrt(own) + np.sqrt(norms.max()))
    limit, step, found = bound.copy(), max(1, CELLS // int(np.diff(begins).max())), []
    for begin in range(0, len(queries), step):
        of = slice(*np.searchsorted(rows, [begin, begin + step]))
        row, place, dist = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        for span in np.unique(spans[of]):
            at, first = rows[of][spans[of] == span], begins[span]
            part = train[first:begins[span + 1]]
            d = (-2 * queries[at]) @ part.T
            d += norms[first:begins[span + 1]]
            i, j = np.nonzero(d <= ((limit[at] + slack[at]) ** 2 - own[at])[:, None])
            crowded = np.bincount(i, minlength=len(at)) > k
            if crowded.any():
                top, kept = np.argpartition(d[crowded], k - 1, axis=1)[:, :k], ~crowded[i]
                i = np.concatenate([i[kept], np.repeat(np.flatnonzero(crowded), k)])
                j = np.concatenate([j[kept], top.ravel()])
            exact = np.sqrt(((part[j] - queries[at[i]]) ** 2).sum(axis=1))
            near = exact <= limit[at[i]]
            row, place, dist = (np.concatenate(c) for c in ((row, at[i[near]]), (place, first + j[near]), (dist, exact[near])))
            order = np.lexsort((ids[place], dist, row))
            row, place, dist = row[order], place[order], dist[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            limit[row[rank == k - 1]] = dist[rank == k - 1]
            row, place, dist = row[rank < k], place[rank < k], dist[rank < k]
        found.append((row, place, dist))
    return tuple(np.concatenate(c) for c in zip(*found))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float)


def vectors(column) -> np.ndarray:
    """Arrow lists, which have one length, as the rows of a matrix."""
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    if len(pc.unique(pc.list_value_length(column))) > 1:
        raise ValueError("all vectors must have one length")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
    return flat.reshape(len(column), len(flat) // max(len(column), 1))


@dataclass
class Space:
    """Points in rings: ``points`` (id, x, copies, ring), the pivots, and per ring its pivot, bounds and size."""

    points: DataFrame
    pivots: np.ndarray
    rings: pd.DataFrame  # ring, low, high, n; the pivot is in the high bits of ring

    @property
    def width(self) -> int:
        return max(1, self.pivots.shape[1])

    @property
    def blocks(self) -> np.ndarray:
        """Of each ring the block it is in; blocks are runs of rings."""
        n = self.rings["n"].to_numpy()
        return (np.cumsum(n) - n) // max(1, NUMBERS // self.width)

    def reach(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per query and ring: the least distance a point of it can have, that to its pivot, and the slack of both."""
        to = np.sqrt(_products(x, self.pivots))[:, self.rings["ring"].to_numpy() >> 40]
        least = np.maximum(np.maximum(self.rings["low"].to_numpy() - to, to - self.rings["high"].to_numpy()), 0.0)
        return least, to, SLACK * (1 + np.sqrt((x * x).sum(axis=1)) + np.sqrt((self.pivots ** 2).sum(axis=1)).max())

    def home(self, x: np.ndarray, k: int) -> list[np.ndarray]:
        """Of each query the places of the nearest rings that together hold k points."""
        least, to, _ = self.reach(x)
        order = np.argsort(least + 1e-6 * to, axis=1, kind="stable")
        held = np.cumsum(self.rings["n"].to_numpy()[order], axis=1)
        return [o[:1 + int((h < k).sum())] for o, h in zip(order, held, strict=True)]

    def other(self, x: np.ndarray, bound: np.ndarray, k: int) -> list[np.ndarray]:
        """Of each query the places of the further rings that may hold a point within its bound."""
        least, _, slack = self.reach(x)
        return [np.setdiff1d(np.flatnonzero(l <= b + s), h, assume_unique=True)
                for l, b, s, h in zip(least, bound, slack, self.home(x, k), strict=True)]


def build_space(points: DataFrame, n: int) -> Space:
    """Deal ``n`` points (id, x, copies) over rings. Only pivots and rings, both limited in number, are collected."""
    spark = points.sparkSession
    drawn = points.orderBy(F.xxhash64("id", F.lit(42)), "id").limit(min(PIVOTS, max(1, n // RING))).select("x").toPandas()
    pivots = _matrix(drawn["x"])
    shared = spark.sparkContext.broadcast(pivots)

    def deal(batches):
        for pdf in batches:
            x, parts = _matrix(pdf["x"]), []
            step = max(1, CELLS // len(shared.value))
            for i in range(0, len(x), step):
                d = _products(x[i:i + step], shared.value)
                at = d.argmin(axis=1)
                parts.append(pd.DataFrame({"pivot": at, "d": np.sqrt(d[np.arange(len(at)), at])}))
            yield pd.concat([pdf.reset_index(drop=True), pd.concat(parts, ignore_index=True)], axis=1)

    dealt = materialize(points.mapInPandas(deal, "id long, x array<double>, copies long, pivot long, d double"), "dealt")
    size = max(RING, n // RINGS)
    cuts = dealt.groupBy("pivot").agg(F.ceil(F.count("*") / size).alias("parts"),
                                      F.percentile_approx("d", [i / CUTS for i in range(1, CUTS)], 1000).alias("cuts"))
    band = F.floor(F.size(F.filter("cuts", lambda c: c < F.col("d"))) * F.least("parts", F.lit(CUTS)) / CUTS)
    salt = F.pmod(F.xxhash64("id"), F.ceil(F.col("parts") / CUTS))
    ring = (F.shiftleft("pivot", 40) + F.shiftleft(band.cast("long"), 32) + salt).alias("ring")
    placed = materialize(dealt.join(F.broadcast(cuts), "pivot").select("id", "x", "copies", "d", ring), "points")
    rings = placed.groupBy("ring").agg(F.min("d").alias("low"), F.max("d").alias("high"), F.count("*").alias("n"))
    return Space(placed.drop("d"), pivots, rings.orderBy("ring").toPandas())


def _meet(visits: DataFrame, space: Space, k: int) -> DataFrame:
    """qid, id, copies and dist of the k nearest points of each block a query visits (qid, x, bound, block, rings)."""
    spark = visits.sparkSession
    busy = visits.groupBy("block").agg(F.count("*").alias("n")).toPandas()  # a row for each block at most
    fair = max(FEW_VISITS, int(busy["n"].sum()) // (4 * spark.sparkContext.defaultParallelism))
    most = max(1, min(VISITS, NUMBERS // space.width, fair))
    chunks = dict(zip(busy["block"], -(-busy["n"] // most)))
    of_block = spark.createDataFrame([(int(b), int(c)) for b, c in chunks.items()], "block long, chunks long")
    of_ring = spark.createDataFrame([(int(r), int(b), int(chunks[b])) for r, b in zip(space.rings["ring"], space.blocks) if b in chunks],
                                    "ring long, block long, chunks long")
    queries = (visits.join(F.broadcast(of_block), "block")
               .select("block", F.pmod(F.xxhash64("qid"), F.col("chunks")).alias("chunk"), "qid", "x", "bound", "rings"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk")
    points = space.points.join(F.broadcast(of_ring), "ring").select("block", every, "ring", "id", "x", "copies")

    def search(q: pa.Table, p: pa.Table) -> pa.Table:
        if not len(q) or not len(p):
            return pa.table({n: pa.array([], t) for n, t in (("qid", pa.int64()), ("id", pa.int64()), ("copies", pa.int64()),
                                                             ("dist", pa.float64()))})
        p = p.take(pc.sort_indices(p.select(["ring", "id"]), [("ring", "ascending"), ("id", "ascending")]))
        rings, begins = np.unique(p["ring"].to_numpy(), return_index=True)
        named = pa.concat_arrays(q["rings"].chunks)
        rows = np.repeat(np.arange(len(q)), pc.list_value_length(named).to_numpy())
        spans = np.searchsorted(rings, named.flatten().to_numpy())
        ids = p["id"].to_numpy()
        row, place, dist = nearest(vectors(q["x"]), q["bound"].to_numpy(), rows, spans, vectors(p["x"]),
                                   np.append(begins, len(p)), ids, k)
        return pa.table({"qid": q["qid"].to_numpy()[row], "id": ids[place], "copies": p["copies"].to_numpy()[place], "dist": dist})

    keys = ["block", "chunk"]
    return queries.groupBy(*keys).cogroup(points.groupBy(*keys)).applyInArrow(search, "qid long, id long, copies long, dist double")


def nearest_points(queries: DataFrame, space: Space, k: int) -> DataFrame:
    """qid, id, copies and dist of the ``k`` nearest points of each query (qid, x); ties go to the smaller id."""
    shared = queries.sparkSession.sparkContext.broadcast((space.pivots, space.rings, space.blocks))

    def visits(ring_of):
        """A function over batches that gives a row for each block a query visits, with the rings it visits there."""
        def send(batches):
            pivots, rings, blocks = shared.value
            own, names, step = Space(None, pivots, rings), rings["ring"].to_numpy(), max(1, CELLS // len(rings))
            for batch in batches:
                for i in range(0, len(batch), step):
                    part = batch.slice(i, step)
                    found = ring_of(own, vectors(part.column("x")), part.column("bound").to_numpy())
                    rows, places = np.repeat(np.arange(len(part)), [len(p) for p in found]), np.concatenate(found)
                    order = np.lexsort((places, rows))
                    rows, places = rows[order], places[order]
                    first = np.diff(rows, prepend=-1).astype(bool) | np.diff(blocks[places], prepend=-1).astype(bool)
                    begins = np.append(np.flatnonzero(first), len(rows))
                    size = max(1, SENT // own.width)
                    for j in range(0, len(begins) - 1, size):
                        cut = begins[j:j + size + 1]
                        sent = part.take(pa.array(rows[cut[:-1]]))
                        named = pa.ListArray.from_arrays((cut - cut[0]).astype(np.int32), names[places[cut[0]:cut[-1]]])
                        yield pa.RecordBatch.from_arrays([*sent.columns, pa.array(blocks[places[cut[:-1]]]), named],
                                                         names=["qid", "x", "bound", "block", "rings"])
        return send

    kind = "qid long, x array<double>, bound double, block long, rings array<long>"
    order = Window.partitionBy("qid").orderBy("dist", "id")
    at_home = queries.select("qid", "x", F.lit(float("inf")).alias("bound")).mapInArrow(
        visits(lambda s, x, b: s.home(x, k)), kind)
    found = materialize(_meet(materialize(at_home, "visits"), space, k).withColumn("place", F.row_number().over(order))
                        .where(F.col("place") <= k).drop("place"), "found")
    bound = found.groupBy("qid").agg(F.when(F.count("*") >= k, F.max("dist")).otherwise(F.lit(float("inf"))).alias("bound"))
    further = queries.join(bound, "qid").select("qid", "x", "bound").mapInArrow(
        visits(lambda s, x, b: s.other(x, b, k)), kind)
    more = _meet(materialize(further, "visits"), space, k)
    return (found.unionByName(more).withColumn("place", F.row_number().over(order))
            .where(F.col("place") <= k).drop("place"))


def weighted(pairs: DataFrame, k: int, copies: Column) -> DataFrame:
    """``pairs`` with ``w``: how many of the query's k neighbours the point's copies are; points that give none go."""
    before = Window.partitionBy("qid").orderBy("dist", "id").rowsBetween(Window.unboundedPreceding, -1)
    rows = pairs.withColumn("c", copies)
    left = F.lit(k) - F.coalesce(F.sum("c").over(before), F.lit(0))
    return rows.withColumn("w", F.least("c", left)).where("w > 0").drop("c", "copies")


def _density(k: int) -> Column:
    return 1 / (F.sum(F.col("w") * F.greatest("dist", "reach")) / k + 1e-10)


@dataclass
class LofModel:
    """Points with their k-distance (reach) and local density, as a table that neighbours are searched in."""

    columns: list[str] | str
    k: int
    space: Space
    offset: float = -1.5  # scores below it are outliers
    near: DataFrame | None = None  # the neighbours of the training points (qid, id, copies, dist), as the fit found them

    def transform(self, df: DataFrame, out: str = "raw_score") -> DataFrame:
        """Add the negated factor; lower is more anomalous. A row without a vector has no score.

        Every row is scored against the stored points, so a training row counts as its own neighbour. Rows of equal
        features are searched once, and those of the training not again; a loaded model searches them all.
        """
        x = vector(self.columns)
        queries = df.select(x.alias("x")).where("x is not null").distinct().withColumn("qid", F.monotonically_increasing_id())
        if self.near is None:
            queries = materialize(queries, "queries")
            found = nearest_points(queries, self.space, self.k)
        else:
            trained = self.space.points.select(F.col("x").alias("_x"), F.col("id").alias("point"))
            queries = materialize(queries.join(trained, F.col("x") == F.col("_x"), "left").drop("_x"), "queries")
            found = (queries.where("point is not null").select(F.col("qid").alias("_qid"), "point")
                     .join(self.near.withColumnRenamed("qid", "point"), "point")
                     .select(F.col("_qid").alias("qid"), "id", "copies", "dist"))
            new = queries.where("point is null").select("qid", "x")
            if not new.isEmpty():
                found = found.unionByName(nearest_points(new, self.space, self.k))
        pairs = weighted(found, self.k, F.col("copies"))
        known = self.space.points.select("id", "reach", "density")
        scores = (pairs.join(known, "id").groupBy("qid")
                  .agg((-(F.sum(F.col("w") * F.col("density")) / self.k) / _density(self.k)).alias("_score")))
        by_x = queries.join(scores, "qid").select(F.col("x").alias("_x"), "_score")
        return df.join(by_x, x == F.col("_x"), "left").withColumn(out, F.col("_score")).drop("_x", "_score")

    def fit_offset(self, train: DataFrame, contamination: float) -> "LofModel":
        """Learn the score below which the contamination share of rows lies."""
        self.offset = exact_quantile(materialize(self.transform(train).select("raw_score"), "scores"), "raw_score", contamination)
        return self

    def predict_labels(self, df: DataFrame, raw: str = "raw_score", out: str = "label") -> DataFrame:
        """-1 below the offset, else 1."""
        scored = df if raw in df.columns else self.transform(df, raw)
        return scored.withColumn(out, F.when(F.col(raw) < self.offset, -1).otherwise(1))

    def save(self, path: str, spark: SparkSession | None = None) -> None:
        spark = spark or SparkSession.active()
        self.space.points.write.mode("overwrite").parquet(f"{path}/rows")
        spark.createDataFrame(self.space.rings, "ring long, low double, high double, n long").write.mode("overwrite").parquet(f"{path}/rings")
        spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(self.space.pivots)], "i long, x array<double>").write.mode(
            "overwrite").parquet(f"{path}/pivots")
        spark.createDataFrame([(json.dumps([self.columns, self.k, self.offset]),)], "meta string").coalesce(1).write.mode(
            "overwrite").json(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "LofModel":
        columns, k, offset = json.loads(spark.read.schema("meta string").json(f"{path}/meta").first()["meta"])
        pivots = spark.read.parquet(f"{path}/pivots").orderBy("i").toPandas()  # PIVOTS rows at most
        rings = spark.read.parquet(f"{path}/rings").orderBy("ring").toPandas()  # about RINGS rows at most
        space = Space(spark.read.schema(POINTS).parquet(f"{path}/rows"), _matrix(pivots["x"]), rings)
        return cls(columns, k, space, offset)


def vector(columns):
    """Features as one array: named columns, or one array column."""
    if isinstance(columns, str):
        return F.col(columns).cast("array<double>")
    return F.array(*[feature_value(c) for c in columns])


def fit_lof(train: DataFrame, columns, k: int = 20) -> LofModel:
    """Fit on every row of a table of any size; its order does not matter, and rows without a vector are left out.

    Equal rows are one point with copies: they are each other's neighbours at distance 0, as many as they are, and
    have one k-distance and density, so a vector that fills a third of the table is searched once.
    """
    points = materialize(train.select(vector(columns).alias("x")).where("x is not null").groupBy("x").agg(F.count("*").alias("copies"))
                         .select(F.monotonically_increasing_id().alias("id"), "x", "copies"), "points")
    sizes = points.agg(F.count("*").alias("points"), F.sum("copies").alias("rows")).first()
    if (sizes["rows"] or 0) < 2:
        raise ValueError("at least two training rows are needed")
    k = min(k, sizes["rows"] - 1)
    space = build_space(points, sizes["points"])
    found = materialize(nearest_points(points.select(F.col("id").alias("qid"), "x"), space, k + 1), "near")
    own = F.when(F.col("id") == F.col("qid"), F.col("copies") - 1).otherwise(F.col("copies"))
    pairs = materialize(weighted(found, k, own), "pairs")
    reach = pairs.groupBy(F.col("qid").alias("id")).agg(F.max("dist").alias("reach"))
    fitted = pairs.join(reach, "id").groupBy("qid").agg(_density(k).alias("density")).withColumnRenamed("qid", "id")
    known = space.points.join(reach, "id").join(fitted, "id").select(*[c.split()[0] for c in POINTS.split(", ")])
    space.points = materialize(known, "model")
    return LofModel(columns, k, space, near=found)


def neighbor_count(rows: int) -> int:
    """Neighbours used when detectors are compared on a sample of this size."""
    return min(20, max(5, rows // 100))
