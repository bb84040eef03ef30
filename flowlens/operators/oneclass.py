"""One-class support estimate with an RBF kernel, at scale.

The kernel is approximated by random Fourier features (Rahimi and Recht, 2007). In that
space the one-class problem is the point of smallest norm in the set of weighted means
where no row weighs more than 1/(nu n). Frank-Wolfe steps solve it: find the nu share of
rows with the lowest scores, and move towards their mean with an exact line search. A step
scores the table once and takes the mean of that share; nothing but a few hundred numbers reaches the driver.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlens.functions.quantiles import exact_quantile
from flowlens.operators.neighbors import vector, vectors

#: Rows whose Fourier features are held at once; small enough to stay in a core's cache.
BLOCK = 128
#: cos(sqrt(u)) for u up to (pi/2)^2 by rising powers, good to all digits.
COSINE = np.polynomial.Chebyshev.interpolate(lambda u: np.cos(np.sqrt(u)), 9, [0, (np.pi / 2) ** 2]).convert(
    kind=np.polynomial.Polynomial).coef
#: pi in two parts; whole multiples of the first are exact.
PI = (3.140625, 9.676535897932385e-4)


@dataclass
class OneClassModel:
    columns: list[str] | str
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    rho: float

    def transform(self, df: DataFrame, out: str = "raw_score") -> DataFrame:
        """Add the decision value; negative (lower) is more anomalous."""
        return df.withColumn(out, linear_score(df, self.columns, self.directions, self.phases, self.weights)
                             - F.lit(self.rho))

    def predict_labels(self, df: DataFrame, raw: str = "raw_score", out: str = "label") -> DataFrame:
        """-1 where the decision value is negative, else 1."""
        scored = df if raw in df.columns else self.transform(df, raw)
        return scored.withColumn(out, F.when(F.col(raw) < 0, -1).otherwise(1))

    def save(self, path: str, spark: SparkSession | None = None) -> None:
        """One row for each Fourier feature."""
        spark = spark or SparkSession.active()
        rows = pd.DataFrame({"id": np.arange(len(self.phases)), "direction": self.directions.T.tolist(), "phase": self.phases,
                             "weight": self.weights})
        spark.createDataFrame(rows, "id long, direction array<double>, phase double, weight double").write.mode("overwrite").parquet(f"{path}/rows")
        spark.createDataFrame([(json.dumps([self.columns, self.rho]),)], "meta string").coalesce(1).write.mode(
            "overwrite").json(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "OneClassModel":
        columns, rho = json.loads(spark.read.schema("meta string").json(f"{path}/meta").first()["meta"])
        rows = spark.read.parquet(f"{path}/rows").toPandas().sort_values("id")
        return cls(columns, np.stack(rows["direction"].to_numpy()).T, rows["phase"].to_numpy(), rows["weight"].to_numpy(), rho)


def cosine_of_double(half: np.ndarray) -> np.ndarray:
    """cos(2 half), changing ``half``; some times faster than one call of numpy's cosine a value."""
    turns = np.rint(half * (1 / np.pi))
    half -= turns * PI[0]
    half -= turns * PI[1]
    half *= half
    out = np.full_like(half, COSINE[-1])
    for c in COSINE[-2::-1]:
        out *= half
        out += c
    out *= out
    out *= 2
    out -= 1
    return out


def fourier(x: pa.Array, directions, phases):
    """Fourier features of vectors, block by block."""
    rows, d, p = vectors(x), directions / 2, phases / 2
    for begin in range(0, len(rows), BLOCK):
        yield cosine_of_double(rows[begin:begin + BLOCK] @ d + p) * np.sqrt(2.0 / len(phases))


def linear_score(df: DataFrame, columns, directions, phases, weights):
    shared = df.sparkSession.sparkContext.broadcast((directions, phases, weights))

    @F.arrow_udf("double")
    def score(x: pa.Array) -> pa.Array:
        d, p, w = shared.value
        return pa.array(np.concatenate([np.empty(0), *[z @ w for z in fourier(x, d, p)]]))

    return score(vector(columns))


def mean_feature(rows: DataFrame, directions, phases) -> np.ndarray:
    """Mean Fourier feature of all rows.

    Tasks emit partial sums per feature, which Spark adds up.
    """
    shared = rows.sparkSession.sparkContext.broadcast((directions, phases))
    size = len(phases)

    def partial(batches):
        d, p = shared.value
        total, n = np.zeros(size), 0
        for batch in batches:
            for z in fourier(batch.column("x"), d, p):
                total, n = total + z.sum(axis=0), n + len(z)
        if n:
            yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(size), pa.int32()), "total": total,
                                              "n": pa.array(np.full(size, n), pa.int64())})

    sums = rows.select("x").mapInArrow(partial, "at int, total double, n long").groupBy("at").agg(
        (F.sum("total") / F.sum("n")).alias("m")).collect()  # one row per feature
    out = np.zeros(size)
    for r in sums:
        out[r["at"]] = r["m"]
    return out


def scale_gamma(rows: DataFrame) -> float:
    """1 / (number of features x variance of all values)."""
    found = rows.select(F.size("x").alias("p"), F.explode("x").alias("v")).agg(
        F.max("p").alias("p"), F.var_pop("v").alias("v")).first()
    return 1.0 / (found["p"] * found["v"]) if found["v"] else 1.0


def fit_oneclass(df: DataFrame, columns, nu: float = 0.1, gamma: float | None = None, features: int = 256,
                 steps: int = 12, seed: int = 42) -> OneClassModel:
    if not 0.0 < nu <= 1.0:
        raise ValueError(f"nu must be in (0, 1], got {nu}")
    rows = df.select(vector(columns).alias("x")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        gamma = gamma or scale_gamma(rows)
        width = len(rows.first()["x"])
        rng = np.random.default_rng(seed)
        directions = rng.normal(0.0, np.sqrt(2 * gamma), (width, features))
        phases = rng.uniform(0, 2 * np.pi, features)
        w = mean_feature(rows, directions, phases)
        for _ in range(steps):
            # Scores are kept, so only the share below the cut is made into features again.
            scored = rows.select("x", linear_score(rows, "x", directions, phases, w).alias("s")).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                cut = scored.agg(F.percentile_approx("s", nu, 2_000)).first()[0]
                target = mean_feature(scored.where(F.col("s") <= cut), directions, phases)
            finally:
                scored.unpersist()
            gap = w - target
            size = float(gap @ gap)
            if size < 1e-12:
                break
            move = float(np.clip((w @ gap) / size, 0.0, 1.0))
            w = w - move * gap
            if move * np.sqrt(size) < 1e-5:
                break
        scored = rows.select(linear_score(rows, "x", directions, phases, w).alias("s")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rho = exact_quantile(scored, "s", nu)  # reads its rows more than once
        finally:
            scored.unpersist()
        return OneClassModel(columns, directions, phases, w, rho)
    finally:
        rows.unpersist()
