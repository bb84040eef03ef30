"""Feature selection. Decisions are made on report tables of one row per feature (pair)."""

from __future__ import annotations

from enum import Enum

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from flowlens.functions.catalog import CALENDAR_FEATURES
from flowlens.functions.columns import INF, finite
from flowlens.functions.quantiles import column_quantiles, melt

# Clock features watched for bias.
WATCHED_TIME = ["hour", "cos_hour", "sin_hour"]
#: A column of no more variance has no correlation.
LEAST_VARIANCE = 1e-12


class Strategy(Enum):
    QUALITY = "quality"
    CORRELATION = "correlation"
    IMPORTANCE = "importance"
    ALL = "all"


def quality_report(df: DataFrame, cols, variance: float = 1e-6, inf_share: float = 0.1,
                   missing_share: float = 0.5) -> DataFrame:
    """One row per feature with the four reasons to drop it; one pass over all features."""
    long = melt(df, cols)
    long = long.withColumn("value", F.nanvl("value", F.lit(None).cast("double")))
    value = F.col("value")
    is_inf = F.coalesce(F.abs(value) == INF, F.lit(False))
    stats = long.groupBy("feature").agg(
        (F.count(value) == 0).alias("empty"), F.min(value).alias("lo"), F.max(value).alias("hi"),
        F.var_samp(F.when(~is_inf, value)).alias("variance"), F.max(is_inf).alias("any_inf"),
        F.avg(is_inf.cast("double")).alias("inf_share"),
        F.avg(value.isNull().cast("double")).alias("missing_share"))
    # The variance of a column with an infinity is undefined, so it is not called low.
    low = F.coalesce((F.col("variance") < variance) & ~F.col("any_inf"), F.lit(False))
    out = stats.select(
        "feature", (F.col("empty") | (F.col("lo") == F.col("hi"))).alias("constant"), low.alias("low_variance"),
        (F.col("inf_share") > inf_share).alias("inf"), (F.col("missing_share") > missing_share).alias("high_missing"))
    return out.withColumn("dropped", F.expr("constant or low_variance or inf or high_missing"))


def correlation_matrix(df: DataFrame, columns, centers) -> np.ndarray:
    """Pearson's r of all columns in one pass; NULL and NaN count as the column's center, its median.

    Columns are moved by their centers, so that sums of tasks add up. A mean is never further from the median than one
    deviation, so this loses no digits. A column that never differs has no r (NaN).
    """
    names, centers = list(columns), np.array(centers, float)
    width = len(names)

    def sums(batches):
        n, total = 0, np.zeros((width + 1, width))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float, copy=False) for c in batch.columns]) - centers[:, None]
            x[np.isnan(x)] = 0.0
            n += batch.num_rows
            total[0] += x.sum(axis=1)
            total[1:] += x @ x.T
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel()),
                                              pa.array([n] * total.size, pa.int64())], names=["cell", "x", "n"])

    data = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    found = data.mapInArrow(sums, "cell int, x double, n long").groupBy("cell").agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
    cells = {r["cell"]: (r["x"], r["n"]) for r in found.collect()}  # features x features
    n = cells[0][1] if cells else 0
    if n < 2:
        raise ValueError(f"a correlation needs two rows, got {n}")
    total = np.array([cells[i][0] for i in range((width + 1) * width)]).reshape(width + 1, width)
    spread = (total[1:] - np.outer(total[0], total[0]) / n) / (n - 1)
    deviation = np.sqrt(np.where(spread.diagonal() > LEAST_VARIANCE, spread.diagonal(), np.nan))
    return spread / np.outer(deviation, deviation)


def correlation_pairs(df: DataFrame, cols, threshold: float = 0.98) -> DataFrame:
    """Pairs (feature_i before feature_j in the given order) with |r| above the threshold."""
    cols = list(cols)
    typed = df.select(*[finite(F.col(c)).alias(c) for c in cols])
    quantiles = column_quantiles(typed, cols, [0.5])
    matrix = correlation_matrix(typed, cols, [(quantiles[c] or [0.0])[0] for c in cols])
    rows = [(cols[i], cols[j], float(matrix[i, j])) for i in range(len(cols)) for j in range(i + 1, len(cols))
            if abs(matrix[i, j]) > threshold]
    return df.sparkSession.createDataFrame(rows, "feature_i string, feature_j string, r double")


def correlation_prune(df: DataFrame, cols, threshold: float = 0.98) -> tuple[list[str], DataFrame]:
    """Columns left after dropping the later one of each correlated pair, and the pairs."""
    if len(cols) <= 1:
        return list(cols), df.sparkSession.createDataFrame([], "feature_i string, feature_j string, r double")
    pairs = correlation_pairs(df, cols, threshold)
    dropped = {r["feature_j"] for r in pairs.collect()}
    return [c for c in cols if c not in dropped], pairs


def importance_select(importances: DataFrame, share: float = 0.98, fewest: int = 15, most: int = 25) -> DataFrame:
    """Features up to the cumulative share, but at least ``fewest`` and at most ``most``.

    The table has one row per feature, so one task orders it.
    """
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("importance"), "feature")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy(F.lit(0))
    ranked = importances.select(
        "feature", "importance", F.row_number().over(order).alias("place"),
        F.try_divide(F.sum("importance").over(upto), F.sum("importance").over(everything)).alias("cumulative"))
    # The first place where the loop over sorted features would stop.
    stop = ((F.col("cumulative") >= share) & (F.col("place") >= fewest)) | (F.col("place") >= most)
    end = F.coalesce(F.min(F.when(stop, F.col("place"))).over(everything), F.lit(10 ** 9))
    return (ranked.withColumn("_end", end).withColumn("kept", F.col("place") <= F.col("_end")).drop("_end"))


def time_bias_guard(cols, importances: DataFrame, threshold: float = 0.05, watched=None) -> tuple[list[str], float]:
    """Drop all calendar features when the watched ones carry too much importance."""
    watched = [c for c in (watched or WATCHED_TIME) if c in cols]
    share = importances.where(F.col("feature").isin(watched)).agg(F.sum("importance")).first()[0] or 0.0
    if share > threshold:
        return [c for c in cols if c not in CALENDAR_FEATURES], share
    return list(cols), share


def select_features(df: DataFrame, cols, strategies=(Strategy.ALL,), label: str | None = None,
                    importances=None, share: float = 0.98, fewest: int = 15, most: int = 25,
                    correlation: float = 0.98) -> tuple[list[str], DataFrame]:
    """Apply the strategies in order; returns the kept columns and a table (feature, reason).

    ``importances`` is a callable (df, cols, label) -> table, used only when a label is given.
    """
    every = Strategy.ALL in strategies
    kept, removed = list(cols), []
    if every or Strategy.QUALITY in strategies:
        for r in quality_report(df, kept).where("dropped").collect():
            removed += [(r["feature"], w) for w in ("constant", "low_variance", "inf", "high_missing") if r[w]]
        gone = {f for f, _ in removed}
        kept = [c for c in kept if c not in gone]
    if every or Strategy.CORRELATION in strategies:
        after, _ = correlation_prune(df, kept, correlation)
        removed += [(c, "high_correlation") for c in kept if c not in after]
        kept = after
    if (every or Strategy.IMPORTANCE in strategies) and label and importances is not None and kept:
        table = importance_select(importances(df, kept, label), share, fewest, most)
        chosen = {r["feature"] for r in table.where("kept").collect()}
        removed += [(c, "low_importance") for c in kept if c not in chosen]
        kept = [c for c in kept if c in chosen]
    return kept, df.sparkSession.createDataFrame(removed, "feature string, reason string")


def leak_screen(df: DataFrame, cols, raw=("SrcAddr", "DstAddr", "Sport", "Dport")) -> tuple[list[str], DataFrame]:
    """Model inputs without raw address and port columns, and a table of what was removed."""
    kept = [c for c in cols if c not in raw]
    return kept, df.sparkSession.createDataFrame([(c,) for c in cols if c in raw], "feature string")
