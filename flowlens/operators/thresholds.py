"""Score thresholds and ranking curves."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowlens.functions.columns import ratio, ratio_or_zero
from flowlens.functions.ordering import ROWS_PER_SLICE, running_sums
from flowlens.functions.quantiles import exact_quantile, exact_quantiles

TINY = 1e-10


def score_threshold(df: DataFrame, score: str, prob: float, approximate: bool = False) -> float | None:
    if approximate:
        return df.agg(F.percentile_approx(score, prob, 10_000)).first()[0]
    return exact_quantile(df, score, prob)


def flag_top(df: DataFrame, score: str = "anomaly_score", frac: float = 0.1, out: str = "y_pred",
             threshold: float | None = None) -> DataFrame:
    """Flag the rows at or above the (1 - frac) quantile; rows without a score are not flagged."""
    cut = threshold if threshold is not None else score_threshold(df, score, 1 - frac)
    return df.withColumn(out, F.coalesce(F.col(score) >= F.lit(cut), F.lit(False)).cast("int"))


def flag_bottom(df: DataFrame, score: str = "raw_score", frac: float = 0.1, out: str = "y_pred") -> DataFrame:
    """Flag the rows at or below the frac quantile of a raw score (low = anomalous)."""
    cut = score_threshold(df, score, frac)
    return df.withColumn(out, F.coalesce(F.col(score) <= F.lit(cut), F.lit(False)).cast("int"))


def pr_curve(df: DataFrame, score: str = "anomaly_score", label: str = "label_binary",
             rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Precision and recall of flagging everything at or above each distinct score."""
    rated = df.where(F.col(label).isNotNull())
    totals = rated.where(F.col(score).isNotNull()).agg(F.sum(F.col(label)).alias("p")).first()
    sums = running_sums(rated, score, {"pos": F.col(label).cast("long"), "n": F.lit(1).cast("long")},
                        descending=True, rows_per_slice=rows_per_slice)
    tp, flagged = F.col("cum_pos"), F.col("cum_n")
    return sums.select(F.col(score).alias("threshold"), tp.alias("tp"), (flagged - tp).alias("fp"),
                       ratio_or_zero(tp, flagged).alias("precision"),
                       F.coalesce(ratio(tp, F.lit(totals["p"])), F.lit(1.0)).alias("recall"))


def best_f1_threshold(df: DataFrame, score: str = "anomaly_score", label: str = "label_binary",
                      fallback_frac: float = 0.1, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """One row: the threshold with the best F1 (the lowest on ties) and its precision and recall.

    Without a positive row the contamination quantile is the threshold.
    """
    curve = pr_curve(df, score, label, rows_per_slice)
    p, r = F.col("precision"), F.col("recall")
    f1 = 2 * r * p / (r + p + TINY)
    best = (curve.withColumn("f1", f1).orderBy(F.desc("f1"), F.asc("threshold")).limit(1)
            .select("threshold", "precision", "recall", "f1"))
    if df.where(F.col(label) == 1).limit(1).count():
        return best
    cut = score_threshold(df, score, 1 - fallback_frac)
    return df.sparkSession.createDataFrame([(cut, 0.0, 0.0, 0.0)],
                                           "threshold double, precision double, recall double, f1 double")


def roc_auc(df: DataFrame, score: str = "anomaly_score", label: str = "label_binary",
            higher_is_anomalous: bool = True, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Area under the ROC curve as a rank statistic; equal scores count one half."""
    sums = running_sums(df.where(F.col(label).isNotNull()), score,
                        {"pos": F.col(label).cast("long"), "neg": (1 - F.col(label)).cast("long")},
                        descending=not higher_is_anomalous, rows_per_slice=rows_per_slice)
    below = F.col("cum_neg") - F.col("neg")
    wins = F.sum(F.col("pos") * (below + F.col("neg") / 2.0))
    return sums.agg(F.try_divide(wins, (F.sum("pos") * F.sum("neg")).cast("double")).alias("roc_auc"))


def threshold_grid(df: DataFrame, score: str = "anomaly_score", label: str = "label_binary",
                   percentiles=(90, 91, 92, 93, 94, 95, 96, 97, 98, 99, 99.5)) -> DataFrame:
    """Precision, recall and F1 at a grid of score percentiles: one wide aggregate after the quantiles."""
    cuts = exact_quantiles(df, [], score, [p / 100 for p in percentiles]).first()["q"]
    if cuts is None:
        cuts = [None] * len(percentiles)
    attack, normal = F.col(label) == 1, F.col(label) == 0

    def counted(percentile, cut):
        hit = F.col(score) >= F.lit(cut).cast("double")
        return F.struct(
            F.lit(float(percentile)).alias("percentile"), F.lit(cut).cast("double").alias("threshold"),
            F.count_if(hit & attack).alias("tp"), F.count_if(hit & normal).alias("fp"), F.count_if(~hit & attack).alias("fn"))

    grid = [counted(p, c) for p, c in zip(percentiles, cuts, strict=True)]
    stats = df.agg(F.array(*grid).alias("g")).select(F.inline("g"))
    p = ratio_or_zero(F.col("tp"), F.col("tp") + F.col("fp"))
    r = ratio_or_zero(F.col("tp"), F.col("tp") + F.col("fn"))
    return stats.select("percentile", "threshold", "tp", "fp", "fn", p.alias("precision"), r.alias("recall"),
                        ratio_or_zero(2 * p * r, p + r).alias("f1"))


def contamination(df: DataFrame, label: str = "label_binary", by: str | None = None, multiplier: float = 1.3,
                  maximum: float = 0.2, high: float = 0.15, minimum: float = 0.01,
                  default: float = 0.1) -> DataFrame:
    """Share of rows to flag, from the label share: per group when ``by`` names one."""
    keys = [by] if by else []
    if label not in df.columns:
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).withColumn("contamination", F.lit(default))
    share = F.col("anomaly_ratio")
    raised = F.when(share > high, share).otherwise(F.least(share * multiplier, F.lit(maximum)))
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.avg(F.col(label)).alias("anomaly_ratio"))
            .withColumn("contamination", F.greatest(raised, F.lit(minimum))))
