"""Confusion counts, metrics and before/after reports. All are single-pass aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowlens.functions.columns import ratio_or_zero

CELLS = ["tn", "fp", "fn", "tp"]


def cells(y: str, p: str) -> dict:
    """The four confusion counts as aggregates; a missing class simply counts 0."""
    return {name: F.count_if((F.col(y) == truth) & (F.col(p) == flagged))
            for name, truth, flagged in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))}


def confusion(df: DataFrame, y: str = "label_binary", p: str = "y_pred", by=None) -> DataFrame:
    keys = [by] if isinstance(by, str) else list(by or [])
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in cells(y, p).items()])


def with_metrics(counts: DataFrame) -> DataFrame:
    """Rates over confusion counts; 0 where a denominator is 0."""
    tn, fp, fn, tp = (F.col(c) for c in CELLS)
    precision, recall = ratio_or_zero(tp, tp + fp), ratio_or_zero(tp, tp + fn)
    return counts.withColumns({
        "total": tn + fp + fn + tp, "accuracy": ratio_or_zero(tn + tp, tn + fp + fn + tp),
        "precision": precision, "recall": recall,
        "f1": ratio_or_zero(2 * precision * recall, precision + recall),
        "precision_normal": ratio_or_zero(tn, tn + fn), "recall_normal": ratio_or_zero(tn, tn + fp)})


def metrics(df: DataFrame, y: str = "label_binary", p: str = "y_pred", by=None) -> DataFrame:
    return with_metrics(confusion(df, y, p, by))


def classification_report(df: DataFrame, y: str = "label_binary", p: str = "y_pred") -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted rows."""
    m = metrics(df, y, p)
    f1_normal = ratio_or_zero(2 * F.col("precision_normal") * F.col("recall_normal"),
                              F.col("precision_normal") + F.col("recall_normal"))

    def line(name, precision, recall, f1, support):
        return F.struct(F.lit(name).alias("class"), precision.alias("precision"), recall.alias("recall"),
                        f1.alias("f1"), support.alias("support"))

    normal = [F.col("precision_normal"), F.col("recall_normal"), f1_normal]
    anomaly = [F.col("precision"), F.col("recall"), F.col("f1")]
    n0, n1, total = F.col("tn") + F.col("fp"), F.col("fn") + F.col("tp"), F.col("total")
    macro = [(a + b) / 2 for a, b in zip(normal, anomaly)]
    weighted = [ratio_or_zero(a * n0 + b * n1, total) for a, b in zip(normal, anomaly)]
    accuracy = [F.col("accuracy")] * 3
    rows = F.array(line("normal", *normal, n0), line("anomaly", *anomaly, n1), line("accuracy", *accuracy, total),
                   line("macro avg", *macro, total), line("weighted avg", *weighted, total))
    return m.select(F.explode(rows).alias("r")).select("r.*")


def score_summary(df: DataFrame, score: str = "anomaly_score", p: str = "y_pred",
                  y: str | None = "label_binary") -> DataFrame:
    """Range and moments of the score with the predicted and actual anomaly share."""
    actual = [F.avg(F.col(y)).alias("actual_share")] if y else []
    return df.agg(F.min(score).alias("min"), F.max(score).alias("max"), F.avg(score).alias("mean"),
                  F.stddev_pop(score).alias("std"), F.avg(F.col(p)).alias("predicted_share"), *actual)


def percent_change(before, after):
    return ratio_or_zero(after - before, before) * 100


def side_by_side(before: DataFrame, after: DataFrame, names) -> DataFrame:
    """Two one-row tables as one row of before_* and after_* columns, without a join."""
    both = (before.select(*names, F.lit(True).alias("_first"))
            .unionByName(after.select(*names, F.lit(False).alias("_first"))))
    return both.agg(*[F.max(F.when(F.col("_first") == first, F.col(n))).alias(f"{tag}_{n}")
                      for tag, first in (("before", True), ("after", False)) for n in names])


def compare_metrics(before: DataFrame, after: DataFrame) -> DataFrame:
    """False-positive drop with precision and F1 change, in percent, from two metric rows."""
    names = ["fp", "precision", "f1"]
    b, a = ({n: F.col(f"{tag}_{n}") for n in names} for tag in ("before", "after"))
    return side_by_side(before, after, names).withColumns({
        "fp_reduction": b["fp"] - a["fp"],
        "fp_reduction_percent": ratio_or_zero(b["fp"] - a["fp"], b["fp"]) * 100,
        "precision_change_percent": percent_change(b["precision"], a["precision"]),
        "f1_change_percent": percent_change(b["f1"], a["f1"])})


def risk_level(gap, high: float, medium: float):
    return F.when(gap > high, "HIGH").when(gap > medium, "MEDIUM").otherwise("LOW")


def by_split(df: DataFrame, y: str, p: str, split: str, train: str, test: str) -> DataFrame:
    """Accuracy on two splits and their gap, in one pass."""
    correct = F.when(F.col(y) == F.col(p), 1.0).otherwise(0.0)

    def accuracy(name):
        return F.coalesce(F.avg(F.when(F.col(split) == name, correct)), F.lit(0.0))

    return (df.agg(accuracy(train).alias("train_accuracy"), accuracy(test).alias("test_accuracy"))
            .withColumn("gap", F.col("train_accuracy") - F.col("test_accuracy")))


def split_gap(df: DataFrame, y: str = "label_binary", p: str = "y_pred", split: str = "split",
              train: str = "train", test: str = "test") -> DataFrame:
    """Train/test accuracy gap; above 0.1 is HIGH, above 0.05 MEDIUM."""
    return by_split(df, y, p, split, train, test).withColumn("risk", risk_level(F.col("gap"), 0.1, 0.05))


def overfit_report(df: DataFrame, y: str = "label_binary", p: str = "y_pred", split: str = "split",
                   train: str = "train", test: str = "test") -> DataFrame:
    """The stricter scale used while training: below 0.01 low, below 0.05 medium, else high."""
    gap = F.col("gap")
    level = F.when(gap < 0.01, "low").when(gap < 0.05, "medium").otherwise("high")
    return by_split(df, y, p, split, train, test).withColumn("risk", level)


def funnel(df: DataFrame, y: str = "label_binary", before: str = "y_pred", after: str = "y_final") -> DataFrame:
    """How many flagged rows, true and false, the rules take away."""
    b, a = cells(y, before), cells(y, after)
    counts = df.agg(F.count(F.lit(1)).alias("total"),
                    *[b[c].alias(f"before_{c}") for c in ("tp", "fp")],
                    *[a[c].alias(f"after_{c}") for c in ("tp", "fp")])
    counts = counts.withColumns({f"{t}_anomalies": F.col(f"{t}_tp") + F.col(f"{t}_fp") for t in ("before", "after")})

    def dropped(name):
        return ratio_or_zero(F.col(f"before_{name}") - F.col(f"after_{name}"), F.col(f"before_{name}")) * 100

    return counts.withColumns({
        "before_rate": ratio_or_zero(F.col("before_anomalies"), F.col("total")) * 100,
        "after_rate": ratio_or_zero(F.col("after_anomalies"), F.col("total")) * 100,
        "filter_rate": dropped("anomalies"), "tp_filter_rate": dropped("tp"), "fp_filter_rate": dropped("fp")})


def metric_deltas(before: DataFrame, after: DataFrame) -> DataFrame:
    """Metric differences in percentage points."""
    names = ["accuracy", "precision", "recall", "f1"]
    return side_by_side(before, after, names).select(
        *[((F.col(f"after_{n}") - F.col(f"before_{n}")) * 100).alias(f"{n}_delta") for n in names])


def top_importances(importances: DataFrame, n: int = 15) -> DataFrame:
    return importances.orderBy(F.desc("importance"), "feature").limit(n)


def feature_counts(stored: DataFrame, model: list[str], transformed: list[str], final: list[str]) -> DataFrame:
    """One row: columns stored, offered to the model, after the transform, finally used."""
    return stored.sparkSession.createDataFrame(
        [(len(stored.columns), len(model), len(transformed), len(final))],
        "stored_columns int, model_features int, transformed_features int, final_features int")
