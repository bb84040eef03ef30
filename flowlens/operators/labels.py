"""Binary labels and label statistics."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F, types as T

from flowlens.functions.columns import flag, ratio_or_zero, require

# Label keywords that mark an anomaly.
KEYWORDS = ["Botnet", "botnet", "bot"]


def binary_label(df: DataFrame, label: str = "Label", keywords=None, out: str = "label_binary",
                 literal: bool = False) -> DataFrame:
    """Add a 0/1 label: keyword match on text (case-insensitive), equality with 1 on numbers."""
    require(df, [label])
    if isinstance(df.schema[label].dataType, T.NumericType):
        return df.withColumn(out, flag(F.col(label) == 1))
    words = [re.escape(k) if literal else k for k in (keywords or KEYWORDS)]
    pattern = "|".join(words).lower()
    return df.withColumn(out, flag(F.lower(F.col(label).cast("string")).rlike(pattern)))


def label_stats(df: DataFrame, binary: str = "label_binary") -> DataFrame:
    """One row: total, normal and anomaly counts and ratios (0 on an empty table)."""
    total = F.count(F.lit(1))
    normal, anomaly = F.count_if(F.col(binary) == 0), F.count_if(F.col(binary) == 1)
    return df.agg(total.alias("total_count"), normal.alias("normal_count"),
                  anomaly.alias("anomaly_count"),
                  ratio_or_zero(normal, total).alias("normal_ratio"),
                  ratio_or_zero(anomaly, total).alias("anomaly_ratio"))


def label_counts(df: DataFrame, label: str = "Label") -> DataFrame:
    """Rows per original label; a missing label is not a label."""
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def validate_labels(df: DataFrame, min_ratio: float = 0.0, max_ratio: float = 1.0,
                    label: str = "Label", binary: str = "label_binary") -> DataFrame:
    """One row: is_valid and the list of messages."""
    for name in (label, binary):
        if name not in df.columns:
            return df.sparkSession.createDataFrame(
                [(False, [f"missing column: {name}"])], "is_valid boolean, messages array<string>")
    found = label_stats(df, binary)
    share = F.col("anomaly_ratio")
    messages = F.array_compact(F.array(
        F.when(share < min_ratio, F.lit("anomaly ratio too low")),
        F.when(share > max_ratio, F.lit("anomaly ratio too high")),
        F.when(F.col("anomaly_count") == 0, F.lit("no anomalies")),
    ))
    return found.select((F.size(messages) == 0).alias("is_valid"), messages.alias("messages"))


def label_distribution(df: DataFrame, n: int = 10, label: str = "Label") -> DataFrame:
    """The n most frequent labels with their share of all rows."""
    total = df.count()
    return (label_counts(df, label)
            .withColumn("share", ratio_or_zero(F.col("n"), F.lit(total)))
            .orderBy(F.desc("n"), F.asc(label)).limit(n))


def imbalance(df: DataFrame, binary: str = "label_binary") -> DataFrame:
    """One row: negatives, positives, and their ratio (1.0 without positives)."""
    negative, positive = F.count_if(F.col(binary) == 0), F.count_if(F.col(binary) == 1)
    return df.agg(negative.alias("negatives"), positive.alias("positives"),
                  F.coalesce(F.try_divide(negative.cast("double"), positive.cast("double")),
                             F.lit(1.0)).alias("imbalance_ratio"))
