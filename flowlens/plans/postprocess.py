"""From a scored run to allow-list rules and their effect."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from flowlens.operators import evaluate as ev, rules as ru
from flowlens.operators.thresholds import flag_top


@dataclass
class PostprocessRun:
    rules: DataFrame
    result: DataFrame
    effect: DataFrame
    comparison: DataFrame
    summary: DataFrame


def postprocess(train: DataFrame, test: DataFrame, contamination: float = 0.1, threshold: float | None = None,
                method: str = "score", y: str = "label_binary", score: str = "anomaly_score",
                use_gate: bool = False, **mining) -> PostprocessRun:
    """Mine rules from the training scores and apply them to the test rows.

    Training rows are flagged at the contamination quantile, test rows at the best threshold
    found before (or the quantile).
    """
    flagged = flag_top(train, score, contamination)
    rules = ru.mine_rules(flagged, y, method=method, **mining)
    rated = flag_top(test, score, contamination, threshold=threshold)
    result = ru.apply_rules(rated, rules, score=score if use_gate else None)
    before, after = ev.metrics(result, y), ev.metrics(result, y, "y_final")
    return PostprocessRun(rules, result, ru.effect_stats(result, y), ev.compare_metrics(before, after),
                          postprocess_summary(result, rules, method, y))


def postprocess_summary(result: DataFrame, rules: DataFrame, method: str, y: str = "label_binary") -> DataFrame:
    """One record: counts, metrics before and after, number of rules, method and time."""
    b, a = ev.cells(y, "y_pred"), ev.cells(y, "y_final")
    counts = result.agg(
        F.count(F.lit(1)).alias("total_samples"), F.count_if(F.col("y_pred") == 1).alias("original_anomalies"),
        F.count_if(F.col("y_final") == 1).alias("final_anomalies"),
        F.struct(*[c.alias(n) for n, c in b.items()]).alias("o"), F.struct(*[c.alias(n) for n, c in a.items()]).alias("f"))
    names = [*ev.CELLS, "accuracy", "precision", "recall", "f1"]
    # The same metric expressions over each struct in turn.
    for part, out in (("o", "original"), ("f", "filtered")):
        counts = ev.with_metrics(counts.withColumns({n: F.col(f"{part}.{n}") for n in ev.CELLS}))
        counts = counts.withColumn(out, F.struct(*names))
    return counts.select(
        "total_samples", "original_anomalies", "final_anomalies",
        (F.col("original_anomalies") - F.col("final_anomalies")).alias("filtered_count"),
        F.lit(rules.count()).alias("rule_count"), F.lit(method).alias("method"),
        "original", "filtered", F.current_timestamp().alias("timestamp"))


def remine(scored: DataFrame, confirmed: DataFrame, key: str = "flow_id", y: str = "label_binary", score: str | None = None,
           **options) -> tuple[DataFrame, DataFrame]:
    """Mine again after an analyst's verdicts: the new rules, and the flows with the rules applied."""
    marked = feedback_labels(scored, confirmed, key, y)
    rules = ru.mine_rules(marked, y, **options)
    return rules, ru.apply_rules(marked, rules, score=score)


def feedback_labels(scored: DataFrame, confirmed: DataFrame, key: str = "flow_id", y: str = "label_binary") -> DataFrame:
    """Flows an analyst confirmed as false alarms count as normal when rules are mined again."""
    marks = confirmed.select(F.col(key).alias("_k"), F.lit(True).alias("_normal")).distinct()
    joined = scored.join(marks, F.col(key) == F.col("_k"), "left")
    return joined.withColumn(y, F.when(F.col("_normal"), 0).otherwise(F.col(y)).cast("int")).drop("_k", "_normal")
