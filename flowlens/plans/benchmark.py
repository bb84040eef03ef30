"""Compare detectors on one shared sample."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, functions as F

from flowlens.operators.evaluate import metrics, score_summary
from flowlens.operators.forest import fit_forest
from flowlens.operators.neighbors import fit_lof, neighbor_count
from flowlens.operators.oneclass import fit_oneclass
from flowlens.operators.sampling import sample_n, split, stratified_sample
from flowlens.operators.thresholds import flag_bottom, roc_auc
from flowlens.operators.transform import transform_for_unsupervised
from flowlens.sources.storage import materialize

# Shown names, and the metrics in which more (or less) is better.
DETECTORS = {"isolation_forest": "Isolation Forest", "lof": "Local Outlier Factor (LOF)",
             "one_class_svm": "One-Class SVM"}
MORE = ["accuracy", "precision", "recall", "f1", "roc_auc"]
LESS = ["train_time", "predict_time", "fn"]


def fit_detector(name: str, train: DataFrame, columns, key: str, contamination: float, rows: int, seed: int = 42):
    if name == "isolation_forest":
        return fit_forest(train, columns, key, seed=seed)
    if name == "lof":
        return fit_lof(train, columns, neighbor_count(rows))
    if name == "one_class_svm":
        return fit_oneclass(train, columns, contamination, seed=seed)
    raise ValueError(f"unknown detector: {name!r}")


def prepare_sample(df: DataFrame, label: str | None = "label_binary", size: int = 50_000, key: str = "flow_id",
                   skewed=None, features=None, seed: int = 42) -> tuple[DataFrame, list[str]]:
    """Transformed features of an exact sample with its 70/30 split; the features are scaled once."""
    moved, _, columns = transform_for_unsupervised(df, skewed, features, key=key)
    stratify = bool(label) and label in df.columns and df.where(F.col(label) == 1).limit(1).count() > 0
    rows = moved.select(key, *([label] if label and label in df.columns else []), *columns)
    rows = stratified_sample(rows, label, size, key, seed) if stratify else sample_n(rows, key, size, seed)
    return split(rows, key, label if stratify else None, 0.3, seed=seed), columns


def benchmark_models(df: DataFrame, label: str | None = "label_binary", detectors=tuple(DETECTORS),
                     contamination: float = 0.1, **sampling) -> DataFrame:
    """One row per detector: times, confusion counts, metrics, AUC and score summary.

    The sample (at most its fixed size) is written once and shared by all detectors.
    """
    key = sampling.get("key", "flow_id")
    rows, columns = prepare_sample(df, label, **sampling)
    # A bounded sample, spread over the cores so that fitting and scoring run in parallel.
    rows = materialize(rows.repartition(df.sparkSession.sparkContext.defaultParallelism, key), "sample")
    train, test = rows.where("split = 'train'"), rows.where("split = 'test'")
    size = train.count()
    labelled = bool(label) and label in rows.columns
    out = None
    for name in detectors:
        start = time.perf_counter()
        model = fit_detector(name, train, columns, key, contamination, size)
        fitted = time.perf_counter() - start
        start = time.perf_counter()
        scored = materialize(model.transform(test).select(key, *([label] if labelled else []), "raw_score"), "scores")
        scored.count()
        predicted = time.perf_counter() - start
        flagged = flag_bottom(scored, "raw_score", contamination)
        summary = score_summary(flagged, "raw_score", y=label if labelled else None)
        parts = [summary.withColumnsRenamed({c: f"score_{c}" for c in ("min", "max", "mean", "std")})]
        if labelled:
            parts += [metrics(flagged, label), roc_auc(scored, "raw_score", label, higher_is_anomalous=False)]
        values = {k: v for p in parts for k, v in p.first().asDict().items()}
        values |= {"model_type": name, "model_name": DETECTORS[name], "train_time": fitted, "predict_time": predicted,
                   "contamination": contamination, "feature_count": len(columns), "has_labels": labelled}
        row = df.sparkSession.createDataFrame([values])
        out = row if out is None else out.unionByName(row, allowMissingColumns=True)
    return out


def compare_models(results: DataFrame) -> DataFrame:
    """The best detector per metric, the fastest, and the one missing fewest attacks.

    Without labels only times and the predicted share can be compared.
    """
    def pick(name, sign):
        """The detector with the smallest signed value; names decide ties, missing values lose."""
        value = F.col(name).cast("double") * sign
        order = F.when(value.isNotNull(), F.struct(value, F.col("model_name")))
        return F.struct(F.lit(name).alias("metric"), F.min_by("model_name", order).alias("best"),
                        (F.min(value) * sign).alias("value"))

    picks = [pick(n, sign) for names, sign in ((MORE, -1.0), (LESS, 1.0)) for n in names if n in results.columns]
    if not set(MORE) & set(results.columns):
        picks.append(pick("predicted_share", -1.0))
    table = results.agg(F.array(*picks).alias("rows"))
    return table.select(F.explode("rows").alias("r")).select("r.*").where("value is not null")
