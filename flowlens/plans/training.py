"""Training jobs: from flows to scored, thresholded and evaluated tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from flowlens.functions.catalog import SKEWED_FEATURES
from flowlens.operators import boosted, select
from flowlens.operators.evaluate import metrics
from flowlens.operators.forest import (
    ForestModel, fit_forest, fit_grouped, group_score_stats, protocol_group, score_grouped,
)
from flowlens.operators.labels import binary_label
from flowlens.operators.row_features import prepare_feature_set
from flowlens.operators.sampling import split
from flowlens.operators.select import Strategy
from flowlens.operators.thresholds import best_f1_threshold, contamination, flag_top
from flowlens.operators.transform import apply_for_unsupervised, fit_for_unsupervised
from flowlens.plans.features import extract_features
from flowlens.sources.storage import materialize


@dataclass
class UnsupervisedConfig:
    size: str = "1min"
    stage: int = 4
    trees: int = 300
    max_samples: int = 256
    bootstrap: bool = True
    min_rows: int = 1000
    importance: bool = True
    guard_sample: int = 10_000
    rank_sample: int = 100_000
    invert_score: bool = False
    seed: int = 42
    key: str = "flow_id"
    boosted_options: dict = field(default_factory=dict)


@dataclass
class UnsupervisedRun:
    scored: DataFrame
    model: ForestModel
    fitted: dict
    columns: list[str]
    threshold: float
    contamination: float
    removed: DataFrame
    report: DataFrame
    metrics: DataFrame | None

    def config(self) -> dict:
        return {"best_threshold": self.threshold, "contamination": self.contamination,
                "transformed_features": self.fitted["columns"], "final_features": self.columns,
                "use_protocol_grouping": self.model.group is not None}


def with_inputs(features: DataFrame, fitted: dict, model: ForestModel, extra=()) -> DataFrame:
    """Score features under the fitted transform while keeping their original values.

    The originals ride along as one struct, so no join is needed to get them back.
    """
    packed = features.withColumn("_kept", F.struct(*features.columns))
    scored = model.transform(apply_for_unsupervised(packed, fitted))
    return scored.select("_kept.*", "raw_score", *extra)


def train_unsupervised(df: DataFrame, cfg: UnsupervisedConfig | None = None) -> UnsupervisedRun:
    """Features, split, selection, transform, forests per protocol, threshold, scores, metrics.

    Everything is fitted on the training split only. Three tables are written on the way: the
    features, the same with their split, and the scores, each of which feeds several passes.
    """
    cfg = cfg or UnsupervisedConfig()
    labelled = "Label" in df.columns or "label_binary" in df.columns
    features = extract_features(df, cfg.stage, size=cfg.size, key=cfg.key)
    if labelled and "label_binary" not in features.columns:
        features = binary_label(features)
    features = protocol_group(features) if "Proto" in features.columns else features.withColumn(
        "protocol_group", F.lit("all"))
    features = materialize(features, "features")
    label = "label_binary" if labelled else None
    if label:
        features = materialize(split(features, cfg.key, label, 0.2, 0.2, cfg.seed, few_strata=True), "split")  # read by every fit below
        train = features.where("split = 'train'")
    else:
        features = features.withColumn("split", F.lit("train"))
        train = features

    names = prepare_feature_set(features, cfg.key, stage=cfg.stage).columns[1:]
    kept, removed = select.select_features(train, names, [Strategy.QUALITY, Strategy.CORRELATION])
    fitted = fit_for_unsupervised(train, [c for c in SKEWED_FEATURES if c in kept], kept, key=cfg.key)
    columns = fitted["columns"]
    if label and cfg.importance:
        inputs = apply_for_unsupervised(train, fitted)

        def rank(frame, cols, y):
            return boosted.rank_features(frame, cols, y, cfg.key, cfg.rank_sample, seed=cfg.seed, **cfg.boosted_options)

        columns, dropped = select.select_features(inputs, columns, [Strategy.IMPORTANCE], label, rank)
        removed = removed.unionByName(dropped)
        watch = boosted.rank_features(inputs, columns, label, cfg.key, cfg.guard_sample,
                                      weight=boosted.class_weight(inputs, label), seed=cfg.seed, **cfg.boosted_options)
        columns, _ = select.time_bias_guard(columns, watch)

    share = contamination(train, label or "").first()["contamination"]
    inputs = apply_for_unsupervised(train, fitted)
    options = dict(key=cfg.key, trees=cfg.trees, max_samples=cfg.max_samples, bootstrap=cfg.bootstrap, seed=cfg.seed)
    model, report = fit_grouped(inputs, columns, label=label, min_rows=cfg.min_rows, **options)
    if not model.sizes:
        model = fit_forest(inputs, columns, **options)
    scored = materialize(with_inputs(features, fitted, model), "scored")
    if model.group is None:
        scored = scored.withColumn("anomaly_score", F.col("raw_score") if cfg.invert_score else -F.col("raw_score"))
    else:
        stats = group_score_stats(scored.where("split = 'train'"))
        scored = score_grouped(scored, stats, invert_score=cfg.invert_score)

    threshold = None
    if label:
        threshold = best_f1_threshold(scored.where("split = 'val'"), fallback_frac=share).first()["threshold"]
    scored = flag_top(scored, frac=share, threshold=threshold)
    test_metrics = metrics(scored.where("split = 'test'")) if label else None
    return UnsupervisedRun(scored, model, fitted, columns, threshold, share, removed, report, test_metrics)


@dataclass
class SupervisedRun:
    model: boosted.BoostedModel
    columns: list[str]
    importances: DataFrame
    overfit: DataFrame
    scored: DataFrame
    metrics: DataFrame


def train_supervised(df: DataFrame, size: str = "1min", stage: int = 4, key: str = "flow_id", seed: int = 42,
                     rank_sample: int = 100_000, guard_sample: int = 10_000, boosted_options: dict | None = None,
                     first: dict | None = None, tighter: dict | None = None) -> SupervisedRun:
    """Features, selection, time-bias guard, hold-out, guarded fit, importances and test metrics."""
    options = boosted_options or {}
    features = materialize(binary_label(extract_features(df, stage, size=size, key=key)), "features")
    features = materialize(split(features, key, "label_binary", 0.2, seed=seed, few_strata=True), "split")  # read by every fit below
    train = features.where("split = 'train'").drop("split")
    names = prepare_feature_set(features, key, stage=stage).columns[1:]

    def rank(frame, cols, y):
        return boosted.rank_features(frame, cols, y, key, rank_sample, seed=seed, **options)

    kept, _ = select.select_features(train, names, [Strategy.ALL], "label_binary", rank, 0.95, 15, 30)
    watch = boosted.rank_features(train, kept, "label_binary", key, guard_sample,
                                  weight=boosted.class_weight(train, "label_binary"), seed=seed, **options)
    kept, _ = select.time_bias_guard(kept, watch)
    model, overfit = boosted.fit_with_guard(train, kept, "label_binary", key, seed, first, tighter)
    scored = model.transform(features)
    return SupervisedRun(model, kept, model.importances(), overfit, scored, metrics(scored.where("split = 'test'")))
