"""The whole feature path: extract, store, select, transform, store."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from flowlens.functions.catalog import SKEWED_FEATURES
from flowlens.operators.evaluate import feature_counts
from flowlens.operators.row_features import prepare_feature_set
from flowlens.operators.select import Strategy, select_features
from flowlens.operators.transform import apply_for_unsupervised, fit_for_unsupervised, params_table
from flowlens.plans.features import add_pair_stage, extract_features, smoke_stage4
from flowlens.sources.storage import materialize
from flowlens.sources.stores import load_features, save_features, save_transformed


@dataclass
class ProcessedFlows:
    features: DataFrame
    transformed: DataFrame
    fitted: dict
    columns: list[str]
    stage: int
    removed: DataFrame | None
    counts: DataFrame


def staged_features(df: DataFrame, stage: int, size: str, key: str, base: str | None,
                    incremental: bool) -> tuple[DataFrame, int, bool]:
    """Features, the stage reached, and whether there is something new to store.

    Incremental: stage 4 is tried on a sample of the stored stage 3 first; if that or the
    full step fails, stage 3 is used and stays as it is on disk.
    """
    if incremental and base and stage == 4:
        stored, found = load_features(df.sparkSession, base, 3, with_stage=True)
        if found == 3:
            try:
                if smoke_stage4(stored, size=size, key=key).where("not present").count() == 0:
                    return add_pair_stage(stored, size), 4, True
            except AnalysisException:  # as above; any other failure is raised
                pass
            return stored, 3, False
    return extract_features(df, stage, size=size, key=key), stage, True


def process_flows(df: DataFrame, base: str | None = None, stage: int = 4, size: str = "1min", key: str = "flow_id",
                  strategies=(Strategy.QUALITY, Strategy.CORRELATION), label: str | None = None, importances=None,
                  incremental: bool = False) -> ProcessedFlows:
    """Features of cleaned flows, selected, log transformed and robust scaled.

    With ``base`` both tables are stored under it. ``strategies=None`` keeps all features.
    """
    features, reached, new = staged_features(df, stage, size, key, base, incremental)
    if base and new:
        features = save_features(features, base, reached)
    elif new:
        features = materialize(features, "features")  # read by several fits below
    offered = prepare_feature_set(features, key, stage=reached).columns[1:]
    kept, removed = (offered, None) if strategies is None else select_features(
        features, offered, strategies, label, importances)
    fitted = fit_for_unsupervised(features, [c for c in SKEWED_FEATURES if c in features.columns], kept, key=key)
    transformed = apply_for_unsupervised(features, fitted)
    if base:
        save_transformed(transformed, params_table(df.sparkSession, fitted["params"]), fitted["columns"],
                         f"{base}/transformed")
    counts = feature_counts(features, offered, fitted["columns"], kept).withColumn("rows", F.lit(features.count()))
    return ProcessedFlows(features, transformed, fitted, fitted["columns"], reached, removed, counts)
