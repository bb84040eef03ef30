"""Stored features, transforms, rules, runs and results. All are plain tables on disk."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from flowlens.sources.flows import try_parquet

# The stored form of one allow-list rule.
RULE_SCHEMA = (
    "rule_id long, name string, type string, proto string, port double, port_min double, "
    "port_max double, ip string, anomaly_score_threshold double, "
    "conditions array<struct<feature:string,op:string,bound:double>>, "
    "fp_ratio double, normal_ratio double, attack_ratio double"
)
PARAM_SCHEMA = "feature string, center double, scale double"

# Result names under which each detector may have been stored.
RESULT_ALIASES = {
    "isolation_forest": ["isolation_forest", "if"],
    "lof": ["lof", "local_outlier_factor"],
    "one_class_svm": ["one_class_svm", "ocsvm", "svm"],
}


def save_features(df: DataFrame, base: str, stage: int) -> DataFrame:
    path = f"{base}/features_stage{stage}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def load_features(spark: SparkSession, base: str, stage: int | None = None, with_stage: bool = False):
    """Features of the given stage, or stage 4, or else stage 3."""
    for s in [stage] if stage else [4, 3]:
        df = try_parquet(spark, f"{base}/features_stage{s}")
        if df is not None:
            return (df, s) if with_stage else df
    if with_stage:
        return None, 0
    raise FileNotFoundError(f"no features under {base}")


def save_transformed(df: DataFrame, params: DataFrame, columns: list[str], base: str) -> None:
    """Data, scaler parameters and a one-row metadata record."""
    df.write.mode("overwrite").parquet(f"{base}/data")
    params.write.mode("overwrite").parquet(f"{base}/params")
    rows = df.sparkSession.read.parquet(f"{base}/data").count()
    (df.sparkSession.createDataFrame(
        [(list(columns), len(columns), rows, len(df.columns))],
        "columns array<string>, count int, row_count long, column_count int")
     .withColumn("timestamp", F.current_timestamp())
     .write.mode("overwrite").json(f"{base}/metadata"))


def load_transformed(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Data, parameters and column list; without metadata all columns count."""
    data = try_parquet(spark, f"{base}/data")
    if data is None:
        raise FileNotFoundError(f"no transformed features under {base}")
    columns = data.columns
    try:
        columns = spark.read.schema("columns array<string>").json(f"{base}/metadata").first()["columns"]
    except Exception as error:  # absent metadata is allowed
        if "PATH_NOT_FOUND" not in str(error):
            raise
    return data, spark.read.parquet(f"{base}/params"), columns


def rule_fields() -> list[tuple[str, str]]:
    """Names and types of the stored rule form."""
    return [(f.name, f.dataType.simpleString()) for f in T.DataType.fromDDL(RULE_SCHEMA).fields]


def save_rules(rules: DataFrame, path: str) -> str:
    """Write rules as JSON lines; the path gets a .json ending."""
    path = path if path.endswith(".json") else path + ".json"
    rules.select(*[n for n, _ in rule_fields()]).write.mode("overwrite").json(path)
    return path


def load_rules(spark: SparkSession, path: str) -> DataFrame:
    path = path if path.endswith(".json") else path + ".json"
    try:
        return spark.read.schema(RULE_SCHEMA).json(path)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(path) from error
        raise


def save_run(scored: DataFrame, base: str, config: dict, model=None) -> None:
    """Scored flows partitioned by split, the configuration, and the model's own table."""
    scored.write.mode("overwrite").partitionBy("split").parquet(f"{base}/scored")
    (scored.sparkSession.createDataFrame([(json.dumps(config, sort_keys=True),)], "config string")
     .coalesce(1).write.mode("overwrite").json(f"{base}/config"))
    if model is not None:
        model.save(f"{base}/model")


def load_run(spark: SparkSession, base: str) -> tuple[DataFrame, dict]:
    scored = try_parquet(spark, f"{base}/scored")
    if scored is None:
        raise FileNotFoundError(f"no run under {base}")
    config = json.loads(spark.read.schema("config string").json(f"{base}/config").first()["config"])
    return scored, config


def load_model(spark: SparkSession, base: str, kind):
    """The model a run was stored with; ``kind`` is its class."""
    return kind.load(spark, f"{base}/model")


def save_result(result: DataFrame, base: str, model: str) -> None:
    """Store one detector's result row under its name."""
    result.coalesce(1).write.mode("overwrite").parquet(os.path.join(base, f"model={model}"))


def load_results(spark: SparkSession, base: str) -> DataFrame:
    """All stored results, one row per detector; the first alias found wins."""
    found = None
    for model, aliases in RESULT_ALIASES.items():
        for alias in aliases:
            df = try_parquet(spark, os.path.join(base, f"model={alias}"))
            if df is not None:
                df = df.withColumn("model_type", F.lit(model))
                found = df if found is None else found.unionByName(df, allowMissingColumns=True)
                break
    if found is None:
        raise FileNotFoundError(f"no results under {base}")
    return found


def write_csv(df: DataFrame, path: str) -> None:
    """A report table (few rows) as one headered CSV file."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def save_best_transforms(best: DataFrame, data: DataFrame, params: DataFrame, base: str) -> None:
    """The chosen transform per feature, the transformed data and the scaler."""
    best.coalesce(1).write.mode("overwrite").json(f"{base}/best")
    data.write.mode("overwrite").parquet(f"{base}/data")
    params.write.mode("overwrite").parquet(f"{base}/params")
