"""Headline timings: prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores."""

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from registry import QUERIES  # noqa: E402
from registry.base import scored_flows  # noqa: E402
from registry.models import INPUTS  # noqa: E402

NAMES = [
    "extract_features", "interval_features", "src_window_features", "pair_window_features", "src_window_orders",
    "describe_lineitem", "long_tail", "quality_report", "correlation_pairs", "transform_for_unsupervised",
    "split_train_val_test", "pr_curve", "roc_auc_lineitem", "behavioral_bounds", "mine_rules", "apply_rules",
    "postprocess_effect", "isolation_forest_grouped", "local_outlier_factor",
]


def session(cpus: str) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark, name, sf_dir) -> float:
    """Build and fully compute a query without keeping its rows."""
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def detectors(spark, sf_dir) -> dict[str, float]:
    """Fit and predict times of the three detectors on the shared 50,000-row sample."""
    from flowlens.plans.benchmark import benchmark_models

    flows = scored_flows(spark, sf_dir).drop("y_pred", "anomaly_score")
    out = {}
    for r in benchmark_models(flows, skewed=INPUTS, features=INPUTS).select(
            "model_type", "train_time", "predict_time").collect():
        out[f"{r['model_type']}_fit"], out[f"{r['model_type']}_predict"] = r["train_time"], r["predict_time"]
    return out


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or NAMES
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):  # load classes and start workers on the smallest data
        for n in names:
            run(spark, n, warm)
        if names == NAMES:
            detectors(spark, warm)
    times = {n: round(run(spark, n, sf_dir), 3) for n in names}
    if names == NAMES:
        times |= {n: round(t, 3) for n, t in detectors(spark, sf_dir).items()}
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
