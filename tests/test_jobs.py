"""Rules, stores, jobs, streams and plan shapes."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flowlens.operators import row_features as rf, rules as ru, windows
from flowlens.plans.features import build_features, extract_features
from flowlens.plans.postprocess import postprocess
from flowlens.plans.training import UnsupervisedConfig, train_unsupervised
from flowlens.sources import flows as src, stores
from flowlens.sources.storage import scratch_path, shared_folder
from flowlens.streaming.arrivals import stream_intervals
from flowlens.streaming.scoring import read_stream, replay, run_available, run_counted
from flowlens.streaming.windows import stream_src_windows
from registry.base import flows, scored_flows

DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rules_never_raise_flags(spark):
    f = rf.row_features(scored_flows(spark, DIR))
    rules = ru.mine_rules(f, method="score", min_samples=1)
    assert rules.count() > 0
    out = ru.apply_rules(f, rules)
    assert out.where("y_final > y_pred").count() == 0 and out.count() == f.count()
    for method in ("threshold", "topn"):
        assert set(ru.mine_rules(f, method=method).columns) == {n for n, _ in stores.rule_fields()}
    with pytest.raises(ValueError):
        ru.mine_rules(f, method="guess")


def test_no_false_positives_no_rules(spark):
    f = rf.row_features(scored_flows(spark, DIR)).withColumn("y_pred", F.lit(0))
    assert ru.mine_rules(f).count() == 0
    assert ru.apply_rules(f, ru.mine_rules(f)).where("allowed").count() == 0


def test_missing_feature_passes_and_log_name_is_found(spark):
    rule = (0, "r", "port_behavioral", None, 80.0, None, None, None, None, [("TotBytes", "max", 5.0)], .1, .1, .1)
    rules = spark.createDataFrame([rule], stores.RULE_SCHEMA)
    df = spark.createDataFrame([(1, 80, 1.0), (2, 80, 9.0), (3, 80, None), (4, 81, 1.0)], "flow_id int, Dport int, log_TotBytes double")
    got = {r["flow_id"]: r["rule_ids"] for r in ru.rule_match(rules, df).collect()}
    assert got == {1: [0], 2: [], 3: [0], 4: []}


def test_thousands_of_rules(spark):
    """Rules are joined, not written into the plan: each flow finds exactly its own."""
    n = 5_000
    ids = spark.range(n)
    null = lambda t: F.lit(None).cast(t)
    rules = ids.select(
        F.col("id").alias("rule_id"), F.lit("r").alias("name"),
        F.when(F.col("id") % 2 == 0, "proto_port").otherwise("port_behavioral").alias("type"), F.lit("tcp").alias("proto"),
        F.col("id").cast("double").alias("port"), null("double").alias("port_min"), null("double").alias("port_max"),
        null("string").alias("ip"), null("double").alias("anomaly_score_threshold"),
        F.when(F.col("id") % 2 == 1, F.array(F.struct(F.lit("TotBytes").alias("feature"), F.lit("max").alias("op"),
                                                      F.lit(10.0).alias("bound")))).alias("conditions"),
        F.lit(.1).alias("fp_ratio"), F.lit(.2).alias("normal_ratio"), F.lit(.3).alias("attack_ratio"))
    flows = ids.select((F.col("id") % (n + 100)).alias("Dport"), F.lit("TCP").alias("Proto"), (F.col("id") % 20).alias("TotBytes"),
                       F.lit(1).alias("label_binary"), F.lit(0).alias("y_pred"))
    out = ru.rule_match(rules, flows)
    want = F.when((F.col("Dport") % 2 == 0) | (F.col("TotBytes") < 10), F.array("Dport")).otherwise(F.array().cast("array<long>"))
    assert out.count() == n and out.where(F.col("rule_ids") != want).count() == 0
    covered = ru.fn_coverage(flows, rules)
    assert covered.count() == n and covered.agg(F.sum("matched_fn")).first()[0] == n // 2 + n // 4
    assert ru.apply_rules(flows.withColumn("y_pred", F.lit(1)), rules).where("y_final = 0").count() == n // 2 + n // 4


def test_rules_file(spark):
    rule = (0, "TCP/80", "proto_port", "tcp", 80.0, None, None, None, None, None, .1, .2, .3)
    rules = spark.createDataFrame([rule], stores.RULE_SCHEMA)
    path = stores.save_rules(rules, scratch_path(spark, "rules"))
    assert path.endswith(".json")
    assert stores.load_rules(spark, path[:-5]).collect() == rules.collect()
    with pytest.raises(FileNotFoundError):
        stores.load_rules(spark, scratch_path(spark, "nothing"))


def test_feature_store_prefers_the_highest_stage(spark):
    base, f = scratch_path(spark, "store"), flows(spark, DIR)
    with pytest.raises(FileNotFoundError):
        stores.load_features(spark, base)
    build_features(spark, base, f, 3, "1 day")
    assert "bidirectional_symmetry" not in stores.load_features(spark, base).columns
    full = build_features(spark, base, stage=4, size="1 day")
    assert "bidirectional_symmetry" in stores.load_features(spark, base).columns
    direct = extract_features(f, 4, size="1 day").select(sorted(full.columns))
    assert full.select(sorted(full.columns)).exceptAll(direct).count() == 0
    assert "bidirectional_symmetry" not in stores.load_features(spark, base, 3).columns


def test_transformed_store_without_metadata(spark):
    base = scratch_path(spark, "transformed")
    f = spark.createDataFrame([(1, 2.0)], "flow_id int, a double")
    params = spark.createDataFrame([("a", 0.0, 1.0)], stores.PARAM_SCHEMA)
    f.write.parquet(f"{base}/data")
    params.write.parquet(f"{base}/params")
    assert stores.load_transformed(spark, base)[2] == ["flow_id", "a"]
    stores.save_transformed(f, params, ["a"], scratch_path(spark, "other"))


def test_csv_cache(spark):
    csv, parquet = scratch_path(spark, "csv"), scratch_path(spark, "parquet")
    flows(spark, DIR).select("flow_id", "Dur", "Dport").write.option("header", True).csv(csv)
    first = src.read_through(spark, csv, parquet)
    assert dict(first.dtypes)["Dport"] == "double" and first.count() == 1_000
    assert src.read_through(spark, "/nowhere", parquet).count() == 1_000
    with pytest.raises(ValueError):
        src.read_flows(spark, csv, "xml")


def test_unsupervised_job_end_to_end(spark):
    cfg = UnsupervisedConfig(size="1 day", trees=20, min_rows=100, boosted_options={"iterations": 2})
    run = train_unsupervised(flows(spark, DIR), cfg)
    scored = run.scored
    assert scored.count() == 1_000 and scored.select("flow_id").distinct().count() == 1_000
    shares = {r["split"]: r["count"] for r in scored.groupBy("split").count().collect()}
    assert shares["train"] + shares["val"] + shares["test"] == 1_000 and abs(shares["train"] - 640) <= 2
    assert scored.where("anomaly_score is null").count() == 0 and run.metrics.first()["total"] == shares["test"]
    assert not set(run.columns) & {"SrcAddr", "Dport"}
    base = scratch_path(spark, "run")
    stores.save_run(scored, base, run.config(), run.model)
    again, config = stores.load_run(spark, base)
    assert again.count() == 1_000 and config["best_threshold"] == run.threshold
    post = postprocess(again.where("split = 'train'"), again.where("split = 'test'"), run.contamination, run.threshold)
    r = post.summary.first()
    assert r["filtered_count"] == post.effect.first()["reduced_anomalies"] and r["original"]["tp"] >= r["filtered"]["tp"]


def test_unlabelled_job(spark):
    cfg = UnsupervisedConfig(size="1 day", stage=1, trees=10, min_rows=10_000)
    run = train_unsupervised(flows(spark, DIR).drop("Label"), cfg)
    assert run.metrics is None and run.model.group is None
    assert run.scored.where("y_pred = 1").count() == pytest.approx(100, abs=10)


def test_late_flows_are_dropped(spark):
    path = scratch_path(spark, "in")
    schema = "StartTime timestamp, SrcAddr string, DstAddr string, Dport int, TotBytes long"
    for i, rows in enumerate([[("2024-01-01 00:00:10", "a", "x", 1, 5), ("2024-01-01 00:00:20", "a", "y", 1, 5)],
                              [("2024-01-01 01:00:00", "a", "x", 1, 1)], [("2024-01-01 00:00:30", "a", "z", 1, 9)],
                              [("2024-01-01 03:00:00", "a", "x", 1, 1)]]):
        spark.createDataFrame(rows, schema.replace("timestamp", "string")).withColumn(
            "StartTime", F.col("StartTime").cast("timestamp")).coalesce(1).write.mode("append").parquet(path)
    out = run_available(stream_src_windows(read_stream(spark, path, schema, 1), "1min", "10 minutes"))
    first = out.orderBy("window_start").first()
    assert first["unique_dst_per_minute_by_src"] in (2, 3) and out.count() == 2


def test_shared_folder_is_the_sessions(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        assert shared_folder(spark) == folder.rstrip("/")


def test_plans(spark):
    f = flows(spark, DIR)
    table = plan(windows.src_window_table(f, "1 day"))
    assert "Python" not in table and "CartesianProduct" not in table and "NestedLoop" not in table
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint" not in table  # ids are pruned
    full = plan(extract_features(f, 4, size="1 day"))
    assert "Python" not in full and "CartesianProduct" not in full and "NestedLoop" not in full
    rules = ru.mine_rules(rf.row_features(scored_flows(spark, DIR)), method="score", min_samples=1)
    applied = plan(ru.apply_rules(rf.row_features(scored_flows(spark, DIR)), rules))
    assert "Exchange" not in applied and "Join" not in applied and "Python" not in applied


def test_interval_features_sort_once(spark):
    sliced = plan(windows.interval_features(flows(spark, DIR), rows_per_slice=100))
    assert sliced.count("Window ") <= 4 and "NestedLoop" not in sliced


def test_hot_source_join_is_split(spark):
    """A source with a third of all rows does not end in one join task."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        ids = spark.range(0, 60_000, 1, 8)
        f = ids.select(F.col("id").alias("flow_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 500)).alias("SrcAddr"),
                       F.md5(F.col("id").cast("string")).alias("DstAddr"), F.lit(80).alias("Dport"), F.lit(1).alias("TotBytes"),
                       F.lit("2024-01-01").cast("timestamp_ntz").alias("StartTime"))
        out = windows.src_window_features(f, "1 day")
        assert out.agg(F.max("flows_per_minute_by_src")).first()[0] == 20_000
        out.collect()
        assert "skew=true" in plan(out)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_bounds_of_large_combinations(spark):
    """Narrow brackets give the same bounds as whole groups."""
    f = rf.row_features(scored_flows(spark, "/root/testdata/sf0.01"))
    combos = ru.combo_stats(f)
    plain = ru.behavioral_bounds(f, combos)
    large = ru.behavioral_bounds(f, combos.select("proto", "port"), whole_rows=100, accuracy=500)
    a, b = ({tuple(r) for r in d.select("proto", "port", "feature", "place", F.round("bound", 6)).collect()} for d in (plain, large))
    assert a == b and len(a) > 10


def test_replay_of_many_files_drops_nothing(spark):
    """Every file holds an early and a late flow; a third trigger loses the early ones."""
    path = scratch_path(spark, "in")
    at = F.when(F.col("id") % 2 == 0, "2024-01-01 00:00:10").otherwise("2024-01-01 10:00:00").cast("timestamp")
    rows = spark.range(0, 416, 1, 208).select(at.alias("StartTime"), F.lit("a").alias("SrcAddr"), F.lit("x").alias("DstAddr"),
                                              F.lit(1).alias("Dport"), F.lit(1).cast("long").alias("TotBytes"))
    rows.write.parquet(path)
    out, dropped = run_counted(stream_src_windows(read_stream(spark, path, rows.schema)))
    assert dropped == 0 and [r.flows_per_minute_by_src for r in out.collect()] == [208]
    _, dropped = run_counted(stream_src_windows(read_stream(spark, path, rows.schema, 100)))
    assert dropped > 0


def test_intervals_over_shuffled_files(spark):
    """Files in any order inside the allowed lateness, several triggers, a hot source: equal to the batch feature."""
    path, rng = scratch_path(spark, "in"), random.Random(5)
    flows = [(i, rng.choice(["hot", "hot", "a", "b", None]), datetime(2024, 1, 1) + timedelta(seconds=rng.randrange(7200), microseconds=rng.randrange(10**6)))
             for i in range(900)]
    flows += [(900 + i, s, t) for i, (_, s, t) in enumerate(flows[:40])]  # equal times are ordered by id
    flows += [(2000, "c", datetime(2024, 1, 3)), (2001, "c", datetime(2024, 1, 1, 0, 0, 1)), (2002, "a", None)]
    schema = "flow_id long, SrcAddr string, StartTime timestamp_ntz"
    order = sorted(flows, key=lambda f: (f[2] or datetime(2024, 1, 1)).timestamp() + rng.uniform(0, 1200))
    for part in range(20):
        mine = order[part * len(order) // 20:(part + 1) * len(order) // 20]
        spark.createDataFrame(rng.sample(mine, len(mine)), schema).coalesce(1).write.mode("append").parquet(path)
    got = replay(spark, path, spark.read.parquet(path).schema, lambda f: stream_intervals(f, "3 days", "1min"), files_per_trigger=3)
    want = windows.interval_features(spark.createDataFrame([f for f in flows if f[1] and f[2]], schema))
    a = {r["flow_id"]: round(r["time_since_last_flow"], 6) for r in got.collect()}
    b = {r["flow_id"]: round(r["time_since_last_flow"], 6) for r in want.collect()}
    assert a == b and len(a) == got.count()


def test_silent_sources_are_forgotten(spark):
    path, start = scratch_path(spark, "in"), datetime(2024, 1, 1)
    schema = "flow_id long, SrcAddr string, StartTime timestamp_ntz"
    for hours, name in ((0, "a"), (1, "a"), (6, "b"), (7, "a"), (8, "b")):
        spark.createDataFrame([(hours, name, start + timedelta(hours=hours))], schema).coalesce(1).write.mode("append").parquet(path)
    build = lambda f: stream_intervals(f, "1 minute", "1min", keep_minutes=120)
    got = replay(spark, path, spark.read.parquet(path).schema, build, files_per_trigger=1)
    assert {r["flow_id"]: r["time_since_last_flow"] for r in got.collect()} == {0: 0.0, 1: 3600.0, 6: 0.0, 7: 0.0, 8: 7200.0}
