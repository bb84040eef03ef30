"""Known small inputs with their exact results."""

import math

import pytest
from pyspark.sql import functions as F

from flowlens.functions.catalog import feature_names, transformed_names
from flowlens.functions.columns import is_private_ip, require, size_micros, time_bucket
from flowlens.operators import evaluate as ev, labels, profile, row_features as rf, select, thresholds, transform as tr, windows
from flowlens.plans.features import extract_features
from flowlens.sources.flows import clean


def values(df, column):
    return [r[column] for r in df.orderBy("i").collect()]


def frame(spark, schema, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)


def test_clean_coerces_and_keeps_rows(spark):
    df = frame(spark, "StartTime string, Dur string, Sport string, TotPkts string, Dport string, extra string",
               ("2011-08-17 12:01:01.780", "3.124", "80", "-5", "99999", "a"), ("invalid-date", "invalid", "invalid", "", "0x0303", "b"),
               ("2011/08/17 12:01:01.780123", "-1", " 80 ", "1e15", None, "c"), (None, "nan", "1", "2", "3", "d"))
    out = clean(df).orderBy("i").collect()
    assert [r["Dur"] for r in out] == [3.124, None, -1.0, None]
    assert [r["Sport"] for r in out] == [80.0, None, 80.0, 1.0]
    assert [r["TotPkts"] for r in out] == [-5.0, None, 1e15, 2.0]
    assert [r["Dport"] for r in out] == [99999.0, None, None, 3.0]
    assert [r["extra"] for r in out] == list("abcd")
    assert [r["StartTime"] is None for r in out] == [False, True, False, True]
    assert out[2]["StartTime"].microsecond == 780123


def test_clean_without_known_columns(spark):
    assert clean(frame(spark, "other string", ("x",))).columns == ["i", "other"]


def test_labels(spark):
    df = frame(spark, "Label string", ("From-Botnet-V50-1",), ("Background-google",), (None,), ("xBOTx",), ("Normal",))
    assert values(labels.binary_label(df), "label_binary") == [1, 0, 0, 1, 0]
    assert values(labels.binary_label(df, keywords=["google"]), "label_binary") == [0, 1, 0, 0, 0]
    numbers = frame(spark, "Label double", (1.0,), (0.0,), (2.0,), (None,))
    assert values(labels.binary_label(numbers), "label_binary") == [1, 0, 0, 0]
    with pytest.raises(ValueError):
        labels.binary_label(df, "absent")


@pytest.mark.parametrize("anomalies,low,high,ok", [(10, .05, 1.0, True), (3, .05, 1.0, False), (50, .05, .3, False), (20, .1, 1.0, True)])
def test_label_validation(spark, anomalies, low, high, ok):
    df = spark.range(100).select(F.lit("x").alias("Label"), (F.col("id") < anomalies).cast("int").alias("label_binary"))
    assert labels.validate_labels(df, low, high).first()["is_valid"] is ok


def test_label_stats_of_empty_table(spark):
    row = labels.label_stats(spark.createDataFrame([], "label_binary int")).first()
    assert row["total_count"] == 0 and row["anomaly_ratio"] == 0.0
    missing = labels.validate_labels(spark.createDataFrame([], "a int")).first()
    assert not missing["is_valid"] and "Label" in missing["messages"][0]


def test_pair_window_of_three_flows(spark):
    df = frame(spark, "StartTime timestamp_ntz, SrcAddr string, DstAddr string, SrcBytes long, DstBytes long, TotBytes long, TotPkts long, Dur double")
    rows = [(0, "2011-08-17 12:01:00", "A", "B", 1000, 100, 1100, 10, 1.0), (1, "2011-08-17 12:01:10", "B", "A", 500, 200, 700, 5, 2.0),
            (2, "2011-08-17 12:01:20", "A", "B", 200, 50, 250, 2, 3.0)]
    df = spark.createDataFrame(rows, "i int, StartTime string, " + "SrcAddr string, DstAddr string, SrcBytes long, DstBytes long, TotBytes long, TotPkts long, Dur double") \
        .withColumn("StartTime", F.col("StartTime").cast("timestamp_ntz"))
    for r in windows.pair_window_features(df).collect():
        assert r["bidirectional_flow_count"] == 3 and r["bidirectional_total_bytes"] == 2050
        assert r["bidirectional_total_packets"] == 17 and r["bidirectional_total_src_bytes"] == 1700
        assert r["bidirectional_total_dst_bytes"] == 350 and r["bidirectional_symmetry"] == pytest.approx(350 / 1700)
        assert r["bidirectional_avg_duration"] == 2.0 and r["bidirectional_window_flow_ratio"] == pytest.approx(1700 / 351)


def test_scan_states(spark):
    df = frame(spark, "State string, TotBytes long, SrcBytes long, TotPkts long, Dur double",
               ("CON", 100, 60, 2, 1.0), ("RST", 0, 0, 0, 0.0), ("S_RA", 100, 101, 1, -1.0))
    out = rf.row_features(df)
    assert values(out, "is_scanning") == [0, 1, 0]
    assert values(rf.row_features(df, prefix_states=True), "is_scanning") == [0, 1, 1]
    assert values(out, "src_ratio") == [60.0, 0.0, 101.0]
    assert values(out, "flow_ratio")[2] is None and values(out, "bytes_per_second")[2] is None
    with pytest.raises(ValueError):
        rf.row_features(df.drop("SrcBytes"))


def test_confusion_and_metrics(spark):
    y, p = [0, 0, 1, 1, 0, 1, 0], [0, 1, 1, 1, 0, 0, 0]
    df = frame(spark, "label_binary int, y_pred int", *zip(y, p))
    r = ev.metrics(df).first()
    assert (r["tn"], r["fp"], r["fn"], r["tp"]) == (3, 1, 1, 2) and r["accuracy"] == pytest.approx(5 / 7)
    only = ev.metrics(df.where("label_binary = 0")).first()
    assert only["tp"] == 0 and only["recall"] == 0.0 and only["f1"] == 0.0


def counts(spark, tn, fp, fn, tp):
    return ev.with_metrics(spark.createDataFrame([(tn, fp, fn, tp)], "tn long, fp long, fn long, tp long"))


def test_published_before_and_after(spark):
    before, after = counts(spark, 231736, 148769, 4937, 32060), counts(spark, 300000, 80000, 5000, 32000)
    r = before.first()
    assert [round(r[c], 4) for c in ("accuracy", "precision", "recall", "f1")] == [.6318, .1773, .8666, .2944]
    c = ev.compare_metrics(before, after).first()
    assert c["fp_reduction"] == 68769 and round(c["fp_reduction_percent"], 1) == 46.2
    assert round(c["precision_change_percent"], 1) == 61.2 and round(c["f1_change_percent"], 1) == 45.9
    published = ev.metric_deltas(before, counts(spark, 289044, 91461, 7036, 29961)).first()
    assert round(published["recall_delta"], 2) == -5.67


def test_split_gap_risk(spark):
    cells = [("train", 0, 0, 1000), ("train", 0, 1, 50), ("train", 1, 0, 20), ("train", 1, 1, 200),
             ("test", 0, 0, 200), ("test", 0, 1, 20), ("test", 1, 0, 10), ("test", 1, 1, 40)]
    df = spark.createDataFrame(cells, "split string, label_binary int, y_pred int, n int")
    df = df.withColumn("x", F.explode(F.sequence(F.lit(1), F.col("n"))))
    r = ev.split_gap(df).first()
    assert round(r["gap"], 4) == .0560 and r["risk"] == "MEDIUM"
    assert ev.overfit_report(df).first()["risk"] == "high"


def test_log_and_sqrt(spark):
    df = frame(spark, "v double, empty double", (-10., None), (0., None), (100., None), (1000., None), (None, None))
    out = tr.log_transform(df, ["v", "empty"])
    assert values(out, "log_v")[:4] == pytest.approx([math.log1p(x) for x in (0, 10, 110, 1010)]) and values(out, "log_v")[4] is None
    assert values(out, "log_empty") == [0.0] * 5
    roots = tr.sqrt_transform(frame(spark, "v double", (0.,), (1.,), (4.,), (9.,), (16.,)), ["v"])
    assert values(roots, "sqrt_v") == [0, 1, 2, 3, 4]
    assert values(tr.log_transform(df, ["v"], ""), "v")[1] == pytest.approx(math.log1p(10))


def test_robust_scaling(spark):
    df = frame(spark, "a double, b double, c double", *zip([1., 2., 3., 4., 5., 100.], [10., 20., 30., 40., 50., 60.], [5.] * 5 + [None]))
    fitted = tr.robust_fit(df, ["a", "b", "c"])
    assert fitted["a"] == (3.5, 2.5) and fitted["c"] == (5.0, 1.0)
    assert values(tr.robust_apply(df, fitted), "c") == [0.0] * 5 + [None]
    peak = frame(spark, "v double", (1.,), (1.,), (1.,), (1.,), (9.,))
    assert values(tr.robust_apply(peak, tr.robust_fit(peak, ["v"])), "v")[4] == 8.0
    with pytest.raises(ValueError):
        tr.robust_fit(df, ["absent"])


def test_metrics_drop_infinities(spark):
    df = frame(spark, "v double", (1.,), (2.,), (float("inf"),), (float("-inf"),), (5.,))
    r = tr.transform_metrics(df, ["v"]).first()
    assert r["n"] == 3 and r["mean"] == pytest.approx(8 / 3)
    empty = tr.transform_metrics(frame(spark, "v double", (None,)), ["v"]).first()
    assert empty["mean"] == 0.0 and empty["std"] == 0.0 and empty["is_normal_like"] is False


def test_class_separation(spark):
    df = frame(spark, "v double, label_binary int", (1., 0), (2., 0), (3., 0), (10., 1), (11., 1), (12., 1))
    assert tr.cohens_d(df, ["v"]).first()["cohens_d"] == pytest.approx(9.0)


def test_quality_and_correlation(spark):
    df = frame(spark, "f1 double, f2 double, f3 double", *zip([1., 2., 3., 4., 5.], [1.] * 5, [10., 20., 30., 40., 50.]))
    kept, removed = select.select_features(df, ["f1", "f2", "f3"], [select.Strategy.QUALITY, select.Strategy.CORRELATION])
    assert kept == ["f1"]
    assert {(r["feature"], r["reason"]) for r in removed.collect()} == {
        ("f2", "constant"), ("f2", "low_variance"), ("f3", "high_correlation")}


def test_private_addresses(spark):
    wanted = {"192.168.1.1": True, "8.8.8.8": False, "10.0.0.1": True, "172.16.0.1": True, "172.32.0.1": False, "127.0.0.1": True,
              "169.254.3.4": True, "::1": True, "fe80::1": True, "fd00::1": True, "2001:4860::1": False, "garbage": False,
              "256.1.1.1": False, "10.0.0": False, "": False, "010.0.0.1": False}
    df = spark.createDataFrame([(k,) for k in [*wanted, None]], "a string")
    got = {r["a"]: r["p"] for r in df.withColumn("p", is_private_ip(F.col("a"))).collect()}
    assert got == {**wanted, None: False}


def test_names_and_sizes(spark):
    assert len(feature_names(4)) == 37 and len(feature_names(4, include_time=False)) == 9
    assert transformed_names(["TotBytes", "hour"]) == ["log_TotBytes", "hour"]
    assert size_micros("1min") == size_micros("60 seconds") == 60_000_000 and size_micros("1h") == size_micros("1hour")
    with pytest.raises(ValueError):
        size_micros("soon")
    df = frame(spark, "t timestamp_ntz")
    assert df.select(time_bucket(df, "1 day", "t").alias("b")).dtypes == [("b", "timestamp_ntz")]
    with pytest.raises(ValueError):
        require(df, ["nope"])


def test_stages(spark):
    base = "flow_id long, SrcBytes long, TotBytes long, TotPkts long, Dur double"
    bare = spark.createDataFrame([(1, 1, 2, 1, 1.0)], base)
    assert set(extract_features(bare, 4).columns) >= set(feature_names(0))
    assert "hour" not in extract_features(bare, 4).columns


def test_contamination(spark):
    def share(n):
        df = spark.range(100).select((F.col("id") < n).cast("int").alias("label_binary"))
        return thresholds.contamination(df).first()["contamination"]

    assert share(25) == .25 and share(10) == pytest.approx(.13) and share(0) == .01 and share(15) == pytest.approx(.195)
    assert thresholds.contamination(spark.range(3)).first()["contamination"] == .1


def test_missing_protocol_column(spark):
    with pytest.raises(ValueError):
        profile.protocol_profile(spark.range(3))
