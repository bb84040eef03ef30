"""Samples, splits, thresholds and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens.operators import evaluate as ev, sampling as sp, thresholds as th
from registry.base import flows, query, scored_flows, table
from registry.features import rounded

HASH = "md5(concat(CAST(flow_id AS VARCHAR), '|42'))"


def split_sql(partition):
    return f"""
WITH r AS (SELECT flow_id, {partition or '0'} AS l, row_number() OVER ({'PARTITION BY ' + partition if partition else ''} ORDER BY {HASH}) AS k,
  COUNT(*) OVER ({'PARTITION BY ' + partition if partition else ''}) AS n FROM {{scored}} AS s),
c AS (SELECT *, floor(n * 0.2 + 0.5) AS t FROM r)
SELECT flow_id, CASE WHEN k <= t THEN 'test' WHEN k <= t + floor((n - t) * 0.2 + 0.5) THEN 'val' ELSE 'train' END AS split FROM c"""


@query("split_train_test", f"""
WITH r AS (SELECT flow_id, row_number() OVER (PARTITION BY label_binary ORDER BY {HASH}) AS k,
  COUNT(*) OVER (PARTITION BY label_binary) AS n FROM {{scored}} AS s)
SELECT flow_id, CASE WHEN k <= floor(n * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split FROM r""")
def split_train_test(spark, sf_dir):
    return sp.split(scored_flows(spark, sf_dir), label="label_binary").select("flow_id", "split")


@query("split_train_val_test", split_sql("label_binary"))
def split_train_val_test(spark, sf_dir):
    return sp.split(scored_flows(spark, sf_dir), label="label_binary", val=0.2).select("flow_id", "split")


@query("split_unstratified", split_sql(""))
def split_unstratified(spark, sf_dir):
    return sp.split(flows(spark, sf_dir), val=0.2).select("flow_id", "split")


@query("split_by_hash", f"""
SELECT flow_id, CASE WHEN h < 0.2 THEN 'test' WHEN h < 0.2 + 0.8 * 0.2 THEN 'val' ELSE 'train' END AS split
FROM (SELECT flow_id, CAST(CAST(concat('0x', substr({HASH}, 1, 8)) AS BIGINT) AS DOUBLE) / 4294967296 AS h FROM {{flows}} AS f) AS t""")
def split_by_hash(spark, sf_dir):
    return sp.split(flows(spark, sf_dir), val=0.2, exact=False).select("flow_id", "split")


@query("stratified_sample", f"""
WITH c AS (SELECT label_binary, 2000 * COUNT(*) / CAST((SELECT COUNT(*) FROM events) AS DOUBLE) AS e FROM {{scored}} AS s GROUP BY 1),
q AS (SELECT label_binary, floor(e) AS base, row_number() OVER (ORDER BY floor(e) - e, CAST(label_binary AS VARCHAR)) AS o FROM c),
w AS (SELECT label_binary, base + CASE WHEN o <= 2000 - (SELECT SUM(base) FROM q) THEN 1 ELSE 0 END AS k FROM q),
r AS (SELECT flow_id, label_binary, row_number() OVER (PARTITION BY label_binary ORDER BY {HASH}) AS k FROM {{scored}} AS s)
SELECT flow_id, r.label_binary FROM r JOIN w ON r.label_binary = w.label_binary WHERE r.k <= w.k""")
def stratified_sample(spark, sf_dir):
    return sp.stratified_sample(scored_flows(spark, sf_dir), n=2000).select("flow_id", "label_binary")


@query("sample_n", f"SELECT flow_id FROM (SELECT flow_id, row_number() OVER (ORDER BY {HASH}) AS k FROM {{flows}} AS f) AS t WHERE k <= 5000")
def sample_n(spark, sf_dir):
    return sp.sample_n(flows(spark, sf_dir), n=5000).select("flow_id")


@query("capped_sample", f"""
WITH c AS (SELECT COUNT(*) AS t, COUNT(*) FILTER (label_binary = 0) AS n0, COUNT(*) FILTER (label_binary = 1) AS n1 FROM {{scored}} AS s),
a AS (SELECT *, least(CAST(floor(3000 * (n0 / CAST(t AS DOUBLE))) AS BIGINT), n0) AS s0, least(CAST(floor(3000 * (n1 / CAST(t AS DOUBLE))) AS BIGINT), n1) AS s1 FROM c),
b AS (SELECT *, s0 + least(3000 - s0 - s1, n0 - s0) AS k0 FROM a),
d AS (SELECT *, s1 + least(3000 - k0 - s1, n1 - s1) AS k1 FROM b),
r AS (SELECT flow_id, label_binary, row_number() OVER (PARTITION BY label_binary ORDER BY {HASH}) AS k FROM {{scored}} AS s)
SELECT flow_id, label_binary FROM r CROSS JOIN d WHERE k <= CASE WHEN label_binary = 0 THEN k0 ELSE k1 END""")
def capped_sample(spark, sf_dir):
    return sp.capped_sample(scored_flows(spark, sf_dir), cap=3000).select("flow_id", "label_binary")


@query("flag_top", """SELECT flow_id, CASE WHEN anomaly_score >= quantile_cont(anomaly_score, 0.9) OVER () THEN 1 ELSE 0 END AS y_pred FROM {scored} AS s""")
def flag_top(spark, sf_dir):
    return th.flag_top(scored_flows(spark, sf_dir)).select("flow_id", "y_pred")


@query("flag_bottom", """SELECT flow_id, CASE WHEN anomaly_score <= quantile_cont(anomaly_score, 0.1) OVER () THEN 1 ELSE 0 END AS y_pred FROM {scored} AS s""")
def flag_bottom(spark, sf_dir):
    return th.flag_bottom(scored_flows(spark, sf_dir), "anomaly_score").select("flow_id", "y_pred")


CURVE = """SELECT threshold, tp, n - tp AS fp, tp / CAST(n AS DOUBLE) AS precision, tp / CAST(p AS DOUBLE) AS recall FROM (
  SELECT DISTINCT anomaly_score AS threshold, CAST(SUM(label_binary) OVER (ORDER BY anomaly_score DESC) AS BIGINT) AS tp,
    COUNT(*) OVER (ORDER BY anomaly_score DESC) AS n, SUM(label_binary) OVER () AS p FROM {scored} AS s) AS t"""
CURVE_ROUNDED = f"SELECT threshold, tp, fp, ROUND(precision, 9) AS precision, ROUND(recall, 9) AS recall FROM ({CURVE}) AS c"


@query("pr_curve", CURVE_ROUNDED)
def pr_curve(spark, sf_dir):
    return rounded(th.pr_curve(scored_flows(spark, sf_dir)), ["precision", "recall"], 9)


@query("pr_curve_sliced", CURVE_ROUNDED)
def pr_curve_sliced(spark, sf_dir):
    """Same curve with small slices, as at large scale."""
    return rounded(th.pr_curve(scored_flows(spark, sf_dir), rows_per_slice=500), ["precision", "recall"], 9)


@query("best_f1_threshold", f"""
SELECT threshold, ROUND(precision, 9) AS precision, ROUND(recall, 9) AS recall, ROUND(f, 9) AS f1
FROM (SELECT *, 2 * recall * precision / (recall + precision + 1e-10) AS f FROM ({CURVE}) AS c) AS t
ORDER BY f DESC, threshold LIMIT 1""")
def best_f1_threshold(spark, sf_dir):
    return rounded(th.best_f1_threshold(scored_flows(spark, sf_dir)), ["precision", "recall", "f1"], 9)


AUC = """SELECT ROUND(SUM(pos * (below + neg / 2.0)) / (SUM(pos) * SUM(neg)), 9) AS roc_auc FROM (
  SELECT pos, neg, SUM(neg) OVER (ORDER BY s) - neg AS below FROM (
    SELECT {s} AS s, COUNT(*) FILTER (l = 1) AS pos, COUNT(*) FILTER (l = 0) AS neg FROM {t} GROUP BY 1) AS g) AS h"""


@query("roc_auc", AUC.replace("{s}", "anomaly_score").replace("{t}", "(SELECT *, label_binary AS l FROM {scored} AS s0) AS s1"))
def roc_auc(spark, sf_dir):
    return rounded(th.roc_auc(scored_flows(spark, sf_dir)), ["roc_auc"], 9)


@query("roc_auc_lineitem", AUC.replace("{s}", "CAST(l_extendedprice AS DOUBLE)").replace(
    "{t}", "(SELECT *, CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS l FROM lineitem) AS s1"))
def roc_auc_lineitem(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_extendedprice", (F.col("l_quantity") > 25).cast("int").alias("l"))
    return rounded(th.roc_auc(li, "l_extendedprice", "l", rows_per_slice=10_000), ["roc_auc"], 9)


@query("threshold_grid", """
SELECT percentile, threshold, tp, fp, fn, ROUND(p, 9) AS precision, ROUND(r, 9) AS recall, ROUND(COALESCE(2 * p * r / NULLIF(p + r, 0), 0), 9) AS f1 FROM (
  SELECT percentile, threshold, tp, fp, fn, COALESCE(tp / CAST(NULLIF(tp + fp, 0) AS DOUBLE), 0) AS p, COALESCE(tp / CAST(NULLIF(tp + fn, 0) AS DOUBLE), 0) AS r FROM (
    SELECT q.percentile, ROUND(q.t, 6) AS threshold, COUNT(*) FILTER (anomaly_score >= t AND label_binary = 1) AS tp,
      COUNT(*) FILTER (anomaly_score >= t AND label_binary = 0) AS fp, COUNT(*) FILTER (anomaly_score < t AND label_binary = 1) AS fn
    FROM {scored} AS s CROSS JOIN (SELECT CAST(g.pc AS DOUBLE) AS percentile, list_extract(l, CAST(g.i AS INT)) AS t FROM
      (SELECT quantile_cont(anomaly_score, [0.90,0.91,0.92,0.93,0.94,0.95,0.96,0.97,0.98,0.99,0.995]) AS l FROM {scored} AS s2) AS a,
      (VALUES (1,90),(2,91),(3,92),(4,93),(5,94),(6,95),(7,96),(8,97),(9,98),(10,99),(11,99.5)) AS g(i, pc)) AS q GROUP BY 1, 2) AS u) AS v""")
def threshold_grid(spark, sf_dir):
    return rounded(rounded(th.threshold_grid(scored_flows(spark, sf_dir)), ["threshold"]), ["precision", "recall", "f1"], 9)


CONT = "ROUND(greatest(CASE WHEN r > 0.15 THEN r ELSE least(1.3 * r, 0.2) END, 0.01), 9) AS contamination"


@query("contamination", f"""SELECT rows, ROUND(r, 9) AS anomaly_ratio, {CONT} FROM (
  SELECT COUNT(*) AS rows, AVG(label_binary) AS r FROM {{scored}} AS s) AS t""")
def contamination(spark, sf_dir):
    return rounded(th.contamination(scored_flows(spark, sf_dir)), ["anomaly_ratio", "contamination"], 9)


@query("contamination_by_protocol", f"""SELECT proto, rows, ROUND(r, 9) AS anomaly_ratio, {CONT} FROM (
  SELECT lower(Proto) AS proto, COUNT(*) AS rows, AVG(label_binary) AS r FROM {{scored}} AS s GROUP BY 1) AS t""")
def contamination_by_protocol(spark, sf_dir):
    f = scored_flows(spark, sf_dir).withColumn("Proto", F.lower("Proto")).withColumnRenamed("Proto", "proto")
    return rounded(th.contamination(f, by="proto"), ["anomaly_ratio", "contamination"], 9)


COUNTS = """COUNT(*) FILTER (y = 0 AND p = 0) AS tn, COUNT(*) FILTER (y = 0 AND p = 1) AS fp,
  COUNT(*) FILTER (y = 1 AND p = 0) AS fn, COUNT(*) FILTER (y = 1 AND p = 1) AS tp"""
SCORED_YP = "(SELECT *, label_binary AS y, y_pred AS p FROM {scored} AS s0) AS s1"
RATES = """tn + fp + fn + tp AS total, (tn + tp) / CAST(tn + fp + fn + tp AS DOUBLE) AS accuracy,
  COALESCE(tp / CAST(NULLIF(tp + fp, 0) AS DOUBLE), 0) AS precision, COALESCE(tp / CAST(NULLIF(tp + fn, 0) AS DOUBLE), 0) AS recall,
  COALESCE(2.0 * tp / CAST(NULLIF(2 * tp + fp + fn, 0) AS DOUBLE), 0) AS f1,
  COALESCE(tn / CAST(NULLIF(tn + fn, 0) AS DOUBLE), 0) AS precision_normal, COALESCE(tn / CAST(NULLIF(tn + fp, 0) AS DOUBLE), 0) AS recall_normal"""
RATE_NAMES = ["accuracy", "precision", "recall", "f1", "precision_normal", "recall_normal"]
ROUND_RATES = ", ".join(f"ROUND({n}, 9) AS {n}" for n in RATE_NAMES)


@query("confusion", f"SELECT {COUNTS} FROM {SCORED_YP}")
def confusion(spark, sf_dir):
    return ev.confusion(scored_flows(spark, sf_dir))


@query("confusion_by_protocol", f"SELECT lower(Proto) AS protocol, {COUNTS} FROM {SCORED_YP} GROUP BY 1")
def confusion_by_protocol(spark, sf_dir):
    return ev.confusion(scored_flows(spark, sf_dir).withColumn("protocol", F.lower("Proto")), by="protocol")


@query("confusion_labels", f"SELECT {COUNTS} FROM (SELECT quality AS y, toxic AS p FROM labels) AS t")
def confusion_labels(spark, sf_dir):
    return ev.confusion(table(spark, sf_dir, "labels"), "quality", "toxic")


@query("metrics", f"SELECT tn, fp, fn, tp, total, {ROUND_RATES} FROM (SELECT *, {RATES} FROM (SELECT {COUNTS} FROM {SCORED_YP}) AS c) AS m")
def metrics(spark, sf_dir):
    return rounded(ev.metrics(scored_flows(spark, sf_dir)), RATE_NAMES, 9)


@query("classification_report", f"""
WITH m AS (SELECT *, {RATES} FROM (SELECT {COUNTS} FROM {SCORED_YP}) AS c),
n AS (SELECT *, 2 * precision_normal * recall_normal / (precision_normal + recall_normal) AS f1n, tn + fp AS n0, fn + tp AS n1 FROM m)
SELECT 'normal' AS class, ROUND(precision_normal, 9) AS precision, ROUND(recall_normal, 9) AS recall, ROUND(f1n, 9) AS f1, n0 AS support FROM n
UNION ALL SELECT 'anomaly', ROUND(precision, 9), ROUND(recall, 9), ROUND(f1, 9), n1 FROM n
UNION ALL SELECT 'accuracy', ROUND(accuracy, 9), ROUND(accuracy, 9), ROUND(accuracy, 9), total FROM n
UNION ALL SELECT 'macro avg', ROUND((precision_normal + precision) / 2, 9), ROUND((recall_normal + recall) / 2, 9), ROUND((f1n + f1) / 2, 9), total FROM n
UNION ALL SELECT 'weighted avg', ROUND((precision_normal * n0 + precision * n1) / total, 9), ROUND((recall_normal * n0 + recall * n1) / total, 9),
  ROUND((f1n * n0 + f1 * n1) / total, 9), total FROM n""")
def classification_report(spark, sf_dir):
    return rounded(ev.classification_report(scored_flows(spark, sf_dir)), ["precision", "recall", "f1"], 9)


@query("score_summary", """SELECT MIN(anomaly_score) AS "min", MAX(anomaly_score) AS "max", ROUND(AVG(anomaly_score), 6) AS mean,
  ROUND(stddev_pop(anomaly_score), 6) AS std, ROUND(AVG(y_pred), 9) AS predicted_share, ROUND(AVG(label_binary), 9) AS actual_share FROM {scored} AS s""")
def score_summary(spark, sf_dir):
    out = ev.score_summary(scored_flows(spark, sf_dir))
    return rounded(rounded(out, ["mean", "std"]), ["predicted_share", "actual_share"], 9)


# A second prediction that lets uncertain tcp rows pass.
BOTH = "(SELECT *, CASE WHEN y_pred = 1 AND lower(Proto) = 'tcp' AND TotBytes < 12000 THEN 0 ELSE y_pred END AS y_final FROM {scored} AS s0)"


def with_final(spark, sf_dir):
    soft = (F.lower("Proto") == "tcp") & (F.col("TotBytes") < 12000)
    return scored_flows(spark, sf_dir).withColumn("y_final", F.when(soft, 0).otherwise(F.col("y_pred")))


def rates_of(prediction):
    return f"(SELECT *, {RATES} FROM (SELECT {COUNTS} FROM (SELECT label_binary AS y, {prediction} AS p FROM {BOTH} AS b) AS d) AS e)"


@query("compare_metrics", f"""
SELECT b.fp AS before_fp, a.fp AS after_fp, ROUND(b.precision, 9) AS before_precision, ROUND(a.precision, 9) AS after_precision,
  ROUND(b.f1, 9) AS before_f1, ROUND(a.f1, 9) AS after_f1, b.fp - a.fp AS fp_reduction,
  ROUND((b.fp - a.fp) * 100.0 / b.fp, 6) AS fp_reduction_percent,
  ROUND((a.precision - b.precision) / b.precision * 100, 6) AS precision_change_percent,
  ROUND((a.f1 - b.f1) / b.f1 * 100, 6) AS f1_change_percent
FROM {rates_of('y_pred')} AS b CROSS JOIN {rates_of('y_final')} AS a""")
def compare_metrics(spark, sf_dir):
    f = with_final(spark, sf_dir)
    out = ev.compare_metrics(ev.metrics(f), ev.metrics(f, p="y_final"))
    out = rounded(out, ["before_precision", "after_precision", "before_f1", "after_f1"], 9)
    return rounded(out, ["fp_reduction_percent", "precision_change_percent", "f1_change_percent"])


@query("metric_deltas", "SELECT " + ", ".join(f"ROUND((a.{n} - b.{n}) * 100, 6) + 0.0 AS {n}_delta" for n in ("accuracy", "precision", "recall", "f1"))
       + f" FROM {rates_of('y_pred')} AS b CROSS JOIN {rates_of('y_final')} AS a")
def metric_deltas(spark, sf_dir):
    f = with_final(spark, sf_dir)
    out = ev.metric_deltas(ev.metrics(f), ev.metrics(f, p="y_final"))
    return rounded(out, out.columns)


@query("funnel", f"""
SELECT total, bt AS before_tp, bf AS before_fp, at_ AS after_tp, af AS after_fp, bt + bf AS before_anomalies, at_ + af AS after_anomalies,
  ROUND((bt + bf) * 100.0 / total, 6) AS before_rate, ROUND((at_ + af) * 100.0 / total, 6) AS after_rate,
  ROUND((bt + bf - at_ - af) * 100.0 / (bt + bf), 6) AS filter_rate, ROUND((bt - at_) * 100.0 / bt, 6) AS tp_filter_rate,
  ROUND((bf - af) * 100.0 / bf, 6) AS fp_filter_rate
FROM (SELECT COUNT(*) AS total, COUNT(*) FILTER (label_binary = 1 AND y_pred = 1) AS bt, COUNT(*) FILTER (label_binary = 0 AND y_pred = 1) AS bf,
  COUNT(*) FILTER (label_binary = 1 AND y_final = 1) AS at_, COUNT(*) FILTER (label_binary = 0 AND y_final = 1) AS af FROM {BOTH} AS b) AS t""")
def funnel(spark, sf_dir):
    out = ev.funnel(with_final(spark, sf_dir))
    return rounded(out, [c for c in out.columns if c.endswith("rate")])


def gap_sql(case):
    return f"""SELECT ROUND(tr, 9) AS train_accuracy, ROUND(te, 9) AS test_accuracy, ROUND(tr - te, 9) AS gap, {case} AS risk FROM (
  SELECT AVG(CASE WHEN split = 'train' THEN c END) AS tr, AVG(CASE WHEN split = 'test' THEN c END) AS te FROM (
    SELECT CASE WHEN flow_id % 5 = 0 THEN 'test' ELSE 'train' END AS split, CASE WHEN label_binary = y_pred THEN 1.0 ELSE 0.0 END AS c
    FROM {{scored}} AS s) AS t) AS u"""


def with_split(spark, sf_dir):
    return scored_flows(spark, sf_dir).withColumn("split", F.when(F.col("flow_id") % 5 == 0, "test").otherwise("train"))


@query("split_gap", gap_sql("CASE WHEN tr - te > 0.1 THEN 'HIGH' WHEN tr - te > 0.05 THEN 'MEDIUM' ELSE 'LOW' END"))
def split_gap(spark, sf_dir):
    return rounded(ev.split_gap(with_split(spark, sf_dir)), ["train_accuracy", "test_accuracy", "gap"], 9)


@query("overfit_report", gap_sql("CASE WHEN tr - te < 0.01 THEN 'low' WHEN tr - te < 0.05 THEN 'medium' ELSE 'high' END"))
def overfit_report(spark, sf_dir):
    return rounded(ev.overfit_report(with_split(spark, sf_dir)), ["train_accuracy", "test_accuracy", "gap"], 9)


@query("top_importances", """SELECT c_mktsegment AS feature, ROUND(SUM(c_acctbal), 2) AS importance FROM customer
  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""")
def top_importances(spark, sf_dir):
    t = (table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("feature"))
         .agg(F.round(F.sum("c_acctbal"), 2).alias("importance")))
    return ev.top_importances(t, 3)
