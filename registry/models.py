"""Detectors, jobs and stored artefacts."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from flowlens.operators import boosted, forest, neighbors, oneclass, row_features as rf, rules as ru, transform as tr
from flowlens.plans.benchmark import benchmark_models, compare_models
from flowlens.plans.features import add_pair_stage, build_features, extract_features, smoke_stage4
from flowlens.plans.postprocess import feedback_labels, postprocess, remine
from flowlens.plans.process import process_flows
from flowlens.plans.training import UnsupervisedConfig, train_supervised, train_unsupervised
from flowlens.sources import flows as src, stores
from flowlens.sources.storage import materialize, scratch_path
from registry.base import flows, query, scored_flows, table
from registry.features import rounded
from registry.profiles import best_sql
from registry.rules import SCORES

INPUTS = ["Dur", "TotPkts", "TotBytes", "SrcBytes"]


def scaled(spark, sf_dir):
    f = scored_flows(spark, sf_dir)
    out, _, columns = tr.transform_for_unsupervised(f, INPUTS, INPUTS)
    return out, columns


#: Rows (id, grp, x0, x1, …) as they enter a forest: logs, then robust scaling over the whole table.
FOREST_LOGS = ", ".join(f"ln(1 + {c}) AS l{i}" for i, c in enumerate(INPUTS))
FOREST_SCALED = ", ".join(
    f"(l{i} - quantile_cont(l{i}, 0.5) OVER ()) / COALESCE(NULLIF(quantile_cont(l{i}, 0.75) OVER () - quantile_cont(l{i}, 0.25) OVER (), 0), 1)"
    f" AS x{i}" for i in range(len(INPUTS)))
FOREST_ROWS = f"SELECT flow_id AS id, {{grp}} AS grp, {FOREST_SCALED} FROM (SELECT *, {FOREST_LOGS} FROM {{flows}} AS f) AS l"
PROTOCOL_SQL = "CASE WHEN lower(Proto) IN ('tcp', 'udp') THEN lower(Proto) ELSE 'other' END"


def drawn_sql(*place: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', 42, grp, tree, {', '.join(place)})), 1, {forest.DRAW_DIGITS}) AS BIGINT)"


def forest_sql(rows: str, width: int, trees: int = 100, bootstrap: bool = False, min_rows: int = 1, share: float = 1.0) -> str:
    """Common tables up to ``raw`` (id, grp, raw_score): the forest grown level by level and descended, in SQL.

    The rows of a node are told by ``node``; a split is made where the node's rows differ and the depth allows it.
    """
    every = range(width)
    seen = max(1, int(share * width))
    of_tree = [f"h{i} < {seen}" if seen < width else "TRUE" for i in every]
    ranks = (", " + ", ".join(f"list_position(cs, {i}) - 1 AS h{i}" for i in every)) if seen < width else ""
    cs = (f", list_transform(list_sort(list_transform(range({width}), lambda c: "
          f"{{'d': CAST('0x' || substr(md5(concat_ws('|', 42, grp, tree, 'c' || c)), 1, {forest.DRAW_DIGITS}) AS BIGINT), 'c': c}})),"
          f" lambda v: v.c) AS cs") if seen < width else ""
    start = f"(CASE WHEN pool < {trees} * draws THEN {drawn_sql("'start'")} ELSE tree * draws END + draw)"
    usable = ", ".join(f"CASE WHEN high{i} > low{i} AND {of_tree[i]} THEN {i} END" for i in every)
    pick = lambda what, of: f"CASE {of} " + " ".join(f"WHEN {i} THEN {what}{i}" for i in every) + " END"
    spans = ", ".join(f"MIN(x{i}) AS low{i}, MAX(x{i}) AS high{i}" for i in every)
    values = ", ".join(f"x{i}" for i in every)
    hs = "".join(f", MIN(h{i}) AS h{i}" for i in every) if seen < width else ""
    held = "".join(f", h{i}" for i in every) if seen < width else ""

    def splits(source: str) -> str:
        return f"""SELECT grp, tree, node, depth, n, draws, pick,
          CASE WHEN cut >= {pick('high', 'pick')} THEN {pick('low', 'pick')} ELSE cut END AS cut FROM (
          SELECT *, {pick('low', 'pick')} + ({pick('high', 'pick')} - {pick('low', 'pick')})
            * (CAST({drawn_sql('node', "'split'")} AS DOUBLE) / {forest.DRAWS}) AS cut FROM (
          SELECT *, CASE WHEN n > 1 AND depth < ceil(log2(greatest(draws, 2))) AND len(open) > 0
            THEN open[CAST({drawn_sql('node', "'feature'")} % len(open) AS INT) + 1] END AS pick FROM (
          SELECT *, list_filter([{usable}], lambda f: f IS NOT NULL) AS open FROM (
          SELECT grp, tree, node, depth, draws, COUNT(*) AS n, {spans}{hs} FROM {source} GROUP BY grp, tree, node, depth, draws))))"""

    return f"""WITH RECURSIVE data AS MATERIALIZED ({rows}),
sizes AS MATERIALIZED (SELECT grp, COUNT(*) AS total, least(256, COUNT(*)) AS draws, least(COUNT(*), {trees} * least(256, COUNT(*))) AS pool
  FROM data WHERE grp IS NOT NULL GROUP BY grp HAVING COUNT(*) >= {min_rows}),
pooled AS MATERIALIZED (SELECT *, ROW_NUMBER() OVER (PARTITION BY grp ORDER BY md5(concat(id, '|42'))) - 1 AS pos FROM data),
drawn AS (SELECT *, {drawn_sql('draw') if bootstrap else start} % pool AS pos{cs}
  FROM (SELECT *, unnest(range(draws)) AS draw FROM (SELECT *, unnest(range({trees})) AS tree FROM sizes))),
levels AS (
  SELECT d.grp, tree, draws, CAST(1 AS BIGINT) AS node, 0 AS depth, {values}{ranks} FROM drawn AS d JOIN pooled AS p ON p.grp = d.grp AND p.pos = d.pos
  UNION ALL
  SELECT l.grp, l.tree, l.draws, 2 * l.node + CAST({pick('l.x', 's.pick')} > s.cut AS INT), l.depth + 1, {values}{held}
  FROM levels AS l JOIN ({splits('levels')}) AS s ON s.grp = l.grp AND s.tree = l.tree AND s.node = l.node WHERE s.pick IS NOT NULL),
nodes AS MATERIALIZED ({splits('levels')}),
walks AS (
  SELECT id, d.grp, t.tree, CAST(1 AS BIGINT) AS node, {values} FROM data AS d JOIN (SELECT grp, tree FROM nodes WHERE node = 1) AS t ON t.grp = d.grp
  UNION ALL
  SELECT w.id, w.grp, w.tree, 2 * w.node + CAST({pick('w.x', 'n.pick')} > n.cut AS INT), {values}
  FROM walks AS w JOIN nodes AS n ON n.grp = w.grp AND n.tree = w.tree AND n.node = w.node WHERE n.pick IS NOT NULL),
raw AS MATERIALIZED (SELECT data.id, data.grp, -pow(2, -mean / {credit_sql('draws')}) AS raw_score FROM data LEFT JOIN (
  SELECT w.id, w.grp, any_value(n.draws) AS draws, SUM(CAST(n.depth + {credit_sql('n.n')} AS DECIMAL(18, 12))) / {trees} AS mean
  FROM walks AS w JOIN nodes AS n ON n.grp = w.grp AND n.tree = w.tree AND n.node = w.node WHERE n.pick IS NULL GROUP BY w.id, w.grp) AS m
  ON m.id = data.id)
"""


def credit_sql(n: str) -> str:
    return f"(CASE WHEN {n} > 2 THEN 2 * (ln({n} - 1) + {forest.EULER}) - 2 * ({n} - 1) / CAST({n} AS DOUBLE) WHEN {n} = 2 THEN 1.0 ELSE 0.0 END)"


ONE_FOREST = forest_sql(FOREST_ROWS.replace("{grp}", "'all'"), len(INPUTS))
EMBEDDING_ROWS = "SELECT vec_id AS id, 'all' AS grp, " + ", ".join(
    f"COALESCE(CAST(embedding[{i + 1}] AS DOUBLE), 0) AS x{i}" for i in range(64)) + " FROM embeddings"


@query("isolation_forest", ONE_FOREST + """SELECT f.flow_id, f.label_binary, ROUND(raw_score, 6) AS raw_score
FROM raw JOIN {scored} AS f ON f.flow_id = raw.id""")
def isolation_forest(spark, sf_dir):
    f, columns = scaled(spark, sf_dir)
    return rounded(forest.fit_forest(f, columns).transform(f).select("flow_id", "label_binary", "raw_score"), ["raw_score"])


@query("isolation_forest_labels", ONE_FOREST + """SELECT CASE WHEN r < quantile_cont THEN -1 ELSE 1 END AS label, COUNT(*) AS n
FROM (SELECT ROUND(raw_score, 12) AS r FROM raw), (SELECT quantile_cont(ROUND(raw_score, 12), 0.1) AS quantile_cont FROM raw) GROUP BY 1""")
def isolation_forest_labels(spark, sf_dir):
    f, columns = scaled(spark, sf_dir)
    model = forest.fit_forest(f, columns).fit_offsets(f, 0.1)
    return model.predict_labels(f).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("isolation_forest_grouped", forest_sql(FOREST_ROWS.replace("{grp}", PROTOCOL_SQL), len(INPUTS), 300, True, 1000) + """
SELECT id AS flow_id, raw.grp AS protocol_group, ROUND(raw_score, 6) AS raw_score,
  ROUND(CASE WHEN raw_score IS NULL THEN NULL WHEN s > 1e-6 THEN 1 / (1 + exp(-(-raw_score - m) / s)) ELSE 0 END, 6) AS anomaly_score
FROM raw JOIN (SELECT grp, AVG(-raw_score) AS m, stddev_pop(-raw_score) AS s FROM raw GROUP BY grp) AS g ON g.grp = raw.grp""")
def isolation_forest_grouped(spark, sf_dir):
    f, columns = scaled(spark, sf_dir)
    f = forest.protocol_group(f)
    model, _ = forest.fit_grouped(f, columns, trees=300, bootstrap=True)
    scored = model.transform(f)
    out = forest.score_grouped(scored, forest.group_score_stats(scored)).select(
        "flow_id", "protocol_group", "raw_score", "anomaly_score")
    return rounded(out, ["raw_score", "anomaly_score"])


@query("isolation_forest_embeddings", forest_sql(EMBEDDING_ROWS, 64, share=forest.feature_share(64)) + """
SELECT vec_id, label, ROUND(raw_score, 6) AS raw_score FROM raw JOIN embeddings ON vec_id = id""")
def isolation_forest_embeddings(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    size = e.agg(F.max(F.size("embedding"))).first()[0]
    wide = e.select("vec_id", "label", *[F.col("embedding")[i].alias(f"d{i}") for i in range(size)])
    model = forest.fit_forest(wide, [f"d{i}" for i in range(size)], "vec_id")
    return rounded(model.transform(wide).select("vec_id", "label", "raw_score"), ["raw_score"])


# A raw score known to both engines: minus the bytes.
@query("grouped_scores", """
SELECT flow_id, g AS protocol_group, ROUND(1 / (1 + exp(-(TotBytes - m) / s)), 9) AS anomaly_score FROM (
  SELECT *, AVG(TotBytes) OVER (PARTITION BY g) AS m, stddev_pop(TotBytes) OVER (PARTITION BY g) AS s FROM (
    SELECT *, CASE WHEN lower(Proto) IN ('tcp', 'udp') THEN lower(Proto) ELSE 'other' END AS g FROM {flows} AS f) AS t) AS u""")
def grouped_scores(spark, sf_dir):
    f = forest.protocol_group(flows(spark, sf_dir)).withColumn("raw_score", -F.col("TotBytes").cast("double"))
    out = forest.score_grouped(f, forest.group_score_stats(f))
    return rounded(out.select("flow_id", "protocol_group", "anomaly_score"), ["anomaly_score"], 9)


SCALED = "({c} - MIN({c}) OVER w) / CAST(MAX({c}) OVER w - MIN({c}) OVER w AS DOUBLE)"


@query("ensemble_score", f"""SELECT flow_id, ROUND(0.5 * {SCALED.format(c='TotBytes')} + 0.3 * {SCALED.format(c='Dur')}
  + 0.2 * {SCALED.format(c='TotPkts')}, 9) AS ensemble_score FROM {{flows}} AS f WINDOW w AS (PARTITION BY lower(Proto))""")
def ensemble_score(spark, sf_dir):
    f = flows(spark, sf_dir).withColumn("p", F.lower("Proto"))
    out = forest.ensemble(f, {"TotBytes": 0.5, "Dur": 0.3, "TotPkts": 0.2}, "p")
    return rounded(out.select("flow_id", "ensemble_score"), ["ensemble_score"], 9)


LOF_SQL = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
d AS (SELECT a.vec_id AS i, b.vec_id AS j, list_distance(a.v, b.v) AS d FROM e AS a CROSS JOIN e AS b),
o AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY d) AS r FROM d WHERE i <> j),
kd AS (SELECT i, MAX(d) AS k FROM o WHERE r <= 10 GROUP BY i),
lrd AS (SELECT o.i, 1 / (AVG(greatest(o.d, kd.k)) + 1e-10) AS l FROM o JOIN kd ON o.j = kd.i WHERE o.r <= 10 GROUP BY o.i),
q AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY d) AS r FROM d)
SELECT q.i AS vec_id, ROUND(-AVG(lrd.l) / (1 / (AVG(greatest(q.d, kd.k)) + 1e-10)), 6) AS raw_score
FROM q JOIN kd ON q.j = kd.i JOIN lrd ON q.j = lrd.i WHERE q.r <= 10 GROUP BY q.i"""


@query("local_outlier_factor", LOF_SQL)
def local_outlier_factor(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    model = neighbors.fit_lof(e, "embedding", 10)
    return rounded(model.transform(e).select("vec_id", "raw_score"), ["raw_score"])


@query("one_class_embeddings")
def one_class_embeddings(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return oneclass.fit_oneclass(e, "embedding", 0.1).transform(e).select("vec_id", "label", "raw_score")


@query("one_class_flows")
def one_class_flows(spark, sf_dir):
    f, columns = scaled(spark, sf_dir)
    return oneclass.fit_oneclass(f, columns, 0.1).transform(f).select("flow_id", "label_binary", "raw_score")


@query("boosted_importances")
def boosted_importances(spark, sf_dir):
    f = rf.row_features(scored_flows(spark, sf_dir))
    return boosted.rank_features(f, [*INPUTS, "DstBytes", "flow_ratio"])


@query("boosted_predictions")
def boosted_predictions(spark, sf_dir):
    f = scored_flows(spark, sf_dir).drop("y_pred")
    return boosted.fit_boosted(f, INPUTS).transform(f).select(
        "flow_id", "label_binary", "y_pred", "probability")


@query("boosted_guarded_fit")
def boosted_guarded_fit(spark, sf_dir):
    return boosted.fit_with_guard(scored_flows(spark, sf_dir).drop("y_pred"), INPUTS)[1]


@query("benchmark_models")
def bench_models(spark, sf_dir):
    return benchmark_models(scored_flows(spark, sf_dir).drop("y_pred", "anomaly_score"), skewed=INPUTS, features=INPUTS)


# Detector results derived from the flows: each protocol plays one detector.
RESULTS = """(SELECT lower(Proto) AS model_name, AVG(CASE WHEN label_binary = y_pred THEN 1.0 ELSE 0.0 END) AS accuracy,
  CAST(COUNT(*) FILTER (label_binary = 1 AND y_pred = 0) AS DOUBLE) AS fn, SUM(Dur) / 1000 AS train_time FROM {scored} AS s GROUP BY 1)"""


@query("compare_models", " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{m}' AS metric, model_name AS best, ROUND({m}, 6) AS value FROM {RESULTS} AS r ORDER BY {m} {o}, model_name LIMIT 1) AS {m}_best"
    for m, o in (("accuracy", "DESC"), ("train_time", ""), ("fn", ""))))
def compare(spark, sf_dir):
    s = scored_flows(spark, sf_dir).groupBy(F.lower("Proto").alias("model_name")).agg(
        F.avg((F.col("label_binary") == F.col("y_pred")).cast("double")).alias("accuracy"),
        F.count_if((F.col("label_binary") == 1) & (F.col("y_pred") == 0)).alias("fn"),
        (F.sum("Dur") / 1000).alias("train_time"))
    return rounded(compare_models(s), ["value"])


@query("train_unsupervised")
def unsupervised(spark, sf_dir):
    run = train_unsupervised(flows(spark, sf_dir), UnsupervisedConfig(size="1 day"))
    return run.metrics


@query("train_supervised")
def supervised(spark, sf_dir):
    return train_supervised(flows(spark, sf_dir), size="1 day").metrics


@query("postprocess_summary", """
WITH s AS (SELECT * FROM {scored} AS s0), q AS (SELECT quantile_cont(anomaly_score, 0.85) AS g FROM s),
f AS (SELECT label_binary AS y, CASE WHEN anomaly_score >= g THEN 1 ELSE 0 END AS p FROM s CROSS JOIN q)
SELECT COUNT(*) AS total_samples, COUNT(*) FILTER (p = 1) AS original_anomalies, COUNT(*) FILTER (y = 0 AND p = 1) AS fp,
  ROUND(COUNT(*) FILTER (y = 1 AND p = 1) / CAST(COUNT(*) FILTER (p = 1) AS DOUBLE), 9) AS precision, 'score' AS method FROM f""")
def post_summary(spark, sf_dir):
    f = rf.row_features(scored_flows(spark, sf_dir)).drop("y_pred")
    run = postprocess(f, f, 0.15)
    return run.summary.select("total_samples", "original_anomalies", F.col("original.fp").alias("fp"),
                              F.round("original.precision", 9).alias("precision"), "method")


@query("postprocess_effect")
def post_effect(spark, sf_dir):
    f = rf.row_features(scored_flows(spark, sf_dir)).drop("y_pred")
    train, test = f.where(F.col("flow_id") % 5 != 0), f.where(F.col("flow_id") % 5 == 0)
    return postprocess(train, test, 0.15, use_gate=True).effect


@query("analyst_feedback", """SELECT flow_id, CASE WHEN label_binary = 1 AND TotPkts > 15 THEN 0 ELSE label_binary END AS label_binary
FROM {scored} AS s""")
def analyst_feedback(spark, sf_dir):
    s = scored_flows(spark, sf_dir)
    return feedback_labels(s, s.where((F.col("label_binary") == 1) & (F.col("TotPkts") > 15))).select("flow_id", "label_binary")


@query("feedback_rules")
def feedback_rules(spark, sf_dir):
    """What the rules mined after the verdicts change."""
    from flowlens.operators.rules import effect_stats

    s = rf.row_features(scored_flows(spark, sf_dir))
    _, applied = remine(s, s.where((F.col("label_binary") == 1) & (F.col("TotPkts") > 15)))
    return effect_stats(applied)


@query("outlier_factor_labels", f"""WITH s AS ({LOF_SQL.replace('ROUND(-AVG', '(-AVG').replace(', 6) AS raw_score', ') AS raw_score')}),
c AS (SELECT quantile_cont(raw_score, 0.1) AS o FROM s)
SELECT CASE WHEN raw_score < o THEN -1 ELSE 1 END AS label, COUNT(*) AS n FROM s, c GROUP BY 1""")
def outlier_factor_labels(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    model = neighbors.fit_lof(e, "embedding", 10).fit_offset(e, 0.1)
    return model.predict_labels(e).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("model_round_trip", "SELECT COUNT(*) AS rows, 0 AS changed FROM embeddings")
def model_round_trip(spark, sf_dir):
    """Labels of a stored one-class model after loading it back: none may change."""
    e, base = table(spark, sf_dir, "embeddings"), scratch_path(spark, "run")
    model = oneclass.fit_oneclass(e, "embedding", 0.1)
    stores.save_run(e.select("vec_id", F.lit("train").alias("split")), base, {}, model)
    loaded = stores.load_model(spark, base, oneclass.OneClassModel)
    both = loaded.predict_labels(model.predict_labels(e, out="before").drop("raw_score"), out="after")
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("before") != F.col("after")).cast("int").alias("changed"))


# Stored artefacts, each read back after writing.

@query("parquet_round_trip", "SELECT flow_id, StartTime, Dur, Proto, Dport, TotBytes FROM {flows} AS f")
def parquet_round_trip(spark, sf_dir):
    path = scratch_path(spark, "flows")
    src.write_flows(src.clean(flows(spark, sf_dir)), path)
    return src.read_flows(spark, path, "parquet").select("flow_id", "StartTime", "Dur", "Proto", "Dport", "TotBytes")


def as_capture(spark, sf_dir, path):
    f = flows(spark, sf_dir)
    text = f.select(F.date_format("StartTime", "yyyy/MM/dd HH:mm:ss.SSSSSS").alias("StartTime"), "Dur", "Proto", "SrcAddr",
                    "Sport", "DstAddr", "Dport", "State", "TotPkts", "TotBytes", "SrcBytes", "Label", "flow_id")
    text.write.option("header", True).csv(path)


CAPTURE = """SELECT CAST(flow_id AS BIGINT) AS flow_id, StartTime AS at, Dur, Proto, CAST(Dport AS DOUBLE) AS "Dport",
  CAST(TotBytes AS DOUBLE) AS "TotBytes", Label FROM {flows} AS f"""


def shown(df):
    return df.select(F.col("flow_id").cast("long").alias("flow_id"), F.col("StartTime").cast("timestamp_ntz").alias("at"), "Dur",
                     "Proto", F.col("Dport").cast("double").alias("Dport"), F.col("TotBytes").cast("double").alias("TotBytes"), "Label")


@query("read_capture_csv", CAPTURE)
def read_capture_csv(spark, sf_dir):
    path = scratch_path(spark, "capture")
    as_capture(spark, sf_dir, path)
    return shown(src.clean(src.read_flows(spark, path)))


@query("read_capture_inferred", CAPTURE)
def read_capture_inferred(spark, sf_dir):
    path = scratch_path(spark, "capture")
    as_capture(spark, sf_dir, path)
    return shown(src.clean(src.read_flows(spark, path, infer=True)))


@query("read_through_cache", CAPTURE)
def read_through_cache(spark, sf_dir):
    csv, parquet = scratch_path(spark, "capture"), scratch_path(spark, "cache")
    as_capture(spark, sf_dir, csv)
    src.read_through(spark, csv, parquet)
    return shown(src.read_through(spark, csv + "-gone", parquet))


@query("feature_store", """SELECT flow_id, COUNT(*) OVER (PARTITION BY SrcAddr, date_trunc('day', StartTime)) AS flows_per_minute_by_src FROM {flows} AS f""")
def feature_store(spark, sf_dir):
    base = scratch_path(spark, "store")
    stores.save_features(extract_features(flows(spark, sf_dir), 3, size="1 day"), base, 3)
    return stores.load_features(spark, base).select("flow_id", "flows_per_minute_by_src")


@query("incremental_features", """SELECT flow_id, COUNT(*) OVER (PARTITION BY least(SrcAddr, DstAddr), greatest(SrcAddr, DstAddr),
  date_trunc('day', StartTime)) AS bidirectional_flow_count FROM {flows} AS f""")
def incremental_features(spark, sf_dir):
    base = scratch_path(spark, "store")
    build_features(spark, base, flows(spark, sf_dir), 3, "1 day")
    return build_features(spark, base, stage=4, size="1 day").select("flow_id", "bidirectional_flow_count")


@query("stage4_smoke", """SELECT feature, TRUE AS present, least(5000, (SELECT COUNT(*) FROM events)) AS rows FROM (
  SELECT unnest(['bidirectional_flow_count', 'bidirectional_total_bytes', 'bidirectional_total_packets', 'bidirectional_total_src_bytes',
    'bidirectional_total_dst_bytes', 'bidirectional_symmetry', 'bidirectional_avg_bytes_per_flow', 'bidirectional_avg_packets_per_flow',
    'bidirectional_avg_duration', 'bidirectional_window_flow_ratio']) AS feature) AS t""")
def stage4_smoke(spark, sf_dir):
    return smoke_stage4(flows(spark, sf_dir), size="1 day")


@query("transformed_store", """SELECT flow_id, ROUND((TotBytes - quantile_cont(TotBytes, 0.5) OVER ()) / (quantile_cont(TotBytes, 0.75) OVER ()
  - quantile_cont(TotBytes, 0.25) OVER ()), 6) AS "TotBytes" FROM {flows} AS f""")
def transformed_store(spark, sf_dir):
    base = scratch_path(spark, "transformed")
    f = flows(spark, sf_dir)
    params = tr.robust_fit(f, ["TotBytes"])
    stores.save_transformed(tr.robust_apply(f, params), tr.params_table(spark, params), ["TotBytes"], base)
    _, table_, columns = stores.load_transformed(spark, base)
    again = tr.robust_apply(f, tr.params_from(table_))
    return rounded(again.select("flow_id", *columns), columns)


@query("rules_round_trip", f"""SELECT CAST(row_number() OVER (ORDER BY proto, port) AS BIGINT) AS rule_id, 'proto_port' AS type, proto, port,
  ROUND(fp_ratio, 9) AS fp_ratio FROM {SCORES} AS s WHERE fp_ratio > 0.05 AND normal_ratio > 0.01""")
def rules_round_trip(spark, sf_dir):
    chosen = ru.candidates(ru.combo_stats(scored_flows(spark, sf_dir)))
    order = Window.partitionBy(F.lit(0)).orderBy("proto", "port")  # at most 20 candidates above a 5 % share
    rules = ru.as_rules(chosen.withColumns({
        "rule_id": F.row_number().over(order), "type": F.lit("proto_port"), "fp_ratio": F.round("fp_ratio", 9)}))
    path = stores.save_rules(rules, scratch_path(spark, "rules"))
    return stores.load_rules(spark, path).select("rule_id", "type", "proto", "port", "fp_ratio")


@query("run_round_trip", """SELECT flow_id, CASE WHEN flow_id % 5 = 0 THEN 'test' ELSE 'train' END AS split, label_binary, anomaly_score FROM {scored} AS s""")
def run_round_trip(spark, sf_dir):
    base = scratch_path(spark, "run")
    s = scored_flows(spark, sf_dir).withColumn("split", F.when(F.col("flow_id") % 5 == 0, "test").otherwise("train"))
    stores.save_run(s, base, {"best_threshold": 0.5})
    scored, config = stores.load_run(spark, base)
    return scored.where(F.lit(config["best_threshold"] == 0.5)).select("flow_id", "split", "label_binary", "anomaly_score")


@query("results_round_trip", """SELECT 'lof' AS model_type, COUNT(*) AS rows FROM {scored} AS s WHERE y_pred = 1
UNION ALL SELECT 'one_class_svm', COUNT(*) FROM {scored} AS s WHERE y_pred = 0""")
def results_round_trip(spark, sf_dir):
    base, s = scratch_path(spark, "results"), scored_flows(spark, sf_dir)
    for alias, flagged in (("local_outlier_factor", 1), ("svm", 0)):
        stores.save_result(s.where(F.col("y_pred") == flagged).agg(F.count(F.lit(1)).alias("rows")), base, alias)
    return stores.load_results(spark, base)


@query("csv_report", "SELECT Label, COUNT(*) AS n FROM {flows} AS f GROUP BY Label")
def csv_report(spark, sf_dir):
    path = scratch_path(spark, "report")
    stores.write_csv(flows(spark, sf_dir).groupBy("Label").agg(F.count(F.lit(1)).alias("n")), path)
    return spark.read.schema("Label string, n long").option("header", True).csv(path)


@query("best_transform_store", best_sql(["TotBytes"]))
def best_transform_store(spark, sf_dir):
    base, f = scratch_path(spark, "best"), scored_flows(spark, sf_dir)
    best = materialize(tr.compare_transforms(f, ["TotBytes"]).where("is_best"), "best")  # read twice, computed once
    data, params = tr.apply_best(f, best)
    stores.save_best_transforms(best, data.select("flow_id", "TotBytes"), tr.params_table(spark, params), base)
    return rounded(spark.read.parquet(f"{base}/data"), ["TotBytes"])


@query("process_flows", """WITH t AS (SELECT flow_id, ln(1 + TotBytes) AS x, ln(1 + Dur) AS y FROM {flows} AS f)
SELECT flow_id, ROUND((x - quantile_cont(x, 0.5) OVER ()) / (quantile_cont(x, 0.75) OVER () - quantile_cont(x, 0.25) OVER ()), 6) AS "log_TotBytes"
FROM t""")
def process(spark, sf_dir):
    done = process_flows(flows(spark, sf_dir), scratch_path(spark, "process"), 3, "1 day")
    return rounded(done.transformed.select("flow_id", "log_TotBytes"), ["log_TotBytes"])


@query("process_incremental", """SELECT flow_id, COUNT(*) OVER (PARTITION BY least(SrcAddr, DstAddr), greatest(SrcAddr, DstAddr),
  date_trunc('day', StartTime)) AS bidirectional_flow_count FROM {flows} AS f""")
def process_incremental(spark, sf_dir):
    base, f = scratch_path(spark, "process"), flows(spark, sf_dir)
    stores.save_features(extract_features(f, 3, size="1 day"), base, 3)
    return process_flows(f, base, 4, "1 day", incremental=True).features.select("flow_id", "bidirectional_flow_count")


@query("feature_counts")
def counts(spark, sf_dir):
    return process_flows(flows(spark, sf_dir), None, 3, "1 day").counts
