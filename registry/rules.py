"""False-positive mining and allow-list rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens.operators import row_features as rf, rules as ru
from flowlens.sources.stores import RULE_SCHEMA
from registry.base import flows, query, scored_flows
from registry.features import rounded

RATIOS = ["fp_ratio", "normal_ratio", "attack_ratio"]
FEATURES = ["TotBytes", "TotPkts", "SrcBytes", "DstBytes", "Dur"]


def featured(spark, sf_dir):
    return rf.row_features(scored_flows(spark, sf_dir))


@query("outcome", """SELECT flow_id, CASE WHEN label_binary = 1 AND y_pred = 1 THEN 'tp' WHEN label_binary = 1 THEN 'fn'
  WHEN y_pred = 1 THEN 'fp' ELSE 'tn' END AS outcome FROM {scored} AS s""")
def outcome(spark, sf_dir):
    return ru.outcome(scored_flows(spark, sf_dir)).select("flow_id", "outcome")


@query("backfill", """SELECT flow_id, TotBytes, Proto, DstAddr, Dport, SrcAddr FROM {flows} AS f""")
def backfill(spark, sf_dir):
    f = flows(spark, sf_dir)
    holes = f.select("flow_id", "TotBytes", "DstAddr", F.when(F.col("flow_id") % 3 == 0, F.col("Proto")).alias("Proto"))
    return ru.backfill(holes, f)


PATTERN = """SELECT '{kind}' AS pattern, v AS value, n, ROUND(n / CAST((SELECT COUNT(*) FROM {scored} AS q WHERE label_binary = 0 AND y_pred = 1) AS DOUBLE), 9) AS share
FROM (SELECT {value} AS v, COUNT(*) AS n FROM {scored} AS s WHERE label_binary = 0 AND y_pred = 1 GROUP BY 1 ORDER BY n DESC, v LIMIT {k}) AS t"""


def pattern(kind, value, k):
    return "SELECT * FROM (" + PATTERN.replace("{kind}", kind).replace("{value}", value).replace("{k}", str(k)) + f") AS {kind}_t"


PORT_TEXT = "concat(CAST(Dport AS VARCHAR), '.0')"


@query("fp_patterns", " UNION ALL ".join([pattern("proto", "lower(Proto)", 5), pattern("port", PORT_TEXT, 10),
                                          pattern("proto_port", f"concat(lower(Proto), '/', {PORT_TEXT})", 10)]))
def fp_patterns(spark, sf_dir):
    return rounded(ru.fp_patterns(scored_flows(spark, sf_dir)), ["share"], 9)


STATS = """(SELECT proto, port, f AS fp_count, n AS normal_count, a AS attack_count, f / CAST(SUM(f) OVER () AS DOUBLE) AS fp_ratio,
  n / CAST(SUM(n) OVER () AS DOUBLE) AS normal_ratio, a / CAST(SUM(a) OVER () AS DOUBLE) AS attack_ratio
FROM (SELECT lower(Proto) AS proto, CAST(Dport AS DOUBLE) AS port, COUNT(*) FILTER (label_binary = 0 AND y_pred = 1) AS f,
  COUNT(*) FILTER (label_binary = 0) AS n, COUNT(*) FILTER (label_binary = 1) AS a FROM {scored} AS s GROUP BY 1, 2) AS g)"""
SCORES = f"""(SELECT *, (0.4 * least(fp_ratio * 10, 1) + 0.3 * least(normal_ratio * 20, 1) + 0.3 * greatest(0, 1 - attack_ratio * 10))
  * CASE WHEN fp_count < 50 THEN fp_count / 50.0 ELSE 1.0 END AS score FROM {STATS} AS st WHERE fp_count > 0)"""
SHOWN = "proto, port, fp_count, normal_count, attack_count, ROUND(fp_ratio, 9) AS fp_ratio, ROUND(normal_ratio, 9) AS normal_ratio, ROUND(attack_ratio, 9) AS attack_ratio"


@query("combo_stats", f"SELECT {SHOWN} FROM {STATS} AS st WHERE fp_count > 0")
def combo_stats(spark, sf_dir):
    return rounded(ru.combo_stats(scored_flows(spark, sf_dir)), RATIOS, 9)


@query("combo_score", f"SELECT {SHOWN}, ROUND(score, 9) AS score FROM {SCORES} AS sc")
def combo_score(spark, sf_dir):
    return rounded(ru.combo_score(ru.combo_stats(scored_flows(spark, sf_dir))), [*RATIOS, "score"], 9)


def candidate_query(name, method, where, **options):
    @query(name, f"SELECT proto, port, ROUND(score, 9) AS score FROM (SELECT * FROM {SCORES} AS sc {where}) AS c WHERE normal_ratio > 0.01")
    def run(spark, sf_dir):
        stats = ru.combo_stats(scored_flows(spark, sf_dir))
        return rounded(ru.candidates(stats, method, **options), ["score"], 9).select("proto", "port", "score")


candidate_query("candidates_threshold", "threshold", "WHERE fp_ratio > 0.05")
candidate_query("candidates_topn", "topn", "ORDER BY score DESC, proto, port LIMIT 5", top_n=5)
candidate_query("candidates_score", "score", "WHERE score > 0.5", score_threshold=0.5)


LONG = " UNION ALL ".join(f"SELECT lower(Proto) AS proto, CAST(Dport AS DOUBLE) AS port, '{c}' AS feature, {i + 1} AS place, label_binary AS y, y_pred AS p, "
                          f"CAST({'TotBytes - SrcBytes' if c == 'DstBytes' else c} AS DOUBLE) AS v FROM sc" for i, c in enumerate(FEATURES))


def bounds_sql(pick):
    return f"""
WITH sc AS (SELECT * FROM {{scored}} AS s), l AS ({LONG}),
m AS (SELECT proto, port, feature, v AS mode FROM (SELECT proto, port, feature, v, row_number() OVER (PARTITION BY proto, port, feature ORDER BY COUNT(*) DESC, v) AS r
  FROM l WHERE y = 0 GROUP BY proto, port, feature, v) AS mm WHERE r = 1),
q AS (SELECT proto, port, feature, place, COUNT(v) FILTER (y = 0) AS nn, COUNT(v) FILTER (y = 1) AS na, COUNT(v) FILTER (y = 1 AND p = 0) AS nf,
  quantile_cont(v, 0.75) FILTER (y = 0) AS n75, quantile_cont(v, 0.90) FILTER (y = 0) AS n90, quantile_cont(v, 0.95) FILTER (y = 0) AS n95,
  quantile_cont(v, 0.05) FILTER (y = 1) AS a5, quantile_cont(v, 0.10) FILTER (y = 1) AS a10, quantile_cont(v, 0.25) FILTER (y = 1) AS a25,
  quantile_cont(v, 0.5) FILTER (y = 1) AS a50, quantile_cont(v, 0.05) FILTER (y = 1 AND p = 0) AS f5, quantile_cont(v, 0.10) FILTER (y = 1 AND p = 0) AS f10
  FROM l GROUP BY 1, 2, 3, 4),
b AS (SELECT *, CASE WHEN a5 > 0 THEN least(n95, a5) ELSE n95 END AS b0 FROM q
  WHERE nn > 10 AND na > 10 AND (a50 > n75 * 1.2 OR a25 > n90 OR a10 > n95)),
t AS (SELECT *, CASE WHEN nf > 5 AND f5 < b0 THEN least(b0, f5 * 0.9) WHEN nf > 5 AND f10 < b0 THEN least(b0, f10 * 0.9) ELSE b0 END AS bound FROM b),
k AS (SELECT t.proto, t.port, t.feature, t.place, t.bound FROM t JOIN m ON t.proto = m.proto AND t.port = m.port AND t.feature = m.feature WHERE t.bound > m.mode),
bounds AS (SELECT proto, port, feature, CAST(row_number() OVER (PARTITION BY proto, port ORDER BY place) AS INT) AS place, bound FROM k)
{pick}"""


@query("behavioral_bounds", bounds_sql("SELECT proto, port, feature, place, ROUND(bound, 6) AS bound FROM bounds"))
def behavioral_bounds(spark, sf_dir):
    f = featured(spark, sf_dir)
    return rounded(ru.behavioral_bounds(f, ru.combo_stats(f), FEATURES), ["bound"])


@query("service_port_stats", """
WITH p AS (SELECT CAST(Dport AS DOUBLE) AS port, COUNT(*) FILTER (label_binary = 0 AND y_pred = 1) AS f, COUNT(*) FILTER (label_binary = 0) AS n,
    COUNT(*) FILTER (label_binary = 1) AS a FROM {scored} AS s GROUP BY 1),
m AS (SELECT port, proto FROM (SELECT CAST(Dport AS DOUBLE) AS port, lower(Proto) AS proto, row_number() OVER (PARTITION BY Dport ORDER BY COUNT(*) DESC, lower(Proto)) AS r
    FROM {scored} AS s WHERE label_binary = 0 AND y_pred = 1 GROUP BY Dport, lower(Proto)) AS x WHERE r = 1)
SELECT p.port, CASE p.port WHEN 53 THEN 'DNS' WHEN 123 THEN 'NTP' WHEN 80 THEN 'HTTP' WHEN 443 THEN 'HTTPS' ELSE 'SSH' END AS service,
  f AS fp_count, n AS normal_count, a AS attack_count, ROUND(f / CAST(SUM(f) OVER () AS DOUBLE), 9) AS fp_ratio,
  ROUND(n / CAST(SUM(n) OVER () AS DOUBLE), 9) AS normal_ratio, ROUND(a / CAST(SUM(a) OVER () AS DOUBLE), 9) AS attack_ratio, m.proto AS modal_proto
FROM p JOIN m ON p.port = m.port""")
def service_port_stats(spark, sf_dir):
    return rounded(ru.service_port_stats(scored_flows(spark, sf_dir)), RATIOS, 9)


@query("service_port_rules", bounds_sql("""
, x AS (SELECT CAST(Dport AS DOUBLE) AS port, COUNT(*) FILTER (label_binary = 0 AND y_pred = 1) AS f, COUNT(*) FILTER (label_binary = 0) AS n,
    COUNT(*) FILTER (label_binary = 1) AS a FROM sc GROUP BY 1),
s AS (SELECT port, f / CAST(SUM(f) OVER () AS DOUBLE) AS fr, n / CAST(SUM(n) OVER () AS DOUBLE) AS nr, a / CAST(SUM(a) OVER () AS DOUBLE) AS ar FROM x),
mo AS (SELECT port, proto FROM (SELECT CAST(Dport AS DOUBLE) AS port, lower(Proto) AS proto, row_number() OVER (PARTITION BY Dport ORDER BY COUNT(*) DESC, lower(Proto)) AS r
    FROM sc WHERE label_binary = 0 AND y_pred = 1 GROUP BY Dport, lower(Proto)) AS y WHERE r = 1),
c AS (SELECT s.*, (SELECT COUNT(*) FROM bounds WHERE bounds.port = s.port AND bounds.proto = mo.proto) AS conditions FROM s JOIN mo ON s.port = mo.port)
SELECT port, CASE WHEN ar >= 0.2 AND conditions > 0 THEN 'port_behavioral' ELSE 'port' END AS type,
  CAST(CASE WHEN ar >= 0.2 THEN conditions ELSE 0 END AS INT) AS conditions
FROM c WHERE fr > 0.05 AND nr > 0.01 AND (ar < 0.2 OR (ar < 0.4 AND (conditions > 0 OR ar < 0.3)))""".replace("\n, x AS", "\n, x AS")).replace("FROM k)\n\n,", "FROM k)\n,"))
def service_port_rules(spark, sf_dir):
    out = ru.service_port_rules(featured(spark, sf_dir), attack_threshold=0.2, features=FEATURES)
    return out.select("port", "type", F.greatest(F.coalesce(F.size("conditions"), F.lit(0)), F.lit(0)).alias("conditions"))


# Two rules of each shape, to be matched against the flows.
def sample_rules(spark):
    none = None
    rows = [
        (0, "TCP/80", "proto_port", "tcp", 80.0, none, none, none, none, none, 0.1, 0.1, 0.1),
        (1, "UDP/443", "proto_port_behavioral", "udp", 443.0, none, none, none, 20000.0,
         [("TotBytes", "max", 15000.0), ("TotPkts", "min", 3.0), ("nothing", "max", 1.0)], 0.1, 0.1, 0.1),
        (2, "SSH", "port", none, 22.0, none, none, none, none, none, 0.1, 0.1, 0.1),
        (3, "NTP", "port_behavioral", none, 123.0, none, none, none, none, [("Dur", "max", 2.0)], 0.1, 0.1, 0.1),
        (4, "host", "proto_ip", "icmp", none, none, none, "h3", none, none, 0.1, 0.1, 0.1),
        (5, "host port", "proto_port_ip", "tcp", 53.0, none, none, "h5", none, none, 0.1, 0.1, 0.1),
        (6, "range", "proto_port_range", "udp", none, 50.0, 90.0, none, none, none, 0.1, 0.1, 0.1),
        (7, "odd", "unheard_of", "udp", 53.0, none, none, none, none, none, 0.1, 0.1, 0.1),
    ]
    return spark.createDataFrame(rows, RULE_SCHEMA)


HITS = ["lower(Proto) = 'tcp' AND Dport = 80", "lower(Proto) = 'udp' AND Dport = 443 AND TotBytes < 15000 AND TotPkts > 3", "Dport = 22",
        "Dport = 123 AND Dur < 2", "lower(Proto) = 'icmp' AND DstAddr = 'h3'", "lower(Proto) = 'tcp' AND Dport = 53 AND DstAddr = 'h5'",
        "lower(Proto) = 'udp' AND Dport BETWEEN 50 AND 90"]


@query("rule_match", "SELECT flow_id, list_filter([" + ", ".join(
    f"CASE WHEN {h} THEN CAST({i} AS BIGINT) END" for i, h in enumerate(HITS)) + "], lambda x: x IS NOT NULL) AS rule_ids FROM {scored} AS s")
def rule_match(spark, sf_dir):
    return ru.rule_match(sample_rules(spark), scored_flows(spark, sf_dir)).select("flow_id", "rule_ids")


ANY = " OR ".join(f"({h})" for h in HITS)


@query("apply_rules", f"SELECT flow_id, CASE WHEN y_pred = 1 AND ({ANY}) THEN 0 ELSE y_pred END AS y_final, {ANY} AS allowed FROM {{scored}} AS s")
def apply_rules(spark, sf_dir):
    return ru.apply_rules(scored_flows(spark, sf_dir), sample_rules(spark)).select("flow_id", "y_final", "allowed")


GATED = " OR ".join(f"({h} AND (y_pred <> 1 OR anomaly_score < {'20000' if i == 1 else 'g'}))" for i, h in enumerate(HITS))


@query("score_gate", f"""SELECT flow_id, CASE WHEN y_pred = 1 AND ({GATED}) THEN 0 ELSE y_pred END AS y_final FROM {{scored}} AS s
  CROSS JOIN (SELECT quantile_cont(anomaly_score, 0.75) AS g FROM {{scored}} AS s2 WHERE y_pred = 1) AS q""")
def score_gate(spark, sf_dir):
    return ru.apply_rules(scored_flows(spark, sf_dir), sample_rules(spark), score="anomaly_score").select("flow_id", "y_final")


@query("effect_stats", f"""SELECT COUNT(*) FILTER (y_pred = 1) AS original_anomalies, COUNT(*) FILTER (y_pred = 1 AND NOT ({ANY})) AS filtered_anomalies,
  COUNT(*) FILTER (y_pred = 1 AND ({ANY})) AS reduced_anomalies, COUNT(*) FILTER ({ANY}) AS matched_rows,
  COUNT(*) FILTER (y_pred = 1 AND label_binary = 0 AND ({ANY})) AS rescued_fp, COUNT(*) FILTER (y_pred = 1 AND label_binary = 1 AND ({ANY})) AS wrongly_allowed
FROM {{scored}} AS s""")
def effect_stats(spark, sf_dir):
    return ru.effect_stats(ru.apply_rules(scored_flows(spark, sf_dir), sample_rules(spark)))


@query("fn_coverage", " UNION ALL ".join(f"""SELECT CAST({i} AS BIGINT) AS rule_id, COUNT(*) FILTER ({h}) AS matched_fn,
  ROUND(COUNT(*) FILTER ({h}) / CAST(COUNT(*) AS DOUBLE), 9) AS fn_share FROM {{scored}} AS s WHERE label_binary = 1 AND y_pred = 0"""
                                       for i, h in enumerate([*HITS, "FALSE"])))
def fn_coverage(spark, sf_dir):
    return rounded(ru.fn_coverage(scored_flows(spark, sf_dir), sample_rules(spark)), ["fn_share"], 9)


@query("validate_rules", "SELECT rule_id FROM (" + " UNION ALL ".join(f"""SELECT CAST({i} AS BIGINT) AS rule_id,
  COUNT(*) FILTER ({h}) / CAST(COUNT(*) AS DOUBLE) AS share FROM {{scored}} AS s WHERE label_binary = 1 AND y_pred = 0"""
                                                                     for i, h in enumerate([*HITS, "FALSE"])) + ") AS t WHERE share <= 0.1")
def validate_rules(spark, sf_dir):
    return ru.validate_rules(scored_flows(spark, sf_dir), sample_rules(spark)).select("rule_id")


KINDS = ["proto_port", "proto_port_behavioral", "port", "port_behavioral", "proto_ip", "proto_port_ip", "proto_port_range", "unheard_of"]


@query("rule_stats", " UNION ALL ".join(f"""SELECT '{k}' AS type, CAST(1 AS BIGINT) AS rules,
  CAST(floor(0.1 * COUNT(*) FILTER (label_binary = 0 AND y_pred = 1) + 1e-9) AS BIGINT) AS estimated_fp_reduction,
  COUNT(*) FILTER (label_binary = 0 AND y_pred = 1 AND {h}) AS exact_fp_reduction, ROUND(COUNT(*) FILTER ({h}) / CAST(COUNT(*) AS DOUBLE), 9) AS coverage
  FROM {{scored}} AS s""" for k, h in zip(KINDS, [*HITS, "FALSE"])))
def rule_stats(spark, sf_dir):
    return rounded(ru.rule_stats(sample_rules(spark), scored_flows(spark, sf_dir)), ["coverage"], 9)


@query("mine_rules", bounds_sql(f"""
, cand AS (SELECT * FROM {SCORES.replace('{scored}', 'sc')} AS scs WHERE score > 0.3 AND normal_ratio > 0.01),
cond AS (SELECT proto, port, COUNT(*) AS n FROM bounds GROUP BY 1, 2),
fn AS (SELECT *, COUNT(*) OVER () AS total FROM sc WHERE label_binary = 1 AND y_pred = 0),
test AS (SELECT c.proto, c.port, ANY_VALUE(c.fp_ratio) AS fp_ratio, ANY_VALUE(COALESCE(d.n, 0)) AS conditions,
  COUNT(CASE WHEN NOT EXISTS (SELECT 1 FROM bounds AS b WHERE b.proto = c.proto AND b.port = c.port AND b.bound <=
     CASE b.feature WHEN 'TotBytes' THEN fn.TotBytes WHEN 'TotPkts' THEN fn.TotPkts WHEN 'SrcBytes' THEN fn.SrcBytes
       WHEN 'Dur' THEN fn.Dur ELSE fn.TotBytes - fn.SrcBytes END) THEN fn.flow_id END) AS hit
  FROM cand AS c LEFT JOIN cond AS d ON c.proto = d.proto AND c.port = d.port
  LEFT JOIN fn ON lower(fn.Proto) = c.proto AND fn.Dport = c.port GROUP BY 1, 2)
SELECT proto, port, CASE WHEN conditions > 0 THEN 'proto_port_behavioral' ELSE 'proto_port' END AS type, CAST(conditions AS INT) AS conditions,
  ROUND(fp_ratio, 9) AS fp_ratio FROM test WHERE hit <= 0.1 * (SELECT COUNT(*) FROM fn)"""))
def mine_rules(spark, sf_dir):
    out = ru.mine_rules(featured(spark, sf_dir), method="score", fp_threshold=1.0, features=FEATURES)
    out = out.select("proto", "port", "type", F.greatest(F.coalesce(F.size("conditions"), F.lit(0)), F.lit(0)).alias("conditions"), "fp_ratio")
    return rounded(out, ["fp_ratio"], 9)


@query("mine_rules_service_ports")
def mine_rules_service_ports(spark, sf_dir):
    return ru.mine_rules(featured(spark, sf_dir), attack_threshold=0.3)
