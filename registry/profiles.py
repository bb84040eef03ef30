"""Profiles, transforms and feature selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens.operators import profile, row_features as rows, select, transform as tr
from flowlens.plans.features import extract_features
from registry.base import flows, gappy_flows, query, scored_flows, table
from registry.features import rounded

NUMBERS = ["Dur", "TotPkts", "TotBytes", "SrcBytes"]
GAPPY_MISSING = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, COUNT(*) FILTER (\"{c}\" IS NULL) AS missing, "
    f"ROUND(COUNT(*) FILTER (\"{c}\" IS NULL) * 100.0 / COUNT(*), 6) AS missing_percent FROM {{gappy}} AS f"
    for c in ["flow_id", "StartTime", "Dur", "Proto", "SrcAddr", "Sport", "DstAddr", "Dport", "State",
              "TotPkts", "TotBytes", "SrcBytes", "Label"])


def each(columns, body, source="{gappy}", cast=True):
    """UNION ALL of one SELECT per column; ``body`` uses x for the column as double."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {body} FROM (SELECT *, CAST(\"{c}\" AS DOUBLE) AS x FROM {source} AS s0) AS s1"
        for c in columns)


@query("missing_profile", GAPPY_MISSING)
def missing_profile(spark, sf_dir):
    return rounded(profile.missing_profile(gappy_flows(spark, sf_dir)), ["missing_percent"])


DESCRIBE = """COUNT(x) AS "count", ROUND(AVG(x), 6) AS mean, ROUND(stddev_samp(x), 6) AS std, MIN(x) AS "min",
  ROUND(quantile_cont(x, 0.25), 6) AS q25, ROUND(quantile_cont(x, 0.5), 6) AS q50,
  ROUND(quantile_cont(x, 0.75), 6) AS q75, MAX(x) AS "max" """
DESCRIBE_RATES = ["mean", "std", "q25", "q50", "q75"]


@query("describe_numeric", each(NUMBERS, DESCRIBE))
def describe_numeric(spark, sf_dir):
    return rounded(profile.describe_numeric(gappy_flows(spark, sf_dir), NUMBERS), DESCRIBE_RATES)


LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount"]


@query("describe_lineitem", each(LINE_NUMBERS, DESCRIBE, "lineitem"))
def describe_lineitem(spark, sf_dir):
    return rounded(profile.describe_numeric(table(spark, sf_dir, "lineitem"), LINE_NUMBERS), DESCRIBE_RATES)


@query("describe_lineitem_bracketed", each(LINE_NUMBERS, DESCRIBE, "lineitem"))
def describe_lineitem_bracketed(spark, sf_dir):
    """Same result with the narrow brackets that big groups get."""
    found = profile.describe_numeric(table(spark, sf_dir, "lineitem"), LINE_NUMBERS, whole_rows=1_000)
    return rounded(found, DESCRIBE_RATES)


@query("time_range", "SELECT COUNT(*) AS rows, MIN(StartTime) AS first, MAX(StartTime) AS last FROM {gappy} AS f")
def time_range(spark, sf_dir):
    return profile.time_range(gappy_flows(spark, sf_dir))


SKEW = "(AVG(x*x*x) - 3*AVG(x)*AVG(x*x) + 2*POWER(AVG(x),3)) / NULLIF(POWER(var_pop(x), 1.5), 0)"
TAIL = f"""ROUND({SKEW}, 4) AS skewness, ROUND(kurtosis_pop(x) + 3, 4) AS kurtosis, ROUND(AVG(x), 6) AS mean,
  ROUND(quantile_cont(x, 0.5), 6) AS median, ROUND(stddev_samp(x), 6) AS std, ROUND(quantile_cont(x, 0.25), 6) AS q25,
  ROUND(quantile_cont(x, 0.75), 6) AS q75, ROUND(quantile_cont(x, 0.95), 6) AS q95, ROUND(quantile_cont(x, 0.99), 6) AS q99,
  ABS({SKEW}) > 1 OR kurtosis_pop(x) + 3 > 5 AS is_long_tail"""


@query("long_tail", each(NUMBERS, TAIL))
def long_tail(spark, sf_dir):
    out = profile.long_tail(gappy_flows(spark, sf_dir), NUMBERS)
    return rounded(rounded(out, ["mean", "median", "std", "q25", "q75", "q95", "q99"]), ["skewness", "kurtosis"], 4)


@query("long_tail_ranking", f"SELECT * FROM ({each(NUMBERS, f'ROUND({SKEW}, 4) AS skewness, ROUND(kurtosis_pop(x) + 3, 4) AS kurtosis')}) AS t "
       "WHERE ABS(skewness) > 1 OR kurtosis > 5 ORDER BY ABS(skewness) DESC, feature LIMIT 10")
def long_tail_ranking(spark, sf_dir):
    return rounded(profile.long_tail_ranking(gappy_flows(spark, sf_dir), NUMBERS), ["skewness", "kurtosis"], 4)


@query("protocol_profile", " UNION ALL ".join(
    f"SELECT protocol, '{c}' AS feature, {DESCRIBE.replace('x)', f'CAST({c} AS DOUBLE))').replace('(x,', f'(CAST({c} AS DOUBLE),')}, "
    "COUNT(*) AS rows, ROUND(COUNT(*) / CAST((SELECT COUNT(*) FROM events) AS DOUBLE), 6) AS share "
    "FROM (SELECT *, lower(Proto) AS protocol FROM {gappy} AS g) AS f WHERE protocol IN ('udp', 'tcp') GROUP BY protocol"
    for c in NUMBERS))
def protocol_profile(spark, sf_dir):
    out = profile.protocol_profile(gappy_flows(spark, sf_dir), columns=NUMBERS)
    return rounded(out, [*DESCRIBE_RATES, "share"])


@query("protocol_mean_ratio", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, ROUND(u, 6) AS udp_mean, ROUND(t, 6) AS tcp_mean, ROUND(u / t, 6) AS udp_tcp_ratio FROM "
    f"(SELECT AVG({c}) FILTER (lower(Proto) = 'udp') AS u, AVG({c}) FILTER (lower(Proto) = 'tcp') AS t FROM {{gappy}} AS f) AS m"
    for c in NUMBERS))
def protocol_mean_ratio(spark, sf_dir):
    return rounded(profile.protocol_mean_ratio(gappy_flows(spark, sf_dir)), ["udp_mean", "tcp_mean", "udp_tcp_ratio"])


@query("protocol_counts", """SELECT COUNT(*) AS total, COUNT(*) FILTER (lower(Proto) = 'udp') AS udp,
  COUNT(*) FILTER (lower(Proto) = 'tcp') AS tcp, COUNT(*) FILTER (lower(Proto) NOT IN ('udp', 'tcp')) AS other FROM {flows} AS f""")
def protocol_counts(spark, sf_dir):
    return profile.protocol_counts(flows(spark, sf_dir))


@query("flat_features_by_protocol", """
SELECT protocol, 'flat' AS feature, MIN(v) = MAX(v) AS is_constant, COALESCE(var_samp(v) < 1e-6, FALSE) AS is_low_variance
FROM (SELECT lower(Proto) AS protocol, CAST(CASE WHEN lower(Proto) = 'tcp' THEN 1 ELSE 1 + TotBytes * 1e-9 END AS DOUBLE) AS v
      FROM {flows} AS f) AS t GROUP BY protocol HAVING MIN(v) = MAX(v) OR COALESCE(var_samp(v) < 1e-6, FALSE)""")
def flat_features_by_protocol(spark, sf_dir):
    f = flows(spark, sf_dir)
    flat = F.when(F.lower("Proto") == "tcp", 1.0).otherwise(1 + F.col("TotBytes") * 1e-9)
    return profile.flat_features_by_protocol(f.withColumn("flat", flat), columns=["flat", "TotBytes", "TotPkts"])


def histogram_sql(value):
    return f"""WITH v AS (SELECT {value} AS x FROM {{gappy}} AS f WHERE TotBytes IS NOT NULL),
e AS (SELECT MIN(x) AS lo, MAX(x) AS hi FROM v)
SELECT bin, COUNT(*) AS n, ROUND(MIN(lo) + (bin - 1) * ((MIN(hi) - MIN(lo)) / 50), 6) AS low_edge
FROM (SELECT CAST(least(floor((x - lo) / ((hi - lo) / 50)) + 1, 50) AS INT) AS bin, lo, hi FROM v CROSS JOIN e) AS t GROUP BY bin"""


@query("histogram", histogram_sql("CAST(TotBytes AS DOUBLE)"))
def histogram(spark, sf_dir):
    return rounded(profile.histogram(gappy_flows(spark, sf_dir), "TotBytes"), ["low_edge"])


@query("histogram_log", histogram_sql("ln(CAST(TotBytes AS DOUBLE) + 1)"))
def histogram_log(spark, sf_dir):
    return rounded(profile.histogram(gappy_flows(spark, sf_dir), "TotBytes", log=True), ["low_edge"])


@query("box_summary", """
WITH v AS (SELECT lower(Proto) AS grp, CAST(TotBytes AS DOUBLE) AS x FROM {gappy} AS f WHERE TotBytes IS NOT NULL),
q AS (SELECT grp, quantile_cont(x, 0.25) AS q25, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q75 FROM v GROUP BY grp)
SELECT v.grp, q25, median, q75, COUNT(*) AS n,
  MIN(CASE WHEN x BETWEEN q25 - 1.5*(q75-q25) AND q75 + 1.5*(q75-q25) THEN x END) AS whisker_low,
  MAX(CASE WHEN x BETWEEN q25 - 1.5*(q75-q25) AND q75 + 1.5*(q75-q25) THEN x END) AS whisker_high,
  COUNT(*) FILTER (x NOT BETWEEN q25 - 1.5*(q75-q25) AND q75 + 1.5*(q75-q25)) AS outliers
FROM v JOIN q ON v.grp = q.grp GROUP BY v.grp, q25, median, q75""")
def box_summary(spark, sf_dir):
    f = gappy_flows(spark, sf_dir).withColumn("p", F.lower("Proto"))
    return profile.box_summary(f, "TotBytes", "p")


@query("feature_breakdown", """
SELECT family, known, present, skewed, present * (SELECT COUNT(*) FROM events) AS filled_cells FROM (VALUES
  ('base', 4, 4, 4), ('row', 9, 9, 5), ('calendar', 12, 12, 0), ('interval', 2, 2, 2),
  ('src_window', 4, 4, 2), ('pair_window', 10, 0, 0), ('other', 1, 1, 0)) AS t(family, known, present, skewed)""")
def feature_breakdown(spark, sf_dir):
    f = extract_features(flows(spark, sf_dir).withColumn("extra", F.lit(1.5)), 3, size="1 day")
    return rows.breakdown_counts(f).withColumns({c: F.col(c).cast("int") for c in ("known", "present", "skewed")})


@query("prepare_feature_set", """SELECT flow_id, Dur, TotBytes, TotPkts, SrcBytes, TotBytes - SrcBytes AS "DstBytes" FROM {flows} AS f""")
def prepare_feature_set(spark, sf_dir):
    f = flows(spark, sf_dir).withColumn("DstBytes", F.col("TotBytes") - F.col("SrcBytes"))
    return rows.prepare_feature_set(f)


@query("numeric_features", "SELECT flow_id, Dur, TotPkts, TotBytes, SrcBytes FROM {flows} AS f")
def numeric_features(spark, sf_dir):
    return rows.numeric_features(flows(spark, sf_dir))


# One column with negative values, one with missing cells.
MOVED = """(SELECT flow_id, TotBytes, CAST(TotBytes - 5000 AS DOUBLE) AS moved, Label FROM {gappy} AS f)"""


def moved(spark, sf_dir):
    return gappy_flows(spark, sf_dir).select("flow_id", "TotBytes", (F.col("TotBytes") - 5000.0).alias("moved"), "Label")


@query("log_transform", f"""SELECT flow_id, ROUND(ln(1 + TotBytes), 6) AS "log_TotBytes",
  ROUND(ln(1 + moved - (SELECT least(MIN(moved), 0) FROM {MOVED} AS m)), 6) AS log_moved FROM {MOVED} AS f""")
def log_transform(spark, sf_dir):
    out = tr.log_transform(moved(spark, sf_dir), ["TotBytes", "moved", "absent"])
    return rounded(out, ["log_TotBytes", "log_moved"]).select("flow_id", "log_TotBytes", "log_moved")


@query("sqrt_transform", f"""SELECT flow_id, ROUND(sqrt(TotBytes), 6) AS "sqrt_TotBytes",
  ROUND(sqrt(moved - (SELECT least(MIN(moved), 0) FROM {MOVED} AS m)), 6) AS sqrt_moved FROM {MOVED} AS f""")
def sqrt_transform(spark, sf_dir):
    out = tr.sqrt_transform(moved(spark, sf_dir), ["TotBytes", "moved"])
    return rounded(out, ["sqrt_TotBytes", "sqrt_moved"]).select("flow_id", "sqrt_TotBytes", "sqrt_moved")


@query("boxcox_apply", """SELECT flow_id, ROUND((POWER(TotPkts, 0.3) - 1) / 0.3, 6) AS "boxcox_TotPkts",
  ROUND(ln(TotPkts + 1), 6) AS log_case FROM {flows} AS f""")
def boxcox_apply(spark, sf_dir):
    out = tr.boxcox_apply(flows(spark, sf_dir), "TotPkts", 0.3)
    out = tr.boxcox_apply(out, "TotPkts", 0.0, 1.0, "log_case")
    return rounded(out, ["boxcox_TotPkts", "log_case"]).select("flow_id", "boxcox_TotPkts", "log_case")


def boxcox_sql(x: str, lam: str) -> str:
    return f"CASE WHEN abs({lam}) < {tr.NEAR_ZERO} THEN ln({x}) ELSE (pow({x}, {lam}) - 1) / {lam} END"


def yeojohnson_sql(x: str, lam: str) -> str:
    return f"CASE WHEN {x} >= 0 THEN {boxcox_sql(f'({x} + 1)', lam)} ELSE -({boxcox_sql(f'(1 - {x})', f'(2 - {lam})')}) END"


def shift_sql(col: str, source: str) -> str:
    return f"(SELECT CASE WHEN MIN({col}) <= 0 THEN 1 - MIN({col}) ELSE 0 END FROM {source} AS m)"


def lambda_sql(col: str, source: str, yeoj: bool = False) -> str:
    """The best lambda as a scalar subquery: three nested grids, each around the top of the one before."""
    lg, curve = ("sign(v) * ln(1 + abs(v))", yeojohnson_sql("v", "lam")) if yeoj else ("ln(v)", boxcox_sql("v", "lam"))
    values = f"SELECT CAST({col} AS DOUBLE) + {'0' if yeoj else shift_sql(col, source)} AS v FROM {source} AS s0 WHERE {col} IS NOT NULL"
    top, steps = "0.0", tr.LAMBDA_POINTS - 1
    for span in tr.LAMBDA_SPANS:
        top = f"""(SELECT CASE WHEN a IS NULL OR b IS NULL OR a - 2 * y + b >= 0 THEN lam
          ELSE lam + {2 * span / steps!r} * greatest(-1, least(1, 0.5 * (a - b) / (a - 2 * y + b))) END
          FROM (SELECT lam, y, lag(y) OVER (ORDER BY lam) AS a, lead(y) OVER (ORDER BY lam) AS b FROM (
            SELECT lam, (lam - 1) * SUM(lg) - COUNT(*) / 2.0 * ln(var_pop(c)) AS y FROM (
              SELECT lam, {lg} AS lg, {curve} AS c FROM ({values}) AS v,
                (SELECT {top} + CAST({span!r} AS DOUBLE) * (2 * j / CAST({steps} AS DOUBLE) - 1) AS lam FROM range({steps + 1}) AS r(j)) AS g)
            GROUP BY lam HAVING var_pop(c) > 0)) ORDER BY y DESC LIMIT 1)"""
    return f"round({top}, 6)"


@query("boxcox_transform", "SELECT flow_id, " + ", ".join(
    f"ROUND({boxcox_sql(f'greatest({c} + sh_{c}, {tr.NEAR_ZERO})', f'lam_{c}')}, 6) AS \"boxcox_{c}\"" for c in ("TotBytes", "TotPkts", "SrcBytes"))
    + " FROM {flows} AS f, (SELECT " + ", ".join(
        f"{lambda_sql(c, '{flows}')} AS lam_{c}, {shift_sql(c, '{flows}')} AS sh_{c}" for c in ("TotBytes", "TotPkts", "SrcBytes")) + ") AS p")
def boxcox_transform(spark, sf_dir):
    out, _ = tr.boxcox_transform(flows(spark, sf_dir), ["TotBytes", "TotPkts", "SrcBytes"])
    names = ["boxcox_TotBytes", "boxcox_TotPkts", "boxcox_SrcBytes"]
    return rounded(out.select("flow_id", *names), names)


@query("yeojohnson_transform", f"""SELECT flow_id, ROUND({yeojohnson_sql('CAST(TotBytes AS DOUBLE)', 'lam_b')}, 6) AS "yeoj_TotBytes",
  ROUND({yeojohnson_sql('CAST(moved AS DOUBLE)', 'lam_m')}, 6) AS yeoj_moved
FROM {MOVED} AS f, (SELECT {lambda_sql('TotBytes', MOVED, True)} AS lam_b, {lambda_sql('moved', MOVED, True)} AS lam_m) AS p""")
def yeojohnson_transform(spark, sf_dir):
    out, _ = tr.yeojohnson_transform(moved(spark, sf_dir), ["TotBytes", "moved"])
    return rounded(out.select("flow_id", "yeoj_TotBytes", "yeoj_moved"), ["yeoj_TotBytes", "yeoj_moved"])


ROBUST = """ROUND((x - quantile_cont(x, 0.5) OVER ()) / COALESCE(NULLIF(quantile_cont(x, 0.75) OVER ()
  - quantile_cont(x, 0.25) OVER (), 0), 1), 6)"""


@query("robust_scale", f"""SELECT flow_id, {ROBUST.replace('x', 'TotBytes')} AS "TotBytes", {ROBUST.replace('x', 'moved')} AS moved
  FROM {MOVED} AS f""")
def robust_scale(spark, sf_dir):
    f = moved(spark, sf_dir)
    out = tr.robust_apply(f, tr.robust_fit(f, ["TotBytes", "moved"]))
    return rounded(out, ["TotBytes", "moved"]).select("flow_id", "TotBytes", "moved")


@query("robust_scale_new_rows", """SELECT flow_id, ROUND((TotBytes - m) / (q3 - q1), 6) AS "TotBytes" FROM {flows} AS f
  CROSS JOIN (SELECT quantile_cont(TotBytes, 0.5) AS m, quantile_cont(TotBytes, 0.25) AS q1, quantile_cont(TotBytes, 0.75) AS q3
              FROM {flows} AS g WHERE Label NOT LIKE '%Botnet%') AS p WHERE Label LIKE '%Botnet%'""")
def robust_scale_new_rows(spark, sf_dir):
    f = scored_flows(spark, sf_dir)
    fitted = tr.robust_fit(f.where("label_binary = 0"), ["TotBytes"])
    return rounded(tr.robust_apply(f.where("label_binary = 1"), fitted), ["TotBytes"]).select("flow_id", "TotBytes")


@query("standard_scale", """SELECT flow_id, ROUND((TotBytes - AVG(TotBytes) OVER ()) / stddev_pop(TotBytes) OVER (), 6) AS "TotBytes",
  ROUND((Dur - AVG(Dur) OVER ()) / stddev_pop(Dur) OVER (), 6) AS "Dur" FROM {flows} AS f""")
def standard_scale(spark, sf_dir):
    f = flows(spark, sf_dir)
    out = tr.standard_apply(f, tr.standard_fit(f, ["TotBytes", "Dur"]))
    return rounded(out, ["TotBytes", "Dur"]).select("flow_id", "TotBytes", "Dur")


@query("transform_for_unsupervised", f"""
WITH t AS (SELECT flow_id, ln(1 + TotBytes) AS lb, ln(1 + Dur) AS ld, CAST(TotPkts AS DOUBLE) AS tp FROM {{flows}} AS f)
SELECT flow_id, {ROBUST.replace('x', 'lb')} AS "log_TotBytes", {ROBUST.replace('x', 'ld')} AS "log_Dur",
  {ROBUST.replace('x', 'tp')} AS "TotPkts" FROM t""")
def transform_for_unsupervised(spark, sf_dir):
    out, _, columns = tr.transform_for_unsupervised(
        flows(spark, sf_dir), ["TotBytes", "Dur"], ["TotBytes", "Dur", "TotPkts"])
    return rounded(out, columns).select("flow_id", *columns)


COHEN = """ABS(AVG(x) FILTER (label_binary = 0) - AVG(x) FILTER (label_binary = 1)) / SQRT((
  POWER(stddev_samp(x) FILTER (label_binary = 0), 2) + POWER(stddev_samp(x) FILTER (label_binary = 1), 2)) / 2)"""


@query("transform_metrics", each(NUMBERS, f"""COUNT(x) AS n, ROUND(AVG(x), 6) AS mean, ROUND(stddev_samp(x), 6) AS std,
  ROUND({SKEW}, 4) AS skewness, ROUND(kurtosis_pop(x) + 3, 4) AS kurtosis, ROUND({COHEN}, 6) AS cohens_d,
  ABS({SKEW}) < 0.5 AND ABS(kurtosis_pop(x)) < 1 AS is_normal_like""", "{scored}"))
def transform_metrics(spark, sf_dir):
    out = tr.transform_metrics(scored_flows(spark, sf_dir), NUMBERS, "label_binary")
    return rounded(rounded(out, ["mean", "std", "cohens_d"]), ["skewness", "kurtosis"], 4)


@query("cohens_d", each(NUMBERS, f"ROUND({COHEN}, 6) AS cohens_d", "{scored}"))
def cohens_d(spark, sf_dir):
    return rounded(tr.cohens_d(scored_flows(spark, sf_dir), NUMBERS), ["cohens_d"])


def overlap_sql(values: str) -> str:
    """(overlap) of the class densities of ``values`` (x, label_binary): bins and grid as the operator has them."""
    return f"""(SELECT COALESCE(SUM(part) / NULLIF(SUM(whole), 0), 1) FROM (
      SELECT (least(y0, y1) + least(lag(y0) OVER o, lag(y1) OVER o)) / 2 AS part, (y0 + y1 + lag(y0) OVER o + lag(y1) OVER o) / 2 AS whole FROM (
      SELECT j, SUM(d) FILTER (label_binary = 0) AS y0, SUM(d) FILTER (label_binary = 1) AS y1 FROM (
        SELECT j, label_binary, SUM(c * exp(-0.5 * pow((lo + (hi - lo) * j / {tr.GRID - 1} - b) / w, 2))) / (any_value(n) * any_value(w)) AS d
        FROM (SELECT label_binary, COUNT(*) AS c, AVG(x) AS b, any_value(lo) AS lo, any_value(hi) AS hi, any_value(n) AS n, any_value(w) AS w FROM (
          SELECT *, least(floor(CAST({tr.BINS} AS DOUBLE) * (x - lo) / (hi - lo)) + 1, {tr.BINS}) AS bin FROM (
          SELECT x, label_binary, MIN(x) OVER () AS lo, MAX(x) OVER () AS hi, COUNT(*) OVER k AS n, stddev_samp(x) OVER k * pow(COUNT(*) OVER k, -0.2) AS w
          FROM {values} AS v WHERE x IS NOT NULL WINDOW k AS (PARTITION BY label_binary))) GROUP BY label_binary, bin),
        (SELECT CAST(range AS DOUBLE) AS j FROM range({tr.GRID})) GROUP BY j, label_binary) GROUP BY j) WINDOW o AS (ORDER BY j)))"""


@query("density_overlap", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, ROUND({overlap_sql(f'(SELECT CAST({c} AS DOUBLE) AS x, label_binary FROM {{scored}} AS s)')}, 6) AS density_overlap"
    for c in NUMBERS))
def density_overlap(spark, sf_dir):
    return rounded(tr.density_overlap(scored_flows(spark, sf_dir), NUMBERS), ["density_overlap"])


# The score formula over metrics, with a given overlap so that SQL can follow.
@query("transform_score", each(NUMBERS, f"""ROUND(least({COHEN} / 2 * 50, 50), 4) AS separation_score,
  CASE WHEN ABS({SKEW}) < 0.5 AND ABS(kurtosis_pop(x)) < 1 THEN 30.0 ELSE 0.0 END + CASE WHEN ABS({SKEW}) < 1 THEN 10.0 ELSE 0.0 END
    AS distribution_score,
  ROUND(least({COHEN} / 2 * 50, 50) + CASE WHEN ABS({SKEW}) < 0.5 AND ABS(kurtosis_pop(x)) < 1 THEN 30 ELSE 0 END
    + CASE WHEN ABS({SKEW}) < 1 THEN 10 ELSE 0 END + 15.0, 4) AS total_score""", "{scored}"))
def transform_score(spark, sf_dir):
    m = tr.transform_metrics(scored_flows(spark, sf_dir), NUMBERS, "label_binary")
    out = tr.score_transform(m.withColumn("density_overlap", F.lit(0.25)))
    return rounded(out, ["separation_score", "total_score"], 4).select(
        "feature", "separation_score", "distribution_score", "total_score")


def comparison_sql(features) -> str:
    """Common tables: ``tried`` (flow_id, label_binary, feature, transform, lam, x) and ``compared``, one row for each transform."""
    source, selects = "flow", []
    for c in features:
        low, x = f"(SELECT least(MIN({c}), 0) FROM flow)", f"CAST({c} AS DOUBLE)"
        for name, lam, value in (
                ("original", "CAST(NULL AS DOUBLE)", x), ("log1p", "CAST(NULL AS DOUBLE)", f"ln(1 + {x} - {low})"),
                ("sqrt", "CAST(NULL AS DOUBLE)", f"sqrt({x} - {low})"),
                ("boxcox", lambda_sql(c, source), boxcox_sql(f"greatest({x} + {shift_sql(c, source)}, {tr.NEAR_ZERO})", "lam")),
                ("yeo-johnson", lambda_sql(c, source, True), yeojohnson_sql(x, "lam"))):
            selects.append(f"SELECT flow_id, label_binary, '{c}' AS feature, '{name}' AS transform, lam, {value} AS x "
                           f"FROM flow, (SELECT {lam} AS lam) AS p")
    rows = [f"""SELECT '{c}' AS feature, '{t}' AS transform, any_value(lam) AS lam, {COHEN} AS cohens_d, {SKEW} AS skewness,
      kurtosis_pop(x) + 3 AS kurtosis, {overlap_sql(f"(SELECT x, label_binary FROM tried WHERE feature = '{c}' AND transform = '{t}')")} AS density_overlap
      FROM tried WHERE feature = '{c}' AND transform = '{t}'""" for c in features for t in tr.TRANSFORMS]
    order = ", ".join(f"'{t}'" for t in tr.TRANSFORMS)
    return f"""WITH flow AS MATERIALIZED (SELECT * FROM {{scored}} AS s), tried AS MATERIALIZED ({' UNION ALL '.join(selects)}),
metrics AS ({' UNION ALL '.join(rows)}),
scores AS (SELECT *, ABS(skewness) < 0.5 AND ABS(kurtosis - 3) < 1 AS is_normal_like, least(cohens_d / 2 * 50, 50) AS separation_score,
  CASE WHEN ABS(skewness) < 0.5 AND ABS(kurtosis - 3) < 1 THEN 30.0 ELSE 0.0 END + CASE WHEN ABS(skewness) < 1 THEN 10.0 ELSE 0.0 END AS distribution_score,
  (1 - density_overlap) * 20 AS overlap_score FROM metrics),
compared AS MATERIALIZED (SELECT *, separation_score + distribution_score + overlap_score AS total_score, ROW_NUMBER() OVER (PARTITION BY feature
  ORDER BY ROUND(separation_score + distribution_score + overlap_score, 9) DESC, list_position([{order}], transform)) = 1 AS is_best FROM scores)
"""


def best_sql(features) -> str:
    """Every feature under its best transform, then robust scaled."""
    pivot = ", ".join(f"MAX(x) FILTER (feature = '{c}') AS {c}" for c in features)
    return comparison_sql(features) + f"SELECT flow_id, " + ", ".join(f'{ROBUST.replace("x", c)} AS "{c}"' for c in features) + (
        f" FROM (SELECT flow_id, {pivot} FROM tried JOIN compared USING (feature, transform) WHERE is_best GROUP BY flow_id) AS b")


@query("compare_transforms", comparison_sql(NUMBERS) + """SELECT feature, transform, lam AS "lambda", ROUND(cohens_d, 6) AS cohens_d,
  ROUND(skewness, 4) AS skewness, ROUND(kurtosis, 4) AS kurtosis, is_normal_like, ROUND(density_overlap, 6) AS density_overlap,
  ROUND(separation_score, 4) AS separation_score, distribution_score, ROUND(overlap_score, 4) AS overlap_score,
  ROUND(total_score, 4) AS total_score, is_best FROM compared""")
def compare_transforms(spark, sf_dir):
    out = tr.compare_transforms(scored_flows(spark, sf_dir), NUMBERS)
    return rounded(rounded(out, ["cohens_d", "density_overlap"]), ["skewness", "kurtosis", "separation_score", "overlap_score", "total_score"], 4)


@query("apply_best_transforms", best_sql(["TotBytes", "Dur"]))
def apply_best_transforms(spark, sf_dir):
    f = scored_flows(spark, sf_dir)
    out, _ = tr.apply_best(f, tr.compare_transforms(f, ["TotBytes", "Dur"]))
    return rounded(out.select("flow_id", "TotBytes", "Dur"), ["TotBytes", "Dur"])


# Columns with every defect the quality report looks for.
DEFECTS = """(SELECT flow_id, CAST(1 AS DOUBLE) AS fixed, 1 + flow_id * 1e-9 AS steady,
  CASE WHEN flow_id % 5 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE CAST(TotBytes AS DOUBLE) END AS endless,
  CASE WHEN flow_id % 3 = 0 THEN CAST(TotBytes AS DOUBLE) END AS sparse, CAST(TotBytes AS DOUBLE) AS fine FROM {flows} AS f)"""
DEFECT_NAMES = ["fixed", "steady", "endless", "sparse", "fine"]


@query("quality_report", " UNION ALL ".join(f"""
SELECT '{c}' AS feature, c AS constant, v AS low_variance, i AS inf, m AS high_missing, c OR v OR i OR m AS dropped
FROM (SELECT COUNT(DISTINCT {c}) <= 1 AS c, {'FALSE' if c == 'endless' else f'COALESCE(var_samp({c}) < 1e-6, FALSE)'} AS v,
  AVG(CASE WHEN isinf({c}) THEN 1.0 ELSE 0.0 END) > 0.1 AS i, AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) > 0.5 AS m
  FROM {DEFECTS} AS d) AS t""" for c in DEFECT_NAMES))
def quality_report(spark, sf_dir):
    f = flows(spark, sf_dir)
    b, i = F.col("TotBytes").cast("double"), F.col("flow_id")
    d = f.select("flow_id", F.lit(1.0).alias("fixed"), (1 + i * 1e-9).alias("steady"),
                 F.when(i % 5 == 0, float("inf")).otherwise(b).alias("endless"),
                 F.when(i % 3 == 0, b).alias("sparse"), b.alias("fine"))
    return select.quality_report(d, DEFECT_NAMES)


CORRELATED = ["TotBytes", "SrcBytes", "double_bytes", "TotPkts", "Dur"]


def correlated(spark, sf_dir):
    return gappy_flows(spark, sf_dir).withColumn("double_bytes", F.col("TotBytes") * 2.0 + F.col("TotPkts"))


@query("correlation_pairs", f"""
WITH f AS (SELECT *, TotBytes * 2.0 + TotPkts AS double_bytes FROM {{gappy}} AS g),
t AS (SELECT {', '.join(f'CAST(COALESCE({c}, (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM f)) AS DOUBLE) AS {c}' for c in CORRELATED)} FROM f)
SELECT feature_i, feature_j, ROUND(r, 6) AS r FROM ({' UNION ALL '.join(
    f"SELECT '{a}' AS feature_i, '{b}' AS feature_j, corr({a}, {b}) AS r FROM t"
    for n, a in enumerate(CORRELATED) for b in CORRELATED[n + 1:])}) AS p WHERE ABS(r) > 0.5""")
def correlation_pairs(spark, sf_dir):
    return rounded(select.correlation_pairs(correlated(spark, sf_dir), CORRELATED, 0.5), ["r"])


@query("correlation_prune", """SELECT unnest(['TotBytes', 'SrcBytes', 'TotPkts', 'Dur']) AS feature""")
def correlation_prune(spark, sf_dir):
    kept, _ = select.correlation_prune(correlated(spark, sf_dir), CORRELATED, 0.98)
    return spark.createDataFrame([(c,) for c in kept], "feature string")


# Importance table derived from the data: label effect of each feature.
IMPORTANCE_SQL = each(NUMBERS, f"ROUND({COHEN}, 6) AS importance", "{scored}")


def importance_table(spark, sf_dir):
    d = tr.cohens_d(scored_flows(spark, sf_dir), NUMBERS)
    return d.select("feature", F.round("cohens_d", 6).alias("importance"))


@query("importance_select", f"""
WITH r AS (SELECT feature, importance, CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INT) AS place,
  SUM(importance) OVER (ORDER BY importance DESC, feature) / SUM(importance) OVER () AS c FROM ({IMPORTANCE_SQL}) AS i)
SELECT feature, importance, place, ROUND(c, 6) AS cumulative,
  place <= (SELECT MIN(place) FROM r WHERE (c >= 0.9 AND place >= 2) OR place >= 3) AS kept FROM r""")
def importance_select(spark, sf_dir):
    out = select.importance_select(importance_table(spark, sf_dir), 0.9, 2, 3)
    return rounded(out, ["cumulative"])


@query("time_bias_guard", f"""SELECT unnest(CASE WHEN (SELECT SUM(importance) FROM ({IMPORTANCE_SQL}) AS i WHERE feature = 'Dur') > 0.05
  THEN ['TotBytes', 'Dur'] ELSE ['TotBytes', 'Dur', 'hour'] END) AS feature""")
def time_bias_guard(spark, sf_dir):
    kept, _ = select.time_bias_guard(["TotBytes", "Dur", "hour"], importance_table(spark, sf_dir), watched=["Dur"])
    return spark.createDataFrame([(c,) for c in kept], "feature string")


@query("select_features", """SELECT * FROM (VALUES ('fixed', 'constant'), ('fixed', 'low_variance'), ('sparse', 'high_missing'),
  ('copy', 'high_correlation')) AS t(feature, reason)""")
def select_features(spark, sf_dir):
    f = flows(spark, sf_dir).withColumns({
        "fixed": F.lit(3.0), "copy": F.col("TotBytes") * 3.0,
        "sparse": F.when(F.col("flow_id") % 3 == 0, F.col("TotBytes"))})
    _, removed = select.select_features(f, ["TotBytes", "fixed", "copy", "sparse", "TotPkts", "Dur"],
                                        [select.Strategy.QUALITY, select.Strategy.CORRELATION])
    return removed


@query("label_leak_screen", "SELECT flow_id, TotBytes, Dur FROM {flows} AS f")
def label_leak_screen(spark, sf_dir):
    f = flows(spark, sf_dir)
    kept, _ = select.leak_screen(f, ["TotBytes", "SrcAddr", "Dport", "Dur"])
    return f.select("flow_id", *kept)


@query("profile_flows", each(NUMBERS, f"ROUND({SKEW}, 4) AS skewness, ROUND(quantile_cont(x, 0.95), 6) AS q95, "
                                      f"ABS({SKEW}) > 1 OR kurtosis_pop(x) + 3 > 5 AS is_long_tail", "{flows}"))
def profile_flows(spark, sf_dir):
    tails = profile.profile_flows(flows(spark, sf_dir))["long_tail"].where(F.col("feature").isin(NUMBERS))
    return rounded(rounded(tails, ["q95"]), ["skewness"], 4).select("feature", "skewness", "q95", "is_long_tail")
