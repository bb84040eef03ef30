"""Cleaning, labels and flow features."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens.functions.catalog import CALENDAR_FEATURES, INTERVAL_FEATURES, PAIR_FEATURES, SRC_WINDOW_FEATURES
from flowlens.functions.columns import is_private_ip, pair_key, time_bucket
from flowlens.operators import labels, row_features as rows, windows
from flowlens.plans.features import extract_features
from flowlens.sources.flows import clean
from registry.base import flows, gappy_flows, query, scored_flows, table


def rounded(df, columns, digits=6):
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


# Damaged text as a capture would hold it.
RAW = """(SELECT event_id AS flow_id,
  CASE WHEN event_id % 97 = 0 THEN 'invalid-date' ELSE strftime(ts, '%Y/%m/%d %H:%M:%S.%f') END AS StartTime,
  CASE WHEN event_id % 89 = 0 THEN 'invalid' ELSE CAST(value AS VARCHAR) END AS Dur,
  CASE WHEN event_id % 83 = 0 THEN '0x0303' ELSE CAST(event_id % 70000 AS VARCHAR) END AS Sport,
  CASE WHEN event_id % 79 = 0 THEN '' ELSE CAST(-(user_id % 100) AS VARCHAR) END AS TotPkts,
  event_type AS Extra FROM events)"""


def raw_text(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    return e.select(
        i.alias("flow_id"),
        F.when(i % 97 == 0, "invalid-date").otherwise(
            F.date_format("ts", "yyyy/MM/dd HH:mm:ss.SSSSSS")).alias("StartTime"),
        F.when(i % 89 == 0, "invalid").otherwise(F.col("value").cast("string")).alias("Dur"),
        F.when(i % 83 == 0, "0x0303").otherwise((i % 70000).cast("string")).alias("Sport"),
        F.when(i % 79 == 0, "").otherwise((-(F.col("user_id") % 100)).cast("string")).alias("TotPkts"),
        F.col("event_type").alias("Extra"))


@query("clean_coercion", f"""
SELECT flow_id, try_strptime(StartTime, '%Y/%m/%d %H:%M:%S.%f') AS started,
  TRY_CAST(Dur AS DOUBLE) AS Dur, TRY_CAST(Sport AS DOUBLE) AS Sport,
  TRY_CAST(TotPkts AS DOUBLE) AS TotPkts, Extra
FROM (SELECT flow_id, StartTime, Dur, CASE WHEN Sport LIKE '0x%' THEN NULL ELSE Sport END AS Sport,
             TotPkts, Extra FROM {RAW} AS r) AS r2""")
def clean_coercion(spark, sf_dir):
    return clean(raw_text(spark, sf_dir)).select(
        "flow_id", F.col("StartTime").cast("timestamp_ntz").alias("started"), "Dur", "Sport", "TotPkts", "Extra")


@query("private_addresses", """
SELECT addr, COUNT(*) AS n, MAX(CASE WHEN
    a = 10 OR a = 127 OR a = 0 OR a >= 240 OR (a = 172 AND b BETWEEN 16 AND 31) OR (a = 192 AND b = 168)
    OR (a = 169 AND b = 254) OR (a = 198 AND b BETWEEN 18 AND 19) THEN 1 ELSE 0 END) AS is_private
FROM (SELECT CAST(c_custkey % 256 AS BIGINT) AS a, CAST(c_nationkey * 11 % 256 AS BIGINT) AS b,
        concat(CAST(c_custkey % 256 AS VARCHAR), '.', CAST(c_nationkey * 11 % 256 AS VARCHAR), '.7.',
               CAST(c_custkey % 250 AS VARCHAR)) AS addr FROM customer) AS t GROUP BY addr""")
def private_addresses(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    addr = F.concat((F.col("c_custkey") % 256).cast("string"), F.lit("."),
                    (F.col("c_nationkey") * 11 % 256).cast("string"), F.lit(".7."),
                    (F.col("c_custkey") % 250).cast("string"))
    return (c.select(addr.alias("addr")).groupBy("addr").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("is_private", is_private_ip(F.col("addr")).cast("int")))


@query("fill_for_agg", """
SELECT flow_id, COALESCE(SrcAddr, '') AS SrcAddr, COALESCE(DstAddr, '') AS DstAddr,
  COALESCE(TotBytes, 0) AS TotBytes, COALESCE(Dport, 0) AS Dport FROM {gappy} AS f""")
def fill_for_agg(spark, sf_dir):
    names = ["SrcAddr", "DstAddr", "TotBytes", "Dport"]
    return rows.fill_for_agg(gappy_flows(spark, sf_dir), names).select("flow_id", *names)


@query("label_binary", """
SELECT flow_id, CASE WHEN regexp_matches(lower(Label), 'botnet|bot') THEN 1 ELSE 0 END AS label_binary
FROM (SELECT flow_id, CASE WHEN flow_id % 53 = 0 THEN NULL ELSE Label END AS Label FROM {flows} AS f) AS g""")
def label_binary(spark, sf_dir):
    f = flows(spark, sf_dir).select("flow_id", F.when(F.col("flow_id") % 53 != 0, F.col("Label")).alias("Label"))
    return labels.binary_label(f).select("flow_id", "label_binary")


@query("label_numeric", """
SELECT doc_id, CASE WHEN quality = 1 THEN 1 ELSE 0 END AS label_binary FROM labels""")
def label_numeric(spark, sf_dir):
    return labels.binary_label(table(spark, sf_dir, "labels"), "quality").select("doc_id", "label_binary")


@query("label_stats", """
SELECT COUNT(*) AS total_count, COUNT(*) FILTER (label_binary = 0) AS normal_count,
  COUNT(*) FILTER (label_binary = 1) AS anomaly_count,
  ROUND(AVG(1.0 - label_binary), 9) AS normal_ratio, ROUND(AVG(CAST(label_binary AS DOUBLE)), 9) AS anomaly_ratio
FROM {scored} AS s""")
def label_stats(spark, sf_dir):
    return rounded(labels.label_stats(scored_flows(spark, sf_dir)), ["normal_ratio", "anomaly_ratio"], 9)


@query("label_counts", "SELECT Label, COUNT(*) AS n FROM {flows} AS f GROUP BY Label")
def label_counts(spark, sf_dir):
    return labels.label_counts(flows(spark, sf_dir))


@query("label_validation", """
SELECT len(m) = 0 AS is_valid, m AS messages FROM (
  SELECT list_filter([CASE WHEN r < 0.1 THEN 'anomaly ratio too low' END,
                      CASE WHEN r > 0.5 THEN 'anomaly ratio too high' END,
                      CASE WHEN r = 0 THEN 'no anomalies' END], lambda x: x IS NOT NULL) AS m
  FROM (SELECT AVG(label_binary) AS r FROM {scored} AS s) AS t) AS u""")
def label_validation(spark, sf_dir):
    return labels.validate_labels(scored_flows(spark, sf_dir), 0.1, 0.5)


@query("label_distribution", """
SELECT Label, n, ROUND(n / CAST((SELECT COUNT(*) FROM events) AS DOUBLE), 9) AS share
FROM (SELECT Label, COUNT(*) AS n FROM {flows} AS f GROUP BY Label) AS g ORDER BY n DESC, Label LIMIT 10""")
def label_distribution(spark, sf_dir):
    return rounded(labels.label_distribution(flows(spark, sf_dir)), ["share"], 9)


@query("class_imbalance", """
SELECT COUNT(*) FILTER (label_binary = 0) AS negatives, COUNT(*) FILTER (label_binary = 1) AS positives,
  ROUND(COUNT(*) FILTER (label_binary = 0) / CAST(COUNT(*) FILTER (label_binary = 1) AS DOUBLE), 9) AS imbalance_ratio
FROM {scored} AS s""")
def class_imbalance(spark, sf_dir):
    return rounded(labels.imbalance(scored_flows(spark, sf_dir)), ["imbalance_ratio"], 9)


ROW_SQL = """
SELECT flow_id, TotBytes - SrcBytes AS DstBytes,
  ROUND(SrcBytes / CAST(NULLIF(TotBytes - SrcBytes + 1, 0) AS DOUBLE), 6) AS flow_ratio,
  ROUND((TotBytes - SrcBytes) / CAST(NULLIF(SrcBytes + 1, 0) AS DOUBLE), 6) AS bytes_symmetry,
  ROUND(COALESCE(SrcBytes * 100.0 / CAST(NULLIF(TotBytes, 0) AS DOUBLE), 0), 6) AS src_ratio,
  ROUND(COALESCE((TotBytes - SrcBytes) * 100.0 / CAST(NULLIF(TotBytes, 0) AS DOUBLE), 0), 6) AS dst_ratio,
  ROUND(TotBytes / CAST(TotPkts + 1 AS DOUBLE), 6) AS packet_size,
  ROUND(TotBytes / (Dur + 1), 6) AS bytes_per_second,
  ROUND(TotPkts / (Dur + 1), 6) AS packets_per_second,
  CASE WHEN State IN ('RST','REQ','S_','INT','URP') THEN 1 ELSE 0 END AS is_scanning
FROM {gappy} AS f"""
ROW_RATIOS = ["flow_ratio", "bytes_symmetry", "src_ratio", "dst_ratio", "packet_size",
              "bytes_per_second", "packets_per_second"]


@query("row_features", ROW_SQL)
def row_features(spark, sf_dir):
    out = rows.row_features(gappy_flows(spark, sf_dir))
    return rounded(out, ROW_RATIOS).select("flow_id", "DstBytes", *ROW_RATIOS, "is_scanning")


@query("row_features_no_state", """
SELECT flow_id, CASE WHEN (TotBytes - SrcBytes) / CAST(NULLIF(SrcBytes + 1, 0) AS DOUBLE) < 0.1
  THEN 1 ELSE 0 END AS is_scanning FROM {flows} AS f""")
def row_features_no_state(spark, sf_dir):
    return rows.row_features(flows(spark, sf_dir).drop("State")).select("flow_id", "is_scanning")


@query("calendar_features", """
SELECT flow_id, h AS hour, d AS day_of_week, m AS day_of_month,
  CASE WHEN d >= 5 THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN h >= 9 AND h < 17 THEN 1 ELSE 0 END AS is_work_hour,
  CASE WHEN h >= 22 OR h < 6 THEN 1 ELSE 0 END AS is_night,
  ROUND(sin(2 * pi() * h / 24), 6) + 0.0 AS sin_hour, ROUND(cos(2 * pi() * h / 24), 6) + 0.0 AS cos_hour,
  ROUND(sin(2 * pi() * d / 7), 6) + 0.0 AS sin_day_of_week, ROUND(cos(2 * pi() * d / 7), 6) + 0.0 AS cos_day_of_week,
  ROUND(sin(2 * pi() * m / 30), 6) + 0.0 AS sin_day_of_month, ROUND(cos(2 * pi() * m / 30), 6) + 0.0 AS cos_day_of_month
FROM (SELECT flow_id, CAST(hour(StartTime) AS INT) AS h, CAST(isodow(StartTime) - 1 AS INT) AS d,
             CAST(day(StartTime) AS INT) AS m FROM {gappy} AS f) AS t""")
def calendar_features(spark, sf_dir):
    out = rows.calendar_features(gappy_flows(spark, sf_dir))
    waves = [c for c in CALENDAR_FEATURES if c[:4] in ("sin_", "cos_")]
    out = rounded(out, waves).withColumns({c: F.col(c) + 0.0 for c in waves})
    return out.select("flow_id", *CALENDAR_FEATURES)


INTERVAL_SQL = """
SELECT flow_id,
  ROUND(CASE WHEN SrcAddr IS NULL OR StartTime IS NULL THEN 0.0 ELSE COALESCE(epoch_us(StartTime) - LAG(epoch_us(StartTime))
    OVER (PARTITION BY SrcAddr, StartTime IS NULL ORDER BY StartTime, flow_id), 0) / 1e6 END, 6) AS time_since_last_flow,
  ROUND(CASE WHEN SrcAddr IS NULL OR StartTime IS NULL THEN 0.0 ELSE COALESCE(LEAD(epoch_us(StartTime))
    OVER (PARTITION BY SrcAddr, StartTime IS NULL ORDER BY StartTime, flow_id) - epoch_us(StartTime), 0) / 1e6 END, 6)
    AS time_to_next_flow
FROM {gappy} AS f"""


@query("interval_features", INTERVAL_SQL)
def interval_features(spark, sf_dir):
    out = windows.interval_features(gappy_flows(spark, sf_dir))
    return rounded(out, INTERVAL_FEATURES).select("flow_id", *INTERVAL_FEATURES)


@query("interval_features_sliced", INTERVAL_SQL)
def interval_features_sliced(spark, sf_dir):
    """Same result with time slices far smaller than the default, as at large scale."""
    out = windows.interval_features(gappy_flows(spark, sf_dir), rows_per_slice=1000)
    return rounded(out, INTERVAL_FEATURES).select("flow_id", *INTERVAL_FEATURES)


@query("time_buckets", """
SELECT date_trunc('hour', StartTime) AS bucket, COUNT(*) AS n FROM {gappy} AS f GROUP BY 1""")
def time_buckets(spark, sf_dir):
    f = gappy_flows(spark, sf_dir)
    return f.groupBy(time_bucket(f, "1h").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


SRC_AGG = """SELECT SrcAddr, date_trunc('day', StartTime) AS d, COUNT(*) AS n, COUNT(DISTINCT DstAddr) AS nd,
  COUNT(DISTINCT Dport) AS np, CAST(SUM(TotBytes) AS BIGINT) AS b FROM {gappy} AS f
  WHERE SrcAddr IS NOT NULL AND StartTime IS NOT NULL GROUP BY 1, 2"""


@query("src_window_features", f"""
SELECT flow_id, COALESCE(n, 0) AS flows_per_minute_by_src, COALESCE(nd, 0) AS unique_dst_per_minute_by_src,
  COALESCE(np, 0) AS unique_dport_per_minute_by_src, COALESCE(b, 0) AS total_bytes_per_minute_by_src
FROM {{gappy}} AS f LEFT JOIN ({SRC_AGG}) AS a ON f.SrcAddr = a.SrcAddr AND date_trunc('day', f.StartTime) = a.d""")
def src_window_features(spark, sf_dir):
    return windows.src_window_features(gappy_flows(spark, sf_dir), "1 day").select("flow_id", *SRC_WINDOW_FEATURES)


@query("src_window_minute", """
SELECT SrcAddr, CAST(floor(epoch_us(StartTime) / 60000000) AS BIGINT) AS minute, COUNT(*) AS flows_per_minute_by_src,
  COUNT(DISTINCT DstAddr) AS unique_dst_per_minute_by_src, COUNT(DISTINCT Dport) AS unique_dport_per_minute_by_src,
  CAST(SUM(TotBytes) AS BIGINT) AS total_bytes_per_minute_by_src FROM {flows} AS f GROUP BY 1, 2""")
def src_window_minute(spark, sf_dir):
    return windows.src_window_table(flows(spark, sf_dir)).withColumnRenamed("_bucket", "minute")


@query("src_window_orders", """
SELECT l_suppkey AS "SrcAddr", CAST(floor(epoch_us(CAST(l_shipdate AS TIMESTAMP)) / 86400000000) AS BIGINT) AS day,
  COUNT(*) AS flows_per_minute_by_src, COUNT(DISTINCT o_custkey) AS unique_dst_per_minute_by_src,
  COUNT(DISTINCT l_linenumber) AS unique_dport_per_minute_by_src,
  ROUND(SUM(l_extendedprice), 2) AS total_bytes_per_minute_by_src
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def src_window_orders(spark, sf_dir):
    """The same aggregates over the largest table: suppliers as sources, customers as targets."""
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    f = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_suppkey").alias("SrcAddr"), F.col("o_custkey").alias("DstAddr"),
        F.col("l_linenumber").alias("Dport"), F.col("l_shipdate").alias("StartTime"),
        F.col("l_extendedprice").alias("TotBytes"))
    return rounded(windows.src_window_table(f, "1 day"), ["total_bytes_per_minute_by_src"], 2) \
        .withColumnRenamed("_bucket", "day")


@query("pair_keys", """
SELECT flow_id, CASE WHEN SrcAddr IS NULL OR DstAddr IS NULL THEN NULL ELSE least(SrcAddr, DstAddr) END AS a,
  CASE WHEN SrcAddr IS NULL OR DstAddr IS NULL THEN NULL ELSE greatest(SrcAddr, DstAddr) END AS b
FROM {gappy} AS f""")
def pair_keys(spark, sf_dir):
    a, b = pair_key()
    return gappy_flows(spark, sf_dir).select("flow_id", a.alias("a"), b.alias("b"))


PAIR_AGG = """SELECT least(SrcAddr, DstAddr) AS a, greatest(SrcAddr, DstAddr) AS b, date_trunc('day', StartTime) AS d,
  COUNT(*) AS n, CAST(COALESCE(SUM(TotBytes), 0) AS BIGINT) AS tb, CAST(SUM(TotPkts) AS BIGINT) AS tp,
  CAST(SUM(SrcBytes) AS BIGINT) AS sb, CAST(COALESCE(SUM(TotBytes - SrcBytes), 0) AS BIGINT) AS db, AVG(Dur) AS mean_dur
  FROM {gappy} AS f WHERE SrcAddr IS NOT NULL AND DstAddr IS NOT NULL AND StartTime IS NOT NULL GROUP BY 1, 2, 3"""
PAIR_RATIOS = ["bidirectional_symmetry", "bidirectional_avg_bytes_per_flow", "bidirectional_avg_packets_per_flow",
               "bidirectional_avg_duration", "bidirectional_window_flow_ratio"]
PAIR_VALUES = """COALESCE(n, 0) AS bidirectional_flow_count, COALESCE(tb, 0) AS bidirectional_total_bytes,
  COALESCE(tp, 0) AS bidirectional_total_packets, COALESCE(sb, 0) AS bidirectional_total_src_bytes,
  COALESCE(db, 0) AS bidirectional_total_dst_bytes,
  ROUND(COALESCE(least(sb, db) / CAST(NULLIF(greatest(sb, db), 0) AS DOUBLE), 0), 6) AS bidirectional_symmetry,
  ROUND(COALESCE(tb / CAST(n AS DOUBLE), 0), 6) AS bidirectional_avg_bytes_per_flow,
  ROUND(COALESCE(tp / CAST(n AS DOUBLE), 0), 6) AS bidirectional_avg_packets_per_flow,
  ROUND(COALESCE(mean_dur, 0), 6) AS bidirectional_avg_duration,
  ROUND(COALESCE(sb / CAST(NULLIF(db + 1, 0) AS DOUBLE), 0), 6) AS bidirectional_window_flow_ratio"""


@query("pair_window_features", f"""
SELECT flow_id, {PAIR_VALUES} FROM {{gappy}} AS f LEFT JOIN ({PAIR_AGG}) AS p
  ON SrcAddr IS NOT NULL AND DstAddr IS NOT NULL AND least(f.SrcAddr, f.DstAddr) = p.a
  AND greatest(f.SrcAddr, f.DstAddr) = p.b AND date_trunc('day', f.StartTime) = p.d""")
def pair_window_features(spark, sf_dir):
    out = windows.pair_window_features(rows.row_features(gappy_flows(spark, sf_dir)), "1 day")
    return rounded(out, PAIR_RATIOS).select("flow_id", *PAIR_FEATURES)


@query("pair_window_table", f"""
SELECT a, b, CAST(floor(epoch_us(d) / 86400000000) AS BIGINT) AS day, {PAIR_VALUES} FROM ({PAIR_AGG}) AS p""")
def pair_window_table(spark, sf_dir):
    out = windows.pair_window_table(rows.row_features(gappy_flows(spark, sf_dir)), "1 day")
    return rounded(out, PAIR_RATIOS).withColumnsRenamed({"_a": "a", "_b": "b", "_bucket": "day"})


ALL_SQL = f"""
WITH g AS (SELECT * FROM {{gappy}} AS f0),
s AS ({SRC_AGG.replace('{gappy}', 'g')}), p AS ({PAIR_AGG.replace('{gappy}', 'g')}),
i AS (SELECT i0.flow_id, i0.time_since_last_flow, i0.time_to_next_flow FROM ({INTERVAL_SQL.replace('{gappy}', 'g')}) AS i0)
SELECT f.flow_id, TotBytes_0 AS "TotBytes", ROUND(COALESCE(fr, 0), 6) AS flow_ratio, h AS hour,
  i.time_since_last_flow, COALESCE(s.n, 0) AS flows_per_minute_by_src, COALESCE(s.nd, 0) AS unique_dst_per_minute_by_src,
  COALESCE(p.n, 0) AS bidirectional_flow_count,
  ROUND(COALESCE(sb / CAST(NULLIF(db + 1, 0) AS DOUBLE), 0), 6) AS bidirectional_window_flow_ratio
FROM (SELECT *, COALESCE(TotBytes, 0) AS TotBytes_0, CAST(COALESCE(hour(StartTime), 0) AS INT) AS h,
        SrcBytes / CAST(NULLIF(TotBytes - SrcBytes + 1, 0) AS DOUBLE) AS fr FROM g) AS f
JOIN i ON f.flow_id = i.flow_id
LEFT JOIN s ON f.SrcAddr = s.SrcAddr AND date_trunc('day', f.StartTime) = s.d
LEFT JOIN p ON f.SrcAddr IS NOT NULL AND f.DstAddr IS NOT NULL AND least(f.SrcAddr, f.DstAddr) = p.a
  AND greatest(f.SrcAddr, f.DstAddr) = p.b AND date_trunc('day', f.StartTime) = p.d"""


@query("extract_features", ALL_SQL)
def extract_all(spark, sf_dir):
    out = extract_features(gappy_flows(spark, sf_dir), 4, size="1 day")
    return rounded(out, ["flow_ratio", "time_since_last_flow", "bidirectional_window_flow_ratio"]).select(
        "flow_id", "TotBytes", "flow_ratio", "hour", "time_since_last_flow", "flows_per_minute_by_src",
        "unique_dst_per_minute_by_src", "bidirectional_flow_count", "bidirectional_window_flow_ratio")


@query("finalize_numeric", """
SELECT flow_id, ROUND(COALESCE(CASE WHEN TotBytes % 7 = 0 THEN NULL ELSE TotBytes / CAST(TotPkts AS DOUBLE) END, 0), 6) AS r,
  COALESCE(TotBytes, 0) AS "TotBytes" FROM {gappy} AS f""")
def finalize_numeric(spark, sf_dir):
    f = gappy_flows(spark, sf_dir)
    r = F.when(F.col("TotBytes") % 7 == 0, F.lit(float("inf"))).otherwise(F.col("TotBytes") / F.col("TotPkts"))
    return rounded(rows.finalize_numeric(f.select("flow_id", r.alias("r"), "TotBytes")), ["r"])


@query("top_sources", """
SELECT SrcAddr, MAX(n) AS max_flows FROM (SELECT SrcAddr, date_trunc('day', StartTime) AS d, COUNT(*) AS n
  FROM {flows} AS f GROUP BY 1, 2) AS g GROUP BY SrcAddr ORDER BY max_flows DESC, SrcAddr LIMIT 10""")
def top_sources(spark, sf_dir):
    return windows.top_sources(windows.src_window_table(flows(spark, sf_dir), "1 day"))


@query("symmetry_profile", f"""
SELECT ROUND(AVG(y), 6) AS mean_symmetry, COUNT(*) FILTER (y > 0.9) AS two_way_rows,
  ROUND(COUNT(*) FILTER (y > 0.9) / CAST(COUNT(*) AS DOUBLE), 6) AS two_way_share,
  COUNT(*) FILTER (y < 0.1) AS one_way_rows, ROUND(COUNT(*) FILTER (y < 0.1) / CAST(COUNT(*) AS DOUBLE), 6) AS one_way_share
FROM (SELECT COALESCE(least(sb, db) / CAST(NULLIF(greatest(sb, db), 0) AS DOUBLE), 0) AS y FROM {{gappy}} AS f
  LEFT JOIN ({PAIR_AGG}) AS p ON SrcAddr IS NOT NULL AND DstAddr IS NOT NULL AND least(f.SrcAddr, f.DstAddr) = p.a
  AND greatest(f.SrcAddr, f.DstAddr) = p.b AND date_trunc('day', f.StartTime) = p.d) AS t""")
def symmetry_profile(spark, sf_dir):
    f = windows.pair_window_features(rows.row_features(gappy_flows(spark, sf_dir)), "1 day")
    return rounded(windows.symmetry_profile(f), ["mean_symmetry", "two_way_share", "one_way_share"])


@query("schema_contract", """
SELECT e.name, c.column_name IS NOT NULL AS present,
  coalesce((e.kind = 'any' AND c.column_name IS NOT NULL) OR (e.kind = 'number' AND regexp_matches(c.data_type, 'INT|DOUBLE|DECIMAL'))
    OR (e.kind = 'time' AND c.data_type LIKE 'TIMESTAMP%'), FALSE) AS type_right
FROM (VALUES ('event_id', 'any'), ('nothing', 'any'), ('value', 'number'), ('event_type', 'number'), ('ts', 'time'),
             ('user_id', 'time')) AS e(name, kind)
LEFT JOIN (SELECT * FROM information_schema.columns WHERE table_name = 'events') AS c ON c.column_name = e.name""")
def schema_contract(spark, sf_dir):
    from flowlens.functions.columns import schema_contract as contract

    return contract(table(spark, sf_dir, "events"), ["event_id", "nothing"], ["value", "event_type"], ["ts", "user_id"])
