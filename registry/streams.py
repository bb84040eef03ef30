"""Streaming forms of the window features and of scoring, and the planned extensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens.operators import forest, row_features as rf, rules as ru, transform as tr, windows
from flowlens.streaming.arrivals import stream_intervals
from flowlens.streaming.scoring import read_stream, replay, run_available, score_stream
from flowlens.streaming.windows import stream_pair_windows, stream_src_windows
from registry.base import FLOWS_SQL, query, scored_flows, flows, table
from registry.features import rounded


def flow_stream(spark, sf_dir):
    """The event table as a file stream."""
    events = read_stream(spark, f"{sf_dir}/events*.parquet", table(spark, sf_dir, "events").schema)
    return spark.sql(FLOWS_SQL, events=events)


def replayed(spark, sf_dir, build):
    """``build`` over the event table as a stream of flows, to the last open window."""
    return replay(spark, f"{sf_dir}/events*.parquet", table(spark, sf_dir, "events").schema,
                  lambda events: build(spark.sql(FLOWS_SQL, events=events)), "ts")


@query("stream_src_windows", """SELECT date_trunc('day', StartTime) AS day, SrcAddr, COUNT(*) AS flows_per_minute_by_src,
  COUNT(DISTINCT DstAddr) AS unique_dst_per_minute_by_src, CAST(SUM(TotBytes) AS BIGINT) AS total_bytes_per_minute_by_src
FROM {flows} AS f GROUP BY 1, 2""")
def src_windows(spark, sf_dir):
    out = replayed(spark, sf_dir, lambda f: stream_src_windows(f, "1 day"))
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("day"), "SrcAddr", "flows_per_minute_by_src",
                      "unique_dst_per_minute_by_src", "total_bytes_per_minute_by_src")


@query("stream_pair_windows", """SELECT day, addr_a, addr_b, n AS bidirectional_flow_count,
  ROUND(COALESCE(least(s, d) / CAST(NULLIF(greatest(s, d), 0) AS DOUBLE), 0), 6) AS bidirectional_symmetry FROM (
  SELECT date_trunc('day', StartTime) AS day, least(SrcAddr, DstAddr) AS addr_a, greatest(SrcAddr, DstAddr) AS addr_b, COUNT(*) AS n,
    SUM(SrcBytes) AS s, SUM(TotBytes - SrcBytes) AS d FROM {flows} AS f GROUP BY 1, 2, 3) AS t""")
def pair_windows(spark, sf_dir):
    out = replayed(spark, sf_dir, lambda f: stream_pair_windows(rf.row_features(f), "1 day"))
    return rounded(out.select(F.col("window_start").cast("timestamp_ntz").alias("day"), "addr_a", "addr_b",
                              "bidirectional_flow_count", "bidirectional_symmetry"), ["bidirectional_symmetry"])


@query("stream_intervals", """SELECT flow_id, ROUND(COALESCE(epoch_us(StartTime) - LAG(epoch_us(StartTime))
  OVER (PARTITION BY SrcAddr ORDER BY StartTime, flow_id), 0) / 1e6, 6) AS time_since_last_flow FROM {flows} AS f""")
def intervals(spark, sf_dir):
    out = replayed(spark, sf_dir, lambda f: stream_intervals(f, slice="1 day"))
    return rounded(out.select("flow_id", "time_since_last_flow"), ["time_since_last_flow"])


@query("stream_scoring")
def stream_scoring(spark, sf_dir):
    s = rf.row_features(scored_flows(spark, sf_dir))
    names = ["Dur", "TotPkts", "TotBytes"]
    fitted = tr.fit_for_unsupervised(s, names, names)
    model = forest.fit_forest(tr.apply_for_unsupervised(s, fitted), fitted["columns"])
    rules = ru.mine_rules(s, method="score")
    out = score_stream(flow_stream(spark, sf_dir), model, rules, 0.6, fitted)
    return run_available(out.select("flow_id", "anomaly_score", "y_pred", "y_final"))


@query("port_entropy", """SELECT SrcAddr, CAST(floor(epoch_us(d) / 86400000000) AS BIGINT) AS day, CAST(SUM(c) AS BIGINT) AS flows,
  ROUND(greatest(-SUM(c / n * log2(c / n)), 0), 6) AS dport_entropy FROM (
  SELECT SrcAddr, d, c, SUM(c) OVER (PARTITION BY SrcAddr, d) AS n FROM (
    SELECT SrcAddr, date_trunc('day', StartTime) AS d, Dport, CAST(COUNT(*) AS DOUBLE) AS c FROM {gappy} AS f
    WHERE SrcAddr IS NOT NULL AND StartTime IS NOT NULL AND Dport IS NOT NULL GROUP BY 1, 2, 3) AS g) AS h GROUP BY 1, 2""")
def port_entropy(spark, sf_dir):
    from registry.base import gappy_flows

    out = windows.port_entropy(gappy_flows(spark, sf_dir), "1 day").withColumnRenamed("_bucket", "day")
    return rounded(out, ["dport_entropy"])


@query("lateral_features", """SELECT SrcAddr, CAST(floor(epoch_us(StartTime) / 86400000000) AS BIGINT) AS day,
  COUNT(*) FILTER (Dport = 443) AS web_flows, COUNT(DISTINCT CASE WHEN Dport = 443 THEN DstAddr END) AS web_targets,
  COUNT(*) FILTER (Dport = 22) AS ssh_flows, COUNT(DISTINCT CASE WHEN Dport = 22 THEN DstAddr END) AS ssh_targets
FROM {flows} AS f GROUP BY 1, 2""")
def lateral_features(spark, sf_dir):
    out = windows.lateral_features(flows(spark, sf_dir), "1 day", {"web": 443, "ssh": 22})
    return out.withColumnRenamed("_bucket", "day")
