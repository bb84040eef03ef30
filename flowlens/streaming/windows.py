"""The window features over an unbounded flow stream.

Late flows are accepted up to a bound; a window leaves once the watermark has passed it, so
state stays proportional to the open windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowlens.functions.columns import pair_key, ratio_or_zero, size_micros
from flowlens.operators.windows import window_flow_ratio


def timed(df: DataFrame, late: str, time: str = "StartTime") -> DataFrame:
    """Event time as a zoned timestamp with a lateness bound."""
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)


#: A flow of this time or later only says that a bounded replay has ended; its windows never leave.
END = "9000-01-01 00:00:00"


def kept(df: DataFrame, key: str, time: str = "StartTime") -> DataFrame:
    """Flows with a key, and what tells the end; tested after the watermark, which the end has to reach."""
    return df.where(F.col(key).isNotNull() | (F.col(time) >= F.lit(END).cast("timestamp")))


def spelled(size: str) -> str:
    return f"{size_micros(size)} microseconds"


def stream_src_windows(df: DataFrame, size: str = "1min", late: str = "10 minutes", rsd: float = 0.01) -> DataFrame:
    """Flows, distinct targets and ports, and bytes per source and window.

    Distinct counts are sketches here: exact ones would keep every value as state.
    """
    flows = kept(timed(df, late), "SrcAddr")
    return (flows.groupBy(F.window("StartTime", spelled(size)).alias("w"), "SrcAddr").agg(
        F.count(F.lit(1)).alias("flows_per_minute_by_src"),
        F.approx_count_distinct("DstAddr", rsd).alias("unique_dst_per_minute_by_src"),
        F.approx_count_distinct("Dport", rsd).alias("unique_dport_per_minute_by_src"),
        F.coalesce(F.sum("TotBytes"), F.lit(0)).alias("total_bytes_per_minute_by_src"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "SrcAddr",
                "flows_per_minute_by_src", "unique_dst_per_minute_by_src", "unique_dport_per_minute_by_src",
                "total_bytes_per_minute_by_src"))


def stream_pair_windows(df: DataFrame, size: str = "1min", late: str = "10 minutes") -> DataFrame:
    """Two-way aggregates per undirected address pair and window."""
    a, b = pair_key()
    keyed = kept(timed(df.withColumns({"addr_a": a, "addr_b": b}), late), "addr_a")
    sums = keyed.groupBy(F.window("StartTime", spelled(size)).alias("w"), "addr_a", "addr_b").agg(
        F.count(F.lit(1)).alias("bidirectional_flow_count"),
        F.coalesce(F.sum("TotBytes"), F.lit(0)).alias("bidirectional_total_bytes"),
        F.coalesce(F.sum("SrcBytes"), F.lit(0)).alias("bidirectional_total_src_bytes"),
        F.coalesce(F.sum("DstBytes"), F.lit(0)).alias("bidirectional_total_dst_bytes"))
    src, dst = F.col("bidirectional_total_src_bytes"), F.col("bidirectional_total_dst_bytes")
    return sums.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "addr_a", "addr_b",
        "bidirectional_flow_count", "bidirectional_total_bytes", "bidirectional_total_src_bytes",
        "bidirectional_total_dst_bytes", ratio_or_zero(F.least(src, dst), F.greatest(src, dst)).alias("bidirectional_symmetry"),
        window_flow_ratio(src, dst).alias("bidirectional_window_flow_ratio"))
