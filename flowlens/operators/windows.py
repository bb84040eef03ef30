"""Features that need other flows of the same source or address pair."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from flowlens.functions.columns import (
    bucket_number, micros, numeric_columns, pair_key, ratio_or_zero,
)
from flowlens.functions.catalog import PAIR_FEATURES
from flowlens.functions.ordering import ROWS_PER_SLICE, slice_bounds, with_slice

SPREAD = 1024


def interval_features(df: DataFrame, key: str = "flow_id", src: str = "SrcAddr",
                      time: str = "StartTime", rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Seconds to the previous and the next flow of the same source (0 at the ends).

    Time is cut into slices of about equal row count, so a source with a third of all
    rows is spread over many tasks; each slice of a source then learns the last and
    first time of its neighbours from a small edge table. The instant that fills a
    slice by itself is cut further by key. Ties are ordered by key.
    """
    if time not in df.columns or src not in df.columns:
        return df
    numeric_key = key in numeric_columns(df)
    at = micros(df, time)
    keyed = [F.col(key)] if numeric_key else []
    rows, bounds, more = slice_bounds(df, at, rows_per_slice, keyed)
    flows = df.withColumn("_t", at)
    usable = F.col(src).isNotNull() & F.col("_t").isNotNull()
    # Rows without source or time keep 0 and must not meet in one task.
    idle = F.pmod(F.xxhash64(key), F.lit(SPREAD))
    if not bounds:
        part = F.when(usable, F.lit(-1)).otherwise(idle)
        inside = Window.partitionBy(src, part).orderBy("_t", key)
        before, after = F.lag("_t").over(inside), F.lead("_t").over(inside)
        return with_gaps(flows, before, after, usable).drop("_t")

    crowded = sorted({b for b in bounds if bounds.count(b) > 1})
    cuts = [*bounds, *[b + 1 for b in crowded]]
    flows = with_slice(flows.withColumn("_order", F.col("_t")), "_order", cuts, "_slice").drop("_order")
    flows = flows.withColumn("_sub", F.when(usable, F.lit(0)).otherwise(idle.cast("int")))
    if crowded and numeric_key:
        flows = with_slice(flows.withColumn("_order", F.col(key)), "_order", more[0], "_cut").drop("_order")
        flows = flows.withColumn("_sub", F.when(usable & F.col("_t").isin(crowded), F.col("_cut"))
                                 .otherwise(F.col("_sub"))).drop("_cut")
    groups = [src, "_slice", "_sub"]
    # One row per source and slice; a source has at most as many as there are slices.
    edges = flows.where(usable).groupBy(*groups).agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"))
    along = Window.partitionBy(src).orderBy("_slice", "_sub")
    edges = edges.select(*groups, F.lag("_last").over(along).alias("_prev"),
                         F.lead("_first").over(along).alias("_next"))
    inside = Window.partitionBy(*groups).orderBy("_t", key)
    flows = flows.withColumns({"_before": F.lag("_t").over(inside), "_after": F.lead("_t").over(inside)})
    flows = flows.join(edges, groups, "left")
    done = with_gaps(flows, F.coalesce("_before", "_prev"), F.coalesce("_after", "_next"), usable)
    return done.select(*df.columns, "time_since_last_flow", "time_to_next_flow")


def with_gaps(flows: DataFrame, before, after, usable) -> DataFrame:
    def seconds(gap):
        return F.when(usable, F.coalesce(gap / F.lit(1e6), F.lit(0.0))).otherwise(F.lit(0.0))

    return flows.withColumns({
        "time_since_last_flow": seconds(F.col("_t") - before),
        "time_to_next_flow": seconds(F.abs(after - F.col("_t"))),
    })


def src_window_table(df: DataFrame, size: str = "1min", approximate: bool = False) -> DataFrame:
    """One row per source and window: flows, distinct targets and ports, total bytes.

    All four come from one aggregate that combines on the map side.
    """
    unique = F.approx_count_distinct if approximate else F.count_distinct

    def count_of(name):
        return unique(F.col(name)) if name in df.columns else F.lit(0).cast("long")

    total = F.sum("TotBytes") if "TotBytes" in df.columns else F.lit(0)
    keyed = df.withColumn("_bucket", bucket_number(df, size))
    return (keyed.where(F.col("SrcAddr").isNotNull() & F.col("_bucket").isNotNull())
            .groupBy("SrcAddr", "_bucket").agg(
                F.count(F.lit(1)).alias("flows_per_minute_by_src"),
                count_of("DstAddr").alias("unique_dst_per_minute_by_src"),
                count_of("Dport").alias("unique_dport_per_minute_by_src"),
                F.coalesce(total, F.lit(0)).alias("total_bytes_per_minute_by_src")))


def src_window_features(df: DataFrame, size: str = "1min", approximate: bool = False) -> DataFrame:
    """Attach the source-window aggregates to every flow; no source or no time gives 0.

    A plain left equi-join: adaptive execution broadcasts the small side or splits the
    partition of a hot source, as the aggregate holds one row per source and window.
    """
    if "StartTime" not in df.columns or "SrcAddr" not in df.columns:
        return df
    table = src_window_table(df, size, approximate)
    names = table.columns[2:]
    joined = df.withColumn("_bucket", bucket_number(df, size)).join(table, ["SrcAddr", "_bucket"], "left")
    return joined.select(*df.columns, *[F.coalesce(n, F.lit(0)).alias(n) for n in names])


def pair_window_table(df: DataFrame, size: str = "1min") -> DataFrame:
    """One row per undirected address pair and window with its two-way aggregates."""
    a, b = pair_key()
    keyed = df.withColumns({"_a": a, "_b": b, "_bucket": bucket_number(df, size)})

    def total(name):
        return F.coalesce(F.sum(name), F.lit(0)) if name in df.columns else F.lit(0)

    duration = F.coalesce(F.avg("Dur"), F.lit(0.0)) if "Dur" in df.columns else F.lit(0.0)
    sums = (keyed.where(F.col("_a").isNotNull() & F.col("_bucket").isNotNull())
            .groupBy("_a", "_b", "_bucket").agg(
                F.count(F.lit(1)).alias("bidirectional_flow_count"),
                total("TotBytes").alias("bidirectional_total_bytes"),
                total("TotPkts").alias("bidirectional_total_packets"),
                total("SrcBytes").alias("bidirectional_total_src_bytes"),
                total("DstBytes").alias("bidirectional_total_dst_bytes"),
                duration.alias("bidirectional_avg_duration")))
    src, dst = F.col("bidirectional_total_src_bytes"), F.col("bidirectional_total_dst_bytes")
    flows = F.col("bidirectional_flow_count")
    return sums.withColumns({
        "bidirectional_symmetry": ratio_or_zero(F.least(src, dst), F.greatest(src, dst)),
        "bidirectional_avg_bytes_per_flow": ratio_or_zero(F.col("bidirectional_total_bytes"), flows),
        "bidirectional_avg_packets_per_flow": ratio_or_zero(F.col("bidirectional_total_packets"), flows),
        "bidirectional_window_flow_ratio": window_flow_ratio(src, dst),
    })


def window_flow_ratio(src, dst):
    """Up/down ratio of a window; 0 where it is undefined."""
    return ratio_or_zero(src, dst + 1)


def pair_window_features(df: DataFrame, size: str = "1min") -> DataFrame:
    """Attach the pair aggregates to every flow of the pair, both directions; missing gives 0."""
    if not {"StartTime", "SrcAddr", "DstAddr"} <= set(df.columns):
        return df.withColumns({n: F.lit(0.0) for n in PAIR_FEATURES})
    a, b = pair_key()
    table = pair_window_table(df, size)
    keyed = df.withColumns({"_a": a, "_b": b, "_bucket": bucket_number(df, size)})
    joined = keyed.join(table, ["_a", "_b", "_bucket"], "left")
    kept = [c for c in df.columns if c not in PAIR_FEATURES]
    return joined.select(*kept, *[F.coalesce(n, F.lit(0)).alias(n) for n in PAIR_FEATURES])


def top_sources(df: DataFrame, n: int = 10, count: str = "flows_per_minute_by_src") -> DataFrame:
    """Sources by their busiest window."""
    return (df.groupBy("SrcAddr").agg(F.max(count).alias("max_flows"))
            .orderBy(F.desc("max_flows"), "SrcAddr").limit(n))


def symmetry_profile(df: DataFrame, column: str = "bidirectional_symmetry") -> DataFrame:
    """Mean symmetry with the count and share of nearly two-way and one-way rows."""
    value, total = F.col(column), F.count(F.lit(1))
    high, low = F.count_if(value > 0.9), F.count_if(value < 0.1)
    return df.agg(F.avg(value).alias("mean_symmetry"),
                  high.alias("two_way_rows"), ratio_or_zero(high, total).alias("two_way_share"),
                  low.alias("one_way_rows"), ratio_or_zero(low, total).alias("one_way_share"))


def port_entropy(df: DataFrame, size: str = "1min") -> DataFrame:
    """Entropy (bits) of the destination ports each source used per window."""
    keyed = df.withColumn("_bucket", bucket_number(df, size))
    ports = (keyed.where("SrcAddr is not null and _bucket is not null and Dport is not null")
             .groupBy("SrcAddr", "_bucket", "Dport").agg(F.count(F.lit(1)).alias("c")))
    # With n flows in the window: -sum(c/n log2(c/n)) = log2(n) - sum(c log2(c)) / n.
    n = F.sum("c")
    return ports.groupBy("SrcAddr", "_bucket").agg(
        n.alias("flows"), F.greatest(F.log2(n.cast("double")) - F.sum(F.col("c") * F.log2(F.col("c").cast("double"))) / n,
                                     F.lit(0.0)).alias("dport_entropy"))


# Ports of file sharing and remote desktop.
LATERAL_PORTS = {"smb": 445, "rdp": 3389}


def lateral_features(df: DataFrame, size: str = "1min", ports=None) -> DataFrame:
    """Flows and distinct targets per source and window on ports used to move sideways."""
    keyed = df.withColumn("_bucket", bucket_number(df, size))
    picked = []
    for name, port in (ports or LATERAL_PORTS).items():
        here = F.col("Dport") == port
        picked += [F.count_if(here).alias(f"{name}_flows"),
                   F.count_distinct(F.when(here, F.col("DstAddr"))).alias(f"{name}_targets")]
    return keyed.where("SrcAddr is not null and _bucket is not null").groupBy("SrcAddr", "_bucket").agg(*picked)
