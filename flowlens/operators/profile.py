"""Distribution profiles of flow tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowlens.functions.catalog import SKEWED_FEATURES
from flowlens.functions.columns import INF, numeric_columns, ratio_or_zero, require
from flowlens.functions.quantiles import exact_quantiles, melt

# Features compared between protocols.
COMPARED = ["TotBytes", "TotPkts", "Dur", "SrcBytes", "DstBytes"]


def missing_profile(df: DataFrame) -> DataFrame:
    """Missing rows and percent per column, most first; one pass over all columns."""
    counts = df.agg(F.count(F.lit(1)).alias("_total"),
                    *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return (counts.unpivot("_total", df.columns, "feature", "missing")
            .select("feature", "missing",
                    (ratio_or_zero(F.col("missing"), F.col("_total")) * 100).alias("missing_percent"))
            .orderBy(F.desc("missing"), "feature"))


def describe_numeric(df: DataFrame, columns=None, by=(), key: str = "flow_id", **kw) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column (and group)."""
    columns = columns or [c for c in numeric_columns(df) if c != key and c not in by]
    long = melt(df, columns, by)
    kw.setdefault("few_groups", not by)  # one for each column
    found = exact_quantiles(long, [*by, "feature"], "value", [0.25, 0.5, 0.75], extra=[
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max")], **kw)
    q = F.col("q")
    return found.select(*by, "feature", F.col("n").alias("count"), "mean", "std", "min",
                        q[0].alias("q25"), q[1].alias("q50"), q[2].alias("q75"), "max")


def time_range(df: DataFrame, time: str = "StartTime") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.min(time).alias("first"), F.max(time).alias("last"))


def long_tail(df: DataFrame, features=None, **kw) -> DataFrame:
    """Shape of each feature's distribution; kurtosis of a normal distribution is 3."""
    features = [f for f in (features or SKEWED_FEATURES) if f in df.columns]
    found = exact_quantiles(melt(df, features), ["feature"], "value", [0.5, 0.25, 0.75, 0.95, 0.99], few_groups=True, extra=[
        F.skewness("value").alias("skewness"), (F.kurtosis("value") + 3).alias("kurtosis"),
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std")], **kw)
    q = F.col("q")
    tail = F.coalesce((F.abs("skewness") > 1) | (F.col("kurtosis") > 5), F.lit(False))
    return found.where("n > 0").select(
        "feature", "skewness", "kurtosis", "mean", q[0].alias("median"), "std", q[1].alias("q25"),
        q[2].alias("q75"), q[3].alias("q95"), q[4].alias("q99"), tail.alias("is_long_tail"))


def long_tail_ranking(df: DataFrame, features=None, n: int = 10) -> DataFrame:
    """Long-tailed features by absolute skewness."""
    return (long_tail(df, features).where("is_long_tail").select("feature", "skewness", "kurtosis")
            .orderBy(F.desc(F.abs("skewness")), "feature").limit(n))


def protocol_profile(df: DataFrame, col: str = "Proto", columns=None, key: str = "flow_id") -> DataFrame:
    """Rows, share and column statistics of UDP and TCP flows."""
    require(df, [col])
    total = df.count()
    columns = columns or [c for c in numeric_columns(df) if c != key]
    chosen = df.withColumn("protocol", F.lower(col)).where(F.col("protocol").isin("udp", "tcp"))
    sizes = chosen.groupBy("protocol").agg(F.count(F.lit(1)).alias("rows"))
    sizes = sizes.withColumn("share", ratio_or_zero(F.col("rows"), F.lit(total)))
    # Two rows at most.
    return describe_numeric(chosen, columns, ["protocol"]).join(F.broadcast(sizes), "protocol")


def protocol_mean_ratio(df: DataFrame, col: str = "Proto") -> DataFrame:
    """UDP mean over TCP mean per feature; infinite where the TCP mean is 0."""
    features = [f for f in COMPARED if f in df.columns]
    name = F.lower(col)
    means = df.agg(*[F.struct(F.avg(F.when(name == "udp", F.col(f))).alias("u"),
                              F.avg(F.when(name == "tcp", F.col(f))).alias("t")).alias(f) for f in features])
    udp, tcp = F.col("m.u"), F.col("m.t")
    return means.unpivot([], features, "feature", "m").select(
        "feature", udp.alias("udp_mean"), tcp.alias("tcp_mean"),
        F.when(tcp == 0, F.lit(INF)).otherwise(F.try_divide(udp, tcp)).alias("udp_tcp_ratio"))


def protocol_counts(df: DataFrame, col: str = "Proto") -> DataFrame:
    """Total, UDP, TCP and other rows."""
    name, total = F.lower(col), F.count(F.lit(1))
    udp, tcp = F.count_if(name == "udp"), F.count_if(name == "tcp")
    return df.agg(total.alias("total"), udp.alias("udp"), tcp.alias("tcp"), (total - udp - tcp).alias("other"))


def flat_features_by_protocol(df: DataFrame, col: str = "Proto", columns=None, threshold: float = 1e-6,
                              key: str = "flow_id") -> DataFrame:
    """Features that are constant or hardly vary inside one protocol."""
    columns = columns or [c for c in numeric_columns(df) if c != key]
    long = melt(df, columns, [F.lower(col).alias("protocol")])
    stats = long.groupBy("protocol", "feature").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.var_samp("value").alias("variance"))
    constant = F.coalesce(F.col("lo") == F.col("hi"), F.lit(True))
    low = F.coalesce(F.col("variance") < threshold, F.lit(False))
    return (stats.select("protocol", "feature", constant.alias("is_constant"), low.alias("is_low_variance"))
            .where("is_constant or is_low_variance"))


def histogram(df: DataFrame, feature: str, bins: int = 50, log: bool = False, by=()) -> DataFrame:
    """Equal-width bin counts of a feature or of its log1p; the top edge is inside the last bin."""
    value = F.col(feature).cast("double")
    data = df.select(*by, (F.log1p(value) if log else value).alias("v")).where("v is not null")
    lo, hi = data.agg(F.min("v"), F.max("v")).first()
    if lo is None:
        lo, hi = 0.0, 1.0
    elif lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    edge = F.least(F.width_bucket("v", F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins))
    return (data.groupBy(*by, edge.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("low_edge", F.lit(lo) + (F.col("bin") - 1) * F.lit((hi - lo) / bins)))


def box_summary(df: DataFrame, feature: str, by: str | None = None) -> DataFrame:
    """Quartiles, whiskers at 1.5 IQR and the number of points beyond, per group if asked."""
    group = F.col(by) if by else F.lit("all")
    data = df.select(group.alias("grp"), F.col(feature).cast("double").alias("v")).where("v is not null")
    found = exact_quantiles(data, ["grp"], "v", [0.25, 0.5, 0.75])
    q = F.col("q")
    box = found.select(F.col("grp").alias("g"), q[0].alias("q25"), q[1].alias("median"), q[2].alias("q75"))
    reach = (F.col("q75") - F.col("q25")) * 1.5
    inside = F.col("v").between(F.col("q25") - reach, F.col("q75") + reach)
    joined = data.join(box, F.col("grp").eqNullSafe(F.col("g")))
    return joined.groupBy("grp", "q25", "median", "q75").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"), F.count_if(~inside).alias("outliers"))


def profile_flows(df: DataFrame) -> dict[str, DataFrame]:
    """Featured flows with their long-tail and protocol profiles."""
    from flowlens.plans.features import extract_features

    featured = extract_features(df, 1)
    out = {"features": featured, "long_tail": long_tail(featured)}
    if "Proto" in df.columns:
        out["protocols"] = protocol_profile(featured)
    return out
