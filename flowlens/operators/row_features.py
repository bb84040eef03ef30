"""Features that need only the row itself."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from flowlens.functions.catalog import (
    BASE_FEATURES, FAMILIES, NON_FEATURES, SCAN_STATES, SKEWED_FEATURES, feature_names,
    transformed_names,
)
from flowlens.functions.columns import finite, flag, numeric_columns, ratio, ratio_or_zero, require


def row_features(df: DataFrame, prefix_states: bool = False) -> DataFrame:
    """Size, symmetry and rate features of one flow."""
    if "DstBytes" not in df.columns:
        require(df, ["TotBytes", "SrcBytes"])
        df = df.withColumn("DstBytes", F.col("TotBytes") - F.col("SrcBytes"))
    require(df, ["TotBytes", "TotPkts", "SrcBytes", "Dur"])
    src, dst, tot, pkts = (F.col(c).cast("double") for c in ("SrcBytes", "DstBytes", "TotBytes", "TotPkts"))
    seconds = F.col("Dur") + 1
    symmetry = ratio(dst, src + 1)
    if "State" not in df.columns:
        scanning = symmetry < 0.1
    elif prefix_states:
        scanning = F.col("State").rlike("^(" + "|".join(SCAN_STATES) + ")")
    else:
        scanning = F.col("State").isin(SCAN_STATES)
    return df.withColumns({
        "flow_ratio": ratio(src, dst + 1),
        "bytes_symmetry": symmetry,
        "src_ratio": ratio_or_zero(src, tot) * 100,
        "dst_ratio": ratio_or_zero(dst, tot) * 100,
        "packet_size": ratio(tot, pkts + 1),
        "bytes_per_second": ratio(tot, seconds),
        "packets_per_second": ratio(pkts, seconds),
        "is_scanning": flag(scanning),
    })


def calendar_features(df: DataFrame, time: str = "StartTime") -> DataFrame:
    """Clock and calendar parts with cyclic encodings; weeks start on Monday (0)."""
    if time not in df.columns:
        return df
    at = F.col(time)
    hour, weekday, day = F.hour(at), F.weekday(at), F.dayofmonth(at)
    columns = {
        "hour": hour, "day_of_week": weekday, "day_of_month": day,
        "is_weekend": flag(weekday >= 5),
        "is_work_hour": flag((hour >= 9) & (hour < 17)),
        "is_night": flag((hour >= 22) | (hour < 6)),
    }
    for name, part, period in (("hour", hour, 24), ("day_of_week", weekday, 7), ("day_of_month", day, 30)):
        angle = part * F.lit(2 * math.pi / period)
        columns[f"sin_{name}"], columns[f"cos_{name}"] = F.sin(angle), F.cos(angle)
    return df.withColumns(columns)


def finalize_numeric(df: DataFrame, key: str = "flow_id") -> DataFrame:
    """Replace NaN, infinities and missing values of numeric columns by 0."""
    out = {}
    for field in df.schema.fields:
        if field.name == key or field.name not in numeric_columns(df):
            continue
        kind = field.dataType.simpleString()
        value = finite(F.col(field.name)) if kind in ("double", "float") else F.col(field.name)
        out[field.name] = F.coalesce(value, F.lit(0)).cast(kind)
    return df.withColumns(out) if out else df


def fill_for_agg(df: DataFrame, columns) -> DataFrame:
    """Missing text becomes '' and missing numbers become 0, in the given columns."""
    kinds = dict(df.dtypes)
    fill = {c: "" if kinds[c] == "string" else 0 for c in columns if c in kinds
            and (kinds[c] == "string" or c in numeric_columns(df))}
    return df.fillna(fill) if fill else df


def prepare_feature_set(df: DataFrame, key: str = "flow_id", include_base: bool = True,
                        include_time: bool = True, stage: int = 4) -> DataFrame:
    """The key and the model inputs that exist, base features first."""
    wanted = (BASE_FEATURES if include_base else []) + feature_names(stage, include_time)
    names = list(dict.fromkeys(n for n in wanted if n in df.columns))
    return df.select(key, *names)


def numeric_features(df: DataFrame, key: str = "flow_id") -> DataFrame:
    """The key and every numeric column that is a feature."""
    names = [c for c in numeric_columns(df) if c not in NON_FEATURES and c != key]
    return df.select(key, *names)


def feature_breakdown(df: DataFrame, skewed=None) -> DataFrame:
    """Catalog table: feature, family, stage, whether skewed, transformed name, presence."""
    skewed = SKEWED_FEATURES if skewed is None else skewed
    known = [("base", 0, BASE_FEATURES), *FAMILIES]
    rows = [(n, family, stage, n in skewed, transformed_names([n], skewed)[0], n in df.columns)
            for family, stage, names in known for n in names]
    named = {r[0] for r in rows} | set(NON_FEATURES)
    rows += [(n, "other", 0, n in skewed, transformed_names([n], skewed)[0], True)
             for n in numeric_columns(df) if n not in named and n != "flow_id"]
    return df.sparkSession.createDataFrame(
        rows, "feature string, family string, stage int, skewed boolean, transformed string, present boolean")


def breakdown_counts(df: DataFrame, skewed=None) -> DataFrame:
    """Features per family: known, present and skewed, with the filled cells of those present."""
    catalog = feature_breakdown(df, skewed)
    present = [c for c in numeric_columns(df) if c not in NON_FEATURES and c != "flow_id"]
    counts = df.agg(*[F.count(c).alias(c) for c in present])
    filled = counts.unpivot([], counts.columns, "feature", "filled")  # one row per column
    return (catalog.join(F.broadcast(filled), "feature", "left").groupBy("family").agg(
        F.count(F.lit(1)).alias("known"), F.count_if("present").alias("present"),
        F.count_if(F.col("skewed") & F.col("present")).alias("skewed"),
        F.coalesce(F.sum("filled"), F.lit(0)).alias("filled_cells")))
