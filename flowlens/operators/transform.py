"""Fitted transforms. Fits are one or two aggregates; what they learn is a few numbers per
feature, which go into the projection as literals."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from flowlens.functions.catalog import SKEWED_FEATURES
from flowlens.functions.columns import finite, numeric_columns, ratio_or_zero, require
from flowlens.functions.quantiles import column_quantiles, melt
from flowlens.sources.stores import PARAM_SCHEMA

# The transforms compared for each feature, in order of preference.
TRANSFORMS = ["original", "log1p", "sqrt", "boxcox", "yeo-johnson"]
NEAR_ZERO = 1e-10
#: Half widths of the ranges in which a lambda is sought, and the lambdas tried in each.
LAMBDA_SPANS = (5.0, 0.9, 0.05)
LAMBDA_POINTS = 13
GRID = 1000
BINS = 4096


def column_minima(df: DataFrame, columns) -> dict[str, float | None]:
    row = df.agg(*[F.min(F.col(c).cast("double")).alias(c) for c in columns]).first()
    return row.asDict()


def shifted(name: str, minimum: float | None, curve) -> Column:
    """Apply a curve after moving negative data up to 0; an all-missing column becomes 0."""
    if minimum is None:
        return F.lit(0.0)
    return curve(F.col(name).cast("double") - min(minimum, 0.0))


def apply_shifted(df: DataFrame, columns, prefix: str, curve, minima) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    minima = minima or column_minima(df, present)
    return df.withColumns({prefix + c: shifted(c, minima[c], curve) for c in present})


def log_transform(df: DataFrame, cols, prefix: str = "log_", minima=None) -> DataFrame:
    """log1p with a shift for negative data; an empty prefix replaces the column.

    ``minima`` reuses the shifts fitted on another table.
    """
    return apply_shifted(df, cols, prefix, F.log1p, minima)


def sqrt_transform(df: DataFrame, cols, prefix: str = "sqrt_", minima=None) -> DataFrame:
    return apply_shifted(df, cols, prefix, F.sqrt, minima)


def boxcox_value(x: Column, lam) -> Column:
    lam = F.lit(lam) if not isinstance(lam, Column) else lam
    return F.when(F.abs(lam) < NEAR_ZERO, F.ln(x)).otherwise(F.try_divide(F.pow(x, lam) - 1, lam))


def boxcox_shift(minimum: float | None) -> float:
    return 1.0 - minimum if minimum is not None and minimum <= 0 else 0.0


def boxcox_apply(df: DataFrame, col: str, lam: float, shift: float = 0.0, out: str | None = None) -> DataFrame:
    """Box-Cox with a known lambda."""
    value = F.col(col).cast("double") + shift
    value = F.greatest(value, F.lit(NEAR_ZERO)) if shift else value
    return df.withColumn(out or f"boxcox_{col}", F.when(F.col(col).isNotNull(), boxcox_value(value, lam)))


def yeojohnson_value(x: Column, lam) -> Column:
    """Yeo-Johnson: Box-Cox of x + 1 above zero, of 1 - x with mirrored lambda below."""
    lam = F.lit(lam) if not isinstance(lam, Column) else lam
    return F.when(x >= 0, boxcox_value(x + 1, lam)).otherwise(-boxcox_value(1 - x, 2 - lam))


def fit_lambdas(df: DataFrame, cols, method: str = "box-cox") -> dict[str, float]:
    """Maximum-likelihood lambda per feature, to six digits.

    Three passes over the table score ``LAMBDA_POINTS`` lambdas of every feature each, as columns of one aggregate
    without a shuffle of rows; the top of the parabola through the best three is the middle of the next, narrower
    range. A feature whose transformed values never differ has no lambda.
    """
    cols = [c for c in cols if c in df.columns]
    if method == "box-cox":
        shifts = {c: boxcox_shift(m) for c, m in column_minima(df, cols).items()}
        values = {c: F.col(c).cast("double") + shifts[c] for c in cols}
        curve, log_term = boxcox_value, F.ln
    elif method == "yeo-johnson":
        values = {c: F.col(c).cast("double") for c in cols}
        curve, log_term = yeojohnson_value, lambda v: F.signum(v) * F.log1p(F.abs(v))
    else:
        raise ValueError(f"unknown method: {method!r}")
    best = dict.fromkeys(cols, 0.0)
    for span in LAMBDA_SPANS:
        grids = {c: best[c] + np.linspace(-span, span, LAMBDA_POINTS) for c in best}
        if not grids:
            break
        found = df.agg(*[F.struct(
            F.count(values[c]).alias("n"), F.sum(log_term(values[c])).alias("lg"),
            F.array(*[F.var_pop(curve(values[c], float(lam))) for lam in grid]).alias("var")).alias(f"l{i}")
            for i, (c, grid) in enumerate(grids.items())]).first()
        best = {}
        for i, (c, grid) in enumerate(grids.items()):
            scored = [((lam - 1) * found[i]["lg"] - found[i]["n"] / 2 * np.log(var), lam)
                      for lam, var in zip(grid, found[i]["var"], strict=True) if var is not None and var > 0]
            if scored:
                likes, lams = map(np.array, zip(*scored, strict=True))
                at = int(np.argmax(likes))
                best[c] = peak(lams[at - 1:at + 2], likes[at - 1:at + 2]) if 0 < at < len(lams) - 1 else float(lams[at])
    return {c: round(lam, 6) for c, lam in best.items()}


def peak(x, y) -> float:
    """Top of the parabola through three equally spaced points."""
    bend = y[0] - 2 * y[1] + y[2]
    if bend >= 0:
        return float(x[1])
    return float(x[1] + (x[1] - x[0]) * np.clip(0.5 * (y[0] - y[2]) / bend, -1, 1))


def boxcox_transform(df: DataFrame, cols, prefix: str = "boxcox_") -> tuple[DataFrame, dict[str, float]]:
    """Box-Cox with fitted lambdas; data at or below zero is moved to start at 1."""
    cols = [c for c in cols if c in df.columns]
    lambdas, minima = fit_lambdas(df, cols, "box-cox"), column_minima(df, cols)
    for c, lam in lambdas.items():
        df = boxcox_apply(df, c, lam, boxcox_shift(minima[c]), prefix + c)
    return df, lambdas


def yeojohnson_transform(df: DataFrame, cols, prefix: str = "yeoj_") -> tuple[DataFrame, dict[str, float]]:
    lambdas = fit_lambdas(df, cols, "yeo-johnson")
    return df.withColumns({prefix + c: yeojohnson_value(F.col(c).cast("double"), lam)
                           for c, lam in lambdas.items()}), lambdas


def robust_fit(df: DataFrame, cols, centering: bool = True, scaling: bool = True, **kw) -> dict:
    """Median and IQR per column; a zero IQR scales by 1, missing values are ignored."""
    require(df, cols)
    typed = df.select(*[finite(F.col(c)).alias(c) for c in cols])
    params = {}
    for c, q in column_quantiles(typed, cols, [0.25, 0.5, 0.75], **kw).items():
        q25, q50, q75 = q or (0.0, 0.0, 1.0)
        params[c] = (q50 if centering else 0.0, ((q75 - q25) or 1.0) if scaling else 1.0)
    return {c: params[c] for c in cols}


def standard_fit(df: DataFrame, cols) -> dict:
    """Mean and population deviation per column; a zero deviation scales by 1."""
    require(df, cols)
    value = {c: finite(F.col(c)) for c in cols}
    row = df.agg(*[F.struct(F.avg(value[c]), F.stddev_pop(value[c])).alias(c) for c in cols]).first()
    return {c: (row[c][0] or 0.0, row[c][1] or 1.0) for c in cols}


def scale_apply(df: DataFrame, params: dict) -> DataFrame:
    """(x - center) / scale in place, with the fitted numbers as literals."""
    return df.withColumns({c: (F.col(c).cast("double") - center) / F.lit(scale)
                           for c, (center, scale) in params.items()})


robust_apply = standard_apply = scale_apply


def params_table(spark: SparkSession, params: dict) -> DataFrame:
    return spark.createDataFrame([(c, float(a), float(b)) for c, (a, b) in params.items()], PARAM_SCHEMA)


def params_from(table: DataFrame) -> dict:
    """Scaler parameters back from their table (one row per feature)."""
    return {r["feature"]: (r["center"], r["scale"]) for r in table.collect()}


def model_columns(df: DataFrame, skewed, features=None, prefix: str = "log_", replace: bool = False,
                  key: str = "flow_id") -> list[str]:
    """Which columns are scaled: the log columns first, then other numbers, or the given list."""
    if features is None:
        logs = list(skewed) if replace else [prefix + c for c in skewed]
        rest = [c for c in numeric_columns(df)
                if c not in skewed and not c.startswith(prefix) and c != key]
        return logs + rest
    named = [prefix + c if c in skewed and not replace else c for c in features]
    made = set(df.columns) | {prefix + c for c in skewed}
    return [c for c in named if c in made]


def fit_for_unsupervised(df: DataFrame, skewed=None, features=None, prefix: str = "log_",
                         replace: bool = False, key: str = "flow_id") -> dict:
    """Everything the log and robust scaling steps learn from a table: two aggregates."""
    skewed = [c for c in (SKEWED_FEATURES if skewed is None else skewed) if c in df.columns]
    columns = model_columns(df, skewed, features, prefix, replace, key)
    if not columns:
        raise ValueError("no numeric feature to scale")
    minima = df.agg(*[F.min(F.col(c).cast("double")).alias(c) for c in skewed]).first().asDict() if skewed else {}
    moved = log_transform(df, skewed, "" if replace else prefix, minima) if skewed else df
    return {"skewed": skewed, "minima": minima, "prefix": "" if replace else prefix, "columns": columns,
            "params": robust_fit(moved, columns)}


def apply_for_unsupervised(df: DataFrame, fitted: dict) -> DataFrame:
    moved = log_transform(df, fitted["skewed"], fitted["prefix"], fitted["minima"]) if fitted["skewed"] else df
    return scale_apply(moved, fitted["params"])


def transform_for_unsupervised(df: DataFrame, skewed=None, features=None, prefix: str = "log_",
                               replace: bool = False, key: str = "flow_id") -> tuple[DataFrame, dict, list[str]]:
    """log1p of the skewed features, then robust scaling: data, parameters, column list."""
    fitted = fit_for_unsupervised(df, skewed, features, prefix, replace, key)
    return apply_for_unsupervised(df, fitted), fitted["params"], fitted["columns"]


def moments(value: Column) -> list[Column]:
    return [F.count(value).alias("n"), F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"),
            F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("std"),
            F.coalesce(F.skewness(value), F.lit(0.0)).alias("skewness"),
            F.coalesce(F.kurtosis(value) + 3, F.lit(0.0)).alias("kurtosis")]


def is_normal_like() -> Column:
    return (F.col("n") > 0) & (F.abs("skewness") < 0.5) & (F.abs(F.col("kurtosis") - 3) < 1)


def class_effect(value: Column, label: Column) -> Column:
    """Cohen's d between the two label classes, 0 where it is undefined."""
    def part(fn, which):
        return fn(F.when(label == which, value))

    gap = F.abs(part(F.avg, 0) - part(F.avg, 1))
    spread = F.sqrt((F.pow(part(F.stddev_samp, 0), 2) + F.pow(part(F.stddev_samp, 1), 2)) / 2)
    return F.coalesce(F.try_divide(gap, spread), F.lit(0.0))


def transform_metrics(df: DataFrame, cols, label: str | None = None) -> DataFrame:
    """Mean, deviation, shape and (with a label) class separation per column, in one pass."""
    long = melt(df, cols, [label] if label else [])
    value = finite(F.col("value"))
    extra = [class_effect(value, F.col(label)).alias("cohens_d")] if label else []
    return long.groupBy("feature").agg(*moments(value), *extra).withColumn("is_normal_like", is_normal_like())


def cohens_d(df: DataFrame, cols, label: str = "label_binary") -> DataFrame:
    long = melt(df, cols, [label])
    return long.groupBy("feature").agg(class_effect(finite(F.col("value")), F.col(label)).alias("cohens_d"))


def overlap_of_bins(pdf: pd.DataFrame) -> float:
    """Shared area of two Gaussian kernel densities, from at most BINS weighted points each."""
    classes = [g for _, g in pdf.groupby("label")]
    if len(classes) < 2 or any(len(g) == 0 or not g["std"].iloc[0] > 0 for g in classes):
        return 1.0
    grid = np.linspace(pdf["lo"].min(), pdf["hi"].max(), GRID)
    curves = []
    for g in classes:
        total = g["c"].sum()
        width = g["std"].iloc[0] * total ** -0.2
        curve = np.zeros(GRID)
        for part in np.array_split(np.arange(len(g)), max(1, len(g) // 512)):
            z = (grid[:, None] - g["x"].to_numpy()[None, part]) / width
            curve += np.exp(-0.5 * z * z) @ g["c"].to_numpy()[part]
        curves.append(curve / (total * width * np.sqrt(2 * np.pi)))
    total = sum(np.trapezoid(c, grid) for c in curves)
    return float(np.trapezoid(np.minimum(*curves), grid) / total) if total > 0 else 1.0


def long_overlap(long: DataFrame, keys: list[str]) -> DataFrame:
    """Density overlap per key over (keys, label, value).

    Values are binned in the engine, so a key arrives in Python as at most 2 x BINS rows.
    """
    data = long.where(F.col("value").isNotNull() & F.col("label").isin(0, 1))
    ranges = data.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    spread = data.groupBy(*keys, "label").agg(F.stddev_samp("value").alias("std"))
    # Both tables hold one or two rows per feature and transform.
    binned = data.join(F.broadcast(ranges), keys)
    spot = F.when(F.col("lo") == F.col("hi"), 1).otherwise(F.least(
        F.width_bucket("value", "lo", "hi", F.lit(BINS)), F.lit(BINS)))
    bins = (binned.groupBy(*keys, "label", spot.alias("bin"))
            .agg(F.count(F.lit(1)).alias("c"), F.avg("value").alias("x"),
                 F.first("lo").alias("lo"), F.first("hi").alias("hi"))
            .join(F.broadcast(spread), [*keys, "label"]))

    def one(pdf):
        return pd.DataFrame([[*[pdf[k].iloc[0] for k in keys], overlap_of_bins(pdf)]],
                            columns=[*keys, "density_overlap"])

    schema = ", ".join(f"`{k}` string" for k in keys) + ", density_overlap double"
    # Few bytes but much work per row: one task per core, which coalescing would undo.
    bins = bins.repartition(long.sparkSession.sparkContext.defaultParallelism, *keys)
    return bins.groupBy(*keys).applyInPandas(one, schema)


def density_overlap(df: DataFrame, cols, label: str = "label_binary") -> DataFrame:
    """Overlap of the class densities per column; 1.0 where it is undefined."""
    long = melt(df, cols, [F.col(label).alias("label")]).withColumn("value", finite(F.col("value")))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "feature string")
    return (names.join(long_overlap(long, ["feature"]), "feature", "left")
            .select("feature", F.coalesce("density_overlap", F.lit(1.0)).alias("density_overlap")))


def score_transform(table: DataFrame) -> DataFrame:
    """Score from separation (50), shape (30 + 10) and class overlap (20)."""
    separation = F.least(F.col("cohens_d") / 2.0 * 50, F.lit(50.0))
    shape = F.col("is_normal_like").cast("int") * 30 + (F.abs("skewness") < 1).cast("int") * 10
    return table.withColumns({
        "separation_score": separation, "distribution_score": shape.cast("double"),
        "overlap_score": (1 - F.col("density_overlap")) * 20,
        "total_score": separation + shape + (1 - F.col("density_overlap")) * 20})


def transform_columns(features, minima, boxcox, yeoj) -> dict[tuple[str, str], Column]:
    """Every (feature, transform) that could be fitted, as a column expression."""
    out = {}
    for f in features:
        x = F.col(f).cast("double")
        out[(f, "original")] = x
        out[(f, "log1p")] = shifted(f, minima[f], F.log1p)
        out[(f, "sqrt")] = shifted(f, minima[f], F.sqrt)
        if f in boxcox:
            moved = F.greatest(x + boxcox_shift(minima[f]), F.lit(NEAR_ZERO))
            out[(f, "boxcox")] = F.when(x.isNotNull(), boxcox_value(moved, boxcox[f]))
        if f in yeoj:
            out[(f, "yeo-johnson")] = yeojohnson_value(x, yeoj[f])
    return out


def compare_transforms(df: DataFrame, features, label: str = "label_binary") -> DataFrame:
    """Metrics and score of each transform of each feature; ``is_best`` marks the winner.

    Everything, the lambdas too, is fitted on all rows. All features and transforms go through the same few jobs as rows of one long table.
    """
    features = [f for f in features if f in df.columns]
    boxcox, yeoj = fit_lambdas(df, features), fit_lambdas(df, features, "yeo-johnson")
    columns = transform_columns(features, column_minima(df, features), boxcox, yeoj)
    wide = df.select(F.col(label).alias("label"), *[c.alias(f"{f}|{t}") for (f, t), c in columns.items()])
    long = wide.unpivot("label", wide.columns[1:], "pair", "value")
    long = long.withColumn("value", finite(F.col("value")))
    value = F.col("value")
    stats = long.groupBy("pair").agg(
        *moments(value), class_effect(value, F.col("label")).alias("cohens_d"),
        (F.count_if(F.col("label") == 0) * F.count_if(F.col("label") == 1) > 0).alias("both"))
    lambdas = F.create_map(*[F.lit(x) for f, d, n in [(f, d, n) for d, n in ((boxcox, "boxcox"), (yeoj, "yeo-johnson"))
                                                      for f in d] for x in (f"{f}|{n}", float(d[f]))]) \
        if boxcox or yeoj else F.lit(None).cast("map<string,double>")
    table = stats.join(long_overlap(long, ["pair"]), "pair", "left").withColumns({
        "is_normal_like": is_normal_like(),
        "density_overlap": F.coalesce("density_overlap", F.lit(1.0)), "lambda": lambdas[F.col("pair")]})
    table = score_transform(table).withColumns({
        "feature": F.split("pair", r"\|")[0], "transform": F.split("pair", r"\|")[1],
        "total_score": F.when(F.col("both"), F.col("total_score")).otherwise(0.0)})
    rank = F.array_position(F.array(*[F.lit(t) for t in TRANSFORMS]), F.col("transform"))
    # At most five rows per feature; scores alike to nine digits count as equal.
    order = Window.partitionBy("feature").orderBy(F.desc(F.round("total_score", 9)), rank)
    return table.withColumn("is_best", F.row_number().over(order) == 1).select(
        "feature", "transform", "lambda", "cohens_d", "skewness", "kurtosis", "is_normal_like",
        "density_overlap", "separation_score", "distribution_score", "overlap_score", "total_score", "is_best")


def apply_best(df: DataFrame, comparison: DataFrame, key: str = "flow_id") -> tuple[DataFrame, dict]:
    """Each feature under its best transform, then all of them robust scaled."""
    best = {r["feature"]: r for r in comparison.where("is_best").collect()}  # one row per feature
    features = [f for f in df.columns if f in best]
    fitted = {n: {f: r["lambda"] for f, r in best.items() if r["transform"] == n} for n in ("boxcox", "yeo-johnson")}
    columns = transform_columns(features, column_minima(df, features), fitted["boxcox"], fitted["yeo-johnson"])
    moved = df.withColumns({f: columns[(f, best[f]["transform"])] for f in features})
    params = robust_fit(moved, features)
    return scale_apply(moved, params), params
