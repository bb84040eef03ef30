"""The paths taken at scale give the same results as the small ones, also under heavy skew."""

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from flowlens.functions.ordering import running_sums
from flowlens.functions.quantiles import column_quantiles, exact_quantile, exact_quantiles
from flowlens.operators import forest, sampling, select, thresholds, transform, windows

PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.9, 0.999, 1.0]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the values equal, a third in one group, some missing."""
    rng = np.random.default_rng(7)
    n = 30_000
    value = np.where(np.arange(n) % 3 == 0, 5.0, rng.lognormal(2, 2, n)).round(3)
    group = np.where(np.arange(n) % 3 == 1, 0, rng.integers(0, 5, n))
    rows = [(int(g), float(v) if i % 101 else None) for i, (g, v) in enumerate(zip(group, value))]
    return spark.createDataFrame(rows, "g int, v double").repartition(6).cache()


@pytest.mark.parametrize("accuracy, whole", [(10_000, 100_000), (200, 1_500), (1_000, 5_000)])
def test_quantiles_equal_numpy(skewed, accuracy, whole):
    pdf = skewed.toPandas().dropna()
    kw = {"accuracy": accuracy, "whole_rows": whole}
    for r in exact_quantiles(skewed, ["g"], "v", PROBS, **kw).collect():
        part = pdf[pdf.g == r["g"]].v
        assert r["n"] == len(part)
        assert r["q"] == pytest.approx(list(np.quantile(part, PROBS)), rel=1e-12)
    assert exact_quantile(skewed, "v", 0.37, **kw) == pytest.approx(np.quantile(pdf.v, 0.37), rel=1e-12)


@pytest.mark.parametrize("whole", [100_000, 1_000])
def test_odd_values_count_alike_at_every_size(spark, whole):
    """NaN is missing, infinities are values, and a thin stretch between two heavy values is found."""
    inf = float("inf")
    rows = [(0, float(i % 7) if i % 4 else float("nan")) for i in range(4_000)]
    rows += [(1, inf if i % 3 else -inf) for i in range(3_000)]
    rows += [(2, 1.0 if i < 2_000 else 9.0 if i >= 2_050 else 2.0 + i / 1_000) for i in range(4_050)]
    rows += [(3, None), (None, 5.0), (None, 6.0)]
    data = spark.createDataFrame(rows, "g int, v double").repartition(5)
    probs = [0.1, 0.25, 0.4945, 0.5, 0.75]
    got = {r["g"]: r for r in exact_quantiles(data, ["g"], "v", probs, accuracy=300, whole_rows=whole).collect()}
    for g in (0, 2):
        values = [v for k, v in rows if k == g and v == v]
        assert got[g]["n"] == len(values) and got[g]["q"] == pytest.approx(list(np.quantile(values, probs)), rel=1e-12)
    assert got[1]["q"] == [-inf, -inf, inf, inf, inf]
    assert got[3]["n"] == 0 and got[3]["q"] is None and got[None]["q"][3] == 5.5


def test_quantiles_of_many_groups(spark):
    data = spark.range(600_000).select((F.col("id") % 200_000).alias("g"), (F.col("id") * 3).alias("v"))
    out = exact_quantiles(data, ["g"], "v", [0.5])
    assert out.where(F.col("q")[0] == (F.col("g") + 200_000) * 3).count() == 200_000


@pytest.mark.parametrize("few", [False, True])
def test_quantiles_of_wide_and_endless_values(spark, few):
    """Values over many orders of magnitude, both signs, repeats and endless ones, in brackets cut into pieces."""
    rng = np.random.default_rng(1)
    rows = [("e", float("inf")), ("e", 1.0), ("a", None), ("a", float("nan")), ("d", None), ("c", float("inf")), ("c", float("-inf"))]
    for g, n in (("a", 3000), ("b", 1), ("c", 9000), (None, 2000)):
        wide = rng.lognormal(3, 4, n // 2) * rng.choice([-1, 1], n // 2)
        rows += [(g, float(v)) for v in [*wide, *rng.integers(0, 5, n - n // 2)]]
    data = spark.createDataFrame(rows, "g string, v double").repartition(4)
    probs = [0, 0.001, 0.25, 0.5, 0.5, 0.9, 0.999, 1]
    got = {r["g"]: r for r in exact_quantiles(data, ["g"], "v", probs, accuracy=300, whole_rows=10, few_groups=few).collect()}
    assert got["d"]["n"] == 0 and got["d"]["q"] is None
    for g in ("a", "b", "c", None, "e"):
        x = sorted(v for k, v in rows if k == g and v is not None and v == v)
        assert got[g]["n"] == len(x)
        for p, q in zip(probs, got[g]["q"], strict=True):
            at = p * (len(x) - 1)
            low, high = x[int(at)], x[-int(-at // 1)]
            want = low if low == high else low + (high - low) * (at - int(at))
            assert q == pytest.approx(want, rel=1e-9, nan_ok=True)


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "v double")
    assert exact_quantile(empty, "v", 0.5) is None


@pytest.mark.parametrize("descending", [True, False])
def test_running_sums_equal_pandas(skewed, descending):
    out = running_sums(skewed, "v", {"n": F.lit(1).cast("long"), "s": F.col("g").cast("long")}, descending, rows_per_slice=700)
    got = out.toPandas().sort_values("v", ascending=not descending, ignore_index=True)
    pdf = skewed.toPandas().dropna().assign(n=1).groupby("v", as_index=False).agg(n=("n", "sum"), s=("g", "sum"))
    pdf = pdf.sort_values("v", ascending=not descending, ignore_index=True)
    assert list(got.cum_n) == list(pdf.n.cumsum()) and list(got.cum_s) == list(pdf.s.cumsum())


@pytest.fixture(scope="module")
def hot_flows(spark):
    """One source with most rows, one instant with a third of them, missing keys and times."""
    rows = spark.range(20_000).withColumn("h", F.pmod(F.xxhash64("id"), F.lit(1000)))
    src = F.when(F.col("h") % 97 == 0, F.lit(None)).when(F.col("h") < 600, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("h") % 7))
    at = F.when(F.col("h") % 89 == 0, F.lit(None)).when(F.col("h") % 3 == 0, F.lit(500_000)).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1_000_000)))
    return rows.select(F.col("id").alias("flow_id"), src.alias("SrcAddr"), F.timestamp_micros(at * 1000).alias("StartTime")).cache()


@pytest.mark.parametrize("rows", [100, 1500])
def test_sliced_intervals_equal_plain(hot_flows, rows):
    plain = windows.interval_features(hot_flows).toPandas().sort_values("flow_id", ignore_index=True)
    cut = windows.interval_features(hot_flows, rows_per_slice=rows)
    cut = cut.toPandas().sort_values("flow_id", ignore_index=True)
    assert len(cut) == 20_000
    for c in ("time_since_last_flow", "time_to_next_flow"):
        assert np.allclose(cut[c], plain[c])


def test_hot_source_is_spread(hot_flows):
    """With slices, no window group holds much more than a slice of the rows."""
    from flowlens.functions.columns import micros
    from flowlens.functions.ordering import slice_bounds, with_slice

    _, bounds, more = slice_bounds(hot_flows, micros(hot_flows), 1000, [F.col("flow_id")])
    crowded = sorted({b for b in bounds if bounds.count(b) > 1})
    f = with_slice(hot_flows.withColumn("t", micros(hot_flows)), "t", [*bounds, *[b + 1 for b in crowded]], "s")
    f = with_slice(f.withColumn("k", F.col("flow_id")), "k", more[0], "cut")
    f = f.withColumn("sub", F.when(F.col("t").isin(crowded), F.col("cut")).otherwise(0))
    assert crowded == [500_000_000]
    assert f.where("t is not null").groupBy("SrcAddr", "s", "sub").count().agg(F.max("count")).first()[0] <= 2000


def test_interval_ties_and_nulls(spark):
    df = spark.createDataFrame([(3, "a", 10), (1, "a", 10), (2, "a", None), (4, None, 5), (5, "a", 25)], "flow_id long, SrcAddr string, s long")
    df = df.withColumn("StartTime", F.timestamp_seconds("s"))
    got = {r["flow_id"]: (r["time_since_last_flow"], r["time_to_next_flow"]) for r in windows.interval_features(df).collect()}
    assert got == {1: (0, 0), 3: (0, 15), 5: (15, 0), 2: (0, 0), 4: (0, 0)}


@pytest.mark.parametrize("digits", [1, 4])
def test_splits_equal_a_full_ranking(spark, monkeypatch, digits):
    monkeypatch.setattr(sampling, "DIGITS", digits)
    df = spark.range(9_000).select(F.col("id").alias("flow_id"), (F.col("id") % 3 == 0).cast("int").alias("label_binary"))
    got = sampling.split(df, label="label_binary", val=0.2).toPandas()
    order = Window.partitionBy("label_binary").orderBy(sampling.key_hash("flow_id"))
    rank = df.withColumn("k", F.row_number().over(order)).toPandas().set_index("flow_id").k
    n = {0: 6000, 1: 3000}
    for r in got.itertuples():
        k, total = rank[r.flow_id], n[r.label_binary]
        want = "test" if k <= total * 0.2 else "val" if k <= total * 0.36 else "train"
        assert r.split == want


def test_splits_are_disjoint_and_stratified(spark):
    df = spark.range(5_000).select(F.col("id").alias("flow_id"), (F.col("id") % 17 == 0).cast("int").alias("label_binary"))
    parts = sampling.split(df, label="label_binary", val=0.2)
    assert parts.count() == 5_000 and parts.select("flow_id").distinct().count() == 5_000
    shares = {r["split"]: r["s"] for r in parts.groupBy("split").agg(F.avg("label_binary").alias("s")).collect()}
    assert set(shares) == {"train", "val", "test"}
    assert max(shares.values()) - min(shares.values()) < 0.002
    assert sampling.stratified_sample(df, n=1_001).count() == 1_001
    assert sampling.sample_n(df, n=777).count() == 777 and sampling.sample_n(df, n=9_999).count() == 5_000
    assert sampling.capped_sample(df, cap=500).count() == 500


def test_exact_sizes_with_repeated_keys_and_many_strata(spark):
    df = spark.range(6_000).select((F.col("id") % 40).alias("flow_id"), F.lit(1).alias("label_binary"))
    assert sampling.sample_n(df, n=255).count() == 255
    assert {r["split"]: r["count"] for r in sampling.split(df, val=0.25).groupBy("split").count().collect()} == {
        "test": 1_200, "val": 1_200, "train": 3_600}
    many = spark.range(20_000).select(F.col("id").alias("flow_id"), (F.col("id") % 5_000).alias("label_binary"))
    got = sampling.stratified_sample(many, n=7_500)
    assert got.count() == 7_500 and got.select("label_binary").distinct().count() == 5_000
    parts = sampling.split(many, label="label_binary", test=0.25)
    assert parts.where("split = 'test'").groupBy("label_binary").count().where("count <> 1").count() == 0


def test_scores_of_many_groups(spark):
    rows = spark.range(20_000).select((F.col("id") % 5_000).cast("string").alias("protocol_group"), (F.col("id") * -1.0).alias("raw_score"))
    out = forest.score_grouped(rows, forest.group_score_stats(rows))
    assert out.where("anomaly_score > 0 AND anomaly_score < 1").count() == 20_000
    mixed = forest.ensemble(rows, {"raw_score": 1.0}, "protocol_group")
    assert mixed.where("ensemble_score BETWEEN 0 AND 1").count() == 20_000


def test_single_class_threshold_falls_back(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("anomaly_score"), F.lit(0).alias("label_binary"))
    assert thresholds.best_f1_threshold(df, fallback_frac=0.1).first()["threshold"] == pytest.approx(89.1)
    assert thresholds.roc_auc(df).first()["roc_auc"] is None


def test_scores_missing_are_never_flagged(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 1.0)], "flow_id int, anomaly_score double")
    got = {r["flow_id"]: r["y_pred"] for r in thresholds.flag_top(df, frac=0.5).collect()}
    assert got == {1: 1, 2: 0, 3: 0}


def test_describe_moves_no_rows_to_their_column(spark):
    """One group for each column: what is known of a column is broadcast, rows are not sorted by their column."""
    from flowlens.operators.profile import describe_numeric

    df = spark.createDataFrame([(i, float(i % 7), float(i)) for i in range(100)], "flow_id long, a double, b double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = describe_numeric(df, ["a", "b"])
        plan = out._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        assert {r["feature"]: (r["count"], r["q50"]) for r in out.collect()} == {"a": (100, 3.0), "b": (100, 49.5)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_brackets_of_quantiles_are_made_once(spark, capsys):
    """A summary made again may give other brackets, whose pieces then miss the wanted rank; the plan must not hold one."""
    df = spark.range(0, 300_000, numPartitions=6).select(F.sqrt("id").alias("v"))
    found = exact_quantiles(df, [], "v", [0.1])
    found.explain()
    assert "percentile_approx" not in capsys.readouterr().out
    assert found.first()["q"][0] == pytest.approx(np.quantile(np.sqrt(np.arange(300_000)), 0.1))


@pytest.mark.parametrize("chunk_values, points", [(4_000_000, 1024), (20_000, 64), (3_000, 16), (50, 1)])
def test_quantiles_of_columns_equal_numpy(spark, chunk_values, points):
    """Heavy values, gaps, endless values and a narrow range; chunks of every size, also some that end in a batch."""
    rng, n = np.random.default_rng(11), 25_000
    columns = {
        "wide": rng.lognormal(0, 8, n) * rng.choice([-1, 1], n), "hours": rng.integers(0, 24, n).astype(float),
        "one": np.full(n, 3.5), "narrow": 1.7e9 + rng.random(n) * 1e-3, "zeros": rng.choice([-0.0, 0.0, 1.0], n, p=[0.4, 0.5, 0.1]),
        "gaps": np.where(rng.random(n) < 0.7, np.nan, rng.random(n)), "rising": np.arange(n) / 7,
        "endless": rng.choice([-np.inf, -1.0, 2.0, np.inf], n)}
    rows = [(*(None if np.isnan(v) and i % 2 else float(v) for v in r), None) for i, r in enumerate(zip(*columns.values()))]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in (*columns, "empty"))).repartition(5).cache()
    got = column_quantiles(df, [*columns, "empty"], [0.5, 0.0, 0.25, 0.8131, 1.0], chunk_values, points)
    assert list(got) == [*columns, "empty"] and got["empty"] is None
    for c, v in columns.items():
        v = np.sort(v[~np.isnan(v)])
        for q, p in zip(got[c], [0.5, 0.0, 0.25, 0.8131, 1.0], strict=True):
            a = p * (len(v) - 1)
            x, y = v[int(np.floor(a))], v[int(np.ceil(a))]
            assert q == (x if x == y else x + (y - x) * (a - np.floor(a))) and str(q) != "-0.0"
    assert column_quantiles(df.where("false"), ["wide"], [0.5]) == {}


def test_fits_over_columns_do_not_melt_the_table(spark, monkeypatch):
    df = spark.range(3_000).selectExpr("id AS flow_id", "id % 97 AS a", "sqrt(id) AS b", "CAST(id % 97 AS DOUBLE) * 2 AS c")
    monkeypatch.setattr(type(df), "unpivot", lambda *_: pytest.fail("a row for each cell of the table"))
    params = transform.robust_fit(df, ["a", "b"])
    b = np.sqrt(np.arange(3_000))
    assert params["b"] == (np.quantile(b, 0.5), pytest.approx(np.quantile(b, 0.75) - np.quantile(b, 0.25)))
    assert [(r.feature_i, r.feature_j) for r in select.correlation_pairs(df, ["a", "b", "c"]).collect()] == [("a", "c")]


def test_a_task_walks_the_trees_once_for_a_row(spark):
    """Also where a filter asks for the score: a second walk takes a second Python worker of the same task."""
    df = spark.range(600).selectExpr("id AS flow_id", "CAST(id % 17 AS DOUBLE) AS a", "sqrt(id) AS b", "IF(id % 3 = 0, 'tcp', 'udp') AS g")
    model = forest.fit_forest(df, ["a", "b"], group="g", trees=5)
    scored = model.transform(df)
    stats = forest.group_score_stats(scored, "g")
    assert stats._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    plain = scored.toPandas().groupby("g").raw_score
    for r in stats.collect():
        assert (r["mean"], r["std"]) == (pytest.approx(-plain.mean()[r["g"]]), pytest.approx(plain.std(ddof=0)[r["g"]]))
