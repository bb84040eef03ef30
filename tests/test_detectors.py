"""Detectors against brute force and their invariants."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.operators import boosted, forest, neighbors, oneclass, transform as tr
from flowlens.plans.benchmark import benchmark_models, compare_models
from flowlens.sources.storage import scratch_path


@pytest.fixture(scope="module")
def cloud(spark):
    """A normal cloud with ten planted outliers (flow_id below 10)."""
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (2_000, 4))
    x[:10] += 9
    rows = [(i, *map(float, r), int(i < 10), "abc"[i % 3]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "flow_id long, a double, b double, c double, d double, label_binary int, g string").cache()


COLUMNS = ["a", "b", "c", "d"]


def ranked(scored, n=10):
    return {r["flow_id"] for r in scored.orderBy("raw_score", "flow_id").limit(n).collect()}


@pytest.mark.parametrize("bootstrap", [True, False])
def test_forest(cloud, bootstrap):
    model = forest.fit_forest(cloud, COLUMNS, trees=50, bootstrap=bootstrap)
    scored = model.transform(cloud)
    assert ranked(scored) == set(range(10))
    lo, hi = scored.agg(F.min("raw_score"), F.max("raw_score")).first()
    assert -1 < lo < -0.6 < hi < 0
    again = forest.fit_forest(cloud.repartition(5), COLUMNS, trees=50, bootstrap=bootstrap)
    assert again.nodes.equals(model.nodes)
    labels = model.fit_offsets(cloud, 0.05).predict_labels(cloud)
    assert labels.where("label = -1").count() == 100


def test_forest_of_constant_and_missing_features(spark):
    df = spark.range(50).select(F.col("id").alias("flow_id"), F.lit(1.0).alias("a"), F.lit(None).cast("double").alias("b"))
    scores = forest.fit_forest(df, ["a", "b"], trees=5).transform(df).select("raw_score").distinct().collect()
    assert len(scores) == 1 and scores[0][0] == pytest.approx(-0.5, abs=0.01)


def test_forest_walk_equals_plain_descent(cloud):
    model = forest.fit_forest(cloud, COLUMNS, trees=7)
    x = np.array([[r[c] for c in COLUMNS] for r in cloud.orderBy("flow_id").limit(40).collect()])
    (trees, steps, _), = model.packed().values()
    for row, got in zip(x, forest.walk(x, trees, steps)):
        total = 0.0
        for feature, split, child, depth in trees:
            at = 0
            while child[at] != at:
                at = child[at] + int(row[feature[at]] > split[at])
            total += depth[at]
        assert got == pytest.approx(total / len(trees))


def test_grouped_forest(spark, cloud):
    df = cloud.withColumn("Proto", F.when(F.col("g") == "a", "TCP").when(F.col("g") == "b", "udp"))
    df = forest.protocol_group(df)
    model, report = forest.fit_grouped(df.where("protocol_group <> 'udp' or flow_id < 30"), COLUMNS, min_rows=100, trees=20)
    assert {r["grp"]: r["trained"] for r in report.collect()} == {"tcp": True, "other": True, "udp": False}
    scored = model.transform(df)
    out = forest.score_grouped(scored, forest.group_score_stats(scored))
    bad = out.where("(protocol_group = 'udp') <> (anomaly_score is null)").count()
    lo, hi = out.agg(F.min("anomaly_score"), F.max("anomaly_score")).first()
    assert bad == 0 and 0 < lo < hi < 1
    flipped = forest.score_grouped(scored, forest.group_score_stats(scored), invert_score=True)
    assert flipped.agg(F.max("anomaly_score")).first()[0] < 0
    path = scratch_path(spark, "forest")
    model.save(path)
    loaded = forest.ForestModel.load(spark, path)
    pairs = model.transform(df).join(loaded.transform(df).select("flow_id", F.col("raw_score").alias("r2")), "flow_id")
    assert pairs.where("not (raw_score <=> r2)").count() == 0


def brute_lof(train, queries, k):
    def dist(a, b):
        return np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2))

    d = dist(train, train)
    np.fill_diagonal(d, np.inf)
    near = np.sort(d, axis=1)[:, :k]
    at = np.argsort(d, axis=1)[:, :k]
    kd = near[:, -1]
    lrd = 1 / (np.maximum(near, kd[at]).mean(axis=1) + 1e-10)
    q = dist(queries, train)
    at = np.argsort(q, axis=1)[:, :k]
    own = 1 / (np.maximum(np.take_along_axis(q, at, 1), kd[at]).mean(axis=1) + 1e-10)
    return -lrd[at].mean(axis=1) / own


def test_lof_equals_brute_force(cloud):
    train = cloud.where("flow_id >= 400")
    model = neighbors.fit_lof(train, COLUMNS, 15)
    scored = model.transform(cloud).orderBy("flow_id").toPandas()
    want = brute_lof(scored[scored.flow_id >= 400][COLUMNS].to_numpy(), scored[COLUMNS].to_numpy(), 15)
    assert np.allclose(scored.raw_score, want)
    assert ranked(model.transform(cloud)) == set(range(10))


def test_lof_of_few_rows(cloud):
    assert neighbors.fit_lof(cloud.limit(3), COLUMNS, 20).k == 2
    with pytest.raises(ValueError):
        neighbors.fit_lof(cloud.limit(1), COLUMNS)


def test_lof_over_many_rings(spark, cloud, monkeypatch):
    """Small rings and tasks change nothing, and queries leave most rings out."""
    for name, value in {"RING": 20, "VISITS": 50, "PIVOTS": 12, "CUTS": 4}.items():
        monkeypatch.setattr(neighbors, name, value)
    train = cloud.where("flow_id >= 400")
    model = neighbors.fit_lof(train, COLUMNS, 15)
    rings = model.space.rings
    assert len(rings) >= 12 and rings["n"].sum() == train.select(*COLUMNS).distinct().count()
    scored = model.transform(cloud).orderBy("flow_id").toPandas()
    x = scored[COLUMNS].to_numpy()
    want = brute_lof(scored[scored.flow_id >= 400][COLUMNS].to_numpy(), x, 15)
    assert np.allclose(scored.raw_score, want)
    bound = np.sort(np.sqrt(((x[:, None] - x[None, scored.flow_id >= 400]) ** 2).sum(axis=2)), axis=1)[:, 15]
    visited = sum(map(len, model.space.home(x, 15))) + sum(map(len, model.space.other(x, bound, 15)))
    assert visited < 0.6 * len(x) * len(rings)


def test_lof_sends_a_query_once_to_a_block(spark, monkeypatch):
    """In many dimensions most rings stay open: rows sent grow with blocks, not rings, and training rows are searched once."""
    for name, value in {"RING": 20, "VISITS": 64, "PIVOTS": 12, "NUMBERS": 24 * 100, "SENT": 24 * 7, "CELLS": 500, "FEW_VISITS": 1}.items():
        monkeypatch.setattr(neighbors, name, value)
    sent, write = [], neighbors.materialize

    def counted(df, name="stage"):
        out = write(df, name)
        if name == "visits":
            sent.append(out.count())
        return out

    monkeypatch.setattr(neighbors, "materialize", counted)
    x = np.random.default_rng(11).normal(0, 1, (600, 24))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "flow_id long, v array<double>")
    model = neighbors.fit_lof(df.where("flow_id < 500"), "v", 10)
    blocks, rings = len(set(model.space.blocks)), len(model.space.rings)
    assert blocks < rings / 3 and sum(sent) <= 500 * (blocks + 2)
    assert len(sent) == 2 and model.transform(df.where("flow_id < 500")).count() == 500 and len(sent) == 2
    scored = model.transform(df).orderBy("flow_id").toPandas()
    assert np.allclose(scored.raw_score, brute_lof(x[:500], x, 10))


def test_lof_is_stored_whole(spark, cloud, tmp_path):
    model = neighbors.fit_lof(cloud, COLUMNS, 5).fit_offset(cloud, 0.1)
    model.save(str(tmp_path / "lof"))
    loaded = neighbors.LofModel.load(spark, str(tmp_path / "lof"))
    assert (loaded.k, loaded.offset, loaded.columns) == (model.k, model.offset, model.columns)
    first, second = ({r["flow_id"]: r["raw_score"] for r in m.transform(cloud).collect()} for m in (model, loaded))
    assert first == pytest.approx(second)


def test_lof_with_copies(spark):
    """A third of the training rows equal: scores stay finite and the far row is the outlier."""
    df = spark.range(300).select(F.col("id").alias("flow_id"), F.when(F.col("id") < 100, 0.0).otherwise(F.rand(1)).alias("a"),
                                 F.when(F.col("id") == 299, 50.0).otherwise(0.0).alias("b"))
    rows = df.toPandas()[["a", "b"]].to_numpy()
    model = neighbors.fit_lof(spark.createDataFrame(rows.tolist(), "a double, b double"), ["a", "b"], 10)
    assert model.space.points.count() == len(np.unique(rows, axis=0))
    scored = model.transform(spark.createDataFrame(rows.tolist(), "a double, b double")).toPandas()
    want = {tuple(x): s for x, s in zip(rows, brute_lof(rows, rows, 10))}
    assert np.allclose(scored.raw_score, [want[a, b] for a, b in zip(scored.a, scored.b)])


def test_one_class(cloud):
    model = oneclass.fit_oneclass(cloud, COLUMNS, nu=0.1)
    scored = model.transform(cloud)
    assert set(range(10)) <= ranked(scored, 200)
    assert scored.where("raw_score < 0").count() == pytest.approx(200, abs=5)
    with pytest.raises(ValueError):
        oneclass.fit_oneclass(cloud, COLUMNS, nu=0.0)


def test_one_class_objective_improves(cloud):
    """More steps bring the weights closer to the smallest norm."""
    short, long = (oneclass.fit_oneclass(cloud, COLUMNS, steps=s).weights for s in (1, 8))
    assert long @ long <= short @ short + 1e-9


def test_one_class_scores_rows_once_a_step(spark, cloud, monkeypatch):
    """A step makes features of all rows once and of the nu share once more, few rows at a time."""
    at = np.random.default_rng(4).uniform(-2_000, 2_000, (50, 40))
    assert np.abs(oneclass.cosine_of_double(at / 2) - np.cos(at)).max() < 1e-14
    made, fourier = spark.sparkContext.accumulator(0), oneclass.fourier

    def counted(*args):
        for z in fourier(*args):
            made.add(len(z))
            yield z

    monkeypatch.setattr(oneclass, "fourier", counted)
    model = oneclass.fit_oneclass(cloud, COLUMNS, steps=3)
    assert made.value <= 2_000 * (1 + 3 * 1.11 + 1)
    x = np.array([[r[c] for c in COLUMNS] for r in cloud.orderBy("flow_id").limit(50).collect()])
    want = np.cos(x @ model.directions + model.phases) * np.sqrt(2 / 256) @ model.weights - model.rho
    got = [r["raw_score"] for r in model.transform(cloud).orderBy("flow_id").limit(50).collect()]
    assert np.allclose(got, want, rtol=0, atol=1e-12)


def test_boosted(spark, cloud):
    df = cloud.withColumn("label_binary", (F.col("a") > 0.3).cast("int"))
    model = boosted.fit_boosted(df, COLUMNS, iterations=5, max_depth=3)
    top = model.importances().orderBy(F.desc("importance")).first()
    assert top["feature"] == "a" and top["importance"] > 0.8
    scored = model.transform(df)
    assert scored.where("y_pred = label_binary").count() > 1_950
    assert scored.where("probability between 0 and 1").count() == 2_000
    with pytest.raises(ValueError):
        boosted.fit_boosted(df, COLUMNS, test=1.0)


def test_boosted_in_many_tasks_is_the_same(spark, cloud, monkeypatch, tmp_path):
    """Histograms summed over tasks grow the trees that one task grows; a stored model predicts alike."""
    df = cloud.withColumn("label_binary", (F.col("a") + 0.3 * F.col("b") > 0.3).cast("int")).repartition(3)
    options = dict(iterations=4, max_depth=3, subsample=0.8, columns_share=0.8)
    one = boosted.fit_boosted(df, COLUMNS, **options)
    monkeypatch.setattr(boosted, "ONE_TASK_ROWS", 0)
    monkeypatch.setattr(boosted, "REFRESH", 2)
    many = boosted.fit_boosted(df, COLUMNS, **options)
    a, b = boosted.node_rows(one.trees), boosted.node_rows(many.trees)
    assert a[["tree", "node", "feature", "cut"]].equals(b[["tree", "node", "feature", "cut"]])
    assert np.allclose(a["value"], b["value"]) and np.allclose(a["gain"], b["gain"])
    one.save(str(tmp_path / "model"))
    loaded = boosted.BoostedModel.load(spark, str(tmp_path / "model"))
    assert loaded.transform(df).join(one.transform(df).select("flow_id", F.col("probability").alias("p")), "flow_id").where(
        "abs(probability - p) > 1e-12").count() == 0


def test_boosted_level_is_one_job(spark, cloud, monkeypatch):
    """Beyond one task a level costs one job of one stage, and margins are not written for every few trees."""
    monkeypatch.setattr(boosted, "ONE_TASK_ROWS", 0)
    monkeypatch.setattr(boosted, "TASK_ROWS", 500)
    df = cloud.withColumn("label_binary", (F.col("a") + 0.3 * F.col("b") > 0.3).cast("int"))
    tracker, jobs = spark.sparkContext.statusTracker(), []
    for trees in (2, 12):
        group = f"boosted-{trees}"
        spark.sparkContext.setJobGroup(group, group)
        assert len(boosted.fit_boosted(df, COLUMNS, iterations=trees, max_depth=2).trees) == trees
        jobs.append(len(tracker.getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] - jobs[0] <= 10 * 2


def test_boosted_splits_are_the_best(spark):
    """One tree of one level against all cuts; importances against its gain; early stopping ends on noise."""
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 20, (600, 2)), rng.integers(0, 2, 600)
    y[x[:, 1] > 12] = 1
    rows = [(i, float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "flow_id long, a double, b double, label_binary int")
    model = boosted.fit_boosted(df, ["a", "b"], iterations=1, max_depth=1, weight=1.0)
    kept = boosted.split(df, "flow_id", "label_binary", 0.2, seed=42).where("split = 'train'").toPandas()
    g, best = 0.5 - kept["label_binary"].to_numpy(), (0, None)
    score = lambda v: v.sum() ** 2 / (0.25 * len(v) + 1)
    for f in ("a", "b"):
        for cut in sorted(set(kept[f]))[:-1]:
            left = (kept[f] <= cut).to_numpy()
            best = max(best, (score(g[left]) + score(g[~left]) - score(g), (f, cut)))
    tree = model.trees[0]
    assert ("ab"[tree.feature[0]], model.edges[tree.feature[0]][tree.cut[0]]) == best[1]
    assert tree.gain[0] == pytest.approx(best[0])
    assert {r["feature"]: r["importance"] for r in model.importances().collect()}[best[1][0]] == 1.0
    noise = df.withColumn("label_binary", F.pmod(F.xxhash64("flow_id"), F.lit(2)).cast("int"))
    assert len(boosted.fit_boosted(noise, ["a", "b"], iterations=100).trees) < 60


def test_benchmark(cloud):
    out = benchmark_models(cloud, detectors=("isolation_forest", "lof"), skewed=[], features=COLUMNS)
    rows = {r["model_type"]: r for r in out.collect()}
    for r in rows.values():
        assert r["total"] == 600 and r["roc_auc"] > 0.95 and r["predicted_share"] == pytest.approx(0.1, abs=0.01)
    best = {r["metric"] for r in compare_models(out).collect()}
    assert {"accuracy", "roc_auc", "fn", "train_time"} <= best
    plain = benchmark_models(cloud.drop("label_binary"), None, ("isolation_forest",), skewed=[], features=COLUMNS)
    assert "predicted_share" in {r["metric"] for r in compare_models(plain).collect()}


def loglike(x, y, lam, extra):
    return (lam - 1) * extra - len(x) / 2 * np.log(y.var())


def test_lambdas_are_the_maximum(spark):
    rng = np.random.default_rng(5)
    x = np.exp(rng.normal(1, 0.5, 3_000)) ** 1.7
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    lam = tr.fit_lambdas(df, ["v"])["v"]
    grid = np.linspace(lam - 0.2, lam + 0.2, 4_001)
    best = grid[np.argmax([loglike(x, (x ** g - 1) / g if abs(g) > 1e-12 else np.log(x), g, np.log(x).sum()) for g in grid])]
    assert lam == pytest.approx(best, abs=3e-4)
    signed = x - 6
    df = spark.createDataFrame([(float(v),) for v in signed], "v double")
    lam = tr.fit_lambdas(df, ["v"], "yeo-johnson")["v"]

    def yj(v, g):
        up, down = v >= 0, v < 0
        out = np.empty_like(v)
        out[up] = ((v[up] + 1) ** g - 1) / g
        out[down] = -((1 - v[down]) ** (2 - g) - 1) / (2 - g)
        return out

    extra = (np.sign(signed) * np.log1p(abs(signed))).sum()
    grid = np.linspace(lam - 0.2, lam + 0.2, 4_001)
    best = grid[np.argmax([loglike(signed, yj(signed, g), g, extra) for g in grid])]
    assert lam == pytest.approx(best, abs=3e-4)


def test_density_overlap_equals_direct(spark):
    rng = np.random.default_rng(6)
    x0, x1 = rng.normal(0, 1, 2_000), rng.normal(1.5, 2, 500)
    rows = [(float(v), 0) for v in x0] + [(float(v), 1) for v in x1]
    df = spark.createDataFrame(rows, "v double, label_binary int")
    grid = np.linspace(min(x0.min(), x1.min()), max(x0.max(), x1.max()), 1_000)
    curves = []
    for x in (x0, x1):
        h = x.std(ddof=1) * len(x) ** -0.2
        curves.append(np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(axis=1) / (len(x) * h * np.sqrt(2 * np.pi)))
    want = np.trapezoid(np.minimum(*curves), grid) / sum(np.trapezoid(c, grid) for c in curves)
    assert tr.density_overlap(df, ["v"]).first()["density_overlap"] == pytest.approx(want, abs=1e-4)
    assert tr.density_overlap(df.where("label_binary = 0"), ["v"]).first()["density_overlap"] == 1.0


def test_best_transform(spark):
    rng = np.random.default_rng(8)
    rows = [(i, float(np.exp(rng.normal(3 + 2 * (i % 2), 0.5))), i % 2) for i in range(2_000)]
    df = spark.createDataFrame(rows, "flow_id long, v double, label_binary int")
    out = tr.compare_transforms(df, ["v"])
    scores = {r["transform"]: r for r in out.collect()}
    assert len(scores) == 5 and sum(r["is_best"] for r in scores.values()) == 1
    assert scores["log1p"]["total_score"] > scores["original"]["total_score"]
    single = tr.compare_transforms(df.where("label_binary = 0"), ["v"])
    assert {r["total_score"] for r in single.collect()} == {0.0}
    data, params = tr.apply_best(df, out)
    med = data.agg(F.median("v")).first()[0]
    assert med == pytest.approx(0.0, abs=1e-9) and set(params) == {"v"}


@pytest.mark.parametrize("name, want", [
    ("boosted_importances", [(4, 50)]), ("boosted_predictions", [(6, 100)]), ("boosted_guarded_fit", [(6, 200), (4, 300)]),
    ("train_unsupervised", [(4, 50)]), ("train_supervised", [(4, 50), (6, 200), (4, 300)])])
def test_registered_fits_have_the_jobs_settings(spark, monkeypatch, name, want):
    """Each fit asks for the depth and rounds of its job; one round is run."""
    import __spark_entry__ as entry

    fit, asked = boosted.fit_boosted, []

    def one_round(*args, **options):
        asked.append((options.get("max_depth", 6), options.get("iterations", 100)))
        return fit(*args, **{**options, "iterations": 1, "max_depth": 2})

    monkeypatch.setattr(boosted, "fit_boosted", one_round)
    monkeypatch.setattr(boosted, "overfit_report", lambda df, label: df.sparkSession.createDataFrame([("high",)], "risk string"))
    entry.queries()[name](spark, "/root/testdata/sf0.001")
    assert sorted(set(asked)) == sorted(want)
