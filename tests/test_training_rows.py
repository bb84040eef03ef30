"""Rows that training reads where the table is part of a split made by the same hash, and how they are moved."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.operators import boosted, forest, sampling, select


@pytest.fixture(scope="module")
def rows(spark):
    x = np.random.default_rng(5).normal(0, 1, (3_000, 3))
    made = [(i, *map(float, r), int(r[0] > 1), "ab"[i % 2]) for i, r in enumerate(x)]
    return spark.createDataFrame(made, "flow_id long, a double, b double, c double, label_binary int, g string").cache()


@pytest.mark.parametrize("group", [None, "g"])
@pytest.mark.parametrize("bootstrap", [True, False])
def test_forest_of_a_training_split(rows, group, bootstrap):
    """The split takes the low hashes away; the pool is filled by the first rows that are left."""
    train = sampling.split(rows, "flow_id", "label_binary", 0.2, 0.2, few_strata=True).where("split = 'train'")
    found = forest.fit_forest(train, ["a", "b", "c"], group=group, trees=4, max_samples=8, bootstrap=bootstrap)
    order = lambda r: hashlib.md5(f"{r.flow_id}|42".encode()).hexdigest()
    kept = sorted(train.select("flow_id", "g").collect(), key=order)
    first = [r.flow_id for part in (("a", "b") if group else ("ab",)) for r in [r for r in kept if r.g in part][:32]]
    wanted = forest.fit_forest(rows.where(F.col("flow_id").isin(first)), ["a", "b", "c"], group=group, trees=4, max_samples=8,
                               bootstrap=bootstrap)
    assert found.sizes == wanted.sizes and len(found.nodes) > 0
    assert found.nodes.equals(wanted.nodes)
    assert found.transform(train).where("raw_score IS NULL").count() == 0


def test_split_of_few_strata_moves_no_rows(rows, monkeypatch):
    """The cuts of a 0/1 label are broadcast: rows of a large table stay in their tasks, and the split is the same."""
    monkeypatch.setattr(sampling, "MOVED_ROWS", 100)
    spread = rows.repartition(6)
    moved = sampling.split(spread, "flow_id", "label_binary", 0.2, 0.2)
    stays = sampling.split(spread, "flow_id", "label_binary", 0.2, 0.2, few_strata=True)
    assert stays.groupBy(F.spark_partition_id()).count().where("count > 100").count() == 6
    assert sorted(map(tuple, stays.collect())) == sorted(map(tuple, moved.collect()))


def test_correlation_in_one_pass(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(1e6, 1, (1_000, 4))
    x[:, 1] = 3 * x[:, 0] + rng.normal(0, 1, 1_000)
    x[:, 3] = 7.0
    x[::9, 2] = np.nan
    rows = [[None if np.isnan(v) else float(v) for v in r] for r in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(5)
    centers = [float(np.nanmedian(c)) for c in x.T]
    found = select.correlation_matrix(df, "abcd", centers)
    with np.errstate(invalid="ignore"):
        wanted = np.corrcoef(np.where(np.isnan(x), centers, x), rowvar=False)
    assert np.allclose(found[:3, :3], wanted[:3, :3], atol=1e-9)
    assert np.isnan(found[3]).all()
    pairs = {(r.feature_i, r.feature_j) for r in select.correlation_pairs(df, "abcd", 0.9).collect()}
    assert pairs == {("a", "b")}


def test_guarded_fits_bin_rows_once(rows, monkeypatch):
    made, asked = boosted.bin_rows, []
    monkeypatch.setattr(boosted, "bin_rows", lambda *a, **k: asked.append(1) or made(*a, **k))
    monkeypatch.setattr(boosted, "overfit_report", lambda df, label: df.sparkSession.createDataFrame([("high",)], "risk string"))
    quick = [{"iterations": 2, "max_depth": 2}, {"iterations": 3, "max_depth": 1, "rate": 0.05}]
    model, report = boosted.fit_with_guard(rows, ["a", "b", "c"], first=quick[0], tighter=quick[1])
    assert len(asked) == 1 and report.count() == 2
    again = boosted.fit_boosted(rows, ["a", "b", "c"], **quick[1])
    assert boosted.node_rows(model.trees).equals(boosted.node_rows(again.trees))


def test_lighter_child_is_summed(rows, spark, monkeypatch):
    """In many tasks a level sums the rows of one child of each node; histograms are those of all rows."""
    asked, sums = [], boosted.lighter_sides

    def kept(tree, level, above, columns):
        found = sums(tree, level, above, columns)
        asked.append((level, len(found)))
        return found

    monkeypatch.setattr(boosted, "lighter_sides", kept)
    options = {"iterations": 4, "max_depth": 3, "columns_share": 0.7, "subsample": 0.8}
    one = boosted.node_rows(boosted.fit_boosted(rows, ["a", "b", "c"], **options).trees)
    assert not asked
    monkeypatch.setattr(boosted, "ONE_TASK_ROWS", 0)
    many = boosted.node_rows(boosted.fit_boosted(rows, ["a", "b", "c"], **options).trees)
    assert {(1, 1), (2, 2)} <= set(asked)
    assert one[["tree", "node", "feature", "cut"]].equals(many[["tree", "node", "feature", "cut"]])
    assert np.allclose(one["value"], many["value"]) and np.allclose(one["gain"], many["gain"])
