"""Trees grown whole inside tasks, over cells of equal rows."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from strata.operators import forest, trees
from strata.operators import ml as ML

FEATS = ["year", "place", "flag"]


def cells_of(spark, n=3000, seed=1):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        year, place, flag = float(rng.randint(2005, 2011)), float(rng.randint(0, 40)), float(rng.randint(0, 1))
        risk = "Low" if place > 20 and rng.random() < 0.9 else "High" if year > 2008 or rng.random() < 0.3 else "Mid"
        rows.append((year, place, flag, risk))
    frame = spark.createDataFrame(rows, "year double, place double, flag double, label string")
    return rows, *ML.index_labels(forest.cells(frame, FEATS).cache())


def gini(counts):
    return 1 - sum((c / sum(counts))**2 for c in counts)


def best_cut(points, weights):
    """Largest gain over all features and cuts between different values; points are (x, class, n)."""
    def sums(some):
        return [w * sum(n for _, c, n in some if c == k) for k, w in enumerate(weights)]
    whole, found = sums(points), 0.0
    for f in range(len(points[0][0])):
        for value in sorted({x[f] for x, _, _ in points})[:-1]:
            sides = [sums([p for p in points if (p[0][f] <= value) == left]) for left in (True, False)]
            found = max(found, gini(whole) - sum(sum(s) / sum(whole) * gini(s) for s in sides))
    return found


def test_a_forest_over_cells_costs_no_job_a_tree(spark):
    """Time at six copies of sf0.1 went into the jobs of 1,800 trees."""
    _, cells, labels = cells_of(spark)
    jobs = []
    for count in (4, 40):
        spark.sparkContext.setJobGroup(f"trees-{count}", "")
        model = ML.fit_forest(cells, FEATS, labels, count, 5, 7)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"trees-{count}")))
        assert model.trees == count
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] < 12


@pytest.mark.parametrize("sparse", [False, True])
def test_every_node_has_its_best_cut(spark, sparse):
    """All features tried: each split is the best of all cuts, and nodes that could be split are."""
    rng = np.random.default_rng(3)
    values = (np.array([-2.0, 1.0, 4.0, 9.0]), np.array([0.0, 1.0]), np.array([3.0]),
              np.arange(60_000.0) if sparse else np.arange(5.0))
    codes = np.array(list(itertools.product(range(4), range(2), range(1), range(5))))
    if sparse:
        codes[:, 3] *= 14_999
    n = rng.integers(0, 6, (3, len(codes)))
    weights = np.array([0.5, 1.0, 2.5])
    nodes = trees.grow(trees.Cells(codes, values, n, weights), n, 4, 4, rng)
    at = {0: [(tuple(values[f][c] for f, c in enumerate(codes[i])), k, n[k, i])
              for i in range(len(codes)) for k in range(3) if n[k, i]]}
    depth = {0: 0}
    for i, points in ((i, at[i]) for i in range(len(nodes["gain"]))):
        assert nodes["stats"][i] == pytest.approx([w * sum(m for _, c, m in points if c == k) for k, w in enumerate(weights)])
        best = best_cut(points, weights)
        if nodes["feature"][i] < 0:
            assert depth[i] == 4 or best < 1e-12
            continue
        assert nodes["gain"][i] == pytest.approx(best)
        for side, child in ((True, nodes["left"][i]), (False, nodes["right"][i])):
            at[child] = [p for p in points if (p[0][nodes["feature"][i]] <= nodes["threshold"][i]) == side]
            depth[child] = depth[i] + 1
            assert at[child]
    assert max(depth.values()) == 4 and len(at) == len(nodes["gain"])


def test_probabilities_are_the_mean_of_the_trees(spark):
    rows, cells, labels = cells_of(spark)
    model = ML.fit_forest(cells, FEATS, labels, 9, 6, 5)
    scored = model.scored(ML.assemble(cells.limit(60), FEATS)).collect()
    each = [tree for block in model.blocks for tree in block.trees]
    for r in scored:
        votes = np.mean([t.predictProbability(Vectors.dense([r.year, r.place, r.flag])).toArray() for t in each], axis=0)
        assert list(r.probabilities) == pytest.approx(list(votes))
        assert r.prediction == labels[int(np.argmax(r.probabilities))]
    shares = dict(model.importances(FEATS))
    mean = np.mean([t.featureImportances.toArray() for t in each], axis=0)
    assert [shares[f] for f in FEATS] == pytest.approx(list(mean / mean.sum()))
    assert max(shares, key=shares.get) == "place" and shares["flag"] < 0.1
    assert model.scored(ML.assemble(cells.limit(0), FEATS)).count() == 0


def test_forest_over_cells_is_as_good_as_mllib(spark):
    """Shares of classes and importances come close to those of Spark's forest over the rows."""
    rows, cells, labels = cells_of(spark, 4000)
    frame = spark.createDataFrame(rows, "year double, place double, flag double, label string")
    own = ML.fit_forest(cells, FEATS, labels, 60, 6, 5)
    data, _ = ML.index_labels(frame)
    mllib = ML.fit_forest(data, FEATS, labels, 60, 6, 5)
    some = ML.assemble(cells.select(*FEATS).distinct(), FEATS).cache()
    a, b = ({(r.year, r.place, r.flag): r.probabilities for r in m.scored(some).collect()} for m in (own, mllib))
    assert np.mean([np.abs(np.subtract(a[k], b[k])).max() for k in a]) < 0.08
    x, y = dict(own.importances(FEATS)), dict(mllib.importances(FEATS))
    assert all(abs(x[f] - y[f]) < 0.08 for f in FEATS)


def test_missing_and_infinite_values(spark):
    """NaN is after every number, as where rows are scored; thresholds tell infinite values apart."""
    nan, inf = math.nan, math.inf
    rows = [(v, "a" if k % 2 else "b") for k, v in enumerate([-inf, 1.0, inf, nan]) for _ in range(50)]
    frame = spark.createDataFrame(rows, "x double, label string")
    cells, labels = ML.index_labels(forest.cells(frame, ["x"]))
    model = ML.fit_forest(cells, ["x"], labels, 5, 6, 1)
    got = model.scored(ML.assemble(cells, ["x"])).select("label", "prediction").collect()
    assert len(got) == 4 and all(r.label == r.prediction for r in got)


def test_one_row_and_one_class(spark):
    frame = spark.createDataFrame([(1.0, "a")], "x double, label string")
    cells, labels = ML.index_labels(forest.cells(frame, ["x"]))
    model = ML.fit_forest(cells, ["x"], labels, 6, 3, 1)
    assert [v for _, v in model.importances(["x"])] == [0.0]
    assert model.scored(ML.assemble(cells, ["x"])).first().prediction == "a"


def test_more_cells_than_a_task_holds(spark, monkeypatch):
    """Past the limit trees are fits of their own over the cells, as before."""
    monkeypatch.setattr(forest, "CELLS_PER_TASK", 10)
    monkeypatch.setattr(forest, "ROWS_PER_PARTITION", 1000)
    monkeypatch.setattr(forest.whole_trees, "forest_of", None)
    assert forest.by_cells(3000, 700) and not forest.by_cells(3000, 900) and not forest.by_cells(900, 100)
    _, cells, labels = cells_of(spark)
    model = ML.fit_forest(cells, FEATS, labels, 2, 3, 7)
    assert model.trees == 2 and sum(v for _, v in model.importances(FEATS)) == pytest.approx(1)


def test_scored_folds_count_every_row(spark):
    """Each row is predicted once, in its own fold, also where labels share all features."""
    rows, _, _ = cells_of(spark)
    frame = spark.createDataFrame(rows, "year double, place double, flag double, risk_level string")
    got = ML.train_risk_classifier(frame, features=FEATS, folds=4, trees=5, depth=5)
    counts = {r.label: r.n for r in got["predictions"].groupBy("label").agg(F.sum("n").alias("n")).collect()}
    assert counts == {k: sum(r[3] == k for r in rows) for k in ("Low", "High", "Mid")}


@pytest.mark.parametrize("query", ["m12_risk_classifier", "m17_training_run"])
def test_raw_observations_are_joined_once(spark, monkeypatch, query):
    """What the run reads again and again is the written table, not the joins over the driver tables."""
    from strata.plans import registry

    class Reached(RuntimeError):
        pass

    def seen(*args, **_):
        raise Reached([f for a in args if hasattr(a, "inputFiles") for f in a.inputFiles()])

    monkeypatch.setattr(registry.ML, "train_risk_classifier", seen)
    monkeypatch.setattr(registry.MD, "run", seen)
    with pytest.raises(Reached) as reached:
        registry.QUERIES[query](spark, "/root/testdata/sf0.001")
    files = reached.value.args[0]
    assert files and not [f for f in files if "testdata" in f]
