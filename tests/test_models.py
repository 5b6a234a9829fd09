"""Modelling: matrices, clusters, folds, weights, reports and scores."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from strata.operators import ml as ML
from strata.operators.reshape import state_disease_matrix, state_topic_shares
from tests.fixtures import state_topics


class TestStateMatrix:
    def test_shape_and_rows_sum_to_one(self, spark):
        df = state_topics(spark, 10)
        m = state_disease_matrix(df)
        assert m.count() == 10 and len(m.columns) == 6 and m.columns[0] == "LocationAbbr"
        sums = m.select(sum(F.col(f"`{c}`") for c in m.columns[1:]).alias("s")).collect()
        assert all(abs(r.s - 1.0) < 1e-9 for r in sums)
        assert m.filter(" or ".join(f"`{c}` < 0" for c in m.columns[1:])).count() == 0

    def test_state_without_topics(self, spark):
        df = spark.createDataFrame([("A", 0, 0), ("B", 1, 0)], "LocationAbbr string, topic_x int, topic_y int")
        got = {r.LocationAbbr: r.topic_x for r in state_disease_matrix(df).collect()}
        assert got == {"A": None, "B": 1.0}

    def test_long_form(self, spark):
        obs = spark.createDataFrame([("A", "x"), ("A", "y"), ("A", "y"), ("B", None)], "LocationAbbr string, Topic string")
        got = {(r.LocationAbbr, r.Topic): r.share for r in state_topic_shares(obs).collect()}
        assert got == {("A", "x"): 1 / 3, ("A", "y"): 2 / 3}


def silhouette_by_definition(points):
    """Mean silhouette from all pairwise distances."""
    scores = []
    for x, c in points:
        same = [math.dist(x, y) for y, d in points if d == c]
        other = [[math.dist(x, y) for y, d in points if d == o] for o in {d for _, d in points} - {c}]
        a = sum(same) / max(len(same) - 1, 1)
        b = min((sum(o) / len(o) for o in other), default=0.0)
        scores.append(0.0 if len(same) == 1 or max(a, b) == 0 else (b - a) / max(a, b))
    return sum(scores) / len(scores)


class TestClusters:
    def test_cluster_properties(self, spark):
        m = state_disease_matrix(state_topics(spark, 30, 1000))
        res = ML.cluster_entities(m, "LocationAbbr", k=3, starts=4)
        assert {r.cluster for r in res["assignments"].collect()} == {0, 1, 2}
        points = [(list(r.features), r.cluster) for r in res["points"].collect()]
        assert ML.silhouette_euclidean(res["points"]) == pytest.approx(silhouette_by_definition(points))
        assert -1.0 <= res["silhouette_squared"] <= 1.0

    def test_separated_clusters(self, spark):
        rows = [(f"S{i}", *(0.9 if j == i // 10 else 0.05 for j in range(3))) for i in range(30)]
        m = spark.createDataFrame(rows, "LocationAbbr string, topic_A double, topic_B double, topic_C double")
        res = ML.cluster_entities(m, "LocationAbbr", k=3, starts=3)
        assert ML.silhouette_euclidean(res["points"]) > 0.5

    def test_silhouette_on_given_labels(self, spark):
        rng = random.Random(3)
        points = [([rng.random(), rng.random()], i % 3) for i in range(40)] + [([9.0, 9.0], 7), ([0.5, 0.5], 0), ([0.5, 0.5], 0)]
        df = spark.createDataFrame([(Vectors.dense(x), c) for x, c in points], ["features", "cluster"])
        assert ML.silhouette_euclidean(df.repartition(3)) == pytest.approx(silhouette_by_definition(points))
        assert ML.silhouette_euclidean(df.repartition(3), tile=4) == pytest.approx(silhouette_by_definition(points))
        assert ML.silhouette_euclidean(df.limit(1)) == ML.silhouette_euclidean(df.limit(0)) == 0.0

    def test_only_clusters_that_may_be_nearest_are_compared(self):
        from strata.operators import silhouette
        pivots = {c: np.array([100.0 * c, 0.0]) for c in range(5)}
        near = np.array([[201.0, 1.0], [199.0, 0.0]])
        assert silhouette.wanted_clusters(near, 2, pivots, dict.fromkeys(range(5), 5.0)) == [2, 1, 3]
        assert silhouette.wanted_clusters(near[:1], 2, pivots, dict.fromkeys(range(5), 0.1)) == [2, 3]
        assert silhouette.wanted_clusters(near, 2, pivots, dict.fromkeys(range(5), 500.0)) == [2, 0, 1, 3, 4]


def test_folds_are_stratified(spark):
    rows = [("Low", i) for i in range(997)] + [("High", i) for i in range(23)] + [("Tiny", 1), ("Tiny", 2)]
    df = spark.createDataFrame(rows, "label string, x int")
    counted = ML.with_folds(df).groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n"))
    sizes = {(r.label, r.fold): r.n for r in counted.collect()}
    for lab, n in (("Low", 997), ("High", 23)):
        per = [sizes.get((lab, f), 0) for f in range(5)]
        assert sum(per) == n and max(per) - min(per) <= 1
    assert sum(v for (lab, _), v in sizes.items() if lab == "Tiny") == 2
    assert [r.label for r in ML.tiny_classes(df).collect()] == ["Tiny"]


def test_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 2, "label string")
    w = {r.label: r.weight for r in ML.class_weights(df).collect()}
    assert w == {"a": 8 / (2 * 6), "b": 8 / (2 * 2)}


def test_classification_report(spark):
    rows = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "a")]
    rep = {r.cls: r for r in ML.classification_report(
        spark.createDataFrame(rows, "label string, prediction string")).collect()}
    assert rep["a"].precision == pytest.approx(3 / 4) and rep["a"].recall == pytest.approx(3 / 4)
    assert rep["c"].precision == 0.0 and rep["c"].recall == 0.0 and rep["c"].f1_score == 0.0
    assert rep["accuracy"].precision == pytest.approx(5 / 7)
    f1 = [rep[c].f1_score for c in "abc"]
    assert rep["macro avg"].f1_score == pytest.approx(sum(f1) / 3)
    assert rep["weighted avg"].f1_score == pytest.approx((f1[0] * 4 + f1[1] * 2 + f1[2] * 1) / 7)


def test_standardizer_population_std(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (3.0, 7.0)], "a double, b double")
    params = ML.fit_standardizer(df, ["a", "b"])
    out = [(r.a, r.b) for r in ML.apply_standardizer(df, params).collect()]
    s = (2 / 3) ** 0.5
    assert out == [pytest.approx((-1 / s, 0.0)), pytest.approx((0.0, 0.0)), pytest.approx((1 / s, 0.0))]


def test_roc_auc_matches_evaluator_and_pairs(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    rows = [(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1), (0.4, 1), (0.4, 0), (0.9, 1), (0.2, 0), (0.6, 0)]
    df = spark.createDataFrame(rows, "score double, label int")
    got = ML.roc_auc(df)
    pos = [sc for sc, y in rows if y == 1]
    neg = [sc for sc, y in rows if y == 0]
    pairs = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))
    assert got == pytest.approx(pairs)
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert got == pytest.approx(ev.evaluate(df.withColumn("label", F.col("label").cast("double"))))


@pytest.fixture(scope="module")
def observations(spark):
    """Rows whose mortality flag and risk level depend on their features."""
    rng = random.Random(11)
    rows = []
    for _ in range(900):
        year, length, value = rng.randint(2005, 2015), rng.randint(0, 4), rng.uniform(0, 6e5)
        risk = "Low" if value < 1e5 else "Moderate" if value < 2.5e5 else "High" if value < 5e5 else "Very High"
        cancer = int(rng.random() < 0.5)
        died = int(rng.random() < 1 / (1 + math.exp(-(2 * cancer - 2 + (value - 3e5) / 2e5))))
        rows.append((year, length, value, died, cancer, rng.randint(0, 6), risk if rng.random() > 0.02 else None))
    return spark.createDataFrame(rows, "YearStart int, disease_duration int, value_normalized double, is_mortality int, "
                                 "topic_Cancer int, LocationAbbr_enc int, risk_level string").cache()


def test_mortality_model_is_at_its_optimum(spark, observations):
    got = ML.train_mortality_model(observations, folds=3)
    assert got["rows"] == 900 and got["scored"].count() == 900  # every row scored once
    assert got["auc"] == pytest.approx(ML.roc_auc(got["scored"])) and got["auc"] > 0.7
    feats = got["feature_names"]
    assert feats == ["YearStart", "disease_duration", "value_normalized", "topic_Cancer"]
    rows = observations.select(*feats, "is_mortality").toPandas()
    x, y = rows[feats].to_numpy(float), rows.is_mortality.to_numpy(float)
    x = (x - x.mean(0)) / x.std(0)
    weight = np.where(y == 1, 900 / (2 * y.sum()), 900 / (2 * (900 - y.sum())))
    table = got["coefficients"].orderBy("place").collect()
    assert [r.feature for r in table] == [*feats, "(intercept)"]
    assert [r["mean"] for r in table[:-1]] == pytest.approx(list(rows[feats].to_numpy(float).mean(0)))
    coef, bias = np.array([r.coefficient for r in table[:-1]]), table[-1].coefficient
    error = weight * (1 / (1 + np.exp(-(x @ coef + bias))) - y)
    # Gradient of the weighted log loss plus half the squared coefficients (C = 1).
    assert np.abs(x.T @ error + coef).max() < 0.05 and abs(error.sum()) < 0.05


def test_risk_classifier_and_importances(spark, observations):
    got = ML.train_risk_classifier(observations, features=("YearStart", "disease_duration", "value_normalized", "absent"),
                                   folds=3, trees=12, depth=6)
    known = observations.filter("risk_level IS NOT NULL").count()
    report = {r.cls: r for r in got["report"].collect()}
    assert got["labels"] == ["High", "Low", "Moderate", "Very High"] and got["tiny_classes"] == []
    assert report["accuracy"].support == known and got["accuracy"] > 0.9 and got["macro_f1"] > 0.9
    importances = {r.feature: r.importance for r in got["feature_importances"].collect()}
    assert sum(importances.values()) == pytest.approx(1) and max(importances, key=importances.get) == "value_normalized"
    assert [r.feature for r in ML.top_importances(got["feature_importances"], 1).collect()] == ["value_normalized"]


@pytest.fixture(scope="module")
def states(observations):
    state = F.concat(F.lit("s"), (F.col("LocationAbbr_enc") * 3 + F.col("YearStart") % 3).cast("string"))
    return observations.withColumn("LocationAbbr", state).withColumn("topic_Other", 1 - F.col("topic_Cancer"))


@pytest.fixture(scope="module")
def whole_run(spark, states, tmp_path_factory):
    from strata.plans import modeling
    path = str(tmp_path_factory.mktemp("run"))
    return modeling.run(spark, states, path, starts=2, trees=4), path


def test_training_run_writes_its_outputs(spark, whole_run):
    got, path = whole_run
    read = lambda name: spark.read.option("header", True).csv(f"{path}/{name}")
    assert read("state_clusters").count() == 21
    assert read("feature_importances").count() == len(got["risk"]["feature_names"])
    assert read("model_summary").count() == got["summary"].count() > 0


class Stopped(RuntimeError):
    pass


def test_training_run_goes_on_where_it_stopped(spark, states, whole_run, tmp_path, monkeypatch):
    from strata.plans import modeling
    fits, fit, whole = [], ML.fit_forest, ML.train_risk_classifier

    def stopping(*args, **kwargs):
        raise Stopped

    def second_fails(*args):
        fits.append(args)
        if len(fits) == 2:
            raise Stopped
        return fit(*args)

    path = str(tmp_path)
    monkeypatch.setattr(ML, "train_risk_classifier", stopping)  # stops after clusters and mortality model
    with pytest.raises(Stopped):
        modeling.run(spark, states, path, starts=2, trees=4)
    monkeypatch.setattr(ML, "train_risk_classifier", whole)
    monkeypatch.setattr(ML, "fit_forest", second_fails)  # and again in the second fold
    with pytest.raises(Stopped):
        modeling.run(spark, states, path, starts=2, trees=4)
    monkeypatch.setattr(modeling, "cluster_states", stopping)
    got = modeling.run(spark, states, path, starts=2, trees=4)
    assert got["steps"].ran == [*(f"risk-fold-{f}" for f in range(1, 5)), "risk-importances"]
    once = whole_run[0]
    assert once["steps"].ran[:5] == ["clusters", "silhouette", "mortality-frame", "mortality-scores", "mortality-model"]
    assert len(once["steps"].ran) == 5 + 1 + 5 + 1
    assert sorted(map(tuple, got["summary"].collect())) == sorted(map(tuple, once["summary"].collect()))
    # Other rows or parameters are another run.
    from strata.plans.steps import Steps, fingerprint
    assert fingerprint(states) == fingerprint(states.repartition(3)) != fingerprint(states.limit(899))
    assert Steps(spark, path, {"trees": 4}).path != Steps(spark, path, {"trees": 5}).path


def test_blocks_vote_like_one_forest(spark, observations, monkeypatch):
    """The class probabilities are the mean over all trees, whatever the blocks."""
    from strata.operators import forest
    monkeypatch.setattr(forest, "TREES_PER_BLOCK", 3)
    feats = ["YearStart", "disease_duration", "value_normalized"]
    rows = ML.feature_frame(ML.labelled(observations, "risk_level"), feats, "risk_level")
    data, labels = ML.index_labels(rows)
    model = ML.fit_forest(data, feats, labels, 8, 4, 5)
    assert [b.getNumTrees for b in model.blocks] == [3, 3, 2] and model.trees == 8
    some = ML.assemble(rows.limit(50), feats)
    scored = model.scored(some).collect()
    for r in scored:
        votes = np.zeros(len(labels))
        for block in model.blocks:
            for tree in block.trees:
                votes += np.array(tree.predictProbability(r.features).toArray())
        assert list(r.probabilities) == pytest.approx(list(votes / 8))
        assert r.prediction == labels[int(np.argmax(r.probabilities))]
    shares = dict(model.importances(feats))
    mean = np.mean([t.featureImportances.toArray() for b in model.blocks for t in b.trees], axis=0)
    assert [shares[f] for f in feats] == pytest.approx(list(mean / mean.sum()))


def test_calibration_bins_and_thresholds(spark):
    from strata.operators import quality as DQ
    rng = random.Random(5)
    rows = [(s := rng.random(), int(rng.random() < s)) for _ in range(2000)]
    scored = spark.createDataFrame(rows, "score double, label int").withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    bins = DQ.calibration(scored).collect()
    assert sum(r.n for r in bins) == 2000
    for r in bins:
        inside = [(s, y) for s, y in rows if min(int(s * len(bins)), len(bins) - 1) == r.bin]
        assert r.mean_score == pytest.approx(sum(s for s, _ in inside) / len(inside))
        assert r.observed_rate == pytest.approx(sum(y for _, y in inside) / len(inside))
    rates = DQ.error_rates(scored).first()
    negative = [s >= 0.5 for s, y in rows if not y]
    assert rates["false_positive_rate"] == pytest.approx(sum(negative) / len(negative))


def test_trees_over_cells_are_those_over_rows(spark, monkeypatch):
    """Equal rows count by their number: bootstraps, weights, votes and folds."""
    from strata.operators import forest
    monkeypatch.setattr(forest, "ROWS_PER_PARTITION", 1_000)
    monkeypatch.setattr(forest, "TREES_PER_BLOCK", 4)
    rng = random.Random(3)
    rows = []
    for _ in range(4000):
        year, place = rng.randint(2005, 2008), rng.randint(0, 3)
        rows.append((year, place, rng.randint(0, 1), "Low" if place > 1 and rng.random() < 0.95 else "High"))
    df = spark.createDataFrame(rows, "YearStart int, LocationAbbr_enc int, is_mortality int, risk_level string")
    feats = ["YearStart", "LocationAbbr_enc", "is_mortality"]
    calls, over_cells = [], forest.grown_over_cells
    monkeypatch.setattr(forest, "grown_over_cells", lambda *a: calls.append(a[-1]) or over_cells(*a))
    got = ML.train_risk_classifier(df, features=feats, folds=3, trees=10, depth=4)
    assert len(calls) == 4 and max(calls) <= 64  # three folds and the refit
    report = {r.cls: r for r in got["report"].collect()}
    assert report["accuracy"].support == 4000 and got["predictions"].agg(F.sum("n")).first()[0] == 4000
    assert got["accuracy"] == pytest.approx(sum((p > 1) == (r == "Low") for _, p, _, r in rows) / 4000)
    model = got["model"]
    assert [b.getNumTrees for b in model.blocks] == [4, 4, 2]
    frame = ML.feature_frame(df, feats, "risk_level")
    cells, labels = ML.index_labels(forest.cells(frame, feats))
    again = ML.fit_forest(cells, feats, labels, 10, 4, 42)
    assert again.importances(feats) == model.importances(feats)
    each = [t.featureImportances.toArray() for b in model.blocks for t in b.trees]
    assert len(each) == 10 and np.std(each, axis=0).max() > 0  # of bootstraps and feature subsets of their own


def test_bootstraps_of_cells_are_poisson(spark):
    """A cell of n rows is drawn n times in the mean, with variance n; trees differ."""
    import pyarrow as pa
    from strata.operators import forest
    n = np.full(2000, 50)
    batch = pa.RecordBatch.from_arrays([pa.array(n), pa.array(np.arange(2000))], names=["n", "cell"])
    draws = np.array(next(iter(forest._draws(7, 3)([batch]))).column(2).to_pylist())
    assert draws.mean() == pytest.approx(50, abs=1) and draws.var() == pytest.approx(50, rel=0.1)
    assert abs(np.corrcoef(draws[:, 0], draws[:, 1])[0, 1]) < 0.1


def test_models_side_by_side_are_those_of_mllib(spark, observations, monkeypatch):
    """Each training part gives the coefficients of a fit of its own; a step is one scan of all."""
    from pyspark.ml.classification import LogisticRegression
    from strata.operators import logistic
    feats = ["YearStart", "disease_duration", "value_normalized", "topic_Cancer", "constant"]
    frame = ML.feature_frame(observations.withColumn("constant", F.lit(3.0)), feats, "is_mortality",
                             [(F.col("LocationAbbr_enc") % 3).alias("fold")]).cache()
    scans, sums = [], logistic._sums
    monkeypatch.setattr(logistic, "_sums", lambda *a: scans.append(a) or sums(*a))
    parts = [[1, 2], [0, 2], [0, 1, 2]]
    found = logistic.fit(frame, feats, "fold", parts, 100)
    assert len(scans) < 12
    for part, model in zip(parts, found, strict=True):
        train = ML.with_class_weights(frame.filter(F.col("fold").isin(part)))
        params = ML.fit_standardizer(train, feats)
        assert list(model.means) == pytest.approx([params[f][0] for f in feats])
        assert list(model.stds) == pytest.approx([params[f][1] for f in feats])
        n = train.count()
        mllib = LogisticRegression(weightCol="weight", regParam=1.0 / n, standardization=False, tol=1e-10).fit(
            ML.assemble(ML.apply_standardizer(train, params), feats))
        assert list(model.coefficients) == pytest.approx(list(mllib.coefficients), abs=1e-4)
        assert model.intercept == pytest.approx(mllib.intercept, abs=1e-4)
    score = frame.select(found[2].score().alias("s")).agg(F.min("s"), F.max("s")).first()
    assert 0 < score[0] < score[1] < 1


def test_model_of_one_class_and_of_rows_that_separate(spark):
    from strata.operators import logistic
    rows = [(float(i), int(i >= 20), 0) for i in range(40)] + [(1.0, 1, 1)] * 3
    frame = spark.createDataFrame(rows, "x double, label int, fold int")
    apart, one = logistic.fit(frame, ["x"], "fold", [[0], [1]], 100)
    assert frame.filter("fold = 0").filter((apart.score() >= 0.5) != (F.col("label") == 1)).count() == 0
    assert [r[0] for r in frame.select(one.score()).distinct().collect()] == [1.0]
    with pytest.raises(ValueError):
        logistic.fit(frame, ["x"], "fold", [[7]], 100)
