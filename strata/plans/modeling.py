"""L3 — modelling run (M17): clustering, mortality model, risk classifier, outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.constants import FOREST_DEPTH, FOREST_TREES, KMEANS_K, KMEANS_STARTS, RISK_FEATURES, SEED
from strata.operators import forest, ml
from strata.operators.priority import materialize
from strata.operators.reshape import state_disease_matrix


def cluster_states(processed: DataFrame, k: int = KMEANS_K, starts: int = KMEANS_STARTS,
                   seed: int = SEED) -> dict:
    """R2 + M2-M4: states clustered by their topic mix."""
    matrix = state_disease_matrix(processed)
    return ml.cluster_entities(matrix, "LocationAbbr", k, starts, seed)


def fit_risk_forest(processed: DataFrame, trees: int = FOREST_TREES, depth: int = FOREST_DEPTH,
                    seed: int = SEED) -> DataFrame:
    """M12 refit on all labelled rows + M15: importances by feature, desc."""
    feats = ml.available_features(processed, RISK_FEATURES)
    frame = ml.feature_frame(ml.labelled(processed, "risk_level"), feats, "risk_level")
    cells, labels = ml.index_labels(materialize(forest.cells(frame, feats), "forest-cells"))
    data = cells
    if not forest.by_cells(cells.agg(F.sum("n")).first()[0] or 0, cells.count()):
        data = cells.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).drop("_copy", "cell", "n")
    return ml.importance_table(processed.sparkSession, ml.fit_forest(data, feats, labels, trees, depth, seed), feats)


def run(spark: SparkSession, processed: DataFrame, out_dir: str | None = None,
        starts: int = KMEANS_STARTS, trees: int = FOREST_TREES) -> dict:
    """The full modelling run; writes the three outputs when ``out_dir`` is set.

    With an ``out_dir`` every part of the run is a step that is written when
    ready: the clusters and their score, the mortality model's frame, scores and
    coefficients, the risk classifier's frame, each of its folds and its
    importances. A run that was stopped goes on where it stopped, if the rows of
    ``processed`` and the parameters are the same (:mod:`strata.plans.steps`).
    """
    from strata.plans.steps import Steps, fingerprint
    from strata.sources.export import write_csv

    keep = ml.written
    if out_dir:
        keep = Steps(spark, out_dir, fingerprint(processed) | {"starts": starts, "trees": trees, "depth": FOREST_DEPTH,
                                                               "k": KMEANS_K, "seed": SEED})
    points = keep("clusters", lambda: cluster_states(processed, starts=starts)["points"])
    silhouette = keep("silhouette", lambda: spark.createDataFrame([(ml.silhouette_euclidean(points),)], "value double"))
    mortality = ml.train_mortality_model(processed, keep=keep)
    risk = ml.train_risk_classifier(processed, trees=trees, keep=keep)
    summary = ml.model_summary(spark, silhouette.first().value, mortality, risk)
    clusters = {"assignments": points.drop("features"), "points": points, "n_clusters": KMEANS_K}
    if out_dir:
        write_csv(clusters["assignments"], f"{out_dir}/state_clusters")
        write_csv(risk["feature_importances"], f"{out_dir}/feature_importances")
        write_csv(summary, f"{out_dir}/model_summary")
    return {"clustering": clusters, "mortality": mortality, "risk": risk, "summary": summary, "steps": keep}
