"""Modelling baselines on MLlib.

* features are assembled JVM-side (VectorAssembler) from columns that exist;
* standardisation uses the *population* standard deviation, fitted on the
  training rows only (inside each fold);
* folds are exactly stratified: the position of a row inside its class, by
  a seeded hash, taken modulo the number of folds — numbered within ranges of
  the hash, so the 99 % majority class is never one task;
* class weights are n / (k * n_class), a join against a k-row table;
* metrics come from aggregates over (label, prediction) counts.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.constants import (
    CV_FOLDS,
    FOREST_DEPTH,
    FOREST_TREES,
    KMEANS_K,
    KMEANS_STARTS,
    LOGISTIC_MAX_ITER,
    MORTALITY_FEATURES,
    PROBABILITY_THRESHOLD,
    RISK_FEATURES,
    SEED,
    TINY_CLASS_ROWS,
)
from strata.operators import forest, logistic
from strata.operators.silhouette import silhouette_euclidean  # noqa: F401

MAX_CLASSES = 1_000
PARALLEL_FITS = 8


# --- M1 / M2 -------------------------------------------------------------------------

def available_features(df: DataFrame, names) -> list[str]:
    """M1: the listed features that exist, in list order."""
    return [n for n in names if n in df.columns]


def feature_frame(df: DataFrame, features: list[str], label: str, keep=()) -> DataFrame:
    """M1: features as doubles with missing -> 0, plus the label column."""
    cols = [F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(0.0)).alias(f) for f in features]
    return df.select(*cols, F.col(label).alias("label"), *keep)


def fit_standardizer(df: DataFrame, features: list[str]) -> dict[str, tuple[float, float]]:
    """M2: mean and population std of every feature (one aggregate job)."""
    aggs = []
    for i, f in enumerate(features):
        aggs += [F.avg(F.col(f"`{f}`")).alias(f"m{i}"), F.stddev_pop(F.col(f"`{f}`")).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    return {f: (float(row[f"m{i}"] or 0.0), float(row[f"s{i}"] or 0.0)) for i, f in enumerate(features)}


def apply_standardizer(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    """(x - mean) / std; a constant feature (std 0) becomes 0."""
    return df.withColumns({
        f: ((F.col(f"`{f}`") - F.lit(m)) / F.lit(s)) if s > 0 else F.lit(0.0)
        for f, (m, s) in params.items()
    })


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="keep").transform(df)


# --- M5 / M6 / M13 / M14 ---------------------------------------------------------------

def class_counts(df: DataFrame, label: str = "label", count: str | None = None) -> DataFrame:
    """Rows per class; a row of ``df`` stands for ``count`` rows, if given."""
    return df.groupBy(label).agg((F.sum(count) if count else F.count(F.lit(1))).alias("n"))


def class_weights(df: DataFrame, label: str = "label", count: str | None = None) -> DataFrame:
    """M5: balanced weights n / (k * n_class) per class."""
    counts = class_counts(df, label, count)
    total = counts.select(F.sum("n")).scalar()
    k = counts.select(F.count(F.lit(1))).scalar()
    return counts.withColumn("weight", total.cast("double") / (k * F.col("n")).cast("double"))


def with_class_weights(df: DataFrame, label: str = "label", out: str = "weight", count: str | None = None) -> DataFrame:
    """Attach M5 weights; the class table has k rows (checked), counted once, so it is broadcast."""
    weights = class_weights(df, label, count).select(label, F.col("weight").alias(out))
    rows = weights.limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    return df.join(F.broadcast(df.sparkSession.createDataFrame(rows, weights.schema)), label)


def with_folds(df: DataFrame, label: str = "label", folds: int = CV_FOLDS, seed: int = SEED,
               row_id: str | None = None, out: str = "fold") -> DataFrame:
    """M6: exact stratified folds.

    Rows of each class are ordered by a seeded hash of a row id and dealt to
    folds round-robin, so every class is split as evenly as possible. The row
    id defaults to ``monotonically_increasing_id``, frozen by a written table
    before it is used, so the assignment survives recomputation.

    The hash is uniform: its leading bits cut it into ``2**FOLD_BUCKET_BITS``
    ranges without looking at the data. Rows are numbered inside (class, range)
    and a small table of counts gives each range its start, so the majority
    class is spread over all ranges and rows are shuffled once.
    """
    from strata.operators.priority import materialize

    rid = F.col(row_id) if row_id else F.monotonically_increasing_id()
    keyed = df.withColumn("_h", F.xxhash64(rid, F.lit(seed)))
    keyed = keyed.withColumn("_b", F.shiftrightunsigned("_h", 64 - FOLD_BUCKET_BITS))
    if row_id is None:
        keyed = materialize(keyed)
    sizes = keyed.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col(label).alias("_label"), F.col("_b").alias("_range"),
                          F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(label, "_b").orderBy("_h")
    placed = keyed.withColumn("_place", F.row_number().over(inside) - 1).join(
        starts, F.col(label).eqNullSafe(F.col("_label")) & (F.col("_b") == F.col("_range")))
    fold = F.pmod(F.col("_start") + F.col("_place"), F.lit(folds)).cast("int")
    return placed.withColumn(out, fold).select(*df.columns, out)


FOLD_BUCKET_BITS = 12
TRAINING_ROWS_PER_PARTITION = 250_000
#: Iterative fits are spread over the cluster while a task keeps this many rows.
LEAST_ROWS_PER_TASK = 5_000


def labelled(df: DataFrame, label: str) -> DataFrame:
    """Rows whose label is known."""
    return df.dropna(subset=[label])


def tiny_classes(df: DataFrame, label: str = "label", threshold: int = TINY_CLASS_ROWS) -> DataFrame:
    """Classes with fewer than ``threshold`` rows."""
    return class_counts(df, label).filter(F.col("n") < threshold)


# --- M9 / M10 / M11 --------------------------------------------------------------------

def positive_rate(df: DataFrame, label: str = "label") -> DataFrame:
    """M9: rows and share of positive labels."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.avg(F.col(label).cast("double")).alias("positive_rate"))


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score") -> float:
    """Exact, tie-aware ROC AUC as a Mann-Whitney rank sum.

    AUC = (sum of positive ranks - P(P+1)/2) / (P * N), ties taking their
    average rank. Ranks come from the distributed prefix counts in
    :mod:`strata.operators.ranking` over distinct scores, so no threshold
    is down-sampled and no single task sorts every score.
    """
    from strata.operators.ranking import value_ranks

    s = scored.select(F.col(score).cast("double").alias("_s"), F.col(label).cast("int").alias("_y"))
    per = s.groupBy("_s").agg(F.count(F.lit(1)).alias("_n"), F.sum("_y").alias("_p"))
    ranks = value_ranks(s.select("_s"), "_s")
    avg_rank = F.col("_below").cast("double") + (F.col("_n").cast("double") + F.lit(1.0)) / F.lit(2.0)
    row = per.join(ranks, "_s").agg(
        F.sum(F.col("_p").cast("double") * avg_rank).alias("rank_sum"),
        F.sum("_p").alias("pos"), F.sum("_n").alias("rows")).first()
    pos = float(row["pos"] or 0)
    neg = float((row["rows"] or 0) - (row["pos"] or 0))
    if pos == 0 or neg == 0:
        return float("nan")
    return (float(row["rank_sum"]) - pos * (pos + 1) / 2.0) / (pos * neg)


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                          count: str | None = None) -> DataFrame:
    """Per-class precision, recall, F1 and support, then accuracy,
    macro and weighted averages (0 where a ratio is undefined).

    Works on the (label, prediction) count table: k^2 rows at most. A row of
    ``pred`` stands for ``count`` rows, if given.
    """
    pairs = (pred.select(F.col(label).cast("string").alias("y"), F.col(prediction).cast("string").alias("p"),
                         (F.col(count) if count else F.lit(1)).cast("long").alias("n"))
             .groupBy("y", "p").agg(F.sum("n").alias("n")))
    support = pairs.groupBy(F.col("y").alias("cls")).agg(F.sum("n").alias("support"))
    predicted = pairs.groupBy(F.col("p").alias("cls")).agg(F.sum("n").alias("predicted"))
    hits = pairs.filter(F.col("y") == F.col("p")).select(F.col("y").alias("cls"), F.col("n").alias("tp"))
    per = (support.join(predicted, "cls", "full").join(hits, "cls", "left")
           .fillna(0, subset=["support", "predicted", "tp"]))
    precision = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted").cast("double")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support").cast("double")), F.lit(0.0))
    per = per.withColumns({"precision": precision, "recall": recall})
    f1 = F.coalesce(F.try_divide(F.lit(2.0) * F.col("precision") * F.col("recall"),
                                 F.col("precision") + F.col("recall")), F.lit(0.0))
    per = per.withColumn("f1_score", f1)
    # Classes only ever predicted (never true) have support 0; they still
    # count in the macro average, as in the usual report.
    totals = per.agg(
        F.sum("support").alias("n"), F.sum("tp").alias("tp"), F.count(F.lit(1)).alias("k"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1_score").alias("mf"),
        F.sum(F.col("precision") * F.col("support")).alias("wp"),
        F.sum(F.col("recall") * F.col("support")).alias("wr"),
        F.sum(F.col("f1_score") * F.col("support")).alias("wf"))
    n = F.col("n").cast("double")
    acc = F.col("tp").cast("double") / n
    summary = totals.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("cls"), acc.alias("precision"), acc.alias("recall"),
                 acc.alias("f1_score"), F.col("n").alias("support")),
        F.struct(F.lit("macro avg").alias("cls"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                 F.col("mf").alias("f1_score"), F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("cls"), (F.col("wp") / n).alias("precision"),
                 (F.col("wr") / n).alias("recall"), (F.col("wf") / n).alias("f1_score"),
                 F.col("n").alias("support")),
    )).alias("r")).select("r.*")
    return per.select("cls", "precision", "recall", "f1_score", "support").unionByName(summary)


def local_copy(df: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """A small result (reports, metrics) held as local rows, so it no longer
    depends on cached or persisted inputs. Raises beyond ``max_rows``."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"result larger than {max_rows} rows")
    return df.sparkSession.createDataFrame(rows, df.schema)


def report_metric(report: DataFrame, cls: str, metric: str) -> float:
    row = report.filter(F.col("cls") == cls).select(metric).first()
    return float(row[0]) if row and row[0] is not None else float("nan")


# --- M3 / M4 --------------------------------------------------------------------------

def kmeans_best_of(df: DataFrame, k: int = KMEANS_K, starts: int = KMEANS_STARTS, seed: int = SEED,
                   features: str = "features", max_iter: int = 300, tol: float = 1e-4):
    """M3: KMeans from ``starts`` seeds, keeping the lowest within-cluster cost
    (Spark has no n_init). The input is cached once for all starts."""
    df = df.cache()
    df.count()  # fill the cache once, before concurrent starts read it

    def fit(i):
        model = KMeans(k=k, seed=seed + i, featuresCol=features, predictionCol="cluster",
                       maxIter=max_iter, tol=tol, initMode="k-means||").fit(df)
        return model.summary.trainingCost, i, model

    # Starts are independent: submit them as concurrent Spark jobs.
    try:
        with ThreadPoolExecutor(max_workers=min(PARALLEL_FITS, starts)) as pool:
            results = list(pool.map(inheritable_thread_target(df.sparkSession)(fit), range(starts)))
    finally:
        df.unpersist()
    return min(results, key=lambda r: (r[0], r[1]))[2]


def silhouette_squared(pred: DataFrame, features: str = "features", cluster: str = "cluster") -> float:
    """Silhouette with squared Euclidean distance (distributed, O(n k))."""
    ev = ClusteringEvaluator(featuresCol=features, predictionCol=cluster,
                             distanceMeasure="squaredEuclidean", metricName="silhouette")
    return float(ev.evaluate(pred))


ENTITY_ROWS_PER_PARTITION = 100_000


def right_sized(df: DataFrame, n_rows: int, rows_per_partition: int) -> DataFrame:
    """Coalesce (never up) to partitions of ``rows_per_partition`` rows, or to
    one per core of the cluster while each keeps ``LEAST_ROWS_PER_TASK``."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = max(1, math.ceil(n_rows / rows_per_partition), min(cores, n_rows // LEAST_ROWS_PER_TASK))
    return df.coalesce(parts) if parts < df.rdd.getNumPartitions() else df


def materialize_small(df: DataFrame, rows_per_partition: int = ENTITY_ROWS_PER_PARTITION) -> DataFrame:
    """Prepare an entity-grain table for an iterative estimator.

    Iterative estimators run many Spark jobs. Each job re-plans its input,
    and each task is tracked by the driver, so the input should have a short
    plan and no empty tasks. The table is written to the shared checkpoint
    folder (lineage cut: a Parquet scan instead of the whole cleaning plan),
    coalesced to the partitions its size needs, and cached.
    """
    from strata.operators.priority import materialize
    stored = materialize(df, "entities")
    return right_sized(stored, stored.count(), rows_per_partition).cache()


def cluster_entities(matrix: DataFrame, key: str, k: int = KMEANS_K, starts: int = KMEANS_STARTS,
                     seed: int = SEED) -> dict:
    """M2-M4: standardise the entity matrix, cluster it, score it."""
    feats = [c for c in matrix.columns if c != key]
    filled = matrix.select(key, *[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(c) for c in feats])
    filled = materialize_small(filled)
    scaled = assemble(apply_standardizer(filled, fit_standardizer(filled, feats)), feats)
    try:
        model = kmeans_best_of(scaled, k, starts, seed)
        pred = model.transform(scaled)
        from strata.operators.priority import materialize
        assigned = materialize(pred.select(key, *feats, "features", F.col("cluster").cast("int").alias("cluster")),
                               "clusters")
        result = {
            "silhouette_squared": silhouette_squared(assigned), "n_clusters": k,
            "points": assigned, "assignments": assigned.drop("features"),
        }
    finally:
        filled.unpersist()
    return result


# --- M7 / M8 / M12 / M15 ---------------------------------------------------------------

def written(name: str, make) -> DataFrame:
    """The table that ``make()`` gives, written once to the shared folder. Staged
    runs pass :class:`strata.plans.steps.Steps` in its place."""
    from strata.operators.priority import materialize
    return materialize(make(), name)


def training_frame(df: DataFrame, features: list[str], label: str, seed: int = SEED, folds: int = CV_FOLDS) -> DataFrame:
    """Features, label and stratified folds. To be written before use: ids and folds are frozen then."""
    return with_folds(feature_frame(df, features, label), seed=seed, folds=folds)


def kept(frame: DataFrame, rows_per_partition: int = TRAINING_ROWS_PER_PARTITION) -> DataFrame:
    """``frame`` sized for iterative fits and held in memory: every optimizer
    iteration is a job over a short plan with no empty tasks."""
    sized = right_sized(frame, frame.count(), rows_per_partition).persist()
    sized.count()
    return sized


def train_mortality_model(df: DataFrame, features=MORTALITY_FEATURES, folds: int = CV_FOLDS,
                          max_iter: int = LOGISTIC_MAX_ITER, seed: int = SEED, keep=written) -> dict:
    """M8: weighted L2 logistic regression (C = 1) on standardised features,
    5-fold out-of-fold AUC and report, then a refit on all rows.

    The models of all folds and the refit are fitted side by side
    (:mod:`strata.operators.logistic`). ``keep`` writes the training frame, the scores
    and the refit (see :func:`written`).
    """
    feats = available_features(df, features)
    frame = keep("mortality-frame", lambda: training_frame(df, feats, "is_mortality", seed, folds))
    fits: list[logistic.Logistic] = []

    def models():
        if not fits:
            each = [[g for g in range(folds) if g != f] for f in range(folds)]
            fits.extend(logistic.fit(frame, feats, "fold", [*each, list(range(folds))], max_iter))
        return fits

    def scores():
        own = [F.when(F.col("fold") == f, m.score()) for f, m in enumerate(models()[:folds])]
        return frame.select("label", F.coalesce(*own).alias("score"))

    def refit():
        m = models()[-1]
        rows = [(i, *r) for i, r in enumerate(zip(feats, m.means, m.stds, m.coefficients, strict=True))]
        return frame.sparkSession.createDataFrame(
            [*rows, (len(feats), "(intercept)", 0.0, 1.0, m.intercept)],
            "place int, feature string, mean double, std double, coefficient double")

    scored = keep("mortality-scores", scores)
    coefficients = keep("mortality-model", refit)
    scored = scored.withColumn("prediction", (F.col("score") >= PROBABILITY_THRESHOLD).cast("int"))
    report = local_copy(classification_report(scored))
    rates = positive_rate(frame).first()
    return {
        "coefficients": coefficients, "auc": roc_auc(scored), "scored": scored,
        "accuracy": report_metric(report, "accuracy", "precision"),
        "macro_f1": report_metric(report, "macro avg", "f1_score"),
        "report": report, "feature_names": feats,
        "rows": int(rates["rows"]), "positive_rate": float(rates["positive_rate"] or 0.0),
    }


def label_indexer(df: DataFrame):
    """Adds ``label_idx``, the place of ``label`` among the labels of ``df`` in order."""
    return StringIndexer(inputCol="label", outputCol="label_idx", stringOrderType="alphabetAsc").fit(df)


def index_labels(df: DataFrame):
    """``df`` with ``label_idx``, and the labels in the order of their index."""
    indexer = label_indexer(df)
    return indexer.transform(df), list(indexer.labels)


def fit_forest(rows: DataFrame, feats: list[str], labels: list[str], trees: int, depth: int, seed: int) -> forest.Forest:
    """Balanced forest over ``rows`` (features, ``label``, ``label_idx``): the
    weights are those of these rows. The assembled rows are held in memory.
    Rows with ``cell`` and ``n`` are cells of equal rows (:func:`forest.cells`)."""
    if "cell" in rows.columns:
        train = with_class_weights(rows, count="n").select(*(f"`{f}`" for f in feats), "label_idx", "weight", "n", "cell")
        return forest.grown_over_cells(train, feats, labels, trees, depth, seed, rows.count())
    train = assemble(with_class_weights(rows), feats).select("features", "label_idx", "weight")
    train = forest.partitioned(train, rows.count()).persist()
    try:
        return forest.grown(train, labels, trees, depth, seed)
    finally:
        train.unpersist()


def importance_table(spark, model: forest.Forest, feats: list[str]) -> DataFrame:
    """Importances by value, descending."""
    table = spark.createDataFrame(model.importances(feats), "feature string, importance double")
    return table.orderBy(F.col("importance").desc(), "feature")


def train_risk_classifier(df: DataFrame, features=RISK_FEATURES, folds: int = CV_FOLDS,
                          trees: int = FOREST_TREES, depth: int = FOREST_DEPTH, seed: int = SEED, keep=written) -> dict:
    """Balanced random forest on rows with a risk label; macro and
    weighted F1 from out-of-fold predictions; importances from a refit.

    Folds run one after another, each written by ``keep`` when it is ready; the
    trees of a forest run beside each other (:mod:`strata.operators.forest`), over
    cells of equal rows where these are few. Equal rows have one prediction: a fold's
    different features are scored once each, spread over the cluster, and the
    predictions are ``(label, prediction, n)``, counted over cells.
    """
    from strata.operators.priority import materialize

    spark = df.sparkSession
    feats = available_features(df, features)
    frame = keep("risk-frame", lambda: training_frame(labelled(df, "risk_level"), feats, "risk_level", seed, folds))
    counts = materialize(forest.cells(frame, feats, folds), "risk-cells")
    indexer = label_indexer(counts)
    counts, labels = indexer.transform(counts), list(indexer.labels)
    tiny = [r["label"] for r in tiny_classes(frame).collect()]
    held: list[DataFrame] = []
    models = {}
    n_cells = counts.count()
    few = forest.by_cells(frame.count(), n_cells)
    parts_scored = max(spark.sparkContext.defaultParallelism, math.ceil(n_cells / forest.ROWS_PER_PARTITION))

    def rows(fold=None):
        """All rows, or those outside ``fold``; as cells where these are few."""
        if few:
            left = sum((F.col(f"n_{f}") for f in range(folds) if f != fold), F.lit(0))
            return counts.withColumn("n", left.cast("long")).filter("n > 0")
        if not held:
            held.append(kept(indexer.transform(frame), forest.ROWS_PER_PARTITION))
        return held[0] if fold is None else held[0].filter(F.col("fold") != fold)

    def predicted(fold):
        model = fit_forest(rows(fold), feats, labels, trees, depth, seed)
        names = [F.col(f"`{f}`") for f in feats]
        own = counts.filter(F.col(f"n_{fold}") > 0).repartition(parts_scored, *names).groupBy(*names).agg(
            F.collect_list(F.struct("label", F.col(f"n_{fold}").alias("n"))).alias("own"))
        each = model.scored(assemble(own, feats)).select("prediction", F.inline("own"))
        return each.groupBy("label", "prediction").agg(F.sum("n").alias("n"))

    def refit():
        models["refit"] = fit_forest(rows(), feats, labels, trees, depth, seed)
        return importance_table(spark, models["refit"], feats)

    try:
        parts = [keep(f"risk-fold-{f}", lambda f=f: predicted(f)) for f in range(folds)]
        importances = keep("risk-importances", refit)
    finally:
        for rows_held in held:
            rows_held.unpersist()
    pred = parts[0]
    for p in parts[1:]:
        pred = pred.unionByName(p)
    report = local_copy(classification_report(pred, count="n"))
    return {
        "model": models.get("refit"), "predictions": pred, "accuracy": report_metric(report, "accuracy", "precision"),
        "macro_f1": report_metric(report, "macro avg", "f1_score"),
        "weighted_f1": report_metric(report, "weighted avg", "f1_score"),
        "report": report, "feature_importances": top_importances(importances, len(feats)), "feature_names": feats,
        "tiny_classes": tiny, "labels": labels,
    }


def top_importances(importances: DataFrame, k: int = 20) -> DataFrame:
    """Importances by value desc (name breaks ties), first ``k``."""
    return importances.orderBy(F.col("importance").desc(), "feature").limit(k)


def model_summary(spark, silhouette: float, mortality: dict, risk: dict) -> DataFrame:
    """The six headline metrics as (metric, value) rows."""
    rows = [
        ("kmeans_silhouette", silhouette),
        ("mortality_auc", mortality["auc"]),
        ("mortality_macro_f1", mortality["macro_f1"]),
        ("risk_accuracy", risk["accuracy"]),
        ("risk_macro_f1", risk["macro_f1"]),
        ("risk_weighted_f1", risk["weighted_f1"]),
    ]
    return spark.createDataFrame([(m, float(v) if v is not None and not math.isnan(v) else None)
                                  for m, v in rows], "metric string, value double")
