"""Evaluation over time and matched comparison: rolling origins (D9) and matched
cohorts (D10).

Both work on cells: rows are counted and added up once, and everything else
re-aggregates the cells, whose number is bounded by segments and years.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.constants import LOGISTIC_MAX_ITER, MORTALITY_FEATURES, PROBABILITY_THRESHOLD
from strata.functions.numeric import exact_sum, ordered_mean_of, ordered_sum_of
from strata.operators import logistic, ml
from strata.operators.priority import materialize
from strata.operators.quality import SEGMENT

#: Models of different origins that are fitted beside each other.
PARALLEL_ORIGINS = 3


# --- D9: rolling origins ---------------------------------------------------------------

def rolling_cells(obs: DataFrame, label: str = "is_mortality", segment=SEGMENT) -> DataFrame:
    """``(cutoff, *segment, n_before, pos_before, n_from, pos_from)``: rows and
    positive rows of each segment before and from every year but the first.
    Rows without a year are in no period; a missing label counts as negative."""
    positive = F.sum(F.when(F.col(label) == 1, 1).otherwise(0))
    cells = materialize(obs.filter(F.col("YearStart").isNotNull()).groupBy(*segment, "YearStart").agg(
        F.count(F.lit(1)).alias("n"), positive.alias("pos")), "rolling-cells")
    years = cells.agg(F.sort_array(F.collect_set("YearStart"))).scalar()
    each = cells.withColumn("cutoff", F.explode(F.slice(years, F.lit(2), F.greatest(F.size(years), F.lit(1)))))
    before = F.col("YearStart") < F.col("cutoff")

    def total(c, when):
        return F.sum(F.when(when, F.col(c)).otherwise(0))

    return each.groupBy("cutoff", *segment).agg(
        total("n", before).alias("n_before"), total("pos", before).alias("pos_before"),
        total("n", ~before).alias("n_from"), total("pos", ~before).alias("pos_from"))


def rolling_origin(obs: DataFrame, label: str = "is_mortality", segment=SEGMENT) -> DataFrame:
    """One row per cutoff year. Rows before it train, rows from it test:
    sizes and positives of both, balanced class weights of the training rows,
    and the AUC of a fixed score on the test rows, namely the smoothed share of
    positives that the segment had before the cutoff, (positives + 1) / (rows + 2).

    The AUC is exact: rows of one segment share a score, so ranks come from
    running totals over the distinct scores of a cutoff.
    """
    score = (F.col("pos_before") + 1).cast("double") / (F.col("n_before") + 2).cast("double")
    cells = rolling_cells(obs, label, segment).withColumn("score", score)
    sizes = cells.groupBy("cutoff").agg(
        F.sum("n_before").alias("train_rows"), F.sum("pos_before").alias("train_positive"),
        F.sum("n_from").alias("test_rows"), F.sum("pos_from").alias("test_positive"))
    big = "decimal(19,0)"
    levels = cells.groupBy("cutoff", "score").agg(
        F.sum("pos_from").cast(big).alias("p"), (F.sum("n_from") - F.sum("pos_from")).cast(big).alias("q"))
    lower = Window.partitionBy("cutoff").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    levels = levels.withColumn("below", F.coalesce(F.sum("q").over(lower), F.lit(0)).cast(big))
    wins = levels.groupBy("cutoff").agg(
        F.sum(F.col("p") * F.col("below")).alias("won"), F.sum(F.col("p") * F.col("q")).alias("tied"),
        F.sum("p").alias("p"), F.sum("q").alias("q"))
    auc = F.try_divide((F.lit(2) * F.col("won") + F.col("tied")).cast("double"),
                       F.lit(2.0) * F.col("p").cast("double") * F.col("q").cast("double"))

    def weight(n):
        return F.try_divide(F.col("train_rows").cast("double"), (F.lit(2) * n).cast("double"))

    return sizes.join(wins.select("cutoff", auc.alias("baseline_auc")), "cutoff").select(
        "cutoff", "train_rows", "train_positive", "test_rows", "test_positive",
        weight(F.col("train_rows") - F.col("train_positive")).alias("weight_negative"),
        weight(F.col("train_positive")).alias("weight_positive"), "baseline_auc")


def segment_scores(obs: DataFrame, label: str = "is_mortality", segment=SEGMENT) -> DataFrame:
    """``(score, label, prediction)`` for the rows of the latest year: the fixed
    score of :func:`rolling_origin` at that cutoff, and whether it is 0.5 or more."""
    latest = obs.select(F.max("YearStart")).scalar()
    cells = rolling_cells(obs, label, segment).withColumn("score", (F.col("pos_before") + 1).cast("double")
                                                          / (F.col("n_before") + 2).cast("double"))
    keys = [F.col(f"o.{c}").eqNullSafe(F.col(f"c.{c}")) for c in segment]
    rows = obs.filter(F.col("YearStart") == latest).alias("o").join(
        cells.filter(F.col("cutoff") == latest).select(*segment, "score").alias("c"), keys)
    return rows.select("score", F.coalesce((F.col(f"o.{label}") == 1).cast("int"), F.lit(0)).alias("label"),
                       (F.col("score") >= PROBABILITY_THRESHOLD).cast("int").alias("prediction"))


def rolling_models(df: DataFrame, features=MORTALITY_FEATURES, label: str = "is_mortality",
                   max_iter: int = LOGISTIC_MAX_ITER, keep=ml.written) -> DataFrame:
    """The mortality model fitted once per cutoff on the rows before it and
    tested on the rows from it: ``cutoff, train_rows, test_rows, auc, accuracy,
    macro_f1``. Scaling and class weights come from the training rows. A cutoff
    whose training or test rows are of one class has no metrics.
    """
    spark = df.sparkSession
    feats = ml.available_features(df, features)
    rows = df.filter(F.col("YearStart").isNotNull())
    frame = keep("rolling-frame", lambda: ml.feature_frame(rows, feats, label, [F.col("YearStart").alias("_year")]))
    sizes = {r["_year"]: (r["n"], r["pos"]) for r in frame.groupBy("_year").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("label").cast("long")).alias("pos")).collect()}
    cutoffs = sorted(sizes)[1:]
    # The models of all cutoffs side by side: a step of all of them is one scan.
    models = dict(zip(cutoffs, logistic.fit(frame, feats, "_year", [[y for y in sizes if y < c] for c in cutoffs], max_iter),
                      strict=True)) if cutoffs else {}

    def one(cutoff):
        before, after = ([sizes[y] for y in sizes if (y < cutoff) == early] for early in (True, False))
        n = [sum(s[0] for s in part) for part in (before, after)]
        if any(sum(s[1] for s in part) in (0, total) for part, total in zip((before, after), n, strict=True)):
            return cutoff, *n, None, None, None
        test = frame.filter(F.col("_year") >= cutoff)
        scored = keep(f"rolling-{cutoff}", lambda: test.select("label", models[cutoff].score().alias("score")))
        scored = scored.withColumn("prediction", (F.col("score") >= PROBABILITY_THRESHOLD).cast("int"))
        report = ml.local_copy(ml.classification_report(scored))
        return (cutoff, *n, ml.roc_auc(scored), ml.report_metric(report, "accuracy", "precision"),
                ml.report_metric(report, "macro avg", "f1_score"))

    with ThreadPoolExecutor(max_workers=PARALLEL_ORIGINS) as pool:
        found = list(pool.map(inheritable_thread_target(spark)(one), cutoffs))
    return spark.createDataFrame(found, "cutoff int, train_rows long, test_rows long, auc double, accuracy double, macro_f1 double")


# --- D10: matched cohorts ----------------------------------------------------------------

STRATUM = ("LocationAbbr", "Topic", "Stratification1")
CELLS = [(t, p) for t in ("treated", "control") for p in ("pre", "post")]


def matched_strata(obs: DataFrame, treated, cutoff=None, strata=STRATUM) -> DataFrame:
    """Coarsened exact matching: rows are alike when their ``strata`` columns are
    equal (a missing value is a value of its own). A stratum is matched when it
    holds treated and control rows both before and from the cutoff year.

    One row per stratum: ``n_*`` and ``sum_*`` of the four cells, ``matched`` and
    the weights of its control rows, ``weight_pre`` and ``weight_post``: with them
    the controls of each period are spread over the strata like the treated rows
    of that period, and their weights add up to their number.
    """
    if cutoff is None:
        cutoff = F.floor((obs.select(F.min("YearStart")).scalar() + obs.select(F.max("YearStart")).scalar()) / 2)
    else:
        cutoff = F.lit(cutoff)
    rows = obs.filter(F.col("DataValueAlt").isNotNull() & F.col("YearStart").isNotNull()).select(
        *strata, "DataValueAlt", F.coalesce(treated, F.lit(False)).alias("_t"), (F.col("YearStart") >= cutoff).alias("_p"))
    aggs = []
    for t, p in CELLS:
        value = F.when((F.col("_t") == (t == "treated")) & (F.col("_p") == (p == "post")), F.col("DataValueAlt"))
        aggs += [F.count(value).alias(f"n_{t}_{p}"), exact_sum(value).alias(f"sum_{t}_{p}")]
    cells = materialize(rows.groupBy(*strata).agg(*aggs), "strata")
    cells = cells.withColumn("matched", F.least(*(F.col(f"n_{t}_{p}") for t, p in CELLS)) > 0)
    totals = cells.filter("matched").agg(*(F.sum(f"n_{t}_{p}").alias(f"{t}_{p}") for t, p in CELLS))

    def weight(p):
        share = totals.select((F.col(f"control_{p}").cast("double") / F.col(f"treated_{p}").cast("double"))).scalar()
        return F.when(F.col("matched"), F.col(f"n_treated_{p}").cast("double") / F.col(f"n_control_{p}").cast("double") * share)

    return cells.withColumns({f"weight_{p}": weight(p) for p in ("pre", "post")})


def matched_diff_in_diff(obs: DataFrame, treated, cutoff=None, strata=STRATUM, cluster: str = "LocationAbbr") -> DataFrame:
    """Weighted means of the four cells over the matched strata, the
    difference in differences, and its standard error by a jackknife over
    clusters: each cluster is left out once, from sums kept per cluster.

    ``cluster`` is one of ``strata``, so leaving it out leaves the weights of the
    other strata as they are (a common factor cancels). One row; the error is
    null for fewer than two clusters.
    """
    cells = matched_strata(obs, treated, cutoff, strata).filter("matched")
    parts = []
    for p in ("pre", "post"):
        n = F.col(f"n_treated_{p}").cast("double")
        parts += [F.col(f"sum_treated_{p}").alias(f"t_{p}"),
                  (n * (F.col(f"sum_control_{p}") / F.col(f"n_control_{p}").cast("double"))).alias(f"c_{p}")]
    names = ["t_pre", "c_pre", "t_post", "c_post"]
    per = cells.select(F.col(cluster).alias("g"), "n_treated_pre", "n_treated_post", "n_control_pre", "n_control_post", *parts)
    per = per.groupBy("g").agg(
        *(ordered_sum_of(F.collect_list(c)).alias(c) for c in names),
        *(F.sum(c).cast("double").alias(c) for c in ("n_treated_pre", "n_treated_post", "n_control_pre", "n_control_post")),
        F.count(F.lit(1)).alias("strata"))
    # One value per cluster from here on.
    lists = per.agg(F.collect_list(F.struct(*names, "n_treated_pre", "n_treated_post")).alias("all"),
                    F.sum("strata").alias("matched_strata"), F.sum("n_control_pre").cast("long").alias("control_pre_rows"),
                    F.sum("n_control_post").cast("long").alias("control_post_rows"), F.count(F.lit(1)).alias("clusters"))
    for c in [*names, "n_treated_pre", "n_treated_post"]:
        lists = lists.withColumn(f"all_{c}", ordered_sum_of(F.col(f"all.{c}")))

    def effect(value):
        means = {c: value(c) / value("n_treated_" + c[2:]) for c in names}
        return (means["t_post"] - means["t_pre"]) - (means["c_post"] - means["c_pre"])

    def whole(c):
        return F.col(f"all_{c}")

    left_out = F.transform("all", lambda x: effect(lambda c: whole(c) - x[c]))
    lists = lists.withColumn("thetas", F.when(F.col("clusters") > 1, left_out))
    mean = ordered_mean_of(F.col("thetas"))
    spread = ordered_sum_of(F.transform("thetas", lambda x: (x - mean) * (x - mean)))
    g = F.col("clusters").cast("double")
    return lists.select(
        "matched_strata", "clusters", whole("n_treated_pre").cast("long").alias("treated_pre_rows"),
        whole("n_treated_post").cast("long").alias("treated_post_rows"), "control_pre_rows", "control_post_rows",
        *((whole(c) / whole("n_treated_" + c[2:])).alias(n) for c, n in (
            ("t_pre", "treated_pre"), ("t_post", "treated_post"), ("c_pre", "control_pre"), ("c_post", "control_post"))),
        effect(whole).alias("did"), F.sqrt((g - F.lit(1.0)) / g * spread).alias("jackknife_error"))
