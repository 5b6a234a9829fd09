"""Registered queries (one per operator of the inventory) and their oracle SQL.

Every query reads the driver tables of ``sf_dir`` through the bridge and the
cleaning layer, so its work grows with the data. Keys follow the inventory
IDs. SQL-expressible queries have an independent DuckDB statement in
:mod:`strata.oracle_sql`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import oracle_sql as O
from strata.operators import marts as M
from strata.operators import priority as P
from strata.operators import questions as Q
from strata.operators import reshape as R
from strata.operators import trend as Z
from strata.plans.cleaning import bridge_facts

QUERIES: dict = {}
ORACLE: dict = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bridge_facts(spark, sf_dir)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.intervention_priority(facts(spark, sf_dir)).orderBy(
        F.col("intervention_priority_score").desc(), "state", "disease_topic", "year")


# --- composite mart ------------------------------------------------------------

@register("p1_intervention_priority", O.PRIORITY)
def p1(spark, sf_dir):
    return P.intervention_priority(facts(spark, sf_dir))


# --- marts ---------------------------------------------------------------------

@register("a1_dashboard_kpis", O.KPIS)
def a1(spark, sf_dir):
    return M.dashboard_kpis(facts(spark, sf_dir))


@register("a2_topic_year_trends", O.TOPIC_YEAR_TRENDS)
def a2(spark, sf_dir):
    return M.topic_year_trends(facts(spark, sf_dir))


@register("a3_state_topic_summary", O.STATE_TOPIC_SUMMARY)
def a3(spark, sf_dir):
    return M.state_topic_summary(facts(spark, sf_dir))


@register("a4_risk_distribution", O.RISK_DISTRIBUTION)
def a4(spark, sf_dir):
    return M.risk_distribution(facts(spark, sf_dir))


@register("a5_mortality_by_topic", O.MORTALITY_BY_TOPIC)
def a5(spark, sf_dir):
    return M.mortality_by_topic(facts(spark, sf_dir))


@register("a6_demographic_risk", O.DEMOGRAPHIC_RISK)
def a6(spark, sf_dir):
    return M.demographic_risk(facts(spark, sf_dir))


@register("a7_state_topic_year", O.STATE_TOPIC_YEAR_FULL)
def a7(spark, sf_dir):
    return P.state_topic_year(facts(spark, sf_dir))


@register("c11_feature_base", O.FEATURE_BASE)
def c11(spark, sf_dir):
    return M.feature_base(facts(spark, sf_dir))


# --- analysis questions ---------------------------------------------------------

@register("a8_q1_overview", O.KPIS)
def a8(spark, sf_dir):
    return Q.overview(facts(spark, sf_dir))


@register("a9_q2_topic_volume", O.TOPIC_VOLUME)
def a9(spark, sf_dir):
    return Q.topic_volume(M.topic_year_trends(facts(spark, sf_dir)))


@register("a10_q3_topic_growth", O.TOPIC_GROWTH)
def a10(spark, sf_dir):
    return Q.topic_growth(M.topic_year_trends(facts(spark, sf_dir)))


@register("t3_q4_top_state_topics", O.TOP_STATE_TOPICS)
def t3(spark, sf_dir):
    return Q.top_state_topics(facts(spark, sf_dir))


@register("q5_mortality_ranking", O.MORTALITY_BY_TOPIC)
def q5(spark, sf_dir):
    return Q.mortality_ranking(facts(spark, sf_dir))


@register("q6_risk_imbalance", O.RISK_DISTRIBUTION)
def q6(spark, sf_dir):
    return Q.risk_imbalance(facts(spark, sf_dir))


@register("t4_q7_top_demographic_groups", O.TOP_DEMOGRAPHIC)
def t4(spark, sf_dir):
    return Q.top_demographic_groups(facts(spark, sf_dir))


@register("a11_q8_feature_base_size", O.FEATURE_BASE_SIZE)
def a11(spark, sf_dir):
    return Q.feature_base_size(facts(spark, sf_dir))


@register("a12_records_per_topic", O.RECORDS_PER_TOPIC)
def a12(spark, sf_dir):
    return Q.records_per_topic(facts(spark, sf_dir))


@register("a13_records_per_year_topic", O.RECORDS_PER_YEAR_TOPIC)
def a13(spark, sf_dir):
    return Q.records_per_year_topic(facts(spark, sf_dir))


@register("a14_state_topic_average", O.STATE_TOPIC_AVERAGE)
def a14(spark, sf_dir):
    return Q.state_topic_average(facts(spark, sf_dir))


@register("a15_mortality_share", O.MORTALITY_SHARE)
def a15(spark, sf_dir):
    return Q.mortality_share(facts(spark, sf_dir))


@register("a16_risk_percentages", O.RISK_PERCENTAGES)
def a16(spark, sf_dir):
    return Q.risk_percentages(facts(spark, sf_dir))


@register("a17_risk_counts", O.RISK_COUNTS)
def a17(spark, sf_dir):
    return Q.risk_counts(facts(spark, sf_dir))


@register("a18_focus_group_means", O.FOCUS_GROUP_MEANS)
def a18(spark, sf_dir):
    return Q.focus_group_means(facts(spark, sf_dir))


@register("a19_yearly_topic_means", O.YEARLY_TOPIC_MEANS)
def a19(spark, sf_dir):
    return Q.yearly_topic_means(facts(spark, sf_dir))


@register("t5_top_topics", O.TOP_TOPICS)
def t5(spark, sf_dir):
    return Q.top_topics(facts(spark, sf_dir))


@register("j3_top_topic_trend", O.TOP_TOPIC_TREND)
def j3(spark, sf_dir):
    return Q.top_topic_trend(facts(spark, sf_dir))


# --- windows -------------------------------------------------------------------

@register("w2_previous_year_value", O.PREVIOUS_YEAR)
def w2(spark, sf_dir):
    base = P.state_topic_year(facts(spark, sf_dir), with_group_count=False)
    return P.with_previous_value(base).select(
        "state", "disease_topic", "year", "avg_indicator_value", "previous_year_value")


def _score(spark, sf_dir, out):
    base = P.materialize(P.state_topic_year(facts(spark, sf_dir), with_group_count=False))
    col = P.SCORE_COLUMNS[out]
    from strata.operators.ranking import percent_rank
    return percent_rank(base.select("state", "disease_topic", "year", col), {out: col})


@register("w3_burden_score", O.BURDEN_SCORE)
def w3(spark, sf_dir):
    return _score(spark, sf_dir, "burden_score")


@register("w4_mortality_score", O.MORTALITY_SCORE)
def w4(spark, sf_dir):
    return _score(spark, sf_dir, "mortality_score")


@register("w5_reliability_score", O.RELIABILITY_SCORE)
def w5(spark, sf_dir):
    return _score(spark, sf_dir, "reliability_score")


# --- reshapes and trend tests -------------------------------------------------------

@register("r1_state_year_heatmap", O.HEATMAP)
def r1(spark, sf_dir):
    return R.state_year_heatmap(facts(spark, sf_dir))


@register("r2_state_topic_shares", O.STATE_TOPIC_SHARES)
def r2(spark, sf_dir):
    return R.state_topic_shares(facts(spark, sf_dir))


@register("z1_mann_kendall", O.MANN_KENDALL)
def z1(spark, sf_dir):
    return Z.mann_kendall(Z.yearly_series(facts(spark, sf_dir)), with_p=False)


@register("z1_mann_kendall_test", O.MANN_KENDALL_TEST)
def z1p(spark, sf_dir):
    found = Z.mann_kendall(Z.yearly_series(facts(spark, sf_dir)), with_p=True)
    return found.withColumn("p_value", F.round("p_value", 8))


@register("z2_spearman", O.SPEARMAN)
def z2(spark, sf_dir):
    return Z.spearman(Z.yearly_series(facts(spark, sf_dir)), with_p=False)


@register("z2_spearman_test", O.SPEARMAN_TEST)
def z2p(spark, sf_dir):
    found = Z.spearman(Z.yearly_series(facts(spark, sf_dir)), with_p=True)
    return found.withColumn("p_value", F.round("p_value", 8))


# --- sources, cleaning and features -------------------------------------------------

from strata.constants import ENCODE_COLUMNS  # noqa: E402
from strata.operators import clean as C  # noqa: E402
from strata.operators import features as FE  # noqa: E402
from strata.sources.bridge import obs_raw  # noqa: E402


def _cleaned(spark, sf_dir):
    return C.parse_geolocation(C.clean(obs_raw(spark, sf_dir)))


@register("c1_coerce_numeric", O.COERCE_NUMERIC)
def c1(spark, sf_dir):
    typed = C.coerce_numeric(obs_raw(spark, sf_dir))
    return typed.groupBy("DataValue").agg(F.count(F.lit(1)).alias("n"),
                                          F.count("DataValueAlt").alias("with_alt"))


@register("c3_clean_report", O.CLEAN_REPORT)
def c3(spark, sf_dir):
    counts = C.clean_counts(C.coerce_numeric(obs_raw(spark, sf_dir)))
    return counts.select("rows_in", "dropped_missing_value", "dropped_missing_location",
                         "rows_out", "passes_gate")


@register("c6_column_profile", O.COLUMN_PROFILE)
def c6(spark, sf_dir):
    counts = C.clean_counts(C.coerce_numeric(obs_raw(spark, sf_dir)))
    nn = [c for c in counts.columns if c.startswith("nn_")]
    return counts.unpivot([], nn, "column_name", "non_null").select(
        F.regexp_replace("column_name", "^nn_", "").alias("column_name"), "non_null")


@register("c8_parse_geolocation", O.PARSE_GEO)
def c8(spark, sf_dir):
    return _cleaned(spark, sf_dir).groupBy("LocationAbbr", "Longitude", "Latitude").agg(
        F.count(F.lit(1)).alias("n"))


@register("c9_impute_unit", O.IMPUTE_UNIT)
def c9(spark, sf_dir):
    return facts(spark, sf_dir).groupBy("Topic", "Question", "DataValueUnit").agg(
        F.count(F.lit(1)).alias("n"))


@register("a20_group_mode", O.GROUP_MODE)
def a20(spark, sf_dir):
    return C.group_mode(_cleaned(spark, sf_dir), ["Topic", "Question"], "DataValueUnit", "mode_unit")


@register("f1_is_mortality", O.MORTALITY_FLAG)
def f1(spark, sf_dir):
    return facts(spark, sf_dir).groupBy("DataSource", "is_mortality").agg(F.count(F.lit(1)).alias("n"))


@register("f3_disease_duration", O.DURATION)
def f3(spark, sf_dir):
    return facts(spark, sf_dir).groupBy("YearStart", "YearEnd", "disease_duration").agg(
        F.count(F.lit(1)).alias("n"))


@register("f5_risk_level", O.RISK_BINS)
def f5(spark, sf_dir):
    return facts(spark, sf_dir).groupBy("risk_level").agg(
        F.count(F.lit(1)).alias("n"), F.min("DataValueAlt").alias("min_value"),
        F.max("DataValueAlt").alias("max_value"))


@register("f6_topic_dummies", O.TOPIC_DUMMIES)
def f6(spark, sf_dir):
    wide = FE.add_topic_dummies(facts(spark, sf_dir))
    dummies = [c for c in wide.columns if c.startswith("topic_")]
    sums = wide.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.sum(F.col(f"`{c}`")).cast("long").alias(c) for c in dummies])
    long = sums.unpivot(["_rows"], dummies, "column_name", "ones")
    return long.select("column_name", "ones", (F.col("_rows") - F.col("ones")).alias("zeros"))


@register("e1_label_encoding", O.LABEL_ENCODING)
def e1(spark, sf_dir):
    obs = P.materialize(facts(spark, sf_dir).select(*ENCODE_COLUMNS), "facts")
    return FE.column_codes(FE.encode_categoricals(obs))


@register("s1_csv_roundtrip", O.CSV_ROUNDTRIP)
def s1(spark, sf_dir):
    from strata.session import scratch_path
    from strata.sources.raw_csv import load_raw, write_raw
    path = write_raw(obs_raw(spark, sf_dir), scratch_path(spark, "raw-csv"))
    return C.coerce_numeric(load_raw(spark, path))


@register("c16_processed_table", O.PROCESSED_TABLE)
def c16(spark, sf_dir):
    from strata.plans.cleaning import run_pipeline
    from strata.session import scratch_path
    out = run_pipeline(spark, obs_raw(spark, sf_dir), scratch_path(spark, "processed"))
    return out.select(*[c for c in out.columns if not c.startswith("topic_")])


@register("s6_export_marts", O.EXPORT_MANIFEST)
def s6(spark, sf_dir):
    from strata.session import scratch_path
    from strata.sources.export import export_marts, read_manifest
    obs = P.materialize(facts(spark, sf_dir).select(*M.MART_COLUMNS), "facts")  # one pass for all marts
    paths = export_marts({name: fn(obs) for name, fn in M.MARTS.items()}, scratch_path(spark, "extracts"))
    return read_manifest(spark, paths)


# --- modelling ---------------------------------------------------------------------------

from strata.constants import MORTALITY_FEATURES  # noqa: E402
from strata.operators import ml as ML  # noqa: E402
from strata.plans import modeling as MD  # noqa: E402


def _processed(spark, sf_dir):
    """The processed table (with one-hot topics and codes), built lazily."""
    from strata.plans.cleaning import processed
    return processed(obs_raw(spark, sf_dir))


def _processed_once(spark, sf_dir):
    """:func:`_processed` for runs that read it many times: the raw observations are joined once."""
    from strata.plans.cleaning import processed
    return processed(P.materialize(obs_raw(spark, sf_dir), "raw"))


def _mortality(spark, sf_dir):
    return ML.train_mortality_model(_processed(spark, sf_dir))


def _forest(spark, sf_dir):
    return MD.fit_risk_forest(_processed(spark, sf_dir))


def _risk_rows(spark, sf_dir):
    return ML.labelled(facts(spark, sf_dir), "risk_level").select(F.col("risk_level").alias("label"))


@register("r2_state_disease_matrix", O.TOPIC_MATRIX)
def r2w(spark, sf_dir):
    return R.state_disease_matrix(_processed(spark, sf_dir))


@register("m3_state_clusters")
def m3(spark, sf_dir):
    return MD.cluster_states(_processed(spark, sf_dir))["assignments"]


@register("m4_silhouette")
def m4(spark, sf_dir):
    res = MD.cluster_states(_processed(spark, sf_dir))
    return spark.createDataFrame([("silhouette_euclidean", ML.silhouette_euclidean(res["points"])),
                                  ("silhouette_squared_euclidean", res["silhouette_squared"])],
                                 "metric string, value double")


@register("m5_class_weights", O.CLASS_WEIGHTS)
def m5(spark, sf_dir):
    return ML.class_weights(_risk_rows(spark, sf_dir))


@register("m6_fold_sizes", O.FOLD_SIZES)
def m6(spark, sf_dir):
    return ML.with_folds(_risk_rows(spark, sf_dir)).groupBy("label", "fold").agg(
        F.count(F.lit(1)).alias("n"))


@register("m8_mortality_model")
def m8(spark, sf_dir):
    res = _mortality(spark, sf_dir)
    return spark.createDataFrame(
        [("auc", res["auc"]), ("accuracy", res["accuracy"]), ("macro_f1", res["macro_f1"]),
         ("rows", float(res["rows"])), ("positive_rate", res["positive_rate"])],
        "metric string, value double")


@register("m9_positive_rate", O.POSITIVE_RATE)
def m9(spark, sf_dir):
    obs = facts(spark, sf_dir)
    return ML.positive_rate(ML.feature_frame(obs, ML.available_features(obs, MORTALITY_FEATURES),
                                             "is_mortality"))


@register("m11_classification_report")
def m11(spark, sf_dir):
    return _mortality(spark, sf_dir)["report"]


@register("m13_labelled_rows", O.LABELLED_ROWS)
def m13(spark, sf_dir):
    return ML.labelled(facts(spark, sf_dir), "StratificationCategory1").agg(F.count(F.lit(1)).alias("n"))


@register("m14_tiny_classes", O.TINY_CLASSES)
def m14(spark, sf_dir):
    return ML.tiny_classes(facts(spark, sf_dir).select(F.col("DataValueType").alias("label")))


@register("m15_feature_importances")
def m15(spark, sf_dir):
    return _forest(spark, sf_dir)


@register("t6_top_importances")
def t6(spark, sf_dir):
    return ML.top_importances(_forest(spark, sf_dir))


@register("m12_risk_classifier")
def m12(spark, sf_dir):
    res = ML.train_risk_classifier(_processed_once(spark, sf_dir))
    return res["report"]


@register("m17_training_run")
def m17(spark, sf_dir):
    from strata.session import scratch_path
    from strata.sources.export import read_manifest
    path = scratch_path(spark, "training")
    names = ("state_clusters", "feature_importances", "model_summary")
    MD.run(spark, _processed_once(spark, sf_dir), path)
    return read_manifest(spark, {n: f"{path}/{n}" for n in names})


# --- documented-only analyses ---------------------------------------------------------------

from strata.constants import RISK_FEATURES  # noqa: E402
from strata.operators import evaluation as EV  # noqa: E402
from strata.operators import quality as DQ  # noqa: E402


@register("d1_documented_priority", O.DOCUMENTED_PRIORITY)
def d1(spark, sf_dir):
    return P.documented_priority(facts(spark, sf_dir))


@register("d2_demographic_disparity", O.DISPARITY)
def d2(spark, sf_dir):
    return P.demographic_disparity(facts(spark, sf_dir))


@register("d3_data_quality", O.DATA_QUALITY)
def d3(spark, sf_dir):
    return DQ.data_quality(facts(spark, sf_dir))


@register("d5_rolling_means", O.ROLLING_MEANS)
def d5(spark, sf_dir):
    return DQ.rolling_means(facts(spark, sf_dir))


@register("d8_risk_thresholds", O.RISK_THRESHOLDS)
def d8(spark, sf_dir):
    return DQ.risk_thresholds(facts(spark, sf_dir))


@register("d9_time_split", O.TIME_SPLIT)
def d9(spark, sf_dir):
    return DQ.time_split(facts(spark, sf_dir))


@register("d9_rolling_origin", O.ROLLING_ORIGIN)
def d9_rolling(spark, sf_dir):
    return EV.rolling_origin(facts(spark, sf_dir))


@register("d9_rolling_models")
def d9_models(spark, sf_dir):
    return EV.rolling_models(_processed(spark, sf_dir))


@register("d10_match_weights", O.MATCH_WEIGHTS)
def d10_weights(spark, sf_dir):
    return EV.matched_strata(facts(spark, sf_dir), F.col("is_mortality") == 1)


@register("d10_matched_diff_in_diff", O.MATCHED_DIFF_IN_DIFF)
def d10_matched(spark, sf_dir):
    return EV.matched_diff_in_diff(facts(spark, sf_dir), F.col("is_mortality") == 1)


@register("d7_per_capita", O.PER_CAPITA)
def d7_rates(spark, sf_dir):
    from strata.sources.bridge import customer_population
    return DQ.per_capita(facts(spark, sf_dir), customer_population(spark, sf_dir))


@register("d10_diff_in_diff", O.DIFF_IN_DIFF)
def d10(spark, sf_dir):
    return DQ.diff_in_diff(facts(spark, sf_dir), F.col("is_mortality") == 1)


@register("d11_filtered_trends", O.FILTERED_TRENDS)
def d11(spark, sf_dir):
    obs = facts(spark, sf_dir)
    first = obs.select(F.min("YearStart")).scalar()
    return M.topic_year_trends(DQ.dashboard_filter(obs, years=(first, first + 2)))


@register("a1_filtered_kpis", O.FILTERED_KPIS)
def a1_cells(spark, sf_dir):
    from strata.operators import cells as CE
    from strata.operators.priority import materialize
    cells = materialize(CE.kpi_cells(facts(spark, sf_dir)), "kpi-cells")
    first = cells.agg(F.min("YearStart")).first()[0]
    whole, some = CE.filtered_kpis(cells), CE.filtered_kpis(cells, topics=["Asthma", "Cancer"], years=(first, first + 2))
    return whole.withColumn("filtered", F.lit(False)).unionByName(some.withColumn("filtered", F.lit(True)))


@register("d12_feature_availability", O.FEATURE_AVAILABILITY)
def d12(spark, sf_dir):
    cols = list(dict.fromkeys(list(MORTALITY_FEATURES) + list(RISK_FEATURES)))
    return DQ.feature_availability(_processed(spark, sf_dir), cols)


@register("d4_calibration")
def d4(spark, sf_dir):
    scored = _mortality(spark, sf_dir)["scored"]
    rates = DQ.error_rates(scored).first()
    return DQ.calibration(scored).select(
        "bin", "n", "mean_score", "observed_rate",
        F.lit(rates["false_positive_rate"]).cast("double").alias("false_positive_rate"),
        F.lit(rates["false_negative_rate"]).cast("double").alias("false_negative_rate"))


@register("d4_fixed_score_calibration", O.FIXED_SCORE_CALIBRATION)
def d4_bins(spark, sf_dir):
    from strata.operators.isotonic import expected_calibration_error
    from strata.operators.priority import materialize
    scored = materialize(EV.segment_scores(facts(spark, sf_dir)), "fixed-scores")
    rates, error = DQ.error_rates(scored), expected_calibration_error(scored)
    bins = DQ.calibration(scored).select("bin", "n", F.round("mean_score", 8).alias("mean_score"), "observed_rate")
    return bins.withColumns({c: rates.select(c).scalar() for c in ("false_positive_rate", "false_negative_rate")}
                            | {"expected_calibration_error": F.round(error.select("ece").scalar(), 8)})


@register("m10_fixed_score_auc", O.FIXED_SCORE_AUC)
def m10(spark, sf_dir):
    from strata.operators.priority import materialize
    scored = materialize(EV.segment_scores(facts(spark, sf_dir)), "fixed-scores")
    return spark.createDataFrame([(scored.count(), ML.roc_auc(scored))], "rows long, auc double")


@register("m11_fixed_score_report", O.FIXED_SCORE_REPORT)
def m11_fixed(spark, sf_dir):
    from strata.operators.priority import materialize
    scored = materialize(EV.segment_scores(facts(spark, sf_dir)), "fixed-scores")
    report = ML.classification_report(scored)
    return report.select("cls", *(F.round(c, 10).alias(c) for c in ("precision", "recall", "f1_score")), "support")


@register("d4_isotonic_blocks", O.ISOTONIC_BLOCKS)
def d4_isotonic(spark, sf_dir):
    from strata.operators.isotonic import isotonic_blocks
    return isotonic_blocks(EV.segment_scores(facts(spark, sf_dir)))


@register("s3_fact_table", O.FACT_TABLE)
def s3(spark, sf_dir):
    from strata.sources.parquet import register_fact_table
    register_fact_table(facts(spark, sf_dir))
    return spark.sql("SELECT LocationAbbr, DataValueType, COUNT(*) AS rows, MIN(DataValueAlt) AS least, "
                     "MAX(DataValueAlt) AS most FROM cdi_observations WHERE is_mortality = 1 "
                     "GROUP BY LocationAbbr, DataValueType")


@register("d7_region_features", O.REGION_FEATURES)
def d7(spark, sf_dir):
    from strata.sources.tables import table
    return DQ.region_features(facts(spark, sf_dir), table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"))


@register("s4_mart_views", O.MART_VIEWS)
def s4(spark, sf_dir):
    from strata.plans.marts import build_marts, register_views
    names = register_views(build_marts(facts(spark, sf_dir)))
    parts = [spark.sql(f"SELECT '{n}' AS view_name, COUNT(*) AS rows FROM {n}") for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
