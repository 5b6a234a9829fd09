"""Intervention priority mart (A7, W2-W5, V4-V6, P1) and its documented variant."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.constants import DOCUMENTED_WEIGHTS, PRIORITY_WEIGHTS
from strata.functions.numeric import exact_mean, flag_rate, relative_change
from strata.operators.ranking import TARGET_BUCKET_ROWS, percent_rank
from strata.session import ensure_checkpoint_dir, scratch_path

SEGMENT = ("state", "disease_topic")


def state_topic_year(obs: DataFrame, with_group_count: bool = True) -> DataFrame:
    """Per (state, topic, year) over rows with a value: count, mean,
    mortality-source rate and (optionally) the number of distinct strata."""
    aggs = [
        F.count(F.lit(1)).alias("record_count"),
        exact_mean("DataValueAlt").alias("avg_indicator_value"),
        flag_rate("is_mortality").alias("mortality_source_rate"),
    ]
    if with_group_count:
        aggs.append(F.countDistinct("Stratification1").alias("demographic_group_count"))
    return (obs.filter(F.col("DataValueAlt").isNotNull())
            .groupBy(F.col("LocationAbbr").alias("state"), F.col("Topic").alias("disease_topic"),
                     F.col("YearStart").alias("year"))
            .agg(*aggs))


def with_previous_value(base: DataFrame, value: str = "avg_indicator_value",
                        out: str = "previous_year_value") -> DataFrame:
    """Value of the previous *available* year of the same segment.

    The window is partitioned by segment, so each task holds whole series
    whose length is the number of years, not a share of the data.
    """
    w = Window.partitionBy(*SEGMENT).orderBy("year")
    return base.withColumn(out, F.lag(value).over(w))


def with_changes(df: DataFrame, value: str = "avg_indicator_value",
                 previous: str = "previous_year_value") -> DataFrame:
    """V4/V5: absolute and relative year-over-year change."""
    return df.withColumns({
        "yoy_absolute_change": F.col(value) - F.col(previous),
        "yoy_pct_change": relative_change(value, previous),
    })


SCORE_COLUMNS = {
    "burden_score": "avg_indicator_value",
    "mortality_score": "mortality_source_rate",
    "reliability_score": "record_count",
}


def with_scores(df: DataFrame, target_rows: int = TARGET_BUCKET_ROWS) -> DataFrame:
    """Global percent ranks computed from distributed prefix counts."""
    return percent_rank(df, SCORE_COLUMNS, target_rows=target_rows)


def weighted_score(weights: dict = PRIORITY_WEIGHTS):
    """V6: 0.40 burden + 0.30 mortality + 0.20 reliability + 0.10 yoy (null -> 0)."""
    return (F.lit(weights["burden"]) * F.col("burden_score")
            + F.lit(weights["mortality"]) * F.col("mortality_score")
            + F.lit(weights["reliability"]) * F.col("reliability_score")
            + F.lit(weights["yoy"]) * F.coalesce(F.col("yoy_pct_change"), F.lit(0.0)))


PRIORITY_COLUMNS = (
    "state", "disease_topic", "year", "record_count", "avg_indicator_value",
    "mortality_source_rate", "yoy_absolute_change", "yoy_pct_change", "burden_score",
    "mortality_score", "reliability_score", "intervention_priority_score",
)


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Cut lineage with a written table in the shared checkpoint folder.

    Used for tables that several jobs read (and for frames carrying
    generated ids), so the plan below them runs once — one write job, unlike
    an eager ``checkpoint()`` that computes an unpersisted input twice — and
    a lost executor re-reads files instead of re-running the plan. The
    result is a plain Parquet scan: column pruning and filter pushdown apply.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def intervention_priority(obs: DataFrame, weights: dict = PRIORITY_WEIGHTS,
                          target_rows: int = TARGET_BUCKET_ROWS,
                          checkpoint: bool = True) -> DataFrame:
    """The intervention priority mart (12 columns)."""
    base = state_topic_year(obs, with_group_count=False)
    if checkpoint:
        base = materialize(base)
    scored = with_scores(with_changes(with_previous_value(base)), target_rows)
    return scored.withColumn("intervention_priority_score", weighted_score(weights)).select(
        *PRIORITY_COLUMNS)


def demographic_disparity(obs: DataFrame) -> DataFrame:
    """Per (state, topic, year): max - min of the stratum means."""
    strata = (obs.filter(F.col("DataValueAlt").isNotNull() & F.col("Stratification1").isNotNull())
              .groupBy(F.col("LocationAbbr").alias("state"), F.col("Topic").alias("disease_topic"),
                       F.col("YearStart").alias("year"), "Stratification1")
              .agg(exact_mean("DataValueAlt").alias("_m")))
    return strata.groupBy("state", "disease_topic", "year").agg(
        (F.max("_m") - F.min("_m")).alias("demographic_disparity"))


def documented_priority(obs: DataFrame, weights: dict = DOCUMENTED_WEIGHTS,
                        target_rows: int = TARGET_BUCKET_ROWS, checkpoint: bool = True) -> DataFrame:
    """The documented 35/25/20/10/10 score.

    Components are percent ranks of burden, mortality rate, year-over-year
    growth (relative change, missing ranked last), demographic disparity
    (D2) and reliability (record count).
    """
    base = state_topic_year(obs, with_group_count=False).join(
        demographic_disparity(obs), on=["state", "disease_topic", "year"], how="left")
    if checkpoint:
        base = materialize(base)
    ranked = percent_rank(
        with_changes(with_previous_value(base)),
        {"burden_score": "avg_indicator_value", "mortality_score": "mortality_source_rate",
         "growth_score": "yoy_pct_change", "disparity_score": "demographic_disparity",
         "reliability_score": "record_count"},
        target_rows=target_rows)
    score = (F.lit(weights["burden"]) * F.col("burden_score")
             + F.lit(weights["mortality"]) * F.col("mortality_score")
             + F.lit(weights["growth"]) * F.col("growth_score")
             + F.lit(weights["disparity"]) * F.col("disparity_score")
             + F.lit(weights["reliability"]) * F.col("reliability_score"))
    return ranked.withColumn("documented_priority_score", score).select(
        "state", "disease_topic", "year", "record_count", "avg_indicator_value",
        "mortality_source_rate", "yoy_pct_change", "demographic_disparity", "burden_score",
        "mortality_score", "growth_score", "disparity_score", "reliability_score",
        "documented_priority_score")
