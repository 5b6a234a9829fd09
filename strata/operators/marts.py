"""Reporting marts (A1-A7), mart filters (C10, C11) and share of total.

Every mart reads only the columns it needs (pruned at the Parquet scan) and
aggregates with partial (map-side) aggregation before its shuffle. Averages
of indicator values use exact decimal sums, so results do not depend on the
partitioning or on the order in which partial aggregates meet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.numeric import exact_mean, flag_rate, share_percent

VALUE = "DataValueAlt"
FLAG = "is_mortality"


def dashboard_kpis(obs: DataFrame, approximate: bool = False) -> DataFrame:
    """A1: one-row KPIs. ``approximate`` swaps the exact distinct counts
    (an Expand of the input per distinct column) for HyperLogLog sketches."""
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    return obs.agg(
        F.count(F.lit(1)).alias("total_records"),
        distinct("LocationAbbr").alias("state_count"),
        distinct("Topic").alias("topic_count"),
        F.min("YearStart").alias("first_year"),
        F.max("YearStart").alias("latest_year"),
        flag_rate(FLAG).alias("mortality_source_rate"),
    )


def topic_year_trends(obs: DataFrame) -> DataFrame:
    """A2: per (YearStart, Topic): count, mean value, mortality-source rate."""
    return obs.groupBy("YearStart", "Topic").agg(
        F.count(F.lit(1)).alias("record_count"),
        exact_mean(VALUE).alias("avg_indicator_value"),
        flag_rate(FLAG).alias("mortality_source_rate"),
    )


def state_topic_summary(obs: DataFrame) -> DataFrame:
    """A3: per (LocationAbbr, Topic): count, mean, rate, smallest coordinates."""
    return obs.groupBy("LocationAbbr", "Topic").agg(
        F.count(F.lit(1)).alias("record_count"),
        exact_mean(VALUE).alias("avg_indicator_value"),
        flag_rate(FLAG).alias("mortality_source_rate"),
        F.min("Latitude").alias("latitude"),
        F.min("Longitude").alias("longitude"),
    )


def with_share_of_total(counts: DataFrame, count_col: str, out: str) -> DataFrame:
    """``100 * count / sum(count) over ()`` on an aggregated table.

    The total is a scalar subquery (one number computed by its own small
    job), instead of an unpartitioned window that would put all rows in one
    task or a join against a one-row table.
    """
    total = counts.select(F.sum(count_col)).scalar()
    return counts.withColumn(out, share_percent(count_col, total))


def risk_distribution(obs: DataFrame) -> DataFrame:
    """A4: rows per risk level and their percentage of all rows."""
    counts = obs.groupBy("risk_level").agg(F.count(F.lit(1)).alias("record_count"))
    return with_share_of_total(counts, "record_count", "pct_of_records")


def mortality_by_topic(obs: DataFrame) -> DataFrame:
    """A5: per topic: count, mortality-source rows and rate."""
    hit = F.when(F.col(FLAG) == 1, F.lit(1)).otherwise(F.lit(0))
    return obs.groupBy("Topic").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.sum(hit).cast("long").alias("mortality_source_records"),
        flag_rate(FLAG).alias("mortality_source_rate"),
    )


def with_strata(obs: DataFrame) -> DataFrame:
    """Rows whose stratification category and stratum are both known."""
    return obs.filter(F.col("StratificationCategory1").isNotNull()
                      & F.col("Stratification1").isNotNull())


def demographic_risk(obs: DataFrame) -> DataFrame:
    """Per (Topic, category, stratum) after C10."""
    return with_strata(obs).groupBy("Topic", "StratificationCategory1", "Stratification1").agg(
        F.count(F.lit(1)).alias("record_count"),
        exact_mean(VALUE).alias("avg_indicator_value"),
        flag_rate(FLAG).alias("mortality_source_rate"),
    )


FEATURE_BASE_COLUMNS = (
    "YearStart", "YearEnd", "LocationAbbr", "Topic", "Question", "DataValueType",
    "StratificationCategory1", "Stratification1", "DataValueAlt", "value_normalized",
    "disease_duration", "is_mortality", "risk_level", "Latitude", "Longitude",
)


def feature_base(obs: DataFrame) -> DataFrame:
    """C11: the 15-column modelling base, value not null (pushed to the scan)."""
    return obs.filter(F.col(VALUE).isNotNull()).select(*FEATURE_BASE_COLUMNS)


#: Columns that the marts below read.
MART_COLUMNS = ("YearStart", "LocationAbbr", "Topic", "StratificationCategory1", "Stratification1", VALUE, FLAG,
                "risk_level", "Latitude", "Longitude")

MARTS = {
    "dashboard_kpis": dashboard_kpis,
    "topic_year_trends": topic_year_trends,
    "state_topic_summary": state_topic_summary,
    "risk_distribution": risk_distribution,
    "mortality_by_topic": mortality_by_topic,
    "demographic_risk": demographic_risk,
}
