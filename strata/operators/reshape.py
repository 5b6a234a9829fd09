"""Reshapes: state x year heatmap (R1) and state x topic frequency matrix (R2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.constants import HEATMAP_FIRST_YEAR
from strata.operators.features import distinct_values

MAX_PIVOT_VALUES = 1_000


def state_year_heatmap(obs: DataFrame, first_year: int = HEATMAP_FIRST_YEAR,
                       years: list | None = None) -> DataFrame:
    """Record counts per state (rows) and year >= ``first_year``
    (columns), missing combinations filled with 0.

    The year list is fetched once (years are a small calendar dimension) and
    passed to ``pivot`` so Spark does not run its own distinct job.
    """
    recent = obs.filter(F.col("YearStart") >= first_year)
    if years is None:
        years = distinct_values(recent, "YearStart", MAX_PIVOT_VALUES)
    if not years:
        return recent.groupBy("LocationAbbr").agg(F.count(F.lit(1)).alias("_n")).select("LocationAbbr")
    wide = recent.groupBy("LocationAbbr").pivot("YearStart", years).agg(F.count(F.lit(1)))
    return wide.fillna(0, subset=[str(y) for y in years])


def state_topic_shares(obs: DataFrame, state: str = "LocationAbbr", topic: str = "Topic") -> DataFrame:
    """R2 (long form): share of each topic in a state's records (rows of a
    state sum to 1). Rows without a topic do not count.

    The per-state total is a window partitioned by state over the aggregated
    (state, topic) table, so a task holds one state's topics, never raw rows.
    """
    counts = (obs.filter(F.col(topic).isNotNull())
              .groupBy(state, topic).agg(F.count(F.lit(1)).alias("topic_records")))
    total = F.sum("topic_records").over(Window.partitionBy(state))
    return counts.withColumn("share", F.col("topic_records").cast("double") / total.cast("double"))


def state_disease_matrix(df: DataFrame, state: str = "LocationAbbr", prefix: str = "topic_") -> DataFrame:
    """R2 (wide form): one row per state, one column per one-hot topic
    column, each row divided by its total (a state without topics -> null)."""
    topic_cols = [c for c in df.columns if c.startswith(prefix)]
    sums = df.groupBy(state).agg(*[F.sum(F.col(f"`{c}`")).alias(c) for c in topic_cols])
    total = sum((F.col(f"`{c}`") for c in topic_cols), F.lit(0))
    return sums.select(state, *[F.try_divide(F.col(f"`{c}`").cast("double"), total.cast("double")).alias(c)
                                for c in topic_cols])
