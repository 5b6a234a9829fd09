"""Dashboard figures from stored cells.

A cell holds what every filtered figure needs of one (state, topic, year,
stratum): counts, which add up, and a HyperLogLog sketch of the questions, which
merges. Filters on the cell's keys then read the cells only, however many facts
lie under them; figures over the keys themselves stay exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.quality import dashboard_filter

KEYS = ("LocationAbbr", "Topic", "YearStart", "Stratification1")
#: Logarithm of the sketch's registers: a standard error of 1.6 %.
SKETCH_BITS = 12


def kpi_cells(obs: DataFrame) -> DataFrame:
    """One row per (state, topic, year, stratum), missing values being values."""
    return obs.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("records"), F.sum(F.when(F.col("is_mortality") == 1, 1).otherwise(0)).alias("mortality_records"),
        F.hll_sketch_agg("Question", F.lit(SKETCH_BITS)).alias("questions"))


def filtered_kpis(cells: DataFrame, **filters) -> DataFrame:
    """A1 under the filters of :func:`strata.operators.quality.dashboard_filter`, and
    ``question_count``, an estimate of the number of different questions."""
    kept = dashboard_filter(cells, **filters)
    return kept.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("total_records"), F.countDistinct("LocationAbbr").alias("state_count"),
        F.countDistinct("Topic").alias("topic_count"), F.min("YearStart").alias("first_year"),
        F.max("YearStart").alias("latest_year"),
        F.try_divide(F.sum("mortality_records").cast("double"), F.sum("records")).alias("mortality_source_rate"),
        F.when(F.sum("records") > 0, F.hll_sketch_estimate(F.hll_union_agg("questions"))).otherwise(0).alias("question_count"))
