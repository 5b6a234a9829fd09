"""Analyses beyond the marts: data quality (D3), calibration (D4), rolling means (D5),
region features (D7), per-capita values (D7), data-driven risk thresholds (D8), time split (D9), difference in
differences (D10), dashboard filters (D11), feature availability (D12).

Series-level statistics re-aggregate already aggregated tables (one value
per year), so their per-group arrays are bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.numeric import (
    DECIMAL_LIMIT,
    DECIMAL_PLACES,
    exact_mean,
    flag_rate,
    ordered_mean_of,
    ordered_stddev_of,
)

SEGMENT = ("LocationAbbr", "Topic")


def yearly_segment_means(obs: DataFrame) -> DataFrame:
    return (obs.filter(F.col("DataValueAlt").isNotNull())
            .groupBy(*SEGMENT, "YearStart").agg(exact_mean("DataValueAlt").alias("v")))


def data_quality(obs: DataFrame) -> DataFrame:
    """D3: per (state, topic): records, value coverage, unit missingness,
    share of all strata present, and volatility (std / mean of yearly means).

    The facts are read once, into counts and sums per (state, topic, year,
    stratum); everything else re-aggregates that table.
    """
    from strata.operators.priority import materialize
    decimals = F.when(F.abs("DataValueAlt") < DECIMAL_LIMIT, F.col("DataValueAlt")).cast(f"decimal(38,{DECIMAL_PLACES})")
    rest = F.when(F.abs("DataValueAlt") >= DECIMAL_LIMIT, F.col("DataValueAlt"))
    cells = materialize(obs.groupBy(*SEGMENT, "YearStart", "Stratification1").agg(
        F.count(F.lit(1)).alias("n"), F.count("DataValueAlt").alias("values"), F.count("DataValueUnit").alias("units"),
        F.sum(decimals).alias("total"), F.sum(rest).alias("rest")), "cells")
    all_strata = cells.select(F.countDistinct("Stratification1")).scalar()
    count = lambda c: F.sum(c).cast("double")
    base = cells.groupBy(*SEGMENT).agg(
        F.sum("n").alias("record_count"), (count("values") / F.sum("n")).alias("value_coverage"),
        (F.lit(1.0) - count("units") / F.sum("n")).alias("unit_missing_rate"),
        F.countDistinct("Stratification1").alias("strata_present"))
    base = base.withColumn("strata_coverage",
                           F.try_divide(F.col("strata_present").cast("double"), all_strata.cast("double")))
    whole, large = F.sum("total").cast("double"), F.sum("rest")
    yearly = cells.filter("values > 0").groupBy(*SEGMENT, "YearStart").agg(
        (F.coalesce(whole + large, whole, large) / F.sum("values")).alias("v"))
    series = yearly.groupBy(*SEGMENT).agg(F.collect_list("v").alias("_vs"))
    vol = series.select(*SEGMENT, F.try_divide(ordered_stddev_of(F.col("_vs")),
                                               ordered_mean_of(F.col("_vs"))).alias("volatility"))
    return base.join(vol, list(SEGMENT), "left")


def region_features(obs: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Records, states, mean value and mortality-source rate per region and
    topic; places are looked up by name in the two dimension tables. Places
    that these do not know have no region and are left out."""
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("LocationAbbr"), F.col("r_name").alias("region"))
    return obs.join(places, "LocationAbbr").groupBy("region", "Topic").agg(
        F.count(F.lit(1)).alias("record_count"), F.countDistinct("LocationAbbr").alias("states"),
        exact_mean("DataValueAlt").alias("avg_indicator_value"), flag_rate("is_mortality").alias("mortality_source_rate"))


def rolling_means(obs: DataFrame, years: int = 3) -> DataFrame:
    """Mean of the last ``years`` available yearly means per segment."""
    w = Window.partitionBy(*SEGMENT).orderBy("YearStart").rowsBetween(-(years - 1), 0)
    yearly = yearly_segment_means(obs)
    return yearly.select(*SEGMENT, "YearStart", F.col("v").alias("yearly_mean"),
                         ordered_mean_of(F.collect_list("v").over(w)).alias("rolling_mean"))


def risk_thresholds(obs: DataFrame, probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """Per-topic cut points of the value distribution, exact: the values of
    rank ``ceil(prob * n)`` (:mod:`strata.operators.selection`)."""
    from strata.operators.selection import exact_quantiles

    cuts = exact_quantiles(obs, "Topic", "DataValueAlt", probs)
    return cuts.groupBy("Topic").agg(*(F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"p{int(p * 100)}")
                                       for p in probs))


def per_capita(obs: DataFrame, population: DataFrame, per: float = 100_000.0) -> DataFrame:
    """Records and mortality records per ``per`` inhabitants, by state, topic and year.

    ``population`` (``LocationAbbr, year, population``) changes slowly: a row holds
    from its year until the state's next one, and a record takes the population
    that held in its year. Years before a state's first row, states without rows
    and missing years have no population and no rates; their counts stay.
    """
    hits = F.sum(F.when(F.col("is_mortality") == 1, 1).otherwise(0))
    cells = obs.groupBy("LocationAbbr", "Topic", "YearStart").agg(
        F.count(F.lit(1)).alias("record_count"), hits.alias("mortality_records"))
    changes = Window.partitionBy("LocationAbbr").orderBy("year")
    spans = population.select(F.col("LocationAbbr").alias("_place"), F.col("year").alias("population_year"), "population",
                              F.lead("year").over(changes).alias("_until"))
    holds = F.expr("LocationAbbr = _place AND YearStart >= population_year AND (_until IS NULL OR YearStart < _until)")
    found = cells.join(spans, holds, "left")

    def rate(c):
        return F.try_divide(F.lit(per) * F.col(c).cast("double"), F.col("population").cast("double"))

    return found.select("LocationAbbr", "Topic", "YearStart", "record_count", "mortality_records", "population",
                        "population_year", rate("record_count").alias("records_per_100k"),
                        rate("mortality_records").alias("mortality_per_100k"))


def time_split(obs: DataFrame, cutoff=None) -> DataFrame:
    """Rows before / from the cutoff year (default: the latest year is the test period)."""
    c = obs.select(F.max("YearStart")).scalar() if cutoff is None else F.lit(cutoff)
    split = F.when(F.col("YearStart") < c, F.lit("train")).otherwise(F.lit("test"))
    return obs.filter(F.col("YearStart").isNotNull()).groupBy(split.alias("split")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("YearStart").alias("first_year"),
        F.max("YearStart").alias("latest_year"))


def diff_in_diff(obs: DataFrame, treated, cutoff=None) -> DataFrame:
    """2x2 group means (treated x post) and the difference in differences.

    ``treated`` is a boolean column expression; ``post`` is YearStart >=
    cutoff (default: the midpoint year of the data).
    """
    if cutoff is None:
        cutoff = F.floor((obs.select(F.min("YearStart")).scalar() + obs.select(F.max("YearStart")).scalar()) / 2)
    else:
        cutoff = F.lit(cutoff)
    cells = (obs.filter(F.col("DataValueAlt").isNotNull() & F.col("YearStart").isNotNull())
             .groupBy(F.coalesce(treated, F.lit(False)).alias("treated"),
                      (F.col("YearStart") >= cutoff).alias("post"))
             .agg(exact_mean("DataValueAlt").alias("m")))
    wide = cells.agg(*[F.max(F.when((F.col("treated") == t) & (F.col("post") == p), F.col("m"))).alias(n)
                       for t, p, n in ((True, True, "treated_post"), (True, False, "treated_pre"),
                                       (False, True, "control_post"), (False, False, "control_pre"))])
    return wide.withColumn("did", (F.col("treated_post") - F.col("treated_pre"))
                           - (F.col("control_post") - F.col("control_pre")))


def dashboard_filter(obs: DataFrame, states=None, topics=None, years=None, groups=None) -> DataFrame:
    """Filter facts before the marts; ``years`` is an inclusive (first, last) pair."""
    out = obs
    if states is not None:
        out = out.filter(F.col("LocationAbbr").isin(list(states)))
    if topics is not None:
        out = out.filter(F.col("Topic").isin(list(topics)))
    if years is not None:
        out = out.filter(F.col("YearStart").between(years[0], years[1]))
    if groups is not None:
        out = out.filter(F.col("Stratification1").isin(list(groups)))
    return out


def feature_availability(df: DataFrame, columns) -> DataFrame:
    """Non-null share of each feature column (one aggregate)."""
    cols = [c for c in columns if c in df.columns]
    agg = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(f"`{c}`")).alias(c) for c in cols])
    return agg.unpivot(["_n"], cols, "feature", "non_null").select(
        "feature", (F.col("non_null").cast("double") / F.col("_n").cast("double")).alias("availability"))


def calibration(scored: DataFrame, label: str = "label", score: str = "score", bins: int = 10) -> DataFrame:
    """Mean score vs observed rate per score decile."""
    b = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return scored.groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"),
        F.avg(F.col(label).cast("double")).alias("observed_rate"))


def error_rates(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """False-positive and false-negative rates of a 0/1 prediction."""
    y, p = F.col(label), F.col(prediction)
    return scored.agg(
        F.try_divide(F.count(F.when((p == 1) & (y == 0), 1)).cast("double"),
                     F.count(F.when(y == 0, 1)).cast("double")).alias("false_positive_rate"),
        F.try_divide(F.count(F.when((p == 0) & (y == 1), 1)).cast("double"),
                     F.count(F.when(y == 1, 1)).cast("double")).alias("false_negative_rate"))
