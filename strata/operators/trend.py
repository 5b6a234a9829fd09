"""Trend tests on yearly means, for every topic in one job.

The series are aggregates: one row per (topic, year), so a series is as
long as the number of years, however large the table under it. Statistics and
their p-values are Spark expressions over those short series.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.constants import SIGNIFICANCE_LEVEL, Z_CRITICAL_05
from strata.functions.numeric import exact_mean


def yearly_series(obs: DataFrame, key: str = "Topic", year: str = "YearStart",
                  value: str = "DataValueAlt") -> DataFrame:
    """(key, year, v): mean value per key and year; rows without a key are
    not a series of any topic and are left out."""
    return (obs.filter(F.col(key).isNotNull() & F.col(year).isNotNull())
            .groupBy(key, year).agg(exact_mean(value).alias("v"))
            .filter(F.col("v").isNotNull()))


def _each(n, first, step):
    """Sum of ``1 + t1 + t1 t2 + ...``: ``n`` factors ``step(k)`` from ``k = first`` on."""
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def add(done, k):
        term = done["term"] * step(k)
        return F.struct(term.alias("term"), (done["sum"] + term).alias("sum"))

    indexes = F.when(n > 0, F.sequence(F.lit(first), F.lit(first - 1) + n)).otherwise(F.expr("cast(array() as array<int>)"))
    return F.aggregate(indexes, start, add, lambda done: done["sum"])


#: Terms of the error function's series: enough for any |z| whose tail is not 0 in double precision.
ERROR_TERMS = 200


def normal_two_sided_p(z):
    """Two-sided tail of the standard normal distribution, to 1e-15: the error
    function by its series ``exp(-x^2) * sum (2 x^2)^k / (1 3 5 ... (2 k + 1))``,
    whose terms are all positive."""
    x = F.abs(z) / F.lit(math.sqrt(2.0))
    total = _each(F.lit(ERROR_TERMS), 1, lambda k: F.lit(2.0) * x * x / (F.lit(2.0) * k + F.lit(1.0)))
    tail = F.lit(1.0) - F.lit(2.0 / math.sqrt(math.pi)) * x * F.exp(-x * x) * total
    return F.when(F.abs(z) > 9, F.lit(0.0)).otherwise(F.greatest(tail, F.lit(0.0)))


def spearman_p(rho, n):
    """Two-sided p of Spearman's rho from Student's t with ``n - 2`` degrees of
    freedom; null for fewer. For a whole number of degrees the tail is a finite
    sum in ``rho`` itself, as ``t / sqrt(df)`` is ``rho / sqrt(1 - rho^2)``."""
    r = F.least(F.abs(rho), F.lit(1.0))
    c2 = F.lit(1.0) - r * r
    df = n - 2
    even = r * _each((df / 2).cast("int") - 1, 1, lambda k: c2 * (F.lit(2.0) * k - 1) / (F.lit(2.0) * k))
    odd = F.when(df == 1, F.lit(0.0)).otherwise(
        r * F.sqrt(c2) * _each(((df - 1) / 2).cast("int") - 1, 1, lambda k: c2 * (F.lit(2.0) * k) / (F.lit(2.0) * k + 1)))
    inside = F.when(df % 2 == 0, even).otherwise(F.lit(2.0 / math.pi) * (F.asin(r) + odd))
    return F.when(df >= 1, F.greatest(F.lit(1.0) - inside, F.lit(0.0)))


def _kendall_parts(series: DataFrame, key: str) -> DataFrame:
    """``(key, n, s, tie_term)``: S, the sum over i < j of sign(v_j - v_i), and the
    tie term of each series. A series has a value a year, so its array is short."""
    years = series.groupBy(F.col(key).alias("key")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("YearStart", "v"))), lambda x: x["v"]).alias("vs"))

    def sign_sum(values, v):
        return F.aggregate(values, F.lit(0).cast("long"), lambda done, x: done + F.signum(v - x).cast("long"))

    s = F.aggregate(F.transform("vs", lambda v, i: sign_sum(F.slice("vs", F.lit(1), i), v)), F.lit(0).cast("long"),
                    lambda done, x: done + x)
    times = F.transform(F.array_distinct("vs"), lambda d: F.size(F.filter("vs", lambda x: x == d)).cast("long"))
    ties = F.aggregate(times, F.lit(0).cast("long"), lambda done, t: done + t * (t - 1) * (F.lit(2) * t + 5))
    return years.select("key", F.size("vs").cast("long").alias("n"), s.alias("s"), ties.alias("tie_term"))


def mann_kendall(series: DataFrame, key: str = "Topic", with_p: bool = True) -> DataFrame:
    """Mann-Kendall test per key: n, S, tie-corrected var(S), tau, z,
    trend label, significance (p < 0.05 <=> |z| > z_0.975) and p."""
    parts = _kendall_parts(series, key)
    n, s = F.col("n"), F.col("s")
    var_s = ((n * (n - 1) * (F.lit(2) * n + 5) - F.col("tie_term")).cast("double") / F.lit(18.0))
    z = (F.when(s > 0, (s - 1).cast("double") / F.sqrt(var_s))
         .when(s < 0, (s + 1).cast("double") / F.sqrt(var_s))
         .otherwise(F.lit(0.0)))
    out = parts.select(
        F.col("key").alias(key), n.alias("n_years"), s.alias("s_statistic"), var_s.alias("var_s"),
        F.try_divide(s.cast("double"), (n * (n - 1)).cast("double") / F.lit(2.0)).alias("tau"),
        z.alias("z_score"))
    significant = F.abs(F.col("z_score")) > F.lit(Z_CRITICAL_05)
    out = out.withColumns({
        "significant": significant,
        "trend": F.when(significant & (F.col("z_score") > 0), F.lit("increasing"))
        .when(significant & (F.col("z_score") < 0), F.lit("decreasing"))
        .otherwise(F.lit("no trend")),
        "method": F.lit("Mann-Kendall"),
    })
    if with_p:
        out = out.withColumn("p_value", normal_two_sided_p(F.col("z_score")))
    return out


def _average_rank(col: str, key: str):
    """Average rank (1-based, ties share the mean of their positions)."""
    w = Window.partitionBy(key).orderBy(col)
    ties = F.count(F.lit(1)).over(Window.partitionBy(key, col))
    return F.rank().over(w).cast("double") + (ties - 1).cast("double") / F.lit(2.0)


def spearman(series: DataFrame, key: str = "Topic", with_p: bool = True) -> DataFrame:
    """Spearman's rho between year and yearly mean per key; the trend is
    the sign of rho (rho <= 0 or undefined -> 'decreasing'); p from Student's
    t with n - 2 degrees of freedom (null for n < 3).

    Ranks come from windows partitioned by key (one short series per task);
    rho is Pearson's formula over rank sums, exact in double for these sizes.
    """
    ranked = series.select(key, _average_rank("YearStart", key).alias("rx"),
                           _average_rank("v", key).alias("ry"))
    sums = ranked.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_years"),
        F.sum("rx").alias("sx"), F.sum("ry").alias("sy"),
        F.sum(F.col("rx") * F.col("ry")).alias("sxy"),
        F.sum(F.col("rx") * F.col("rx")).alias("sxx"),
        F.sum(F.col("ry") * F.col("ry")).alias("syy"))
    n = F.col("n_years").cast("double")
    cov = n * F.col("sxy") - F.col("sx") * F.col("sy")
    vx = n * F.col("sxx") - F.col("sx") * F.col("sx")
    vy = n * F.col("syy") - F.col("sy") * F.col("sy")
    rho = F.try_divide(cov, F.sqrt(vx * vy))
    out = sums.select(key, "n_years", rho.alias("rho")).withColumns({
        "trend": F.when(F.col("rho") > 0, F.lit("increasing")).otherwise(F.lit("decreasing")),
        "method": F.lit("Spearman"),
    })
    if with_p:
        out = out.withColumn("p_value", spearman_p(F.col("rho"), F.col("n_years")))
        out = out.withColumn("significant", F.col("p_value") < F.lit(SIGNIFICANCE_LEVEL))
    return out
