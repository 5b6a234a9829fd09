"""Exact quantiles per group by repeated histograms.

A quantile is the value of a rank. Each round counts the values of every open
(group, range) in equal bins, finds the bin that holds the rank and goes on
inside it, between the least and the greatest value in it. A round is one scan
with partial aggregation: no value is sorted and no group meets in one task.
Ranges shrink by the number of bins a round, so even 1e12 rows take four; one
that holds few rows, or one value, is settled at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.priority import materialize

BINS = 1024
#: Ranges of so many rows are read out and sorted.
FEW = 1_000
#: Open ranges up to this number are broadcast to the scan, more are shuffled.
BROADCAST_RANGES = 50_000


def _bin(bins: int):
    """Bin of ``v`` between ``lo`` and ``hi``: halves keep the span of finite values finite."""
    half = lambda c: F.col(c) * 0.5
    place = F.floor((half("v") - half("lo")) / (half("hi") - half("lo")) * bins)
    endless = F.abs("v") == float("inf")
    return (F.when(endless, F.when(F.col("v") < 0, -1).otherwise(bins))
            .when(F.col("lo") == F.col("hi"), 0).otherwise(F.least(place, F.lit(bins - 1)))).cast("int")


def exact_quantiles(df: DataFrame, group: str, value: str, probs, bins: int = BINS, few: int = FEW) -> DataFrame:
    """``(group, prob, n, value)``: of the ``n`` known values of each group, the
    one of rank ``ceil(prob * n)``, 1 at least. Rows without value are left out; a
    missing group is a group; infinities are values."""
    spark = df.sparkSession
    number = F.col(value).cast("double")
    rows = materialize(df.filter(number.isNotNull() & ~F.isnan(number)).select(
        F.col(group).alias("g"), (number + F.lit(0.0)).alias("v")), "values")
    finite = F.when(F.abs("v") < float("inf"), F.col("v"))
    whole = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min(finite).alias("lo"), F.max(finite).alias("hi"))
    wanted = F.explode(F.array(*(F.lit(float(p)) for p in probs)))
    open_ranges = whole.withColumn("prob", wanted).withColumn(
        "rank", F.greatest(F.ceil(F.col("prob") * F.col("n")), F.lit(1)).cast("long"))
    open_ranges = materialize(open_ranges.withColumn("total", F.col("n")), "ranges")
    found = []
    while n_open := open_ranges.count():
        ranges = open_ranges.select("g", "lo", "hi").distinct()
        if n_open <= BROADCAST_RANGES:
            ranges = F.broadcast(ranges)
        # The first range of a group takes all its values, infinite ones included.
        inside = F.expr("g <=> of AND v BETWEEN lo AND hi" if found else "g <=> of")
        counts = rows.join(ranges.withColumnRenamed("g", "of"), inside).groupBy("g", "lo", "hi", _bin(bins).alias("bin")).agg(
            F.count(F.lit(1)).alias("size"), F.min("v").alias("least"), F.max("v").alias("most"))
        earlier = Window.partitionBy("g", "lo", "hi").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("before", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
        counts = counts.select(F.col("g").alias("of"), F.col("lo").alias("from"), F.col("hi").alias("to"),
                               "size", "least", "most", "before")
        hit = open_ranges.join(counts, F.expr("g <=> of AND lo <=> from AND hi <=> to AND rank > before AND rank <= before + size"))
        step = materialize(hit.select("g", "prob", "total", (F.col("rank") - F.col("before")).alias("rank"),
                                      F.col("least").alias("lo"), F.col("most").alias("hi"), "size"), "ranges")
        found.append(step.filter("lo = hi").select("g", "prob", "total", F.col("lo").alias("value")))
        short = step.filter(f"lo < hi AND size <= {few}")
        if n_open <= BROADCAST_RANGES:
            short = F.broadcast(short)
        picked = rows.join(short.withColumnRenamed("g", "of"), F.expr("g <=> of AND v BETWEEN lo AND hi")).groupBy(
            "g", "prob", "total", "rank").agg(F.sort_array(F.collect_list("v")).alias("vs"))
        found.append(picked.select("g", "prob", "total", F.element_at("vs", F.col("rank").cast("int")).alias("value")))
        open_ranges = materialize(step.filter(f"lo < hi AND size > {few}").drop("size"), "ranges")
    if not found:
        return spark.createDataFrame([], f"`{group}` {df.schema[group].dataType.simpleString()}, prob double, n long, value double")
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out.select(F.col("g").alias(group), "prob", F.col("total").alias("n"), "value")
