"""Distributed ranks without a global window.

``percent_rank() OVER (ORDER BY v)`` with no ``PARTITION BY`` moves every row
into one task. The same numbers follow from prefix counts:

    percent_rank(v) = rows_below(v) / (N - 1)       (0 when N = 1)

``value_ranks`` computes ``rows_below`` for every distinct value with work
spread over many tasks:

1. collapse rows to ``(group, value, n)`` — partial aggregation absorbs hot
   values before the shuffle, so a value holding a third of all rows costs
   one row here;
2. cut the value axis into buckets at approximate quantiles (one small
   driver round trip of at most ``max_quantiles`` numbers), so every bucket
   holds a bounded number of distinct values;
3. per-bucket totals give each bucket its offset (a tiny table);
4. a running sum inside each bucket gives the position within it.

The bucket boundaries are a deterministic function of the value, so a
recomputed partition lands in the same bucket.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TARGET_BUCKET_ROWS = 1_000_000
MAX_QUANTILES = 100_000
QUANTILE_ACCURACY = 10_000


def quantile_splits(df: DataFrame, columns: list[str], target_rows: int = TARGET_BUCKET_ROWS,
                    max_quantiles: int = MAX_QUANTILES) -> dict[str, list[float]]:
    """Split points for several numeric columns.

    One count job sizes the table; only when it exceeds ``target_rows`` a
    second job computes ``ceil(rows / target_rows) - 1`` approximate
    quantiles per column (at most ``max_quantiles``). The quantiles are
    weighted by rows, so a bucket never holds more than about
    ``target_rows`` rows and thus never more distinct values either.
    """
    n_rows = df.count()
    splits: dict[str, list[float]] = {c: [] for c in columns}
    if n_rows > target_rows:
        n_buckets = min(max_quantiles, math.ceil(n_rows / target_rows))
        probs = [i / n_buckets for i in range(1, n_buckets)]
        accuracy = max(QUANTILE_ACCURACY, 4 * n_buckets)
        row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, accuracy).alias(f"_q{i}")
                       for i, c in enumerate(columns)]).first()
        for i, c in enumerate(columns):
            qs = row[f"_q{i}"] or []
            splits[c] = sorted({float(q) for q in qs if q is not None
                                and not math.isnan(q) and not math.isinf(q)})
    return splits


def value_ranks(df: DataFrame, value: str, by: tuple | list = (), splits: list[float] | None = None,
                distinct: bool = False, target_rows: int = TARGET_BUCKET_ROWS) -> DataFrame:
    """One row per distinct ``(by..., value)`` with

    * ``_below`` — rows of the same group whose value is strictly smaller
      (null values sort last, like ``ORDER BY v NULLS LAST``);
    * ``_total`` — rows of the group.

    With ``distinct=True`` every distinct value counts once (dense ranks).
    """
    by = list(by)
    v = F.col(value)
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    if distinct:
        counts = counts.withColumn("_n", F.lit(1).cast("long"))
    if splits is None:
        splits = quantile_splits(df.select(value), [value], target_rows)[value]
    if not splits:
        # At most ``target_rows`` rows (known from the quantile job): one
        # running sum per group, no bucket offsets needed.
        run = Window.partitionBy(*by).orderBy(v.asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
        return counts.select(*by, value,
                             F.coalesce(F.sum("_n").over(run), F.lit(0)).alias("_below"),
                             F.sum("_n").over(Window.partitionBy(*by)).alias("_total"))
    n_buckets = len(splits) + 1
    bucketizer = Bucketizer(splits=[float("-inf")] + list(splits) + [float("inf")],
                            inputCol="_vd", outputCol="_bd", handleInvalid="keep")
    counts = bucketizer.transform(counts.withColumn("_vd", F.coalesce(v.cast("double"), F.lit(0.0))))
    counts = counts.withColumn("_b", F.when(v.isNull(), F.lit(n_buckets)).otherwise(F.col("_bd").cast("int")))
    counts = counts.select(*by, value, "_n", "_b")

    totals = counts.groupBy(*by, "_b").agg(F.sum("_n").alias("_bn"))
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_b",
        F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_off"),
        F.sum("_bn").over(Window.partitionBy(*by)).alias("_total"),
    )
    inside = Window.partitionBy(*by, "_b").orderBy(v.asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    counts = counts.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    return (
        counts.join(offsets, on=[*by, "_b"])
        .select(*by, value, (F.col("_off") + F.col("_in")).alias("_below"), "_total")
    )


def _attach(df: DataFrame, ranks: DataFrame, value: str, by: list, out: str, expr) -> DataFrame:
    """Join rank rows back to ``df`` on (by, value); Spark picks the join by
    the bytes of the rank table."""
    r = ranks.select(*[F.col(b).alias(f"_k_{b}") for b in by], F.col(value).alias("_k_v"),
                     "_below", "_total")
    cond = F.col(value).eqNullSafe(F.col("_k_v"))
    for b in by:
        cond = cond & F.col(b).eqNullSafe(F.col(f"_k_{b}"))
    joined = df.join(r, cond, "left")
    return joined.withColumn(out, expr).drop("_k_v", "_below", "_total",
                                             *[f"_k_{b}" for b in by])


def percent_rank(df: DataFrame, columns: dict[str, str], by: tuple | list = (),
                 target_rows: int = TARGET_BUCKET_ROWS) -> DataFrame:
    """Add ``out = percent_rank() over (partition by by order by col nulls last)``
    for every ``out -> col`` pair, without a single-task window.

    All split points come from one aggregate job; callers that reuse ``df``
    for several actions should materialise it first.
    """
    by = list(by)
    cols = list(dict.fromkeys(columns.values()))
    splits = quantile_splits(df.select(*cols), cols, target_rows)
    out_df = df
    for out, col in columns.items():
        ranks = value_ranks(df.select(*by, col), col, by, splits=splits[col])
        pr = F.when(F.col("_total") > 1,
                    F.col("_below").cast("double") / (F.col("_total") - 1).cast("double")
                    ).otherwise(F.lit(0.0))
        out_df = _attach(out_df, ranks, col, by, out, pr)
    return out_df
