"""Isotonic calibration of scores and expected calibration error.

Equal scores are one level. Levels are range-partitioned by score; each range
pools adjacent violators on its own, and one pass over the blocks that are left
pools them across ranges. Pooling contiguous parts first gives the same blocks
as pooling all at once, so the result is that of the plain algorithm.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.quality import calibration

BLOCKS = "low double, high double, n long, positives long"


def pooled(blocks):
    """Blocks ``(low, high, n, positives)`` in ascending order, with neighbours
    pooled until their shares of positives rise. Shares are compared as whole
    numbers, so equal ones are pooled exactly."""
    stack: list[list] = []
    for block in blocks:
        stack.append(list(block))
        while len(stack) > 1 and stack[-2][3] * stack[-1][2] >= stack[-1][3] * stack[-2][2]:
            low, high = stack[-2], stack.pop()
            low[1], low[2], low[3] = high[1], low[2] + high[2], low[3] + high[3]
    return stack


def _pooled(batches):
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)

    found = pooled(rows())
    columns = list(zip(*found, strict=True)) or [()] * 4
    kinds = [pa.float64(), pa.float64(), pa.int64(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)],
                                     names=[part.split()[0] for part in BLOCKS.split(", ")])


def isotonic_blocks(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """``(low, high, n, positives, calibrated)``: ranges of scores, ascending, with the
    calibrated value of each. Rows without score are left out; a missing label
    is no positive."""
    known = scored.filter(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    levels = known.groupBy(F.col(score).cast("double").alias("low")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long").alias("positives"))
    levels = levels.select("low", F.col("low").alias("high"), "n", "positives")
    ranges = levels.repartitionByRange("low").sortWithinPartitions("low").mapInArrow(_pooled, BLOCKS)
    whole = ranges.repartition(1).sortWithinPartitions("low").mapInArrow(_pooled, BLOCKS)
    return whole.withColumn("calibrated", F.col("positives").cast("double") / F.col("n").cast("double"))


#: Parts of the unit range that scores are looked up in, each on its own.
PARTS = 4096


def calibrated(scored: DataFrame, blocks: DataFrame, score: str = "score") -> DataFrame:
    """``scored`` with ``calibrated``: the value of the block that a score lies in, of
    the block below it between two blocks, of the first one under all blocks.

    Distinct scores and blocks are laid out in parts of the unit range; a part
    takes the last value of the parts below it, so no task sees all scores.
    """
    part = F.floor(F.col("_at") * PARTS).alias("_part")
    marks = blocks.select(F.col("low").alias("_at"), F.col("calibrated").alias("_value"), F.lit(1).alias("_block"))
    levels = scored.filter(F.col(score).isNotNull()).select(F.col(score).cast("double").alias("_at")).distinct()
    levels = levels.select("_at", F.lit(None).cast("double").alias("_value"), F.lit(2).alias("_block"))
    rows = levels.unionByName(marks).select("*", part)
    below = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    parts = rows.groupBy("_part").agg(F.max(F.when(F.col("_block") == 1, F.struct("_at", "_value"))).alias("_top")).select(
        "_part", F.last("_top._value", ignorenulls=True).over(below).alias("_below"))
    inside = Window.partitionBy("_part").orderBy("_at", "_block")
    placed = rows.withColumn("_known", F.last("_value", ignorenulls=True).over(inside)).join(parts, "_part")
    first = blocks.agg(F.min_by("calibrated", "low")).scalar()
    found = placed.filter("_block = 2").select(F.col("_at").alias("_level"),
                                               F.coalesce("_known", "_below", first).alias("calibrated"))
    return scored.join(found, F.col(score).cast("double") == F.col("_level"), "left").drop("_level")


def expected_calibration_error(scored: DataFrame, label: str = "label", score: str = "score", bins: int = 10) -> DataFrame:
    """One row ``(rows, ece)``: the mean over rows of the distance between mean
    score and observed rate of their bin."""
    per = calibration(scored, label, score, bins)
    gap = F.col("n") * F.abs(F.col("mean_score") - F.col("observed_rate"))
    return per.agg(F.sum("n").alias("rows"), F.try_divide(F.sum(gap), F.sum("n").cast("double")).alias("ece"))
