"""Mixing sources to target weights by systematic sampling.

Each source gets a target number of words: its weight's part of the total, at
most ``MAX_REPEATS`` times its own size; what the bound cuts off is shared
among the others by weight until none is above. A document's expected number
of copies is its source's target over its source's size. Within a source the
documents stand in order of size; their expected copies are summed up, one
random offset in [0, 1) is added, and a document is emitted once for every
whole number that the running sum passes at it. Because neighbours in that
order are alike in size, a source's taken words miss its target by at most the
size of its largest document.

Running sums are exact: the step is a fixed-point number of ``STEP_BITS``
fraction bits (a third of 2**STEP_BITS documents per source before a long
overflows, 7 * 10**8 at 32 bits, 10**10 at 28).

A document's place in its source comes from counts, not from one window over
the source: words per (source, size) are summed first, then per (source, size,
tie group) where a tie group is three hex digits of the id's hash, and only
rows of one tie group are numbered by a window. A hot source, or a hot size of
it, is thus spread over thousands of groups.

Nulls and ties: a null text has size 0; documents of size 0 take part with
their expected copies like any other. A null source is a source of its own,
ordered last. A source without any words has target 0. Equal rows are
interchangeable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.components import stored

MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
STEP_BITS = 28
SEED = 7


SPACE = "[\\x20\\x09-\\x0D]"


def n_words(text: Column) -> Column:
    """Number of runs of non-space; null counts as empty."""
    lead = F.substring(text, 1, 1).rlike(SPACE).cast("int")
    trail = F.substring(text, -1, 1).rlike(SPACE).cast("int")
    return F.when(F.length(text) > 0, F.size(F.split(text, SPACE + "+")) - lead - trail).otherwise(0).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, one row
    per source. The sources are a configuration-sized list; their weights
    ``WEIGHTS`` repeat in code point order, null last.

    The shares settle where ``sum(min(weight * level, bound)) = total``. With
    the sources in order of ``bound / weight``, the level is the first that no
    later source's bound is below.
    """
    rank = Window.orderBy(F.col("source").isNull(), "source")
    step = (F.row_number().over(rank) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), step.cast("int") + 1)
    rows = sizes.withColumn("weight", weight.cast("long")).withColumn("bound", MAX_REPEATS * F.col("source_size"))
    rows = rows.withColumn("ratio", F.col("bound") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("bound").over(before), F.lit(0))
    rows = rows.withColumn("level", left / F.sum("weight").over(after))
    # Past the first level that fits they only fall, so the first is the largest.
    level = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(whole)
    target = F.least(F.col("weight") * level, F.col("bound").cast("double"))
    return rows.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def _passed(place: Column) -> Column:
    """Whole numbers up to the running sum before row ``place`` of a source."""
    return F.shiftright(F.col("offset") + place * F.col("step"), STEP_BITS)


def mixed(docs: DataFrame, payload: list[str]) -> DataFrame:
    """``docs`` with ``mix_size``, ``mix_source_size``, ``mix_target`` and
    ``mix_copies`` for every row. ``payload``: the columns of ``docs`` to carry;
    ``doc_id``, ``source`` and ``text`` are needed."""
    source = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))  # null-safe join key
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in payload)).alias("row"),
                       F.col("doc_id").alias("id"), source.alias("src"), n_words(F.col("text")).alias("size"),
                       F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 3).alias("tie"))
    counts = stored(rows.groupBy("src", "size", "tie").agg(F.count(F.lit(1)).alias("n")), "counts")
    per_size = counts.groupBy("src", "size").agg(F.sum("n").alias("n"))
    sizes = (per_size.groupBy("src").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
             .select(F.when(F.col("src") != "", F.expr("substring(src, 2)")).alias("source"), "source_size"))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{SEED}|"), F.coalesce("source", F.lit("")))),
                                1, STEP_BITS // 4), 16, 10).cast("long")
    step = F.when(F.col("source_size") > 0, F.floor(
        F.col("target") / F.col("source_size") * F.lit(float(1 << STEP_BITS)))).otherwise(0).cast("long")
    plan = source_targets(sizes).select(source.alias("src"), "source_size", "target", step.alias("step"),
                                        offset.alias("offset"))
    upto = Window.partitionBy("src").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    ties = Window.partitionBy("src", "size").orderBy("tie").rowsBetween(Window.unboundedPreceding, -1)
    before = per_size.select("src", "size", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("base"))
    places = (counts.withColumn("tie_base", F.coalesce(F.sum("n").over(ties), F.lit(0)))
              .join(before, ["src", "size"]).join(plan, "src")
              .select("src", "size", "tie", (F.col("base") + F.col("tie_base")).alias("first"),
                      "source_size", "target", "step", "offset"))
    group = Window.partitionBy("src", "size", "tie").orderBy("id", F.xxhash64("row"))
    placed = (rows.withColumn("no", F.row_number().over(group) - 1)
              .join(places, ["src", "size", "tie"]).withColumn("place", F.col("first") + F.col("no")))
    return placed.select("row.*", F.col("size").alias("mix_size"), F.col("source_size").alias("mix_source_size"),
                         F.col("target").alias("mix_target"),
                         (_passed(F.col("place") + 1) - _passed(F.col("place"))).alias("mix_copies"))


def sampled(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix takes it: each row as often as it was drawn."""
    rows = mixed(docs.withColumn("mix_row", F.struct(*(F.col(f"`{c}`") for c in docs.columns)))
                 .select("mix_row", "doc_id", "source", "text"), ["mix_row"])
    taken = rows.filter("mix_copies > 0").select("mix_row", F.explode(F.sequence(F.lit(1), F.col("mix_copies"))))
    return taken.select("mix_row.*")
