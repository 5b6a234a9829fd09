"""Interaction audit of document filters, by recursive enumeration of orders.

Five filters fail documents independently of each other; which of them a
document fails is a mask of five bits. Documents are counted once per (part,
mask), so every order of the filters is audited on at most 32 cells per part
and never on documents again. A recursive CTE extends filter prefixes by the
letters they have not used, joined with the mask cells and carrying the bits
applied so far; each level of the recursion says of each cell whether the step
removes it, finds it gone already, or keeps it. Its rows are bounded by the
number of filters, whatever the input; counts per part are joined afterwards.

    A under ``MIN_WORDS`` words          B 100 * distinct words < 80 * words
    C 100 * ``[A-Z]`` > 10 * characters  D holds any of ``#$%&*|``
    E the text of a smaller ``doc_id`` anywhere in the table

Defined cases: a null text is empty; a null ``lang`` is the part ''; a null
``doc_id`` is smaller than none and duplicates none; rows that repeat an id with
the same text are duplicates of the smaller ids only, and every row counts; a
label of any row of an id counts for it; ids without label count for neither;
extra columns are ignored; an empty table has no part and no row. Equal texts
are told by their SHA-256. Distinct words are told by a 64-bit hash; a text is
read in stretches, only the hashes of its words are held whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.components import stored
from strata.llm.words import hash_words, released, runs, text_buffers

FILTERS = "ABCDE"
MIN_WORDS = 100
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#$%&*|")] = True
STRETCH = 1 << 22


def _per_text(data: np.ndarray, offsets: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """Bytes of each text that ``flags`` marks."""
    sums = np.zeros(len(offsets) - 1, dtype=np.int64)
    base, stop = int(offsets[0]), int(offsets[-1])
    for at in range(base, stop, STRETCH):
        end = min(at + STRETCH, stop)
        counts = np.zeros(end - at + 1, dtype=np.int64)
        np.cumsum(flags[data[at:end]], out=counts[1:])
        edges = counts[np.clip(offsets, at, end) - at]
        sums += np.diff(edges)
    return sums


_STARTS = np.ones(256, dtype=bool)
_STARTS[0x80:0xC0] = False


def _masks(batches):
    """Bits A to D of each row: ``(doc_id, lang, digest, mask)``."""
    for batch in released(batches):
        data, all_offsets = text_buffers(batch.column(3))
        for i, j in runs(all_offsets, 1 << 21, 10_000):
            offsets = all_offsets[i:j + 1]
            hashes, _, _, counts = hash_words(data, offsets, lower=False)
            text = np.repeat(np.arange(len(counts)), counts)
            order = np.lexsort((hashes, text))
            h, t = hashes[order], text[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
            distinct = np.bincount(t[new], minlength=len(counts))
            upper, chars, symbols = (_per_text(data, offsets, f) for f in (_UPPER, _STARTS, _SYMBOL))
            bits = (counts < MIN_WORDS, 100 * distinct < 80 * counts, 100 * upper > 10 * chars, symbols > 0)
            mask = sum(bit.astype(np.int32) << k for k, bit in enumerate(bits))
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).slice(i, j - i) for k in range(3)] + [pa.array(mask, type=pa.int32())],
                names=["doc_id", "part", "digest", "mask"])


def failures(docs: DataFrame) -> DataFrame:
    """``(doc_id, part, mask, n)``: how often an id occurs with a mask of the
    filters that its text fails, bit ``k`` for letter ``k``."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"),
                       text.alias("text"))
    rows = stored(rows.mapInArrow(_masks, "doc_id long, part string, digest binary, mask int")
                  .groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n")), "masks")
    # Joined on id and text, not on the text alone: a text that many ids share is no hot key.
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    repeats = F.when(F.col("first").isNull() & F.col("doc_id").isNotNull(), F.lit(1 << FILTERS.index("E"))).otherwise(0)
    return rows.join(first, ["digest", "doc_id"], "left").select(
        "doc_id", "part", F.col("mask").bitwiseOR(repeats).alias("mask"), "n")


def cells(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents, and those with quality 1 and toxic 1."""
    marks = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                                         F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    # An id is summed up before the join, so rows that repeat one are one row of it.
    rows = masks.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n")).join(marks, "doc_id", "left")
    return rows.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.coalesce(F.col("good") * F.col("n"), F.lit(0))).alias("good"),
        F.sum(F.coalesce(F.col("toxic") * F.col("n"), F.lit(0))).alias("toxic"))


TRAILS = """
WITH RECURSIVE filters AS (
  SELECT letter, CAST(shiftleft(1, place) AS INT) AS bit FROM (SELECT posexplode(split({letters}, '')) AS (place, letter))
), masks AS (
  SELECT DISTINCT mask FROM {cells}
), trail (prefix, step, applied, mask, failed, gone, only, survives) AS (
  SELECT CAST('' AS STRING), 0, 0, mask, false, false, false, true FROM masks
  UNION ALL
  SELECT concat(t.prefix, f.letter), t.step + 1, t.applied | f.bit, t.mask,
         t.mask & f.bit <> 0, t.mask & t.applied <> 0, t.mask = f.bit, t.mask & (t.applied | f.bit) = 0
  FROM trail t JOIN filters f ON t.applied & f.bit = 0
)
SELECT * FROM trail WHERE step > 0
"""

REPORT = """
WITH steps AS (
  SELECT c.part, t.prefix, t.step, sum(if(t.survives, c.n, 0)) AS kept,
         sum(if(t.failed AND NOT t.gone, c.n, 0)) AS removed, sum(if(t.failed AND t.gone, c.n, 0)) AS redundant,
         sum(if(t.only, c.n, 0)) AS unique_fails,
         sum(if(t.failed AND NOT t.gone, c.good, 0)) AS good_lost, sum(if(t.failed AND NOT t.gone, c.toxic, 0)) AS toxic_lost
  FROM {trail} t JOIN {cells} c ON t.mask = c.mask GROUP BY c.part, t.prefix, t.step
), orders AS (
  SELECT DISTINCT prefix AS filter_order, posexplode(transform(sequence(1, {n}), k -> left(prefix, k))) AS (at, prefix)
  FROM {trail} WHERE step = {n}
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, substring(filter_order, step, 1)) AS shapley
FROM steps JOIN orders USING (prefix)
"""


def report(counts: DataFrame, letters: str = FILTERS) -> DataFrame:
    """One row per part of ``counts`` (:func:`cells`), order of the ``letters``
    and step; see the columns of :func:`interactions`."""
    spark = counts.sparkSession
    counts = stored(counts, "cells")
    trail = stored(spark.sql(TRAILS, cells=counts, letters=letters), "trail")
    return spark.sql(REPORT, trail=trail, cells=counts, n=len(letters))


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley)``: what the filter of ``step`` does in each
    order of the five; ``shapley`` is its filter's ``removed`` over all orders."""
    return report(cells(stored(failures(docs), "failures"), labels))
