"""Repeated passages across documents by paragraph MinHash.

Passages of ``MIN_WORDS`` words or more that stand in two different documents are
found in two ways; both are proposed by MinHash and confirmed on the words.

* Exact passages, wherever they stand. Paragraphs are all runs of ``WINDOW``
  shingles (of ``SHINGLE`` words) of the word sequence, whatever its lines. The
  MinHash of a run is the place of its least shingle; runs that overlap mostly
  share it, so a text has one place for eight words or so. A band is two places
  that follow each other. Each passage of ``MIN_WORDS`` words holds one band
  whole, with the same places in every document, so a passage can't be missed.
  Where a band stands in two different texts, all ``MIN_WORDS``-word sequences
  around it are compared by their hashes; the sequences that two texts share are
  the passages, word for word.
* Near passages. Lines of ``MIN_WORDS`` words or more are linked when their 5-word
  shingles reach Jaccard 0.8: MinHash bands (16 of 4 rows, a miss of 2e-4 at
  0.8 and 1e-8 at 0.95) and an odd sketch propose pairs, full sets confirm them,
  components cluster them. A line that lies in an exact passage is not told again.

The first document, by id, of a passage keeps it and every later one has it
marked for removal; a stretch whose sequences are held by earlier documents and
a stretch that is kept are separate rows, overlapping by less than a passage.
Passages that share words are clustered by connected components. No pair of
documents is enumerated: a phrase of many documents is one group, partially
aggregated, and its members meet the first one only.

Defined cases: null and empty texts hold no passage. Case of A-Z does not
matter within passages. Documents with equal texts repeat whole: the smallest id
has a row that is kept, each other one a row for removal. Rows that repeat with
the same id and text are one document and repeat in the result. Rows with a
null id come last and have nothing removed. Different texts under
one id keep what they share. Extra columns are ignored; an empty table has no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import neardup
from strata.llm.components import connected_components, stored
from strata.llm.words import hash_words, mix64, released, runs, text_buffers, word_powers

MIN_WORDS = 51
SHINGLE, WINDOW = 8, 16
LINES = neardup.Scheme(rows=4, bands=16, samples=512, bits=1024, floor=0.73, percent=80)
#: Copies of a join's smaller side, for keys that many rows share.
SALTS = 16
LAST_ID = (1 << 63) - 1

_U = np.uint64


def _digests(hashes: np.ndarray, firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Order-sensitive hash of each range of words."""
    with np.errstate(over="ignore"):
        up, down = word_powers(len(hashes))
        sums = np.concatenate([[_U(0)], np.cumsum(hashes * up[:len(hashes)], dtype=_U)])
        return mix64((sums[firsts + sizes] - sums[firsts]) * down[firsts] + sizes.astype(_U))


def _sequences(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all sequences of ``size`` words inside one text, the word each
    begins at, and how many each text has."""
    many = np.maximum(counts - size + 1, 0)
    begins = np.cumsum(counts) - counts
    firsts = np.arange(many.sum()) + np.repeat(begins - (np.cumsum(many) - many), many)
    return _digests(hashes, firsts, np.full(len(firsts), size)), firsts, many


def bands(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bands of texts: their keys, the word each begins at within its text, its
    number of words and its text. Texts under ``MIN_WORDS`` words have none."""
    counts_long = np.where(counts >= MIN_WORDS, counts, 0)
    shingles, firsts, many = _sequences(hashes, counts, SHINGLE)
    long = np.repeat(counts_long > 0, many)
    shingles, firsts, many = shingles[long], firsts[long], np.where(counts_long > 0, many, 0)
    none = np.zeros(0, dtype=np.int64)
    if not len(shingles):
        return np.zeros(0, dtype=_U), none, none, none
    # Place of the least shingle of every run, the last one of equals; runs over a text's end are left out.
    views = np.lib.stride_tricks.sliding_window_view(shingles[::-1], WINDOW)
    least = len(shingles) - 1 - (np.arange(len(views)) + views.argmin(axis=1))[::-1]
    ends = np.cumsum(many)
    text = np.repeat(np.arange(len(many)), many)
    inside = np.arange(len(views)) + WINDOW <= ends[text[:len(views)]]
    places = np.unique(least[inside])
    follow = text[places[1:]] == text[places[:-1]]
    a, b = places[:-1][follow], places[1:][follow]
    with np.errstate(over="ignore"):
        keys = mix64(shingles[a] * _U(3) + shingles[b] + (b - a).astype(_U))
    starts = np.cumsum(counts) - counts
    return keys, firsts[a] - starts[text[a]], b - a + SHINGLE, text[a]


def _hashed(column: pa.Array):
    """``(first text, word hashes, words per text, bytes, offsets)`` of groups of texts."""
    data, offsets = text_buffers(column)
    for i, j in runs(offsets):
        hashes, starts, _, counts = hash_words(data, offsets[i:j + 1])
        yield i, hashes, counts, starts, data, offsets[i:j + 1]


def _lists(values: np.ndarray, sizes: np.ndarray, kind) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


TEXTS = "text_hash long, n_words long, keys array<long>, places array<int>"


def _texts(batches):
    """Bands of every text; a place is ``64 * first word + words``."""
    for batch in released(batches):
        for i, hashes, counts, *_ in _hashed(batch.column(1)):
            keys, firsts, sizes, text = bands(hashes, counts)
            per = np.bincount(text, minlength=len(counts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, len(counts)), pa.array(counts), _lists(keys.view(np.int64), per, pa.int64()),
                 _lists((64 * firsts + sizes).astype(np.int32), per, pa.int32())],
                names=["text_hash", "n_words", "keys", "places"])


GRAMS = "text_hash long, id long, gram long, at long"


def _grams(batches):
    """Sequences of ``MIN_WORDS`` words around the places of repeated bands."""
    for batch in released(batches):
        for i, hashes, counts, *_ in _hashed(batch.column(2)):
            grams, firsts, many = _sequences(hashes, counts, MIN_WORDS)
            places = batch.column(3).slice(i, len(counts))
            per = np.diff(places.offsets.to_numpy())
            packed = places.flatten().to_numpy().astype(np.int64)
            text = np.repeat(np.arange(len(counts)), per)
            base = np.cumsum(many) - many
            low = np.maximum(packed // 64 + packed % 64 - MIN_WORDS, 0)
            high = np.minimum(packed // 64, many[text] - 1)
            use = high >= low
            edge = np.zeros(len(grams) + 1, dtype=np.int64)
            np.add.at(edge, base[text[use]] + low[use], 1)
            np.add.at(edge, base[text[use]] + high[use] + 1, -1)
            chosen = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
            of = np.repeat(np.arange(len(counts)), many)[chosen]
            row = pa.array(i + of)
            begins = np.cumsum(counts) - counts
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), batch.column(1).take(row), pa.array(grams[chosen].view(np.int64)),
                 pa.array(firsts[chosen] - begins[of])], names=["text_hash", "id", "gram", "at"])


def _lines(hashes, starts, counts, data, offsets):
    """First words and sizes of the long lines of a group of texts, and their texts."""
    text = np.repeat(np.arange(len(counts)), counts)
    line_ends = np.flatnonzero(data[offsets[0]:offsets[-1]] == 10) + offsets[0]
    line = np.searchsorted(line_ends, starts)
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (line[1:] != line[:-1])
    firsts = np.flatnonzero(new)
    sizes = np.diff(np.append(firsts, len(hashes)))
    long = sizes >= MIN_WORDS
    return firsts[long], sizes[long], text


LONG_LINES = ("text_hash long, id long, first_word long, words long, digest long, n long, bands array<long>, "
              + ", ".join(f"{lane} long" for lane in LINES.lanes))


def _long_lines(batches):
    """Long lines with their number of distinct shingles, bands and sketch."""
    for batch in released(batches):
        for i, hashes, counts, starts, data, offsets in _hashed(batch.column(2)):
            firsts, sizes, text = _lines(hashes, starts, counts, data, offsets)
            if not len(firsts):
                continue
            flat, set_sizes = _line_sets(hashes, firsts, sizes)
            found, sketch = LINES.sketches(flat, np.cumsum(set_sizes) - set_sizes)
            row = pa.array(i + text[firsts])
            before = np.cumsum(counts) - counts
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), batch.column(1).take(row), pa.array(firsts - before[text[firsts]]), pa.array(sizes),
                 pa.array(_digests(hashes, firsts, sizes).view(np.int64)), pa.array(set_sizes),
                 _lists(found.ravel().view(np.int64), np.full(len(firsts), LINES.bands), pa.int64())]
                + [pa.array(sketch[:, k]) for k in range(len(LINES.lanes))],
                names=[part.split()[0] for part in LONG_LINES.split(", ")])


def _line_sets(hashes, firsts, sizes):
    words = np.concatenate([hashes[a:a + n] for a, n in zip(firsts, sizes, strict=True)])
    return neardup.shingle_sets(words, sizes)


def _sets(batches):
    for batch in released(batches):
        for _, hashes, counts, starts, data, offsets in _hashed(batch.column(0)):
            firsts, sizes, _ = _lines(hashes, starts, counts, data, offsets)
            if len(firsts):
                flat, set_sizes = _line_sets(hashes, firsts, sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_digests(hashes, firsts, sizes).view(np.int64)),
                     _lists(flat.view(np.int64), set_sizes, pa.int64())], names=["digest", "shingles"])


def exact_runs(docs: DataFrame, texts: DataFrame, classes: DataFrame) -> DataFrame:
    """``(text_hash, id, first_word, last_word, held, keep_id, holders)``: the
    passages of each distinct text. ``held``: earlier texts have its sequences;
    ``holders``: for each of them a place where it has one, ``(text_hash, at)``.

    ``docs``: ``(text_hash, id, text)``; ``texts``: the bands of each text;
    ``classes``: the first ``id`` of each text.
    """
    places = texts.select("text_hash", F.explode(F.arrays_zip("keys", "places")).alias("x")).select(
        "text_hash", F.col("x.keys").alias("key"), F.col("x.places").alias("place"))
    common = places.groupBy("key").agg(F.min("text_hash").alias("low"), F.max("text_hash").alias("high")).filter("low <> high")
    around = places.join(common.select("key"), "key", "left_semi").groupBy("text_hash").agg(F.collect_list("place").alias("places"))
    around = stored(around.join(classes.select("text_hash", "id"), "text_hash"), "places")
    # On text and id: of a text that many documents share, one meets its places.
    rows = docs.select("text_hash", "id", "text").join(around, ["text_hash", "id"]).dropDuplicates(["text_hash", "id"])
    grams = stored(rows.select("text_hash", "id", "text", "places").mapInArrow(_grams, GRAMS), "sequences")
    first = F.min(F.struct("id", "text_hash", "at")).alias("keep")
    shared = grams.groupBy("gram").agg(F.min("text_hash").alias("low"), F.max("text_hash").alias("high"), first)
    found = grams.join(shared.filter("low <> high").select("gram", "keep"), "gram")
    found = found.withColumn("held", F.col("keep.id") < F.col("id"))
    order = Window.partitionBy("text_hash").orderBy("at")
    begins = (F.col("at") != F.lag("at").over(order) + 1) | (F.col("held") != F.lag("held").over(order))
    found = found.withColumn("run", F.sum(F.coalesce(begins, F.lit(True)).cast("int")).over(order))
    per_holder = found.groupBy("text_hash", "id", "run", "held", F.col("keep.text_hash").alias("holder")).agg(
        F.min("at").alias("low"), F.max("at").alias("high"), F.min("keep.id").alias("keep_id"), F.min("keep.at").alias("keep_at"))
    return per_holder.groupBy("text_hash", "id", "run", "held").agg(
        F.min("low").alias("first_word"), (F.max("high") + MIN_WORDS).alias("last_word"), F.min("keep_id").alias("keep_id"),
        F.collect_list(F.struct(F.col("holder").alias("text_hash"), F.col("keep_at").alias("at"))).alias("holders")).drop("run")


def clustered(passages: DataFrame) -> DataFrame:
    """``passages`` (of :func:`exact_runs`) with ``cluster_id``: those that a
    holder's passage connects are one cluster."""
    node = F.xxhash64("text_hash", "first_word", "held")
    passages = stored(passages.withColumn("node", node), "passages")
    salt = F.pmod(F.col("node"), F.lit(SALTS))
    asked = passages.filter("held").select("node", salt.alias("salt"), F.explode("holders").alias("x")).select(
        "node", "salt", F.col("x.text_hash").alias("text_hash"), F.col("x.at").alias("at"))
    homes = passages.select(F.col("node").alias("home"), "text_hash", "first_word", "last_word",
                            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    links = asked.join(homes, ["text_hash", "salt"]).filter(f"at >= first_word AND at + {MIN_WORDS} <= last_word")
    roots = connected_components(links.select("node", "home"), "node", "home")
    return passages.join(roots, "node", "left").withColumn("cluster_id", F.coalesce("root", "node")).drop("root", "node", "holders")


def near_lines(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``(text_hash, id, first_word, last_word, held, keep_id, cluster_id)``: long
    lines of distinct texts that are near, or equal, to one of another text.
    Arguments as for :func:`exact_runs`."""
    docs = docs.select("text_hash", "id", "text")
    own = classes.select("text_hash", "id")
    every = stored(docs.mapInArrow(_long_lines, LONG_LINES), "lines")
    lines = stored(every.groupBy("digest").agg(
        F.min("text_hash").alias("low"), F.max("text_hash").alias("high"), F.min("id").alias("id"),
        *(F.first(c).alias(c) for c in ("n", "bands", *LINES.lanes))), "line-classes")

    def sets_of(wanted: DataFrame) -> DataFrame:
        ids = lines.join(wanted, "digest", "left_semi").select(F.col("low").alias("text_hash")).distinct().join(own, "text_hash")
        return (docs.join(ids, ["text_hash", "id"], "left_semi").select("text")
                .mapInArrow(_sets, "digest long, shingles array<long>")
                .join(wanted, "digest", "left_semi").groupBy("digest").agg(F.first("shingles").alias("shingles")))

    roots = neardup.linked_classes(lines, LINES, sets_of).withColumnRenamed("node", "digest")
    rooted = stored(lines.select("digest", "low", "high", "id").join(roots, "digest"), "rooted")
    near = rooted.groupBy("root").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.min("id").alias("keep_id"))
    near = rooted.select("digest", "root").join(near.filter("low <> high"), "root").select(
        "digest", F.col("root").alias("cluster_id"), "keep_id")
    found = every.select("text_hash", "id", "first_word", "words", "digest").join(near, "digest").join(own, ["text_hash", "id"])
    return found.select("text_hash", "id", "first_word", (F.col("first_word") + F.col("words")).alias("last_word"),
                        (F.col("keep_id") < F.col("id")).alias("held"), "keep_id", "cluster_id").distinct()


def repeated_passages(docs: DataFrame) -> DataFrame:
    """``(doc_id, first_word, last_word, n_words, cluster_id, kept_in, removed)``:
    one row per passage of a document; ``kept_in`` is the document that keeps the
    text. See the module text."""
    own = F.coalesce("doc_id", F.lit(LAST_ID))
    docs = docs.filter("text IS NOT NULL").select("doc_id", "text", F.xxhash64("text").alias("text_hash"), own.alias("id"))
    texts = stored(docs.select("text_hash", "text").mapInArrow(_texts, TEXTS)
                   .groupBy("text_hash").agg(*(F.first(c).alias(c) for c in ("n_words", "keys", "places"))), "texts")
    ids = docs.groupBy("text_hash").agg(F.min("id").alias("id"), F.max("id").alias("last_id"))
    classes = stored(texts.filter(f"n_words >= {MIN_WORDS}").select("text_hash", "n_words").join(ids, "text_hash"), "classes")
    exact = stored(clustered(exact_runs(docs, texts, classes)), "exact")
    near = near_lines(docs, classes)
    inside = exact.select("text_hash", F.col("first_word").alias("low"), F.col("last_word").alias("high"))
    near = near.join(inside, (near.text_hash == inside.text_hash) & F.expr("first_word >= low AND last_word <= high"), "left_anti")
    # A text of several documents: its passages are those of the first one, and it repeats whole.
    copies = classes.filter("id < last_id").select(
        "text_hash", "id", F.lit(0).cast("long").alias("first_word"), F.col("n_words").alias("last_word"),
        F.lit(False).alias("held"), F.col("id").alias("keep_id"), F.col("text_hash").alias("cluster_id"))
    found = exact.unionByName(near).unionByName(copies)
    here = docs.select("doc_id", "id", "text_hash").join(found, ["text_hash", "id"])
    later = docs.select("doc_id", F.col("id").alias("own"), "text_hash").join(copies, "text_hash").filter("own > id")
    return _told(here).union(_told(later.withColumn("held", F.lit(True))))


def _told(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "first_word", "last_word", (F.col("last_word") - F.col("first_word")).alias("n_words"),
                       "cluster_id", F.when(F.col("keep_id") != LAST_ID, F.col("keep_id")).alias("kept_in"),
                       (F.col("held") & F.col("doc_id").isNotNull()).alias("removed"))
