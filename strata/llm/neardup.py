"""Near-duplicate detection with MinHash bands and odd sketches.

* Words are lower-cased (A-Z) runs of non-space; a document's set holds its
  distinct 5-word shingles, or its whole word sequence when it has fewer than
  five words. A document without words has an empty set and links to nothing.
* Documents with equal sets form one class; a class is one node from then on,
  so thousands of copies cost one node.
* Each class has 25 band keys of five MinHash samples that propose candidates, and an odd sketch that estimates their similarity: a bitmap in
  which each of ``k`` further samples flips one bit. Two sketches differ in about
  ``bits / 2 * (1 - exp(-4 k (1 - J) / bits))`` bits. Candidates that it puts
  far below the threshold go; the rest is confirmed on the full sets.
* Candidates are found without listing all pairs of a band's members. First
  every member is compared with its band's star, the member that shares bands
  with most others: in a group of near copies that is their common original.
  Where that leaves members of one band in different components, each member
  outside the star's component is compared with the members of the other
  components. Every pair that shares a band is thus either in one component
  already or compared.

At Jaccard 0.85 a pair shares no band with probability 4e-7, and the sketch, cut
four deviations below it, drops one with probability 2e-5.

Nulls: a null text has no words. Rows with a null ``doc_id`` take part by
their text; they get the smallest non-null id of their component, or null.
Repeated rows stay repeated. Columns other than ``doc_id`` and ``text`` are
ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.components import connected_components, stored
from strata.llm.words import hash_words, mix64, released, runs, seeds, text_buffers

SHINGLE = 5
_U = np.uint64
_SHINGLE = seeds(SHINGLE, 1000) | _U(1)
_DIGEST = seeds(2, 7000)
SETS = "digest binary, shingles array<long>"


def shingle_sets(hashes: np.ndarray, counts: np.ndarray):
    """Distinct shingle hashes of each text, one text after another, and the
    size of each set. ``hashes``: word hashes of all texts."""
    stops = np.cumsum(counts)
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(len(hashes) - SHINGLE + 1, 0), dtype=_U)
        for i in range(SHINGLE):
            rolled += hashes[i:i + len(rolled)] * _SHINGLE[i]
        rolled = mix64(rolled)
        sets = []
        for stop, n in zip(stops, counts, strict=True):
            if n >= SHINGLE:
                sets.append(np.unique(rolled[stop - n:stop - SHINGLE + 1]))
            elif n:
                short = (hashes[stop - n:stop] * _SHINGLE[:n]).sum(dtype=_U) + _U(n)
                sets.append(mix64(np.array([short], dtype=_U)))
            else:
                sets.append(hashes[:0])
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    return (np.concatenate(sets) if sets else hashes[:0]), sizes


def digests(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """128-bit digest of each non-empty set, as rows of two words."""
    with np.errstate(over="ignore"):
        return np.stack([np.add.reduceat(mix64(flat ^ s), starts) for s in _DIGEST], axis=1)


class Scheme:
    """Sizes of the bands and the odd sketch, and the similarity sought."""

    def __init__(self, rows: int, bands: int, samples: int, bits: int, floor: float, percent: int):
        self.rows, self.bands, self.samples, self.bits, self.percent = rows, bands, samples, bits, percent
        self.lanes = [f"s{i}" for i in range(bits // 64)]
        #: Bits in which sketches of similarity ``floor`` differ on average.
        self.most = int(bits / 2 * (1 - math.exp(-4 * samples * (1 - floor) / bits)))

    def sketches(self, flat: np.ndarray, starts: np.ndarray):
        """Band keys and odd sketches (as 64-bit lanes), a row per non-empty set."""
        n, k = len(starts), self.rows * self.bands
        mul, add = seeds(k, 2000) | _U(1), seeds(k, 3000)
        mul32 = (seeds(self.samples, 10_000) | _U(1)).astype(np.uint32)
        add32, bit = seeds(self.samples, 11_000).astype(np.uint32), seeds(self.samples, 12_000)
        place = seeds(self.rows, 6000) | _U(1)
        bands = np.zeros((n, self.bands), dtype=_U)
        flips = np.empty((n, self.samples), dtype=np.int64)
        rows = np.arange(n, dtype=np.int64) * self.bits
        short = (flat >> _U(32)).astype(np.uint32)
        shift = _U(64 - int(math.log2(self.bits)))
        with np.errstate(over="ignore"):
            for i in range(k):
                low = np.minimum.reduceat(flat * mul[i] + add[i], starts)
                bands[:, i // self.rows] += mix64(low) * place[i % self.rows]
            bands = mix64(bands + seeds(self.bands, 5000))
            for i in range(self.samples):
                low = np.minimum.reduceat(short * mul32[i] + add32[i], starts).astype(_U)
                flips[:, i] = rows + (mix64(low ^ bit[i]) >> shift).astype(np.int64)
        parity = np.bincount(flips.ravel(), minlength=n * self.bits) & 1
        return bands, np.packbits(parity.astype(np.uint8).reshape(n, -1), axis=1).view(np.int64)

    def similar(self, a: str, b: str) -> str:
        """Condition that sizes and sketches of two sides allow the similarity."""
        differ = " + ".join(f"bit_count({a}.{s} ^ {b}.{s})" for s in self.lanes)
        return (f"100 * least({a}.n, {b}.n) >= {self.percent} * greatest({a}.n, {b}.n) "
                f"AND {differ} <= {self.most}")


#: At Jaccard 0.85 no band is shared with probability 4e-7; the sketch cuts
#: four deviations below it.
DOCUMENTS = Scheme(rows=5, bands=25, samples=512, bits=1024, floor=0.77, percent=85)


def _binary(rows: np.ndarray, present: np.ndarray) -> pa.Array:
    """16-byte values where ``present``, else null."""
    out = np.full(len(present), None, dtype=object)
    data = rows.tobytes()
    out[present] = [data[16 * i:16 * i + 16] for i in range(len(rows))]
    return pa.array(out, type=pa.binary())


def _lists(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def _text_sets(batch, column: int):
    data, offsets = text_buffers(batch.column(column))
    for i, j in runs(offsets):
        hashes, _, _, counts = hash_words(data, offsets[i:j + 1])
        flat, sizes = shingle_sets(hashes, counts)
        some = sizes > 0
        yield i, j, flat, sizes, some, (np.cumsum(sizes) - sizes)[some]


def _features(batches):
    for batch in released(batches):
        for i, j, flat, sizes, some, starts in _text_sets(batch, 2):
            n = len(sizes)
            bands = np.zeros((0, DOCUMENTS.bands), dtype=_U)
            sketch = np.zeros((n, len(DOCUMENTS.lanes)), dtype=np.int64)
            digest = np.zeros((0, 2), dtype=_U)
            if some.any():
                digest = digests(flat, starts)
                bands, sketch[some] = DOCUMENTS.sketches(flat, starts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(sizes), _binary(digest, some),
                 _lists(bands.ravel(), np.where(some, DOCUMENTS.bands, 0))]
                + [pa.array(sketch[:, k]) for k in range(len(DOCUMENTS.lanes))],
                names=["doc_id", "text_hash", "n", "digest", "bands", *DOCUMENTS.lanes])


FEATURES = ("doc_id long, text_hash long, n long, digest binary, bands array<long>, "
            + ", ".join(f"{lane} long" for lane in DOCUMENTS.lanes))


def _sets(batches):
    for batch in released(batches):
        for _, _, flat, sizes, some, starts in _text_sets(batch, 0):
            if some.any():
                yield pa.RecordBatch.from_arrays(
                    [_binary(digests(flat, starts), np.ones(int(some.sum()), dtype=bool)),
                     _lists(flat, sizes[some])], names=["digest", "shingles"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` whose ``sets`` (``digest, shingles``) reach ``percent``."""
    sets = stored(sets, "sets")
    first = pairs.join(sets.select(F.col("digest").alias("a"), F.col("shingles").alias("set_a")), "a")
    both = first.join(sets.select(F.col("digest").alias("b"), F.col("shingles").alias("set_b")), "b")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    total = F.size("set_a") + F.size("set_b") - shared
    return both.filter(100 * shared >= percent * total).select("a", "b")


def one_text_each(classes: DataFrame, wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """Texts that hold the ``wanted`` classes: those of each class's ``doc_id``,
    and all without an id."""
    ids = classes.join(wanted, "digest", "left_semi").select("doc_id").filter("doc_id IS NOT NULL").distinct()
    return (docs.join(ids, "doc_id", "left_semi").select("text")
            .union(docs.filter("doc_id IS NULL").select("text")))


def linked_classes(classes: DataFrame, scheme: Scheme, sets_of) -> DataFrame:
    """``(node, root)`` of all classes with a link. ``classes``: ``digest, n,
    bands`` and the sketch lanes; ``sets_of(wanted)`` gives the full sets of the
    classes in ``wanted``."""
    members = classes.filter("bands IS NOT NULL").select("digest", F.posexplode("bands").alias("band_no", "key"))
    sizes = members.groupBy("band_no", "key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = stored(members.join(sizes, ["band_no", "key"]), "members")
    weight = members.groupBy("digest").agg(F.sum("size").alias("weight"))
    stars = (members.join(weight, "digest").groupBy("band_no", "key")
             .agg(F.max(F.struct("weight", "digest")).alias("star"))
             .select("band_no", "key", F.col("star.digest").alias("star")))
    members = stored(members.drop("size").join(stars, ["band_no", "key"]), "members")
    facts = classes.select("digest", "n", "bands", *scheme.lanes)

    def links_among(pairs: DataFrame) -> DataFrame:
        pairs = stored(pairs, "pairs")
        wanted = pairs.select(F.col("a").alias("digest")).union(pairs.select("b")).distinct()
        return confirmed(pairs, sets_of(wanted), scheme.percent)

    links = stored(links_among(
        members.filter("digest <> star")
        .select(F.col("digest").alias("a"), F.col("star").alias("b")).distinct()
        .join(facts.alias("x"), F.expr("a = x.digest"))
        .join(facts.alias("y"), F.expr("b = y.digest"))
        .filter(scheme.similar("x", "y")).select("a", "b")), "confirmed")
    roots = connected_components(links)

    labelled = (members.join(roots.withColumnRenamed("node", "digest"), "digest", "left")
                .withColumn("comp", F.coalesce("root", "digest")).drop("root"))
    star_comp = roots.select(F.col("node").alias("star"), F.col("root").alias("star_root"))
    rest = stored(labelled.join(star_comp, "star", "left")
                  .filter("comp <> coalesce(star_root, star)").drop("star_root")
                  .join(facts, "digest"), "rest")
    if rest.isEmpty():
        return roots
    open_bands = rest.select("band_no", "key").distinct()
    others = labelled.join(open_bands, ["band_no", "key"], "left_semi").join(facts, "digest")
    # A pair counts in the first band it shares only.
    once = "array_position(zip_with(x.bands, y.bands, (p, q) -> p = q), true) = x.band_no + 1"
    more = (rest.alias("x").join(
        others.alias("y"),
        F.expr("x.band_no = y.band_no AND x.key = y.key AND x.comp <> y.comp "
               f"AND y.digest <> x.star AND {scheme.similar('x', 'y')} AND {once}"))
        .select(F.greatest("x.digest", "y.digest").alias("a"),
                F.least("x.digest", "y.digest").alias("b")).distinct())
    return connected_components(stored(links.union(links_among(more)), "confirmed"))


def clustered(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, n, cluster, component_id)`` for every row of
    ``docs``. ``cluster`` names the component, null for a row without words;
    ``component_id`` is its smallest ``doc_id``, or the row's own."""
    docs = docs.select("doc_id", "text")
    features = stored(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
                      .mapInArrow(_features, FEATURES), "features")
    classes = stored(
        features.filter("n > 0").groupBy("digest").agg(
            F.min("doc_id").alias("doc_id"),
            *(F.first(c).alias(c) for c in ("n", "bands", *DOCUMENTS.lanes))), "classes")

    def sets_of(wanted: DataFrame) -> DataFrame:
        texts = one_text_each(classes, wanted, docs)
        return (texts.mapInArrow(_sets, SETS).join(wanted, "digest", "left_semi")
                .groupBy("digest").agg(F.first("shingles").alias("shingles")))

    roots = linked_classes(classes, DOCUMENTS, sets_of)
    linked = stored(roots.withColumnRenamed("node", "digest").join(classes.select("digest", "doc_id"), "digest"),
                    "linked")
    smallest = linked.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_digest = (classes.select("digest", F.col("doc_id").alias("own"))
                 .join(linked.select("digest", "root").join(smallest, "root"), "digest", "left")
                 .select("digest", F.coalesce("root", "digest").alias("cluster"),
                         F.coalesce("component_id", "own").alias("smallest")))
    joined = features.select("doc_id", "text_hash", "n", "digest").join(by_digest, "digest", "left")
    component = F.when(F.col("cluster").isNull(), F.col("doc_id")).otherwise(F.col("smallest"))
    return joined.select("doc_id", "text_hash", "n", "cluster", component.alias("component_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` that links reach, ``kept`` says
    whether it is the row's own. See the module text for nulls and ties.
    """
    return clustered(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                                  F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: the smallest ``doc_id`` (nulls
    last), one row if that repeats. Rows without words all stay."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                       F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"),
                       F.xxhash64("text").alias("text_hash"),
                       F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False)).alias("has_words"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"),
                           "text_hash")).alias("first")
    chosen = clustered(docs).filter("cluster IS NOT NULL").groupBy("cluster").agg(first).select("first.*")
    keys = ["no_id", "id", "text_hash"]
    kept = rows.filter("has_words").join(chosen, keys).groupBy(keys).agg(F.first("row").alias("row"))
    return kept.select("row.*").union(rows.filter("NOT has_words").select("row.*"))
