"""Quality rules: base counts and divergence from language references.

Base rules fail a document with fewer than 50 words, or with more than half of
its words in 3-word windows that occur twice or more in it. The others are
compared with a reference of their language, learned from all documents:

* characters fall into classes (letters by case, digits, punctuation, ...);
* words fall into the language's common words (each at least ``COMMON_SHARE``
  of its words, so 250 at most) and the rest.

Both comparisons use the Jensen-Shannon distance (base 2, 0 to 1). A short
text differs from its reference by chance, by about ``(k - 1) / (8 n ln 2)``
in divergence for ``k`` bins and ``n`` draws of the text, and as much for those
of the reference; the limits grow by twice that, and nothing under the minimum
length is compared.

Every language with ``LANGUAGE_WORDS`` words or more has a reference, however
large the rest of the corpus is, and all references are sent to every task: a
reference is 260 numbers at most and their number is that of the language
names, so a table of 5,000 languages is 10 MB. ``MAX_LANGUAGES`` names or more
are an error: such a column does not hold languages. A document is first held
against its own language; if that fails, or it names no language, the closest
of all references decides, at any size of the corpus. Where the language it
names has no reference, the base rules alone decide.

Nulls: a null text has no words and fails; a null ``lang`` has no reference of
its own and feeds none. Repeated rows get equal verdicts.
Extra columns are ignored, or kept by the filter; a text is judged whole, one at a
time; an empty table gives no row.
"""

from __future__ import annotations

import functools
import math
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.llm.components import stored
from strata.llm.words import hash_words, mix64, released, runs, seeds, SPACE, text_buffers

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
COMMON_SHARE = 0.004
LANGUAGE_WORDS = 1000
MAX_LANGUAGES = 20_000
#: Divergence (square of the distance) allowed beyond chance.
CLASS_DIVERGENCE, WORD_DIVERGENCE = 0.08, 0.04
#: Words are told apart by this many hash buckets when references are learned.
BUCKETS = 1 << 16
MAX_LANGUAGES_HELD = 64

_U = np.uint64
CLASSES = ("line end", "blank", "lower", "upper", "other letter", "digit", "symbol",
           "sentence mark", "other punctuation", "other")
_WINDOW = seeds(3, 8000) | _U(1)
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


@functools.cache
def _class_table() -> np.ndarray:
    """Class of every code point."""
    general = {"Ll": 2, "Lu": 3, "Lt": 3}
    groups = {"L": 4, "M": 4, "N": 5, "P": 8}
    table = np.empty(0x110000, dtype=np.uint8)
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))
        table[i] = general.get(kind) or groups.get(kind[0], 9)
    table[10] = 0
    table[[9, 11, 12, 13, 32]] = 1
    table[list(b"#*$%&|<>")] = 6
    table[list(b".,;:!?'\"()-")] = 7
    return table


def _classes(text: bytes) -> np.ndarray:
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    return np.bincount(_class_table()[points], minlength=len(CLASSES))


def _repeated_words(hashes: np.ndarray) -> int:
    """Words that lie in a 3-word window found twice or more."""
    if len(hashes) < 3:
        return 0
    with np.errstate(over="ignore"):
        windows = mix64(hashes[:-2] * _WINDOW[0] + hashes[1:-1] * _WINDOW[1] + hashes[2:] * _WINDOW[2])
    _, where, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[where] > 1
    covered = np.zeros(len(hashes), dtype=bool)
    for i in range(3):
        covered[i:i + len(again)] |= again
    return int(covered.sum())


def _base(text: bytes, hashes: np.ndarray) -> tuple[int, int, int, int, int]:
    """Word count and the four base counts of a text (see ``BASE``)."""
    data = np.frombuffer(text, dtype=np.uint8)
    word_chars = int((~SPACE[data] & ((data & 0xC0) != 0x80)).sum())
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (len(hashes), word_chars, int(_SYMBOLS[data].sum()), len(lines) - len(set(lines)),
            _repeated_words(hashes))


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _each_text(batch, column: int, lower: bool):
    """``(row, text bytes, word hashes)`` of every row."""
    data, offsets = text_buffers(batch.column(column))
    for i, j in runs(offsets):
        hashes, _, _, counts = hash_words(data, offsets[i:j + 1], lower)
        at = 0
        for k, n in enumerate(counts):
            yield i + k, data[offsets[i + k]:offsets[i + k + 1]].tobytes(), hashes[at:at + n]
            at += n


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _U(64 - 16)).astype(np.int64)


def _language_counts(batches):
    """Rows (lang, kind, bin, n) summed over a task; kind 0: character classes,
    1: word buckets. Held for a bounded number of languages at a time."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def flush():
        for lang, counts in held.items():
            for kind, n in enumerate(counts):
                bins = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(bins), type=pa.string()), pa.array(np.full(len(bins), kind, dtype=np.int32)),
                     pa.array(bins.astype(np.int32)), pa.array(n[bins])], names=["lang", "kind", "bin", "n"])
        held.clear()

    for batch in released(batches):
        langs = batch.column(0).to_pylist()
        for row, text, hashes in _each_text(batch, 1, True):
            if langs[row] not in held:
                if len(held) == MAX_LANGUAGES_HELD:
                    yield from flush()
                held[langs[row]] = (np.zeros(len(CLASSES), dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64))
            classes, words = held[langs[row]]
            classes += _classes(text)
            if len(hashes):
                words += np.bincount(_bucket(hashes), minlength=BUCKETS)
    yield from flush()


def _reference(words: int, bins) -> tuple:
    """Class shares, buckets of common words, their shares with that of all
    other words last, and the draws behind the classes and the words."""
    classes = np.zeros(len(CLASSES))
    for _, at, n in (b for b in bins if b[0] == 0):
        classes[at] = n
    common = sorted((at, n) for kind, at, n in bins if kind == 1)
    shares = np.array([n for _, n in common] + [0.0]) / words
    shares[-1] = 1 - shares.sum()
    return (classes / classes.sum(), np.array([b for b, _ in common], dtype=np.int64), shares, classes.sum(), words)


def language_references(docs: DataFrame) -> dict:
    """References by name of all languages with ``LANGUAGE_WORDS`` words or more,
    with ``1 / COMMON_SHARE`` common words each at most, by definition."""
    counts = (docs.select("lang", "text").filter("lang IS NOT NULL AND text IS NOT NULL")
              .mapInArrow(_language_counts, "lang string, kind int, bin int, n long")
              .groupBy("lang", "kind", "bin").agg(F.sum("n").alias("n")))
    counts = stored(counts, "languages")
    sizes = counts.filter("kind = 1").groupBy("lang").agg(F.sum("n").alias("words"))
    found = stored(counts.join(sizes.filter(F.col("words") >= LANGUAGE_WORDS), "lang")
                   .filter((F.col("kind") == 0) | (F.col("n") >= COMMON_SHARE * F.col("words")))
                   .groupBy("lang").agg(F.first("words").alias("words"),
                                        F.collect_list(F.struct("kind", "bin", "n")).alias("bins")), "references")
    if found.count() > MAX_LANGUAGES:
        raise ValueError(f"over {MAX_LANGUAGES} values of lang with {LANGUAGE_WORDS} words or more")
    return {r.lang: _reference(r.words, r.bins) for r in found.orderBy("lang").collect()}


def divergence(counts: np.ndarray, reference: np.ndarray) -> float:
    """Jensen-Shannon divergence in bits; its square root is the distance."""
    p = counts / counts.sum()
    middle = (p + reference) / 2
    a, b = p > 0, reference > 0
    return max(0.0, float((p[a] * np.log2(p[a] / middle[a])).sum()
                          + (reference[b] * np.log2(reference[b] / middle[b])).sum()) / 2)


def _excess(classes: np.ndarray, buckets: np.ndarray, reference) -> tuple[float, float, float]:
    """The two distances, and by how much the worse of them is over its limit."""
    class_ref, common, word_ref, n_classes, n_words = reference
    hit = buckets[:0]
    if len(common):
        at = np.minimum(np.searchsorted(common, buckets), len(common) - 1)
        hit = at[common[at] == buckets]
    words = np.bincount(hit, minlength=len(word_ref)).astype(float)
    words[-1] += len(buckets) - len(hit)
    chance = 2 / (8 * math.log(2))
    found = []
    for counts, ref, n, allowed in ((classes, class_ref, n_classes, CLASS_DIVERGENCE),
                                    (words, word_ref, n_words, WORD_DIVERGENCE)):
        limit = allowed + chance * (len(ref) - 1) * (1 / counts.sum() + 1 / n)
        found.append((math.sqrt(divergence(counts, ref)), math.sqrt(min(limit, 1.0))))
    (c, c_limit), (w, w_limit) = found
    return c, w, max(c - c_limit, w - w_limit)


SCHEMA = ("doc_id long, " + ", ".join(f"{c} long" for c in BASE)
          + ", base_failed boolean, class_distance double, word_distance double, kept boolean")


def _verdict_rows(references: dict, batch, lang: int, text: int) -> list[tuple]:
    """A tuple as in ``SCHEMA``, without ``doc_id``, for every row of a batch."""
    langs = batch.column(lang).to_pylist()
    rows = []
    for (row, content, hashes), (_, _, low) in zip(
            _each_text(batch, text, False), _each_text(batch, text, True), strict=True):
        base = _base(content, hashes)
        n, repeated = base[0], base[4]
        failed = n < MIN_WORDS or 100 * repeated > MAX_REPEATED_PERCENT * n
        c = w = None
        kept = not failed
        mine = references.get(langs[row])
        if kept and references:
            classes, buckets = _classes(content).astype(float), _bucket(low)
            best = _excess(classes, buckets, mine) if mine else None
            if not best or best[2] > 0:
                others = [_excess(classes, buckets, r) for r in references.values()]
                best = min([best, *others] if best else others, key=lambda x: x[2])
            c, w, over = best
            kept = over <= 0 or (mine is None and langs[row] is not None)
        rows.append((*base, failed, c, w, kept))
    return rows


def _verdicts(references, batches):
    kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
    for batch in released(batches):
        columns = list(zip(*_verdict_rows(references, batch, 1, 2), strict=True)) or [()] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0)] + [pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)],
            names=["doc_id", *BASE, "base_failed", "class_distance", "word_distance", "kept"])


def _passing(references, batches):
    for batch in released(batches):
        kept = [r[-1] for r in _verdict_rows(references, batch, 0, 1)]
        yield pa.RecordBatch.from_arrays([batch.column(2).filter(pa.array(kept, type=pa.bool_()))], names=["row"])


def _judged(rows: DataFrame, references: dict, task, schema) -> DataFrame:
    """``task(references, batches)`` over ``rows``."""
    shared = rows.sparkSession.sparkContext.broadcast(references)
    return rows.mapInArrow(lambda batches: task(shared.value, batches), schema)


def quality_filter(docs: DataFrame, references: dict | None = None) -> DataFrame:
    """The rows of ``docs`` that :func:`quality_verdicts` keeps, all columns."""
    if references is None:
        references = language_references(docs)
    rows = docs.select(F.col("lang"), F.col("text"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    return _judged(rows, references, _passing, StructType([rows.schema["row"]])).select("row.*")


def quality_verdicts(docs: DataFrame, references: dict | None = None) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, lang, text``): base counts, the
    two distances (null where the base rules failed) and ``kept``."""
    if references is None:
        references = language_references(docs)
    return _judged(docs.select("doc_id", "lang", "text"), references, _verdicts, SCHEMA)
