"""Language identification: known words first, then ever shorter n-grams.

Words are lower-cased runs of ASCII letters and of characters beyond ASCII. A
word that makes up ``WORD_SHARE`` of some language or more scores by its log
frequency in every language; any other word scores by the mean log frequency of
its n-grams (word ends marked), of the longest length from ``LONGEST`` down of
which the model knows one (``GRAM_SHARE`` of some language's n-grams of that
length). A document's score is the sum over its words plus the log share of the
language; the softmax of these sums is the score of the prediction.

The model is fitted on a sample of labelled rows, about ``ROWS_PER_LANGUAGE`` of
each language chosen by a hash of the id (of the text where that is null), so
its cost does not grow with the input. What is known follows from frequency
alone; no language can have more than ``1 / share`` entries of a kind, which
bounds the model by the number of languages. Words are counted once; n-grams
are counted from the distinct words and their counts.

Texts are read in slices of ``SLICE`` bytes, as words' hashes; a worker keeps the
scores of words that it has met, so each distinct word is looked at once.

Defined cases: null, empty and letterless texts are ``und`` with score 0; so is
every text when no row is labelled. Rows with a null ``lang`` or ``text`` teach
nothing; rows that repeat count as often. Equal scores go to the language first
in code point order. Extra columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.components import stored
from strata.llm.words import hash_words, parts, released, text_buffers

ROWS_PER_LANGUAGE = 20_000
WORD_SHARE, GRAM_SHARE = 2e-5, 1e-4
LONGEST = 4
SMOOTHING = 0.5
UNKNOWN = "und"
SLICE = 1 << 20
#: Scores of words that a worker keeps, in numbers.
MEMO = 20_000_000

#: Bytes between words: all ASCII but letters.
_BETWEEN = np.zeros(256, dtype=bool)
_BETWEEN[:128] = True
_BETWEEN[65:91] = _BETWEEN[97:123] = False


def _lowered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a lower-cased string column."""
    return text_buffers(pc.utf8_lower(column))


def _grams(word: str, n: int) -> list[str]:
    marked = f" {word} "
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def _counts(batches):
    """Rows ``(lang, word, n)``."""
    for batch in released(batches):
        langs = batch.column(0).dictionary_encode()
        codes, names = langs.indices.to_numpy(), langs.dictionary.to_pylist()
        data, offsets = _lowered(batch.column(1))
        for first, group in parts(data, offsets, SLICE, _BETWEEN):
            hashes, starts, ends, counts = hash_words(data, group, lower=False, separators=_BETWEEN)
            if not len(hashes):
                continue
            of = np.repeat(codes[first:first + len(counts)], counts)
            order = np.lexsort((hashes, of))
            new = np.ones(len(order), dtype=bool)
            h, c = hashes[order], of[order]
            new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
            at = np.flatnonzero(new)
            chosen, n = order[at], np.diff(np.append(at, len(order)))
            words = [data[a:b].tobytes().decode() for a, b in zip(starts[chosen].tolist(), ends[chosen].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[k] for k in of[chosen].tolist()], type=pa.string()), pa.array(words, type=pa.string()),
                 pa.array(n, type=pa.int64())], names=["lang", "key", "n"])


class Model:
    """Log frequencies of words (kind 0) and n-grams (kind = their length).

    ``tables[kind]`` gives a key's row; row ``r`` holds, for the languages
    ``column[starts[r]:starts[r + 1]]``, the logs ``value[...]``, and a language
    beside them has the kind's floor."""

    def __init__(self, languages: list[str], prior: np.ndarray, tables: list[dict[str, int]], floors: list[np.ndarray],
                 starts: np.ndarray, column: np.ndarray, value: np.ndarray):
        self.languages, self.prior, self.tables, self.floors = languages, prior, tables, floors
        self.starts, self.column, self.value = starts, column, value
        self.forget()

    def forget(self) -> None:
        self.memo: dict[int, int] = {}
        self.rows = np.zeros((1024, len(self.languages)), dtype=np.float32)

    def row(self, kind: int, key: str) -> np.ndarray | None:
        at = self.tables[kind].get(key)
        if at is None:
            return None
        found = self.floors[kind].copy()
        span = slice(self.starts[at], self.starts[at + 1])
        found[self.column[span]] = self.value[span]
        return found

    def word(self, word: str) -> np.ndarray:
        found = self.row(0, word)
        if found is not None:
            return found
        for size in range(LONGEST, 0, -1):
            known = [r for r in (self.row(size, g) for g in _grams(word, size)) if r is not None]
            if known:
                return np.mean(known, axis=0)
        return self.floors[1]

    def scores_of(self, data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Rows of ``self.rows`` for the words of these hashes."""
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.memo) * max(len(self.languages), 1) > MEMO:
            self.forget()
        memo, keys = self.memo, distinct.tolist()
        for k, at in zip(keys, first.tolist(), strict=True):
            if k not in memo:
                if len(memo) == len(self.rows):
                    self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
                self.rows[len(memo)] = self.word(data[starts[at]:ends[at]].tobytes().decode())
                memo[k] = len(memo)
        return np.array([memo[k] for k in keys], dtype=np.int64)[back]

    def predict(self, texts: pa.Array) -> tuple[list[str], list[float]]:
        """Language and score of every text."""
        n, width = len(texts), len(self.languages)
        lettered = pc.fill_null(pc.match_substring_regex(texts, r"\pL"), False).to_numpy(zero_copy_only=False)
        if not width:
            return [UNKNOWN] * n, [0.0] * n
        data, offsets = _lowered(texts)
        totals = np.zeros((n, width))
        for first, group in parts(data, offsets, SLICE, _BETWEEN):
            hashes, starts, ends, counts = hash_words(data, group, lower=False, separators=_BETWEEN)
            if not len(hashes):
                continue
            rows = self.scores_of(data, hashes, starts, ends)
            some = np.flatnonzero(counts)
            begins = (np.cumsum(counts) - counts)[some]
            for k in range(width):
                scores = self.rows[rows, k].astype(np.float64)
                totals[first + some, k] += np.add.reduceat(scores, begins)
        totals += self.prior
        best = totals.argmax(axis=1)
        share = 1.0 / np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
        names = [self.languages[b] if yes else UNKNOWN for b, yes in zip(best.tolist(), lettered.tolist(), strict=True)]
        return names, np.where(lettered, share, 0.0).tolist()


def sample(docs: DataFrame, teach: Column) -> tuple[DataFrame, list[tuple[str, int]]]:
    """Rows ``(lang, text)`` to learn from, and the number of labelled rows of each language."""
    rows = docs.select("doc_id", "lang", "text", teach.alias("teach")).filter(
        "teach AND lang IS NOT NULL AND text IS NOT NULL")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    found = sorted((r.lang, r.rows) for r in sizes.collect())
    own = F.coalesce(F.col("doc_id"), F.xxhash64("text"))
    ticket = F.pmod(F.xxhash64(own, F.lit("language")), F.lit(1 << 30))
    shares = docs.sparkSession.createDataFrame(
        [(lang, min(1 << 30, math.ceil((1 << 30) * ROWS_PER_LANGUAGE / n))) for lang, n in found], "lang string, share long")
    return rows.join(F.broadcast(shares), "lang").filter(ticket < F.col("share")).select("lang", "text"), found


def counted(rows: DataFrame) -> DataFrame:
    """``(lang, kind, key, n)``: words (kind 0) and n-grams of rows ``(lang, text)``."""
    words = stored(rows.mapInArrow(_counts, "lang string, key string, n long")
                   .groupBy("lang", "key").agg(F.sum("n").alias("n")), "language-words")
    marked = F.concat(F.lit(" "), "key", F.lit(" "))

    def of_length(size):
        cut = F.transform(F.sequence(F.lit(1), F.length(marked) - size + 1),
                          lambda i: F.struct(F.lit(size).alias("kind"), F.substring(marked, i, F.lit(size)).alias("key")))
        return F.when(F.length(marked) >= size, cut).otherwise(F.expr("cast(array() as array<struct<kind:int,key:string>>)"))

    grams = [of_length(size) for size in range(1, LONGEST + 1)]
    grams = (words.select("lang", "n", F.explode(F.flatten(F.array(*grams))).alias("gram"))
             .groupBy("lang", "gram.kind", "gram.key").agg(F.sum("n").alias("n")))
    return words.select("lang", F.lit(0).alias("kind"), "key", "n").unionByName(grams)


def fitted(docs: DataFrame, teach: Column) -> Model:
    """Model from the rows of ``docs`` (``doc_id, lang, text``) where ``teach``
    holds."""
    rows, found = sample(docs, teach)
    if not found:
        return Model([], np.zeros(0), [{} for _ in range(LONGEST + 1)], [np.zeros(0)] * (LONGEST + 1),
                     np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))
    counts = stored(counted(rows), "language-counts")
    totals = counts.groupBy("lang", "kind").agg(F.sum("n").alias("total")).collect()
    spark = docs.sparkSession
    known = spark.createDataFrame(
        [(r.lang, r.kind, r.total * (GRAM_SHARE if r.kind else WORD_SHARE)) for r in totals], "lang string, kind int, least double")
    keys = counts.join(F.broadcast(known), ["lang", "kind"]).filter("n >= least").select("kind", "key").distinct()
    kept = counts.join(keys, ["kind", "key"]).orderBy("kind", "key", "lang").toArrow()

    languages = [lang for lang, _ in found]
    place = {lang: i for i, lang in enumerate(languages)}
    sums = np.zeros((LONGEST + 1, len(languages)))
    for r in totals:
        sums[r.kind, place[r.lang]] = r.total
    tables: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
    kinds, names = kept["kind"].to_numpy(), kept["key"].to_pylist()
    starts = []
    for at, (kind, key) in enumerate(zip(kinds.tolist(), names, strict=True)):
        if key not in tables[kind]:
            tables[kind][key] = len(starts)
            starts.append(at)
    column = np.array([place[x] for x in kept["lang"].to_pylist()], dtype=np.int64)
    bases = np.array([np.log(sums[k] + SMOOTHING * (len(t) + 1)) for k, t in enumerate(tables)])
    value = np.log(kept["n"].to_numpy() + SMOOTHING) - bases[kinds, column]
    floors = [(math.log(SMOOTHING) - b).astype(np.float32) for b in bases]
    rows_of = np.array([n for _, n in found], dtype=float)
    return Model(languages, np.log(rows_of / rows_of.sum()), tables, floors,
                 np.array([*starts, len(names)], dtype=np.int64), column, value.astype(np.float32))


def _predicted(model: Model, batches):
    for batch in released(batches):
        names, scores = model.predict(batch.column(2))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(names, type=pa.string()), pa.array(scores, type=pa.float64())],
            names=["doc_id", "held_out", "lang_pred", "score"])


def identified(docs: DataFrame, model: Model, held_out: Column) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return rows.mapInArrow(lambda batches: _predicted(shared.value, batches),
                           "doc_id long, held_out boolean, lang_pred string, score double")
