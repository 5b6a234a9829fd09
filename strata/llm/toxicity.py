"""Toxicity by maximum-scoring segments.

1. Every word gets the log-odds of standing in toxic against clean labelled
   documents, with a Dirichlet prior (``ALPHA`` for each word and ``PRIOR`` of
   its own count on both sides), one standard deviation nearer to zero. Words
   whose log-odds are within ``MIN_Z`` deviations or score within ``MIN_SCORE``
   of zero (which words of a language with more or fewer toxic documents do)
   count as neutral, as do all others: they cost ``DRIFT``.
2. One linear scan over every occurrence finds all maximal-scoring segments of a
   text, so a later passage is found whatever words stood before it.
3. Scores of such segments in clean text follow an extreme-value law with the
   parameters ``rate`` and ``K``, both fitted to the best segments of clean
   documents (with few of them, ``rate`` is the root of
   ``E[exp(rate * score)] = 1``): a segment of score S has the E-value
   ``K n exp(-rate S)`` in ``n`` words. Passages with an E-value of at most
   ``MAX_E`` are reported.
4. Odds count documents, so repeats say less: in a document's evidence a segment
   counts each of its words once. The evidence is the log of the sum of
   ``exp(rate s) / (K n)`` over the segments' scores s of that kind, turned into
   a probability by a logistic curve.

The model is fitted on about ``ROWS_PER_CLASS`` labelled rows of each class,
chosen by a hash of the id. The curve and ``K`` are fitted on scores of rows
that the words' log-odds had not seen (``FOLDS`` folds). Every word scores whose
log-odds are significant and that stands in ``WORD_SHARE`` of its class's rows, two
at least; no number of words is set.

Defined cases: null and empty texts have no segment and get the share of toxic
rows among such; without labels of both classes that share is the score of
every row (0 without any). A document labelled more than once is toxic if any
label says so; null labels and labels without a document teach nothing.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.components import stored
from strata.llm.words import released

ROWS_PER_CLASS = 20_000
FOLDS = 5
ALPHA, PRIOR = 0.5, 0.01
MIN_Z, MIN_SCORE = 2.5, 1.5
DRIFT = 0.15
MAX_E = 0.05
#: Share of a class's sampled rows that a word of its sign stands in.
WORD_SHARE = 1e-4
#: Clean documents with a segment from which ``rate`` is fitted.
MIN_TOPS = 20

_WORD = re.compile(r"[^\W\d_]+")
_SLICE = 1 << 20
_HELD = 400_000


def word_slices(text: str):
    """Lists of the lower-case words of ``text``, over about a megabyte each."""
    at = 0
    while at < len(text):
        end = at + _SLICE
        while end < len(text) and text[end].isalnum():
            end += 1
        yield _WORD.findall(text[at:end].lower())
        at = end


def maximal_segments(places: list[int], scores: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments ``(first place, last place, score)`` of a
    sequence that scores ``scores`` at ``places`` and ``-drift`` elsewhere, in
    one pass (Ruzzo and Tompa). ``left`` and ``right`` are running sums before
    and after a segment."""
    found: list[list] = []  # [first, last, left, right]
    total, at = 0.0, -1
    for place, score in zip(places, scores, strict=True):
        total -= drift * (place - at - 1)
        if score <= 0:
            total, at = total + score, place
            continue
        segment = [place, place, total, total + score]
        total, at = total + score, place
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= segment[2]:
                j -= 1
            if j < 0 or found[j][3] >= segment[3]:
                found.append(segment)
                break
            segment = [found[j][0], segment[1], found[j][2], segment[3]]
            del found[j:]
    return [(a, b, right - left) for a, b, left, right in found]


def scores_once(segments: list[tuple[int, int, float]], places: list[int], words: list[str], known: dict[str, float],
                drift: float) -> list[float]:
    """Score of each segment with every word counted once (at least that of its
    best word). ``words`` stand at ``places``; both in order, as ``segments``."""
    found, at = [], 0
    for a, b, _ in segments:
        while places[at] < a:
            at += 1
        first = at
        while at < len(places) and places[at] <= b:
            at += 1
        scores = [known[w] for w in set(words[first:at])]
        found.append(max(math.fsum(scores) - drift * (b - a + 1 - (at - first)), max(scores)))
    return found


def extreme_value_law(n: np.ndarray, tops: np.ndarray) -> tuple[float, float] | None:
    """Maximum-likelihood ``(rate, log K)`` of ``P(top < s) = exp(-K n exp(-rate s))``
    from texts of ``n`` words with these best scores (0: none above the least one
    possible); None with too few to tell."""
    some = tops > 0
    if some.sum() < MIN_TOPS:
        return None
    floored = np.maximum(tops, MIN_SCORE)
    best = (-math.inf, 0.0, 0.0)
    for rate in np.geomspace(0.02, 8, 200):
        log_k = math.log(some.sum() / float((n * np.exp(-rate * floored)).sum()))
        likelihood = some.sum() * (log_k + math.log(rate)) - rate * tops[some].sum()
        best = max(best, (likelihood, float(rate), log_k))
    return best[1], best[2]


class Model:
    """Word scores and the extreme-value law of segment scores."""

    def __init__(self, words: dict[str, float], background: dict[str, float]):
        self.words = words
        self.rate = self._rate(np.array(list(words.values())), np.array([background[w] for w in words]))
        self.log_k = 0.0
        self.curve = (0.0, 0.0, 0.0)  # without a segment; with one; per unit of evidence

    @staticmethod
    def _rate(scores: np.ndarray, shares: np.ndarray) -> float:
        """Positive root of ``E[exp(rate * score)] = 1``."""
        if not len(scores):
            return 1.0
        rest = max(1.0 - shares.sum(), 1e-9)
        excess = lambda r: float((shares * np.exp(np.minimum(r * scores, 700))).sum()) + rest * math.exp(-r * DRIFT) - 1
        low, high = 0.0, 1.0
        while excess(high) < 0 and high < 64:
            high *= 2
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if excess(middle) < 0 else (low, middle)
        return max(high, 1e-3)

    def segments(self, text: str | None) -> tuple[int, list[tuple[int, int, float]], list[float]]:
        """Number of words, the segments of a text, and their scores with every
        word counted once."""
        known, n, places, used = self.words, 0, [], []
        for words in word_slices(text or ""):
            for i, w in enumerate(words, n):
                if w in known:
                    places.append(i)
                    used.append(w)
            n += len(words)
        found = maximal_segments(places, [known[w] for w in used], DRIFT)
        return n, found, scores_once(found, places, used, known, DRIFT)

    def evidence(self, n: int, once: list[float]) -> float | None:
        """Log of the summed ``exp(rate s) / n`` (``K`` aside); None without a segment."""
        if not len(once):
            return None
        exponents = self.rate * np.array(once)
        top = exponents.max()
        return float(top + np.log(np.exp(exponents - top).sum()) - math.log(max(n, 1)))

    def score(self, evidence: float | None) -> float:
        none, some, slope = self.curve
        x = none if evidence is None else some + slope * (evidence - self.log_k)
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, x))))

    def passages(self, n: int, segments: list[tuple[int, int, float]]) -> list[dict]:
        """The significant segments as word ranges with score and E-value."""
        rows = [{"first_word": a, "last_word": b, "score": s,
                 "e_value": math.exp(min(700.0, self.log_k + math.log(max(n, 1)) - self.rate * s))} for a, b, s in segments]
        return [r for r in rows if r["e_value"] <= MAX_E]


def _presence(batches):
    """Rows (fold, toxic, word, n): documents that hold a word; word null counts
    documents, the empty word the distinct words of all."""
    held: Counter = Counter()

    def flush():
        keys = list(held)
        out = pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], type=pa.int32()), pa.array([k[1] for k in keys], type=pa.int32()),
             pa.array([k[2] for k in keys], type=pa.string()), pa.array([held[k] for k in keys], type=pa.int64())],
            names=["fold", "toxic", "word", "n"])
        held.clear()
        return out

    for batch in released(batches):
        for fold, toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            words: set[str] = set()
            for some in word_slices(text.as_py() or ""):
                words.update(some)
            held.update((fold, toxic, w) for w in words)
            held[fold, toxic, ""] += len(words)
            if len(held) > _HELD:
                yield flush()
    yield flush()


def _model(tox: np.ndarray, clean: np.ndarray, words: list[str], n_tox: float, n_clean: float) -> Model:
    """Model from the documents that hold each word, by class."""
    if not words or not n_tox or not n_clean:
        return Model({}, {})
    prior = ALPHA + PRIOR * (tox + clean)
    odds = np.log(tox + prior) - np.log(n_tox) - np.log(clean + prior) + np.log(n_clean)
    spread = np.sqrt(1 / (tox + prior) + 1 / (clean + prior))
    scores = np.sign(odds) * (np.abs(odds) - spread)
    use = (np.abs(odds) >= MIN_Z * spread) & (np.abs(odds) - spread >= MIN_SCORE) & ((odds < 0) | (tox > 0))
    share = (clean + prior) / n_clean
    picked = np.flatnonzero(use)
    return Model({words[i]: float(scores[i]) for i in picked}, {words[i]: float(share[i]) for i in picked})


def _held_out_scores(models, batches):
    for batch in released(batches):
        rows = []
        for fold, toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            n, segments, once = models[fold].segments(text.as_py())
            rows.append((toxic, n, max((s for _, _, s in segments), default=0.0), once))
        columns = list(zip(*rows, strict=True)) or [()] * 4
        kinds = [pa.int32(), pa.int64(), pa.float64(), pa.list_(pa.float64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)],
                                         names=["toxic", "n", "top", "once"])


def _curve(toxic: np.ndarray, evidence: np.ndarray) -> tuple[float, float, float]:
    """Logistic curve with a level of its own for documents without a segment
    (``evidence`` NaN), by Newton steps with a slight ridge."""
    none = np.isnan(evidence)
    x = np.stack([none, ~none, np.where(none, 0.0, evidence)], axis=1).astype(float)
    weights, ridge = np.zeros(3), np.diag([1e-2, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (toxic - p) - ridge @ weights)
        weights = weights + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    weights[2] = max(weights[2], 0.0)
    return tuple(float(w) for w in weights)


def fitted(docs: DataFrame, labels: DataFrame, teach: Column) -> Model:
    """Model from the rows of ``docs`` (``doc_id, text``) that ``labels``
    (``doc_id, toxic``) cover and for which ``teach`` holds."""
    known = (labels.select("doc_id", "toxic").filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(teach)
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).filter("toxic IN (0, 1)").collect()}
    ticket = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 30))
    share = {k: min(1 << 30, math.ceil((1 << 30) * ROWS_PER_CLASS / n)) for k, n in sizes.items()}
    bound = F.when(F.col("toxic") == 1, F.lit(share.get(1, 0))).when(F.col("toxic") == 0, F.lit(share.get(0, 0)))
    chosen = known.filter(ticket < bound).withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int"))
    # About ROWS_PER_CLASS ids of each class: small enough for every task.
    sample = stored(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("fold", "toxic", "text"), "sample")
    counts = stored(sample.mapInArrow(_presence, "fold int, toxic int, word string, n long")
                    .groupBy("fold", "toxic", "word").agg(F.sum("n").alias("n")), "presence")
    totals = np.zeros((FOLDS, 2))
    for r in counts.filter("word = ''").collect():
        totals[r.fold, r.toxic] = r.n
    n_clean, n_tox = totals.sum(axis=0)
    if not n_clean or not n_tox:
        only = Model({}, {})
        rows = sizes.get(0, 0) + sizes.get(1, 0)
        only.curve = (math.log((sizes.get(1, 0) + 1e-9) / (sizes.get(0, 0) + 1e-9)) if rows else -700.0, 0.0, 0.0)
        return only
    tox, clean = F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0))
    words = counts.filter("word <> ''").groupBy("word").agg(tox.alias("t"), clean.alias("c")).filter("t > 1 OR c > 1")
    a, b = (F.col(k) + ALPHA + PRIOR * (F.col("t") + F.col("c")) for k in ("t", "c"))
    z = (F.log(a) - F.log(b) + math.log(n_clean / n_tox)) / F.sqrt(1 / a + 1 / b)
    words = words.withColumn("z", z)
    toxic = (F.col("z") >= MIN_Z) & (F.col("t") >= max(2.0, WORD_SHARE * n_tox))
    screened = words.filter(toxic | ((F.col("z") <= -MIN_Z) & (F.col("c") >= max(2.0, WORD_SHARE * n_clean)))).select("word")
    table: dict[str, np.ndarray] = {}
    for r in counts.join(F.broadcast(screened), "word").collect():
        table.setdefault(r.word, np.zeros((FOLDS, 2)))[r.fold, r.toxic] = r.n
    names = sorted(table)
    each = np.stack([table[w] for w in names]) if names else np.zeros((0, FOLDS, 2))
    whole = each.sum(axis=1)

    folds = []
    for k in range(FOLDS):
        rest = whole - each[:, k]
        folds.append(_model(rest[:, 1], rest[:, 0], names, n_tox - totals[k, 1], n_clean - totals[k, 0]))
    unseen = sample.mapInArrow(lambda batches: _held_out_scores(folds, batches),
                               "toxic int, n long, top double, once array<double>").toPandas()
    model = _model(whole[:, 1], whole[:, 0], names, n_tox, n_clean)
    background = unseen[(unseen.toxic == 0) & (unseen.n > 0)]
    law = extreme_value_law(background.n.to_numpy(dtype=float), background.top.to_numpy(dtype=float))
    if law:
        model.rate, model.log_k = law
    elif len(background):
        # Maximum-likelihood K of P(max < s) = exp(-K n exp(-rate s)).
        model.log_k = math.log(len(background) / float((background.n * np.exp(-model.rate * background.top)).sum()))
    found = [model.evidence(n, once) for n, once in zip(unseen.n, unseen.once, strict=True)]
    evidence = np.array([np.nan if e is None else e for e in found], dtype=float) - model.log_k
    model.curve = _curve(unseen.toxic.to_numpy(dtype=float), evidence)
    return model


def _scored(model: Model, batches):
    passage = pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()),
                                  ("score", pa.float64()), ("e_value", pa.float64())]))
    for batch in released(batches):
        scores, found = [], []
        for text in batch.column(2):
            n, segments, once = model.segments(text.as_py())
            scores.append(model.score(model.evidence(n, once)))
            found.append(model.passages(n, segments))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(scores, type=pa.float64()), pa.array(found, type=passage)],
            names=["doc_id", "held_out", "score", "passages"])


def scored(docs: DataFrame, model: Model, held_out: Column) -> DataFrame:
    """``(doc_id, held_out, score, passages)`` for every row of ``docs``;
    ``passages`` are the significant segments, as word ranges."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return rows.mapInArrow(
        lambda batches: _scored(shared.value, batches),
        "doc_id long, held_out boolean, score double, passages array<struct<first_word:long,last_word:long,"
        "score:double,e_value:double>>")
