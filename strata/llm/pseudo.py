"""Masked pseudo-likelihood of documents under a bidirectional window network.

Every word is predicted from the ``SIDE`` words on either side of it, itself
masked: ``softmax(tanh(sum_p T_p[word at p] + b) W + c)``. A document's score is
the sum of the log-probabilities of its words.

Every word of the corpus is counted, and has a probability of its own: that of
its class given the neighbours, by the network, times the word's share of its
class, from counts over all documents. The vocabulary thus grows with the corpus
while the output layer and a task's memory stay fixed in size. Classes:

* the ``WORDS`` most frequent words are a class each;
* the other words over a frequency threshold, which leaves ``HEAD`` words at
  most, fall into ``BANDS`` classes of about equal count by frequency;
* words under it fall into ``TAILS`` classes by hash.

Words over the threshold are looked up in the task. The others of a document
meet their counts in a join, in which no word is frequent; their logarithms are
summed as integers, so equal texts score equally. A word that the corpus does not
hold counts as one more word, seen once, of its tail class.

Training covers every document once: documents are dealt into ``ROUNDS`` by a
hash of the id; in each round every task runs stochastic gradient descent in
numpy over its share, starting from the same weights, and the results are
averaged with the number of words as weight. The average is a Spark aggregation
over (weight number, value) rows, so what reaches the driver is one set of
weights however many tasks there are.

Nulls: null and empty texts have no words, a score of 0 and no mean. Repeated
rows are trained on as often as they stand there and score equally.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.components import stored
from strata.llm.words import hash_words, released, runs, text_buffers

SIDE = 2
WORDS, BANDS, TAILS = 104, 20, 4
HEAD = 1 << 17
HIDDEN = 16
ROUNDS = 3
BATCH = 1024
RATE = 0.8
SEED = 11

#: Classes.
VOCABULARY = WORDS + BANDS + TAILS
PAD = VOCABULARY
_SHAPES = ((2 * SIDE, VOCABULARY + 1, HIDDEN), (HIDDEN,), (HIDDEN, VOCABULARY), (VOCABULARY,))


#: Distinct words a task holds before it hands its counts on.
_HELD = 1 << 19
#: Logarithms are summed in units of this.
_UNIT = 2.0 ** -30


class Lookup(NamedTuple):
    """What a task knows of the words: hashes of the head in order, their
    classes and the logarithms of their shares of these."""
    head: np.ndarray
    classes: np.ndarray
    logs: np.ndarray

    def of(self, hashes: np.ndarray):
        """Class of every word, logarithm of its share (0 in the tail), and whether it is of the tail."""
        tail = np.ones(len(hashes), dtype=bool)
        classes = WORDS + BANDS + (hashes >> np.uint64(40)).astype(np.int64) % TAILS
        logs = np.zeros(len(hashes))
        if len(self.head):
            at = np.minimum(np.searchsorted(self.head, hashes), len(self.head) - 1)
            tail = self.head[at] != hashes
            classes, logs = np.where(tail, classes, self.classes[at]), np.where(tail, 0.0, self.logs[at])
        return classes, logs, tail


class Vocabulary(NamedTuple):
    lookup: Lookup
    #: ``word, n`` of the words of the tail.
    tail: DataFrame
    #: Corpus count of every class.
    counts: np.ndarray


def _word_counts(batches):
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def merged():
        words, where = np.unique(np.concatenate([w for w, _ in held]), return_inverse=True)
        return words, np.bincount(where, weights=np.concatenate([n for _, n in held])).astype(np.int64)

    def rows():
        words, n = held[0]
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["word", "n"])

    for batch in released(batches):
        data, offsets = text_buffers(batch.column(0))
        for i, j in runs(offsets):
            words, n = np.unique(hash_words(data, offsets[i:j + 1])[0], return_counts=True)
            held.append((words, n))
            size += len(words)
            if size > 2 * _HELD:
                held[:] = [merged()]
                size = len(held[0][0])
                if size > _HELD:
                    yield rows()
                    held, size = [], 0
    if held:
        held[:] = [merged()]
        yield rows()


def vocabulary(docs: DataFrame) -> Vocabulary:
    """Counts of all words of the corpus, and their classes."""
    counts = stored(docs.select("text").mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(
        F.sum("n").alias("n")), "words")
    # Words by count, in steps of an eighth of a power of two: 512 rows at most.
    step = F.floor(F.log2("n") * 8).cast("int")
    steps = sorted(((r.step, r.words) for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect()),
                   reverse=True)
    held, least = 0, 1 << 20
    for at, words in steps:
        held += words
        if held > HEAD:
            break
        least = at
    head = counts.filter(step >= least).toPandas()  # HEAD rows at most
    tail = counts.filter(step < least)
    words, n = head.word.to_numpy(dtype=np.int64).view(np.uint64), head.n.to_numpy(dtype=np.int64)
    order = np.lexsort((words, -n))
    words, n = words[order], n[order]
    classes = np.arange(len(words))
    rest = n[WORDS:]
    if len(rest):
        classes[WORDS:] = WORDS + (np.cumsum(rest) - rest) * BANDS // rest.sum()
    totals = np.bincount(classes, weights=n, minlength=VOCABULARY)
    logs = np.log(n / totals[classes])
    for r in tail.groupBy(_tail_class().alias("class")).agg(F.sum("n").alias("n")).collect():
        totals[WORDS + BANDS + r["class"]] = r.n
    order = np.argsort(words)
    return Vocabulary(Lookup(words[order], classes[order], logs[order]), tail, totals)


def _tail_class():
    return F.pmod(F.shiftrightunsigned("word", 40), F.lit(TAILS)).cast("int")


def initial(counts: np.ndarray) -> list[np.ndarray]:
    """Small random tables, and the corpus frequencies as output biases."""
    rng = np.random.default_rng(SEED)
    tables, hidden, out, bias = (np.zeros(s, dtype=np.float32) for s in _SHAPES)
    tables[:] = rng.normal(0, 0.3, tables.shape)
    out[:] = rng.normal(0, 0.1, out.shape)
    bias[:] = np.log((counts + 1) / (counts + 1).sum())
    return [tables, hidden, out, bias]


def _windows(ids: np.ndarray, counts: np.ndarray):
    """Words of several texts, their neighbours (``PAD`` beyond a text) and texts."""
    n = len(counts)
    text = np.repeat(np.arange(n), counts)
    padded = np.full(len(ids) + SIDE * (n + 1), PAD, dtype=np.int64)
    at = np.arange(len(ids)) + SIDE * (text + 1)
    padded[at] = ids
    shifts = [s for s in range(-SIDE, SIDE + 1) if s]
    return padded[at], [padded[at + s] for s in shifts], text


def _forward(weights, around):
    tables, hidden, out, bias = weights
    h = np.tanh(sum(tables[p][x] for p, x in enumerate(around)) + hidden)
    logits = h @ out + bias
    logits -= logits.max(axis=1, keepdims=True)
    return h, logits


def log_probabilities(weights: list[np.ndarray], words: np.ndarray, around: list[np.ndarray]) -> np.ndarray:
    """Log-probability of every word given its neighbours."""
    found = np.empty(len(words))
    for a in range(0, len(words), BATCH):
        part = slice(a, a + BATCH)
        _, logits = _forward(weights, [x[part] for x in around])
        chosen = logits[np.arange(len(logits)), words[part]]
        found[part] = chosen - np.log(np.exp(logits, out=logits).sum(axis=1))
    return found


def train(weights: list[np.ndarray], words: np.ndarray, around: list[np.ndarray]) -> None:
    """One pass of gradient steps over the words, in place."""
    tables, hidden, out, bias = weights
    for a in range(0, len(words), BATCH):
        part = slice(a, a + BATCH)
        near, target = [x[part] for x in around], words[part]
        h, logits = _forward(weights, near)
        n = len(target)
        error = np.exp(logits, out=logits)
        error /= error.sum(axis=1, keepdims=True)
        error[np.arange(n), target] -= 1
        error *= np.float32(min(1.0, n / BATCH) / n)
        back = (error @ out.T) * (1 - h * h)
        step = np.float32(RATE)
        out -= step * (h.T @ error)
        bias -= step * error.sum(axis=0)
        hidden -= step * back.sum(axis=0)
        # Rows of the tables are touched by few words of a batch each.
        for p, x in enumerate(near):
            order = np.argsort(x, kind="stable")
            rows, firsts = np.unique(x[order], return_index=True)
            tables[p][rows] -= step * np.add.reduceat(back[order], firsts, axis=0)


def _texts(batch, column: int, lookup: Lookup):
    data, offsets = text_buffers(batch.column(column))
    for i, j in runs(offsets):
        hashes, _, _, counts = hash_words(data, offsets[i:j + 1])
        classes, logs, tail = lookup.of(hashes)
        yield i, j, counts, *_windows(classes, counts), logs, hashes, tail


def _trained(weights, lookup, batches):
    weights = [w.copy() for w in weights]
    seen = 0
    for batch in released(batches):
        for _, _, _, words, around, *_ in _texts(batch, 0, lookup):
            train(weights, words, around)
            seen += len(words)
    if seen:
        flat = np.concatenate([w.ravel() for w in weights]).astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat * seen), pa.array(np.full(len(flat), float(seen)))],
            names=["at", "total", "seen"])


class Model:
    def __init__(self, table: Vocabulary, weights: list[np.ndarray]):
        self.table, self.weights = table, weights


def fitted(docs: DataFrame) -> Model:
    """Network trained on all of ``docs`` (``doc_id, text``)."""
    context = docs.sparkSession.sparkContext
    table = vocabulary(docs)
    weights = initial(table.counts)
    turn = F.pmod(F.xxhash64("doc_id", F.lit("round")), F.lit(ROUNDS))
    for k in range(ROUNDS):
        shared = context.broadcast((weights, table.lookup))
        sums = (docs.filter(turn == k).select("text")
                .mapInArrow(lambda batches, s=shared: _trained(*s.value, batches), "at int, total double, seen double")
                .groupBy("at").agg((F.sum("total") / F.sum("seen")).alias("value")).toPandas())
        if len(sums):
            flat = np.zeros(len(sums), dtype=np.float32)
            flat[sums["at"].to_numpy()] = sums["value"].to_numpy()
            cuts = np.cumsum([w.size for w in weights])[:-1]
            weights = [part.reshape(s).copy() for part, s in zip(np.split(flat, cuts), _SHAPES, strict=True)]
    return Model(table, weights)


SCORES = "doc_id long, n_words long, total double, tail array<long>"


def _scored(weights, lookup, batches):
    """Scores without the shares of tail words, and these words."""
    for batch in released(batches):
        for i, j, counts, words, around, text, logs, hashes, tail in _texts(batch, 1, lookup):
            logs = logs + log_probabilities(weights, words, around)
            total = np.bincount(text, weights=logs, minlength=len(counts))
            offsets = np.concatenate([[0], np.cumsum(np.bincount(text[tail], minlength=len(counts)))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.array(counts.astype(np.int64)), pa.array(total),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes[tail].view(np.int64)))],
                names=["doc_id", "n_words", "total", "tail"])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, n_words, log_likelihood, mean_log_likelihood)`` for every row."""
    table = model.table
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, table.lookup))
    rows = stored(docs.select("doc_id", "text").mapInArrow(lambda batches: _scored(*shared.value, batches), SCORES)
                  .withColumn("row", F.monotonically_increasing_id()), "scores")
    sizes = F.array(*(F.lit(math.log(n + 1)) for n in table.counts[WORDS + BANDS:]))
    share = F.log(F.coalesce("n", F.lit(1)).cast("double")) - F.get(sizes, _tail_class())
    tails = (rows.select("row", F.explode("tail").alias("word")).join(table.tail, "word", "left")
             .groupBy("row").agg(F.sum(F.round(share / _UNIT).cast("long")).alias("units")))
    whole = F.col("total") + F.coalesce("units", F.lit(0)) * _UNIT
    return rows.drop("tail").join(tails, "row", "left").select(
        "doc_id", "n_words", whole.alias("log_likelihood"),
        F.when(F.col("n_words") > 0, whole / F.col("n_words")).alias("mean_log_likelihood"))
