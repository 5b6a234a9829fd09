"""Language identification, toxicity and pseudo-likelihood."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import langid, pseudo, toxicity
from tests.llm.data import clashing, edge_rows, frame, prose

BAD = ["grumbo", "vexlat", "snorp"]


def corpus():
    rng = random.Random(13)
    rows = []
    for i in range(400):
        lang = "fr" if i % 3 == 0 else "en"
        words = prose(rng, rng.randint(20, 120), lang).split(" ")
        toxic = i % 5 == 0
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words), lang, "a", 0, int(toxic)))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return clashing(frame(spark, [r[:5] for r in corpus()]))


def held():
    return F.coalesce(F.col("doc_id") % 4 == 1, F.lit(False))


def test_language_of_held_out_rows(spark, docs):
    model = langid.fitted(docs, ~held())
    found = {r.doc_id: r for r in langid.identified(docs, model, held()).collect()}
    assert all(found[r[0]].lang_pred == r[2] and 0 <= found[r[0]].score <= 1 for r in corpus())
    edges = langid.identified(clashing(frame(spark)), model, held()).collect()
    by_id = {r.doc_id: r for r in edges if r.doc_id is not None}
    assert [by_id[i].lang_pred for i in (5, 6, 7)] == ["und"] * 3
    assert by_id[12].lang_pred in ("en", "fr") and by_id[14].lang_pred in ("en", "fr")
    assert len(edges) == len(edge_rows())


def model_of(tables, floors):
    """A model of two languages from dense rows."""
    at, places, values = 0, [], []
    indexed = []
    for table in tables:
        indexed.append({key: at + i for i, key in enumerate(table)})
        at += len(table)
        values += [v for row in table.values() for v in row]
        places += [0, 1] * len(table)
    return langid.Model(["a", "b"], np.log([0.5, 0.5]), indexed, floors, np.arange(0, 2 * at + 1, 2), np.array(places, dtype=int),
                        np.array(values, dtype=np.float32))


def test_backoff_takes_the_longest_known_grams():
    word, one, three = np.array([-1.0, -5]), np.array([-3.0, -7]), np.array([-2.0, -6])
    model = model_of([{"known": word}, {"q": one}, {}, {" un": three, "unk": three * 2}, {}], [np.array([-9.0, -9.0])] * 5)
    assert list(model.word("known")) == [-1, -5]
    assert list(model.word("unk")) == [-3, -9]  # the mean of two 3-grams
    assert list(model.word("qqq")) == [-3, -7]
    assert list(model.word("zzz")) == [-9, -9]
    assert model.predict(pa.array(["12 ² ½ !", None, ""])) == (["und"] * 3, [0.0] * 3)
    labels, scores = model.predict(pa.array(["Known zzz", "x", "qqq KNOWN-known"]))
    assert labels == ["a"] * 3 and scores[0] == pytest.approx(1 / (1 + math.exp(-4)))
    assert scores[2] == pytest.approx(1 / (1 + math.exp(-12)))


def words_by_hand(text):
    return re.findall("(?:[a-z]|[^\x00-\x7f])+", text.lower())


def test_long_texts_in_slices_score_as_whole(monkeypatch):
    word, one = np.array([-1.0, -5]), np.array([-3.0, -2.5])
    model = model_of([{"known": word}, {"q": one}, {}, {}, {}], [np.array([-4.0, -3.0])] * 5)
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["known", "qé", "zzz", "x" * 40]) for _ in range(n)) for n in (1, 300, 5, 4000, 2)]
    whole = model.predict(pa.array(texts))
    monkeypatch.setattr(langid, "SLICE", 64)
    model.forget()
    sliced = model.predict(pa.array(texts))
    assert sliced[0] == whole[0] and sliced[1] == pytest.approx(whole[1])
    for text, label in zip(texts, whole[0], strict=True):
        total = sum(model.word(w) for w in words_by_hand(text))
        assert label == "ab"[int(np.argmax(total))]


def test_fit_counts_as_by_hand(spark, docs, monkeypatch):
    """Words, n-grams and what is known of them, by plain loops over all rows."""
    rows, _ = langid.sample(docs, F.lit(True))
    want = Counter()
    for _, text, lang, *_ in corpus():
        for w in words_by_hand(text):
            want[lang, 0, w] += 1
            for size in range(1, 5):
                marked = f" {w} "
                want.update((lang, size, marked[i:i + size]) for i in range(len(marked) - size + 1))
    assert {(r.lang, r.kind, r.key): r.n for r in langid.counted(rows).collect()} == want
    monkeypatch.setattr(langid, "WORD_SHARE", 0.01)
    monkeypatch.setattr(langid, "GRAM_SHARE", 0.005)
    model = langid.fitted(docs, F.lit(True))
    totals = Counter()
    for (lang, kind, _), n in want.items():
        totals[lang, kind] += n
    for kind, share in enumerate([0.01] + [0.005] * 4):
        known = {k for (lang, of, k), n in want.items() if of == kind and n >= share * totals[lang, kind]}
        assert set(model.tables[kind]) == known
        for key in known:
            logs = [math.log((want[lang, kind, key] + 0.5) / (totals[lang, kind] + 0.5 * (len(known) + 1))) for lang in ("en", "fr")]
            assert list(model.row(kind, key)) == pytest.approx(logs, rel=1e-5)


def test_no_labelled_language(spark):
    rows = [(1, "text here", None, "a", 0)]
    model = langid.fitted(frame(spark, rows), F.lit(True))
    assert langid.identified(frame(spark, rows), model, held()).first().lang_pred == "und"
    assert langid.identified(frame(spark, []), langid.fitted(frame(spark, []), F.lit(True)), held()).count() == 0


def brute_segments(scores):
    """All maximal-scoring segments by their definition: the best segment, then
    the same left and right of it."""
    best, found = 0.0, None
    for i in range(len(scores)):
        for j in range(i, len(scores)):
            s = sum(scores[i:j + 1])
            if s > best + 1e-9:
                best, found = s, (i, j)
    if not found:
        return []
    i, j = found
    return brute_segments(scores[:i]) + [(i, j, best)] + [(a + j + 1, b + j + 1, s) for a, b, s in brute_segments(scores[j + 1:])]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([-1, -1, -1, 1.37, 2.713, 4.091]), max_size=14))
def test_maximal_segments(scores):
    places = [i for i, s in enumerate(scores) if s > 0]
    found = toxicity.maximal_segments(places, [scores[i] for i in places], 1.0)
    want = brute_segments(scores)
    assert math.isclose(sum(s for *_, s in found), sum(s for *_, s in want), abs_tol=1e-6)
    assert max((s for *_, s in found), default=0) == pytest.approx(max((s for *_, s in want), default=0))


def test_toxic_held_out_rows(spark, docs):
    labels = spark.createDataFrame([(r[0], 1, r[5]) for r in corpus()] + [(0, 1, 0), (None, 1, 1), (3, 1, None), (9999, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    model = toxicity.fitted(docs, clashing(labels), ~held())
    assert set(BAD) <= set(model.words)
    found = {r.doc_id: r for r in toxicity.scored(docs, model, held()).collect()}
    unseen = [r for r in corpus() if r[0] % 4 == 1]
    assert sum((found[r[0]].score >= 0.7) == bool(r[5]) for r in unseen) >= 0.95 * len(unseen)
    assert all(found[r[0]].passages for r in unseen if r[5])
    edges = toxicity.scored(clashing(frame(spark)), model, held()).collect()
    assert len(edges) == len(edge_rows()) and all(0 <= r.score < 0.7 for r in edges)


def test_long_text_slices_hold_every_word(monkeypatch):
    monkeypatch.setattr(toxicity, "_SLICE", 50)
    text = prose(random.Random(2), 400)
    assert [w for part in toxicity.word_slices(text) for w in part] == toxicity._WORD.findall(text.lower())


def test_no_toxic_label(spark):
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    for have in (labels, labels.limit(0)):
        model = toxicity.fitted(frame(spark), have, F.lit(True))
        assert all(r.score < 1e-6 for r in toxicity.scored(frame(spark), model, held()).collect())


def test_pseudo_likelihood_learns_and_sums(spark, docs):
    model = pseudo.fitted(docs)
    found = {r.doc_id: r for r in pseudo.scored(docs, model).collect()}
    start = pseudo.Model(model.table, pseudo.initial(np.ones(pseudo.VOCABULARY)))
    flat = {r.doc_id: r for r in pseudo.scored(docs, start).collect()}
    assert sum(r.log_likelihood for r in found.values()) > sum(r.log_likelihood for r in flat.values())
    for r in list(found.values())[:20]:
        assert r.mean_log_likelihood == pytest.approx(r.log_likelihood / r.n_words)
    edges = {r.doc_id: r for r in pseudo.scored(clashing(frame(spark)), model).collect()}
    assert [(edges[i].n_words, edges[i].log_likelihood, edges[i].mean_log_likelihood) for i in (5, 6, 7)] == [(0, 0, None)] * 3
    assert edges[1].log_likelihood == edges[2].log_likelihood


def test_conditional_probabilities_word_by_word():
    """Vectorised windows against a plain loop over one text."""
    rng = np.random.default_rng(0)
    weights = pseudo.initial(rng.integers(1, 50, pseudo.VOCABULARY))
    ids = rng.integers(0, pseudo.VOCABULARY, 30)
    words, around, text = pseudo._windows(ids, np.array([12, 0, 18]))
    logs = pseudo.log_probabilities(weights, words, around)
    tables, hidden, out, bias = (w.astype(float) for w in weights)
    for begin, end in ((0, 12), (12, 30)):
        for i in range(begin, end):
            near = [ids[i + s] if begin <= i + s < end else pseudo.PAD for s in (-2, -1, 1, 2)]
            h = np.tanh(sum(tables[p][x] for p, x in enumerate(near)) + hidden)
            z = h @ out + bias
            assert logs[i] == pytest.approx(z[ids[i]] - np.log(np.exp(z - z.max()).sum()) - z.max(), abs=1e-4)
    assert list(Counter(text).items()) == [(0, 12), (2, 18)]


def test_gradient_step_matches_finite_differences():
    rng = np.random.default_rng(1)
    weights = pseudo.initial(np.ones(pseudo.VOCABULARY))
    ids = rng.integers(0, pseudo.VOCABULARY, pseudo.BATCH)
    words, around, _ = pseudo._windows(ids, np.array([len(ids)]))
    stepped = [w.copy() for w in weights]
    pseudo.train(stepped, words, around)
    for k in range(4):
        at = tuple(int(x) for x in np.unravel_index(np.argmax(np.abs(stepped[k] - weights[k])), weights[k].shape))
        sides = []
        for sign in (1, -1):
            moved = [w.astype(np.float64) for w in weights]
            moved[k][at] += sign * 1e-4
            sides.append(pseudo.log_probabilities(moved, words, around).mean())
        slope = (sides[0] - sides[1]) / 2e-4
        assert stepped[k][at] - weights[k][at] == pytest.approx(pseudo.RATE * slope, rel=0.05)


def test_empty_table(spark):
    assert pseudo.scored(frame(spark, []), pseudo.fitted(frame(spark, []))).count() == 0


def test_every_word_has_a_probability_of_its_own(spark, monkeypatch):
    """Texts that differ in one rare word score by its corpus count; the words
    of the corpus share a probability of one."""
    rng = random.Random(21)
    filler = [f"w{i}" for i in range(1500)]
    rows = [(i, " ".join(rng.choices(filler, k=40)), "en", "a", 0) for i in range(200)]
    rows += [(1000 + i, " ".join(["often"] * 3 + rng.choices(filler, k=20)), "en", "a", 0) for i in range(10)]
    rows += [(2000, "seldom " + " ".join(filler[:20]), "en", "a", 0)]
    corpus_rows = frame(spark, rows)
    counts = Counter(w for r in rows for w in r[1].split())
    for head in (pseudo.HEAD, 300):  # all words in the task; most of them through the join
        monkeypatch.setattr(pseudo, "HEAD", head)
        model = pseudo.fitted(corpus_rows)
        assert len(model.table.lookup.head) + model.table.tail.count() == len(counts)
        probe = [(i, w, "en", "a", 0) for i, w in enumerate([*counts, "unheard"])]
        found = {probe[r.doc_id][1]: r.log_likelihood for r in pseudo.scored(frame(spark, probe), model).collect()}
        assert sum(math.exp(x) for x in found.values()) == pytest.approx(1, abs=0.02)
        assert len({round(x, 6) for x in found.values()}) > 10
        assert found["often"] > found["seldom"] + 1
        assert found["seldom"] >= found["unheard"] - 3


def test_every_toxic_passage_of_a_text_is_found():
    """Listed words that stand singly early on, or in an earlier passage, do not
    hide a later passage; repeats of one word add no evidence."""
    listed = [f"bad{c}" for c in "abcdefgh"]
    model = toxicity.Model(dict.fromkeys(listed, 3.0) | {"kindly": -2.0}, dict.fromkeys([*listed, "kindly"], 1e-4))
    calm, dense = ["calm"] * 60, [w for b in listed for w in (b, "calm")]
    singly = [w for b in listed for w in (b, *calm)]
    rows = {"singly": singly, "later": singly + dense, "twice": calm + dense + calm * 4 + dense + calm}
    found = {}
    for name, words in rows.items():
        n, segments, once = model.segments(" ".join(words))
        found[name] = model.passages(n, segments), model.evidence(n, once)
    assert not found["singly"][0]
    assert [(r["first_word"], r["last_word"]) for r in found["later"][0]] == [(len(singly), len(singly) + 14)]
    assert [r["first_word"] for r in found["twice"][0]] == [60, 60 + 16 + 240]
    assert found["later"][1] > found["singly"][1] + 5
    one = model.segments("bada bada bada bada")
    assert one[1] == [(0, 3, 12.0)] and one[2] == [3.0]
    assert model.segments("bada kindly badb")[1] == [(0, 2, 4.0)]


def test_extreme_value_law_is_recovered():
    rng = np.random.default_rng(3)
    n = rng.integers(50, 1000, 20_000).astype(float)
    tops = (np.log(0.02 * n) - np.log(-np.log(rng.random(len(n))))) / 0.7
    tops[tops < toxicity.MIN_SCORE] = 0
    rate, log_k = toxicity.extreme_value_law(n, tops)
    assert rate == pytest.approx(0.7, rel=0.05) and log_k == pytest.approx(math.log(0.02), abs=0.15)
    assert toxicity.extreme_value_law(n[:10], tops[:10]) is None
