import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import words as W

WORD = re.compile(r"[^\x20\x09-\x0D]+")
texts = st.lists(st.one_of(st.none(), st.text(alphabet="aAbé字 \n\t\x0b\x1c.", max_size=40)), max_size=8)


def by_text(values, **kinds):
    data, offsets = W.text_buffers(pa.array(values, type=pa.string()))
    hashes, starts, ends, counts = W.hash_words(data, offsets, **kinds)
    stops = np.cumsum(counts)
    return [([bytes(data[s:e]).decode() for s, e in zip(starts[b - n:b], ends[b - n:b])], list(hashes[b - n:b]))
            for b, n in zip(stops, counts)]


@settings(max_examples=150, deadline=None)
@given(texts)
def test_words_and_hashes_agree_with_the_pattern(values):
    seen = {}
    for value, (words, hashes) in zip(values, by_text(values)):
        assert words == WORD.findall(value or "")
        for w, h in zip(words, hashes):
            key = w.translate({c: c + 32 for c in range(65, 91)})
            assert seen.setdefault(key, h) == h
    assert len(set(seen.values())) == len(seen)


def test_stretches_do_not_change_hashes(monkeypatch):
    values = ["alpha beta " * 50, "y" * 300, "", "gamma " + "z" * 90 + " delta"]
    whole = by_text(values)
    monkeypatch.setattr(W, "STRETCH", 64)
    assert by_text(values) == whole


def test_runs_cover_all_texts_once():
    offsets = np.array([0, 5, 5, 900, 905, 2000])
    assert list(W.runs(offsets, 100)) == [(0, 2), (2, 3), (3, 4), (4, 5)]


def test_a_word_longer_than_the_stretch_ends_with_its_text(monkeypatch):
    monkeypatch.setattr(W, "STRETCH", 64)
    data, offsets = W.text_buffers(pa.array(["q" * 500, "next words", "r" * 100]))
    for i in range(3):
        hashes, _, _, counts = W.hash_words(data, offsets[i:i + 2])
        assert len(hashes) == counts.sum() == (1, 2, 1)[i]
