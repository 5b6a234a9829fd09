import re
from collections import Counter, defaultdict

import pytest

from strata.llm import mixing
from tests.llm.data import clashing, edge_rows, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shares(sizes):
    """Targets by resharing round after round."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        want = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if want[s] > 3 * sizes[s]]
        if not over:
            return fixed | want
        fixed |= {s: 3 * sizes[s] for s in over}


def n_words(text):
    return len(WORD.findall(text or ""))


@pytest.mark.parametrize("rows", [
    edge_rows(),
    [(i, "w " * (i % 40), "en", s, 0) for i, s in enumerate(["big"] * 400 + ["mid"] * 50 + ["tiny"] * 3 + [None] * 20)],
    [(i, "", "en", "empty", 0) for i in range(5)] + [(9, "a b", "en", "x", 0)],
], ids=["edges", "hot source", "source without words"])
def test_targets_and_taken_words(spark, rows):
    found = mixing.mixed(clashing(frame(spark, rows)), ["doc_id", "source"]).collect()
    assert len(found) == len(rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += n_words(r[1])
    want = shares(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, 0.0)
    taken, largest = Counter(), Counter()
    for r in found:
        assert 0 <= r.mix_copies <= 3 and r.mix_source_size == sizes[r.source]
        assert r.mix_target == pytest.approx(want[r.source])
        taken[r.source] += r.mix_copies * r.mix_size
        largest[r.source] = max(largest[r.source], r.mix_size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] + 1
    assert Counter(r.mix_size for r in found) == Counter(n_words(r[1]) for r in rows)


def test_reruns_and_other_partitionings_agree(spark):
    rows = edge_rows()
    one = mixing.mixed(frame(spark, rows), ["doc_id"]).collect()
    two = mixing.mixed(frame(spark, rows).repartition(5), ["doc_id"]).collect()
    assert sorted(map(str, one)) == sorted(map(str, two))


def test_sampled_rows_are_the_copies(spark):
    rows = edge_rows()
    docs = clashing(frame(spark, rows))
    out = mixing.sampled(docs)
    assert out.columns == docs.columns
    copies = Counter()
    for r in mixing.mixed(frame(spark, rows), ["doc_id", "text"]).collect():
        copies[r.doc_id, r.text] += r.mix_copies
    assert Counter((r.doc_id, r.text) for r in out.collect()) == +copies


def test_empty_table(spark):
    assert mixing.mixed(frame(spark, []), ["doc_id"]).count() == 0
    assert mixing.sampled(frame(spark, [])).count() == 0
