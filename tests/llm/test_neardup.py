import random
import re

import pytest

from strata.llm import neardup
from strata.llm.components import connected_components
from tests.llm.data import clashing, edge_rows, frame, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute_force(rows):
    """Component (a set of row numbers) of every row, by comparing all pairs."""
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    return sets, {i: g for g in groups.values() for i in g}


def expected(rows):
    sets, groups = brute_force(rows)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in groups[i] if rows[j][0] is not None]
        component = min(ids) if ids and sets[i] else r[0] if not sets[i] else None
        out.append((r[0], len(sets[i]), component, r[0] == component))
    return sorted(out, key=str)


def near_copies(n=40):
    """A group of edited copies of one text, some outside the threshold, and
    chains of texts in which only neighbours are close."""
    rng = random.Random(3)
    base = prose(rng, 200).split()
    rows = [(1000, " ".join(base))]
    for i in range(n):
        words = base.copy()
        for at in rng.sample(range(200), rng.randint(1, 9)):
            words[at] = f"edit{i}x{at}"
        rows.append((1001 + i, " ".join(words)))
    chain = prose(rng, 150).split()
    for i in range(8):
        chain = chain.copy()
        chain[10 + 15 * i] = f"link{i}"
        rows.append((2000 + i, " ".join(chain)))
    return [(i, t, "en", "a", len(t)) for i, t in rows]


@pytest.mark.parametrize("rows", [edge_rows(), near_copies()], ids=["edges", "near copies"])
def test_equals_comparing_all_pairs(spark, rows):
    found = neardup.near_duplicates(clashing(frame(spark, rows))).collect()
    assert sorted((tuple(r) for r in found), key=str) == expected(rows)


def test_one_row_of_each_group_stays(spark):
    rows = edge_rows()
    sets, groups = brute_force(rows)
    kept = neardup.deduplicated(clashing(frame(spark, rows)))
    assert kept.columns == clashing(frame(spark, [])).columns
    kept = kept.select("doc_id", "text").collect()
    with_words = {frozenset(groups[i]) for i in range(len(rows)) if sets[i]}
    assert len(kept) == len(with_words) + sum(not s for s in sets)
    for g in with_words:
        ids = [rows[i][0] for i in g]
        first = min((x is None, x or 0) for x in ids)
        assert sum((r.doc_id is None, r.doc_id or 0) == first and shingles(r.text) in {sets[i] for i in g} for r in kept) == 1


def test_empty_table(spark):
    assert neardup.near_duplicates(frame(spark, [])).count() == 0
    assert neardup.deduplicated(frame(spark, [])).count() == 0


def test_sketch_cut_keeps_pairs_at_the_threshold():
    import numpy as np
    rng = np.random.default_rng(1)
    misses = 0
    for _ in range(60):
        pool = rng.integers(0, 2**63, 600, dtype=np.uint64)
        a, b = pool[:575], pool[25:]  # 550 of 600 shared: well above; drop to 0.85 below
        b = np.concatenate([pool[46:575], rng.integers(0, 2**63, 46, dtype=np.uint64)])
        flat = np.concatenate([a, b])
        _, lanes = neardup.DOCUMENTS.sketches(flat, np.array([0, len(a)]))
        differ = sum(int(x).bit_count() for x in (lanes[0] ^ lanes[1]).view(np.uint64))
        misses += differ > neardup.DOCUMENTS.most
    assert misses == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
