import random

import numpy as np
import pyarrow as pa

from strata.llm import decontam
from tests.llm.data import clashing, edge_rows, frame, prose

ITEMS = "item_id long, text string"


def bench_rows():
    rng = random.Random(21)
    items = [(i, prose(rng, rng.randint(15, 60), "fr" if i % 3 else "en")) for i in range(20)]
    return items + [(50, None), (51, ""), (52, "too short here"), (53, "exactly six rare words zyx here"),
                    (54, prose(rng, 900)), (20, items[0][1])]


def planted(rate, copies=3):
    rng = random.Random(4)
    rows = []
    for item, text in bench_rows()[:20]:
        for k in range(copies):
            words = [f"swap{rng.randrange(10**6)}" if rng.random() < rate else w.upper() + "," for w in text.split()]
            rows.append((item * 10 + k, prose(rng, 120) + " " + " ".join(words) + " " + prose(rng, 90), "en", "a", 0))
    return rows


def hits(spark, rows):
    found = decontam.contaminated(clashing(frame(spark, rows)), spark.createDataFrame(bench_rows(), ITEMS)).collect()
    return {(r.doc_id, r.item_id) for r in found}, found


def test_exact_and_substituted_passages_are_found(spark):
    exact, found = hits(spark, planted(0))
    assert exact == {(i * 10 + k, i) for i in range(20) for k in range(3)} | {(k, 20) for k in range(3)}
    assert all(r.overlap == 1 and r.last_word - r.first_word == r.item_words for r in found)
    some, _ = hits(spark, planted(0.2))
    assert sum((i * 10 + k, i) in some for i in range(20) for k in range(3)) >= 58
    assert all(d // 10 == item or (d // 10 == 0 and item == 20) for d, item in some)


def brute_force(rows):
    """Pairs by laying every document beside every item at every offset."""
    def hashed(text):
        batch = pa.RecordBatch.from_arrays([pa.array([0]), pa.array([text.lower()])], names=["id", "text"])
        return next(iter(decontam._hashed(batch, 1)))[1].view(np.int64)

    items = [(i, hashed(t)) for i, t in bench_rows() if t]
    out = set()
    for doc_id, text, *_ in rows:
        doc = hashed(text)
        for item_id, item in items:
            if len(item) < decontam.MIN_ITEM:
                continue
            matched, longest, *_ = decontam.aligned(doc, item, range(-len(item), len(doc)))
            m = int(matched.sum())
            if m and (m >= decontam.MIN_SHARE * len(item) or longest >= decontam.MIN_PASSAGE):
                out.add((doc_id, item_id))
    return out


def test_recall_by_share_of_replaced_words(spark):
    """Against the brute-force version: nothing else is reported, and 0.9 at least is found
    with 10, 20 and 30 % of the words replaced."""
    rates = (0.1, 0.2, 0.3)
    rows = [(10_000 * k + r[0], *r[1:]) for k, rate in enumerate(rates) for r in planted(rate)]
    found, _ = hits(spark, rows)
    want = brute_force(rows)
    assert found <= want
    for k in range(len(rates)):
        of = {x for x in want if x[0] // 10_000 == k}
        assert len(of & found) >= 0.9 * len(of) and len(of & found) >= 0.9 * 60


def test_items_too_short_to_be_sought_are_listed(spark):
    listed = decontam.unsought(spark.createDataFrame(bench_rows(), ITEMS)).collect()
    assert {(r.item_id, r.n) for r in listed} == {(50, 0), (51, 0), (52, 3)}


def test_awkward_rows(spark):
    rows = edge_rows() + [(900, "we saw EXACTLY six, rare words zyx here again", "en", "a", 0),
                          (901, "too short here", "en", "a", 0), (902, "exactly six rare words", "en", "a", 0),
                          (None, bench_rows()[3][1], "en", "a", 0), (903, prose(random.Random(1), 50) + bench_rows()[24][1][300:], "en", "a", 0)]
    found, _ = hits(spark, rows)
    assert found == {(900, 53), (None, 3), (903, 54)}


def test_only_contaminated_rows_go(spark):
    rows = edge_rows() + planted(0, 1) + [(None, bench_rows()[3][1], "en", "a", 0)]
    docs = clashing(frame(spark, rows))
    kept = decontam.decontaminated(docs, spark.createDataFrame(bench_rows(), ITEMS))
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.select("doc_id", "text").collect())) == sorted(
        map(str, frame(spark, edge_rows()).select("doc_id", "text").collect()))


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    assert hits(spark, [])[0] == set()
    assert decontam.contaminated(frame(spark), none).count() == 0
    assert decontam.decontaminated(frame(spark), none).count() == len(edge_rows())


def test_alignment_against_every_offset():
    """Words matched at the offsets of the hits are those of all offsets."""
    rng = np.random.default_rng(2)
    for _ in range(30):
        item = rng.integers(0, 10**6, 30)
        doc = np.concatenate([rng.integers(0, 10**6, 20), item, rng.integers(0, 10**6, 15)])
        swap = rng.random(len(doc)) < 0.15
        doc[swap] = -1
        every, *_ = decontam.aligned(doc, item, range(-29, len(doc)))
        near, *_ = decontam.aligned(doc, item, [20])
        assert (every == near).all() and near.sum() <= (doc[20:50] == item).sum()
