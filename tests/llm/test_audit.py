import random
from itertools import permutations

import duckdb
import pytest

from strata.llm import audit, oracle
from tests.llm.data import SCHEMA, clashing, edge_rows, frame, prose

WHITE = " \t\n\x0b\x0c\r"


def words_of(text):
    for c in WHITE:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def fails(text, doc_id, first):
    words = words_of(text)
    return {
        "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text), "D": any(c in "#$%&*|" for c in text),
        "E": doc_id is not None and first is not None and doc_id > first}


def brute_force(rows, labels):
    """Every order applied to every document, one filter after another."""
    firsts = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            firsts[text or ""] = min(firsts.get(text or "", doc_id), doc_id)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    parts = {}
    for doc_id, text, lang, *_ in rows:
        parts.setdefault(lang or "", []).append((doc_id, fails(text or "", doc_id, firsts.get(text or ""))))
    out, removed_by = [], {}
    for part, docs in parts.items():
        for order in map("".join, permutations("ABCDE")):
            alive = docs
            for step, x in enumerate(order, 1):
                here = [d for d, f in alive if f[x]]
                redundant = sum(f[x] for _, f in docs) - len(here)
                alive = [(d, f) for d, f in alive if not f[x]]
                only = sum(f[x] and sum(f.values()) == 1 for _, f in docs)
                removed_by[part, x] = removed_by.get((part, x), 0) + len(here)
                out.append((part, order, step, len(alive), len(here), redundant, only,
                            sum(d in good for d in here), sum(d in toxic for d in here)))
    return sorted((*r, removed_by[r[0], r[1][r[2] - 1]]) for r in out)


def cases():
    rng = random.Random(4)
    rows = edge_rows()
    for i in range(60):
        text = prose(rng, rng.choice([20, 90, 130]))
        if i % 4 == 0:
            text = text.upper()
        if i % 5 == 0:
            text += rng.choice(["#", " $", "|"])
        if i % 6 == 0:
            text = "again and again " * 40
        rows.append((500 + i, text, rng.choice(["en", "fr", None, ""]), "s", 1))
    rows += [(490, rows[-1][1], "fr", "s", 1), (None, rows[-1][1], "en", "s", 1)]
    labels = [(r[0], rng.choice([0, 1, None]), rng.choice([0, 1, None])) for r in rows if rng.random() < 0.7]
    return rows, labels + labels[:5] + [(99_999, 1, 1), (None, 1, 1)]


LABELS = "doc_id long, quality int, toxic int"


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def audited(spark):
    rows, labels = cases()
    return rows, labels, audit.interactions(clashing(frame(spark, rows)), clashing(spark.createDataFrame(labels, LABELS)))


def test_as_brute_force(audited):
    rows, labels, result = audited
    assert result.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                              "toxic_lost", "shapley"]
    assert found(result) == brute_force(rows, labels)


def test_as_sql(audited):
    rows, labels, result = audited
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", [list(r) for r in rows])
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", [list(r) for r in labels])
    want = con.sql(oracle.FILTER_AUDIT)
    places = [want.columns.index(c) for c in result.columns]
    assert found(result) == sorted(tuple(r[i] for i in places) for r in want.fetchall())


def test_levels_depend_on_filters_only(spark):
    """The recursion meets mask cells, not documents: its rows are bounded."""
    masks = spark.createDataFrame([(p, m, 10, 1, 0) for p in "xyz" for m in range(32)],
                                  "part string, mask int, n long, good long, toxic long")
    trail = spark.sql(audit.TRAILS, cells=masks, letters=audit.FILTERS)
    assert trail.count() == 32 * (5 + 20 + 60 + 120 + 120)
    assert audit.report(masks).count() == 3 * 120 * 5


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert audit.interactions(none, spark.createDataFrame([], LABELS)).collect() == []
