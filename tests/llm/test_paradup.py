import random
import re

import pyarrow as pa

from strata.llm import paradup
from tests.llm.data import clashing, edge_rows, frame, prose


def planted():
    """Shared passages as lines of their own, inside long lines, and edited;
    clean documents beside them."""
    rng = random.Random(17)
    rows = [(i, prose(rng, 200), "en", "a", 0) for i in range(40)]
    shared = [prose(rng, 90).replace("\n", " ") for _ in range(4)]
    for k, passage in enumerate(shared):
        for j in range(4):
            words = passage.split()
            if j == 3:
                words[40] = "edited"
            middle = " ".join(words)
            before, after = prose(rng, 80).replace("\n", " "), prose(rng, 60).replace("\n", " ")
            text = f"{before}\n{middle}\n{after}" if j != 1 else f"{before} {middle} {after}"
            rows.append((100 + 10 * k + j, text, "en", "a", 0))
    return rows


def test_planted_passages(spark):
    found = paradup.repeated_passages(clashing(frame(spark, planted()))).collect()
    got = {r.doc_id for r in found}
    assert got == {100 + 10 * k + j for k in range(4) for j in range(4)}
    for doc_id in got:
        told = {(r.removed, r.kept_in) for r in found if r.doc_id == doc_id and 85 <= r.n_words <= 100 and r.first_word >= 60}
        assert (doc_id % 10 > 0, doc_id // 10 * 10) in told
    assert all(r.n_words >= paradup.MIN_WORDS for r in found)


def test_awkward_rows(spark):
    found = paradup.repeated_passages(clashing(frame(spark, edge_rows()))).collect()
    assert {r.doc_id for r in found} == {1, 2, 3, 4, None}
    assert all(not r.removed for r in found if r.doc_id in (1, None))
    assert paradup.repeated_passages(frame(spark, [])).count() == 0


def test_repeats_inside_one_document_do_not_count(spark):
    line = prose(random.Random(8), 70).replace("\n", " ")
    rows = [(1, f"{line}\n{line}", "en", "a", 0), (2, prose(random.Random(9), 100), "en", "a", 0)]
    assert paradup.repeated_passages(frame(spark, rows)).count() == 0


def test_line_sizes_count_distinct_shingles():
    """Sixty words against the same words twice: Jaccard 0.93, so the sizes that
    candidates are held against must not rule the pair out."""
    line = " ".join(f"w{i}" for i in range(60))
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 2]), pa.array([1, 2]), pa.array([line, f"{line} {line}"])], names=["doc_id", "text_hash", "text"])
    found = pa.Table.from_batches(paradup._long_lines([batch])).to_pydict()
    assert found["n"] == [56, 60]
    assert 100 * min(found["n"]) >= paradup.LINES.percent * max(found["n"])


def words(rng, n):
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(4, 9))) for _ in range(n)]


def in_pairs(rng, first, n, middle, lines=None):
    """``n`` pairs of documents that share a passage of ``middle`` words between 60 other words."""
    rows = []
    for i in range(n):
        passage = words(rng, middle)
        for j in range(2):
            width = lines[j] if lines else 10_000
            laid = "\n".join(" ".join(passage[a:a + width]) for a in range(0, middle, width))
            rows.append((first + 2 * i + j, f"{' '.join(words(rng, 60))} {laid} {' '.join(words(rng, 60))}", "en", "a", 0))
    return rows


CASES = [(51, None), (55, None), (60, None), (70, None), (30, None), (40, None), (49, None), (50, None), (90, (3, 3)), (80, (5, 6))]


def test_planted_in_long_and_short_lines(spark):
    """Passages over 50 words are found word for word wherever their lines end, shorter ones and
    rows of phrases from many documents never."""
    rng = random.Random(5)
    rows = [r for k, (middle, lines) in enumerate(CASES) for r in in_pairs(rng, 1000 * k, 60 if lines is None else 30, middle, lines)]
    for i in range(20):
        phrases = [words(rng, 12) for _ in range(6)]
        rows += [(90_000 + 100 * i + k, " ".join(words(rng, 40) + p + words(rng, 40)), "en", "a", 0) for k, p in enumerate(phrases)]
        rows.append((90_000 + 100 * i + 50, " ".join(w for p in phrases for w in p), "en", "a", 0))
    many = words(rng, 60)
    rows += [(80_000 + i, " ".join(words(rng, 60) + many + words(rng, 20)), "en", "a", 0) for i in range(5)]
    found = paradup.repeated_passages(frame(spark, rows)).collect()
    want = {(r[0], 60, CASES[r[0] // 1000][0], r[0] // 2 * 2, r[0] % 2 == 1)
            for r in rows if r[0] < 80_000 and CASES[r[0] // 1000][0] > 50}
    want |= {(80_000 + i, 60, 60, 80_000, i > 0) for i in range(5)}
    assert {(r.doc_id, r.first_word, r.n_words, r.kept_in, r.removed) for r in found} == want
    clusters = {r.doc_id: r.cluster_id for r in found}
    assert len({clusters[80_000 + i] for i in range(5)}) == 1
    pairs = {d: c for d, c in clusters.items() if d < 80_000}
    assert all(pairs[d] == pairs[d ^ 1] for d in pairs) and len(set(clusters.values())) == len(pairs) // 2 + 1


def lowered(text):
    return re.findall("[^\\x20\\x09-\\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute_force(rows):
    """Exact passages by comparing all sequences of 51 words."""
    first = {}
    for doc_id, text, *_ in rows:
        first[text] = min(doc_id, first.get(text, doc_id))
    grams = {t: [tuple(lowered(t)[i:i + 51]) for i in range(len(lowered(t)) - 50)] for t in first}
    holders = {}
    for t, gs in grams.items():
        for g in gs:
            holders.setdefault(g, set()).add(t)
    out = set()
    for doc_id, text, *_ in rows:
        if doc_id > first[text]:
            if grams[text]:
                out.add((doc_id, 0, len(lowered(text)), first[text], True))
            continue
        if grams[text] and any(r[0] > doc_id and r[1] == text for r in rows):
            out.add((doc_id, 0, len(lowered(text)), doc_id, False))
        keep = [min(first[t] for t in holders[g]) if len(holders[g]) > 1 else None for g in grams[text]]
        at = 0
        while at < len(keep):
            if keep[at] is None:
                at += 1
                continue
            end = at
            while end + 1 < len(keep) and keep[end + 1] is not None and (keep[end + 1] < doc_id) == (keep[at] < doc_id):
                end += 1
            out.add((doc_id, at, end + 51, min(keep[at:end + 1]), keep[at] < doc_id))
            at = end + 1
    return out


def test_as_brute_force_on_200_documents(spark):
    """Passages of all lengths, overlapping, shared by several documents, in copies and in capitals."""
    rng = random.Random(21)
    pool = [words(rng, rng.choice([30, 45, 51, 52, 60, 120, 300])) for _ in range(25)]
    rows = []
    for i in range(200):
        parts = []
        for _ in range(rng.randint(1, 4)):
            parts += words(rng, rng.randint(0, 40))
            source = rng.choice(pool)
            a = rng.randrange(max(len(source) - 40, 1))
            parts += source[a:a + rng.choice([25, 51, 60, 400])]
        text = " ".join(parts)
        rows.append((i, text.upper() if i % 11 == 0 else text, "en", "a", 0))
    rows += [(300 + i, rows[i][1], "en", "a", 0) for i in range(0, 40, 4)] + [rows[3], rows[3]]
    found = paradup.repeated_passages(frame(spark, rows)).collect()
    exact = {(r.doc_id, r.first_word, r.last_word, r.kept_in, r.removed) for r in found}
    want = brute_force(rows)
    assert want <= exact
    # Anything beside them is a near line: a whole text, as these have one line each.
    sizes = {r[0]: len(lowered(r[1])) for r in rows}
    assert all((a, b) == (0, sizes[d]) for d, a, b, *_ in exact - want)


def test_every_passage_holds_a_band():
    """The places inside a shared run of 51 words are the same whatever stands around it."""
    import numpy as np
    from strata.llm.words import seeds
    rng = np.random.default_rng(3)
    for trial in range(300):
        shared = seeds(51, int(rng.integers(1 << 40)))
        keys = []
        for side in range(2):
            before, after = (seeds(int(rng.integers(0, 60)), int(rng.integers(1 << 40))) for _ in range(2))
            keys.append(set(paradup.bands(np.concatenate([before, shared, after]),
                                          np.array([len(before) + 51 + len(after)]))[0].tolist()))
        assert keys[0] & keys[1]


def test_stored_tables_leave_no_shuffle_files(spark):
    """A table that is written ends its shuffles: they take no disk while later steps run."""
    import os
    import time

    from strata.llm.components import DROP_SHUFFLES, stored
    status = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()

    def files():
        roots = [d.toString() for d in status.diskBlockManager().localDirs()]
        return {os.path.join(at, f) for r in roots for at, _, fs in os.walk(r) for f in fs if f.startswith("shuffle_")}
    before = files()
    rows = spark.range(20000).selectExpr("id % 977 AS k", "id").groupBy("k").count()
    table = stored(rows, "few")
    for _ in range(50):  # files are removed in the background
        if files() <= before:
            break
        time.sleep(0.2)
    assert files() <= before and table.count() == 977
    assert spark.conf.get(DROP_SHUFFLES) == "false"
