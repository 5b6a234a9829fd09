import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from strata.llm import oracle, queries, trie
from tests.llm.data import clashing

TURNS = "conv_id long, turn long, role string, text string"


def key(row):
    _, turn, role, text = row
    return (turn is not None, turn or 0, role or "", text or "")


def as_rebuilt(rows):
    """Turns of every conversation after grafting, by the letter of the definition."""
    turns = {}
    for row in sorted((r for r in rows if r[0] is not None), key=key):
        turns.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = turns.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute_force(conversations):
    members, ends = {}, {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    out = []
    for node, of in members.items():
        below = [m for m in members if m[:len(node)] == node]
        inner = {m[:-1] for m in members if m}
        out.append((
            min(of), len(node), min(members[node[:-1]]) if node else None, len(of),
            sum(len(m) == len(node) + 1 for m in below), sum(m not in inner for m in below),
            sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in below if m),
            hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()))
    return sorted(out, key=str)


def conversations():
    """Few texts, so that prefixes are shared; ties, nulls, gaps, long and repeated conversations."""
    rng = random.Random(11)
    rows = []
    for c in range(120):
        if c % 17 == 3:
            continue
        for t in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", rng.choice(["a", "b", "é字", ""])))
    rows += [(200, t, "user", f"deep {t % 3}") for t in range(90)] + [(201, t, "user", f"deep {t % 3}") for t in range(85)]
    rows += [(205, None, "user", "null first"), (205, 1, None, None), (205, 1, "user", "tie"), (205, 1, "user", "tie"),
             (206, 0, "", "")]
    rows += [(None, 0, "user", "nobody"), (300, 5_000, "user", "late"), (300, 100, "user", "early"), (-4, 0, "user", "a")]
    return rows


@pytest.fixture(params=[2, 3, 16])
def band(request, monkeypatch):
    monkeypatch.setattr(trie, "BAND", request.param)


def nodes(spark, rows):
    turns = trie.stored(trie.ordered_turns(clashing_turns(spark, rows)), "placed")
    family = F.col("conv_id") - F.col("conv_id") % 5
    return trie.prefix_trie(trie.rebuilt(turns, family, F.crc32(F.col("conv_id").cast("string")) % 9))


def clashing_turns(spark, rows):
    df = clashing(spark.createDataFrame(rows, TURNS))
    for name in ("place", "block", "depth", "c", "a", "b", "first", "bytes", "own", "parent"):
        df = df.withColumn(name, F.lit("x"))
    return df


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_as_brute_force_in_low_and_high_bands(spark, band):
    rows = conversations()
    assert found(nodes(spark, rows)) == brute_force(as_rebuilt([r for r in rows if r[0] != -4]) | as_rebuilt_negative(rows))


def as_rebuilt_negative(rows):
    """Remainders of negative ids follow SQL: they keep the sign."""
    own = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == -4), key=key)]
    turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == 0), key=key)]
    h = zlib.crc32(b"-4") % 9
    return {-4: turns[:h] + own[h:]}


def test_as_sql(spark, monkeypatch, tmp_path):
    rows = [r for r in conversations() if r[0] is not None]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", [list(r) for r in rows])
    spark.createDataFrame(rows, TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    result = queries.op11(spark, str(tmp_path))
    want = con.sql(oracle.PREFIX_TRIE)
    places = [want.columns.index(c) for c in result.columns]
    assert found(result) == sorted((tuple(r[i] for i in places) for r in want.fetchall()), key=str)


def test_plain_conversations_and_blocks(spark, monkeypatch):
    """Without grafting, with turns numbered over several blocks."""
    monkeypatch.setattr(trie, "BLOCK", 8)
    monkeypatch.setattr(trie, "HOT_SHARE", 0.01)
    rows = [r for r in conversations() if r[0] is not None]
    turns = {}
    for row in sorted(rows, key=key):
        turns.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    placed = trie.stored(trie.ordered_turns(spark.createDataFrame(rows, TURNS)), "placed")
    assert found(trie.prefix_trie(trie.whole(placed))) == brute_force(turns)


def test_ends_over_many_batches(spark):
    """A node where very many conversations end reads its ids in order, whatever the batches."""
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        ends = spark.range(5_000).select(F.lit(1).cast("long").alias("depth"), F.lit(5).cast("long").alias("a"),
                                         (F.col("id") % 2).alias("b"), F.lit(1).cast("long").alias("length"), F.col("id").alias("c"))
        digests = {r.b: r.ends_sha256 for r in trie.end_digests(ends).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert digests == {b: hashlib.sha256(",".join(map(str, range(b, 5_000, 2))).encode()).hexdigest() for b in (0, 1)}


def test_explosion_is_bounded_by_the_band(spark, monkeypatch):
    """Totals of a chain of 400 nodes: right, in few rounds."""
    monkeypatch.setattr(trie, "BAND", 4)
    rows = [(0, t, "user", "x") for t in range(400)] + [(1, t, "user", "x") for t in range(399)]
    placed = trie.stored(trie.ordered_turns(spark.createDataFrame(rows, TURNS)), "placed")
    result = {r.depth: r for r in trie.prefix_trie(trie.whole(placed)).collect()}
    assert len(result) == 401
    assert all(result[d].saved_tokens == 399 - max(d, 1) + 1 for d in range(400)) and result[400].saved_tokens == 0


def test_empty_table(spark):
    placed = trie.stored(trie.ordered_turns(spark.createDataFrame([], TURNS)), "placed")
    assert trie.prefix_trie(trie.whole(placed)).collect() == []
