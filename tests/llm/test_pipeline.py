import random
import sys
from collections import Counter

import corpus_pipeline
from strata.llm import decontam, mixing, neardup, quality
from tests.llm.data import frame, prose
from tests.llm.test_decontam import ITEMS, bench_rows, planted
from tests.llm.test_records import expected


def test_stages_on_a_small_corpus(spark, tmp_path):
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randint(60, 300)), "en", "ab"[i % 2], 0) for i in range(1000, 1060)] + planted(0)[:6]
    rows += [(500 + i, rows[i][1], rows[i][2], "c", 0) for i in range(5)] + [(600, None, None, None, 0), (601, "", "en", "a", 0)]
    docs = frame(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench_rows(), ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()

    # The same decisions from the operators' other outputs, joined in plain Python.
    text = {r[0]: r for r in rows}
    kept = {r.doc_id for r in quality.quality_verdicts(docs).collect() if r.kept}
    left = frame(spark, [text[i] for i in sorted(kept)])
    kept = {r.doc_id for r in neardup.near_duplicates(left).collect() if r.kept}
    left = frame(spark, [text[i] for i in sorted(kept)])
    kept -= {r.doc_id for r in decontam.contaminated(left, spark.createDataFrame(bench_rows(), ITEMS)).collect()}
    left = frame(spark, [text[i] for i in sorted(kept)])
    copies = [text[r.doc_id] for r in mixing.mixed(left, ["doc_id"]).collect() for _ in range(r.mix_copies)]
    assert sorted(map(tuple, out)) == sorted(expected(copies))
    assert not {r.doc_id for r in out} & ({1000, 1001, 1002, 1003, 1004, 600, 601} | {r[0] for r in planted(0)[:6]})
    assert max(Counter(r.doc_id for r in out).values()) <= 3


def test_registered_with_the_library():
    import __spark_entry__ as entry
    names = entry.queries()
    assert [sum(k.startswith(f"op{n}_") for k in names) for n in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)
    assert "corpus_pipeline" in sys.modules
