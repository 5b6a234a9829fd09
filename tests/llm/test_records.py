import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from strata.llm import records
from strata.session import scratch_path
from tests.llm.data import clashing, edge_rows, frame


def expected(rows):
    """``(doc_id, start, n_tokens, crc)`` with whole texts encoded one by one."""
    tokenizer = Tokenizer.from_file(records.tokenizer_path())
    out, start = [], 0
    for doc_id, text in sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [records.END_ID]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


ROWS = [r for r in edge_rows() if r[0] is not None] + [
    (300, "a<|endoftext|>b  it's nb sp \x1cfs\x1d İİ ΣΑΣ é don't", "en", "a", 0), (301, "tab\tnew\nline\x85next", "en", "a", 0)]


@pytest.fixture(scope="module")
def written(spark):
    path = scratch_path(spark, "test-records")
    records.write_records(clashing(frame(spark, ROWS)), path, records.tokenizer_path())
    return path


def test_files_hold_what_the_tokenizer_gives(spark, written):
    found = sorted((tuple(r) for r in records.read_records(spark, written).collect()))
    want = sorted(expected(ROWS))
    assert [(r[0], r[2], r[3]) for r in found] == [(r[0], r[2], r[3]) for r in want]
    assert [r[1] for r in found] == [r[1] for r in want]


def test_index_finds_single_records(spark, written):
    index = spark.read.parquet(f"{written}/index").collect()
    shards = {int(r.path.rsplit("part-", 1)[1][:5]): bytes(r.content) for r in
              spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{written}/records").collect()}
    assert sum(map(len, shards.values())) == sum(r.length for r in index)
    for r in random.Random(1).sample(index, 10):
        (_, length, payload), = records.frames(shards[r.shard][r.offset:r.offset + r.length])
        doc_id, ids = records.token_ids(payload)
        assert (doc_id, len(ids), length) == (r.doc_id, r.n_tokens, r.length)


def test_damage_is_noticed():
    good = records.frame(b"payload") + b"\n"
    assert [p for _, _, p in records.frames(good + good)] == [b"payload"] * 2
    for at in (0, 9, 13, len(good) - 3, len(good) - 1):
        bad = bytearray(good)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            list(records.frames(bytes(bad)))


def test_null_ids_and_empty_table(spark):
    path = scratch_path(spark, "test-records")
    rows = [(None, "some words", "en", "a", 0), (None, None, "en", "a", 0), (3, "x", "en", "a", 0)]
    records.write_records(frame(spark, rows), path, records.tokenizer_path())
    assert sorted((r.doc_id is None, r.n_tokens) for r in records.read_records(spark, path).collect()) == [
        (False, 2), (True, 1), (True, 3)]
    path = scratch_path(spark, "test-records")
    records.write_records(frame(spark, []), path, records.tokenizer_path())
    assert records.read_records(spark, path).count() == 0


def packed(texts):
    """Ids of each text as the tasks give them, and the worker's encoder."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    path = records.tokenizer_path()
    out = [f for b in records._encoded(path, [batch]) for f in b.column(0).to_pylist()]
    return [records.token_ids(p)[1].tolist() for f in out for _, _, p in records.frames(f + b"\n")], records._encoders[path]


def plainly(texts):
    tokenizer = Tokenizer.from_file(records.tokenizer_path())
    return [tokenizer.encode(t, add_special_tokens=False).ids + [records.END_ID] for t in texts]


def test_forms_of_a_word_are_encoded_once(monkeypatch):
    monkeypatch.setattr(records, "_encoders", {})
    signs = [*".,=/\"", "!!", "###", ".%%%"]
    texts = [" ".join(form + sign for form in ("élan", "Élan", "ÉLAN")) for sign in signs] + ["(élan) élan/Élan 2024 4202 20"]
    found, encoder = packed(texts)
    assert found == plainly(texts)
    assert len(encoder.places) == 1 + len(signs) + 2 + 3  # the word, runs of signs with brackets, digits


def test_odd_letters_and_signs(monkeypatch):
    monkeypatch.setattr(records, "_encoders", {})
    letters = [chr(c) for c in [*range(1, 0x600), *range(0x1E00, 0x1F00), 0x2028, 0x3000, 0x4E2D, 0xAC00, 0xFB01, 0x1F600, 0x10400]]
    rng = random.Random(7)
    common = [*"abzAZ09 .,'!#<|> \n", "'s", "'LL", "don't", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "e\u0301", "É", "ß", "İ"]
    texts = [c + "a" + c + "B " + c for c in letters]
    texts += ["".join(rng.choice(common if rng.random() < 0.7 else letters) for _ in range(rng.randrange(40))) for _ in range(4000)]
    found, _ = packed(texts)
    assert [t for t, a, b in zip(texts, found, plainly(texts), strict=True) if a != b] == []


def test_memo_that_starts_anew_and_long_pieces(monkeypatch):
    monkeypatch.setattr(records, "_encoders", {})
    monkeypatch.setattr(records, "MEMO", 50)
    monkeypatch.setattr(records, "CHUNK", 2000)
    rng = random.Random(3)
    words = ["".join(rng.choice("aebtnséü中'") for _ in range(rng.randrange(1, 9))) for _ in range(2000)]
    texts = [" ".join(rng.choices(words, k=rng.randrange(900))) for _ in range(30)] + ["", "aé1" * 3000, "x" * 5000, "中" * 2000 + " end"]
    found, _ = packed(texts)
    assert found == plainly(texts)


def test_places_number_hashes_by_arrival():
    places = records._Places()
    hashes = np.concatenate([np.arange(40_000, dtype=np.uint64) * np.uint64(1 << 14), np.arange(1, 40_000, 7, dtype=np.uint64)])
    hashes = np.unique(hashes)[::-1][:30_000].copy()
    for part in np.array_split(hashes, 9):
        assert (places.find(part) == -1).all()
        places.add(part)
    assert places.find(hashes).tolist() == list(range(len(hashes)))
