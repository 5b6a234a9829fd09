"""Token ids in length-delimited binary record files with an offset index.

A shard is a file of frames, one per document, in ascending ``doc_id`` order
within the shard and from shard to shard (nulls first, equal ids by their
text's hash). A frame is, all little-endian::

    u64 payload length | u32 masked crc32 of the length
    payload            | u32 masked crc32 of the payload | 0x0A

    payload: i64 doc_id (0 if null) | u8 doc_id is null | u8 bytes per id
             | u32 number of ids | ids

A checksum is masked by rotating it right by 15 bits and adding ``0xa282ead8``.
Frames reach storage through Spark's own file writer, the frame's last byte
being its record separator: files go to any store Spark writes to, and a task
that is run again replaces its file whole.

The index is a Parquet table ``(shard, doc_id, offset, length, n_tokens)``: a
reader that shuffles picks frames by offset without scanning the shards.

Texts are split at white space. Where the tokenizer's further cuts are known
(``_units``), pieces of Latin letters, digits and signs are split into its words,
folded as it folds them; other pieces stay whole. Each distinct word or piece,
known by a 64-bit hash, is encoded once per memo; the tokenizer cuts at these
places anyway, so the ids are those of the whole text. Ids are gathered for many
texts at once.

Defined cases: null texts count as empty and hold the end id alone; a text longer
than ``CHUNK`` is encoded in parts; rows that repeat are records of their own;
extra columns are ignored; an empty table gives no record.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.words import SPACE, STRETCH, hash_spans, parts, released, text_buffers

END_ID = 2
TOKENIZER = "word_bpe_49k.json"
#: Words and pieces of text, and their ids, that a worker remembers before it
#: starts anew, in arrays.
MEMO, MEMO_IDS = 1_000_000, 16_000_000
#: Bytes of text that are encoded together, and of text in a shard.
CHUNK, SHARD_BYTES = STRETCH, 1 << 25

_HEAD = struct.Struct("<QI")
_PAYLOAD = struct.Struct("<qBBI")
_U32 = struct.Struct("<I")


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """One record without its closing separator."""
    length = struct.pack("<Q", len(payload))
    return b"".join((length, _U32.pack(masked_crc(length)), payload, _U32.pack(masked_crc(payload))))


def frames(content: bytes):
    """``(offset, length, payload)`` of each record of a shard, checksums checked."""
    at = 0
    while at < len(content):
        size, crc = _HEAD.unpack_from(content, at)
        if masked_crc(content[at:at + 8]) != crc:
            raise ValueError(f"length checksum differs at byte {at}")
        start = at + _HEAD.size
        payload = content[start:start + size]
        if len(payload) < size or masked_crc(payload) != _U32.unpack_from(content, start + size)[0]:
            raise ValueError(f"payload checksum differs at byte {at}")
        end = start + size + 5
        if content[end - 1:end] != b"\n":
            raise ValueError(f"separator missing at byte {end - 1}")
        yield at, end - at, payload
        at = end


def token_ids(payload: bytes) -> tuple[int | None, np.ndarray]:
    """``doc_id`` and ids of a record's payload."""
    doc_id, null, width, n = _PAYLOAD.unpack_from(payload)
    return (None if null else doc_id), np.frombuffer(payload, f"<u{width}", n, _PAYLOAD.size)


#: A tokenizer whose cuts ``_units`` knows composes and lower-cases, cuts texts into
#: runs of letters, single digits and runs of other characters, spells bytes as
#: characters, and has added tokens only that begin with ``<|``.
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_CUTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Kinds of bytes: white space, letters, digits, other ASCII, and what only the
#: whole tokenizer judges (apostrophes, control characters, other alphabets).
_GAP, _LETTER, _DIGIT, _SIGN, _ODD = range(5)
_KINDS = np.full(256, _ODD, dtype=np.uint8)
_KINDS[33:127] = [_ODD if c == "'" else _LETTER if c.isalpha() else _DIGIT if c.isdigit() else _SIGN
                  for c in map(chr, range(33, 127))]
_KINDS[SPACE] = _GAP
_PIECES = np.where(SPACE, _GAP, _ODD).astype(np.uint8)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Lower case of the Latin letters of two bytes that need no composing.
_LATIN = np.zeros(1 << 11, dtype=np.uint16)
for _c in map(chr, range(0x80, 0x250)):
    if _c.isalpha() and len(_c.lower()) == 1 and ord(_c.lower()) < 1 << 11 and unicodedata.is_normalized("NFC", _c):
        _LATIN[ord(_c)] = ord(_c.lower())
#: The character that stands for each byte in such a vocabulary; blanks stay.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_HIDDEN = [b for b in range(256) if b not in _SHOWN]
_SPELLED = "".join(" " if b == 32 else chr(b if b in _SHOWN else 256 + _HIDDEN.index(b)) for b in range(256))


def _cuts_known(parts: dict) -> bool:
    normalizer, cutter = parts["normalizer"] or {}, parts["pre_tokenizer"] or {}
    steps = cutter.get("pretokenizers") or [{}]
    return (normalizer.get("normalizers") == _NORMALIZER and len(steps) == 2 and not parts["model"].get("dropout")
            and steps[0] == {"type": "Split", "pattern": {"Regex": _CUTS}, "behavior": "Removed", "invert": True}
            and steps[1]["type"] == "ByteLevel" and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
            and all(t["content"].startswith("<|") and not t["normalized"] for t in parts["added_tokens"]))


def _units(data: np.ndarray, offsets: np.ndarray, known: bool):
    """What is encoded by itself in the texts ``data[offsets[i]:offsets[i + 1]]``:
    their bytes, folded in words; hashes, starts and ends there, which ones are
    whole pieces between white space, and how many each text has. Not ``known``:
    all are whole pieces."""
    raw = data[int(offsets[0]):int(offsets[-1])]
    breaks = offsets - offsets[0]
    kinds, folded = (_KINDS if known else _PIECES)[raw], raw
    if known and len(raw):
        folded = _LOWER[raw]
        lead = np.flatnonzero((raw[:-1] >= 0xC2) & (raw[:-1] <= 0xC9))
        follow = raw[lead + 1]
        lower = _LATIN[(raw[lead].astype(np.int64) & 31) << 6 | follow & 63]
        letter = (lower > 0) & (follow & 0xC0 == 0x80)
        lead, lower = lead[letter], lower[letter]
        kinds[lead] = kinds[lead + 1] = _LETTER
        folded[lead], folded[lead + 1] = 0xC0 | lower >> 6, 0x80 | lower & 63
        kinds[:-1][(raw[:-1] == ord("<")) & (raw[1:] == ord("|"))] = _ODD
        odd = kinds == _ODD
        if odd.any():
            word = kinds != _GAP
            first = word.copy()
            first[1:] &= ~word[:-1]
            inside = breaks[breaks < len(raw)]
            first[inside] = word[inside]
            piece = np.cumsum(first)
            has = np.zeros(int(piece[-1]) + 1, dtype=bool)
            has[piece[odd]] = True
            odd = has[piece] & word
            kinds[odd], folded[odd] = _ODD, raw[odd]
    cut = np.ones(len(raw) + 1, dtype=bool)
    cut[1:-1] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == _DIGIT)
    cut[breaks] = True
    edges = np.flatnonzero(cut)
    starts, ends = edges[:-1], edges[1:]
    full = kinds[starts] != _GAP
    starts, ends = starts[full], ends[full]
    counts = np.diff(np.searchsorted(starts, breaks))
    return folded, hash_spans(folded, starts, ends), starts, ends, kinds[starts] == _ODD, counts


class _Places:
    """Numbers of 64-bit hashes, in order of arrival. Open addressing in arrays
    looks up many at once."""

    def __init__(self):
        self._empty(1 << 14)

    def _empty(self, size: int) -> None:
        self.n = 0
        self.keys, self.numbers = np.zeros(size, dtype=np.uint64), np.full(size, -1, dtype=np.int32)

    def __len__(self) -> int:
        return self.n

    def _first(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64(len(self.keys) - 1)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Their numbers, -1 for unknown ones."""
        at = self._first(hashes)
        found = self.numbers[at]
        other = np.flatnonzero((found >= 0) & (self.keys[at] != hashes))
        while len(other):
            at[other] = (at[other] + 1) & (len(self.keys) - 1)
            found[other] = self.numbers[at[other]]
            other = other[(found[other] >= 0) & (self.keys[at[other]] != hashes[other])]
        return found

    def add(self, hashes: np.ndarray) -> None:
        """Number distinct unknown hashes."""
        if 2 * (self.n + len(hashes)) > len(self.keys):
            filled = self.numbers >= 0
            old = self.keys[filled][np.argsort(self.numbers[filled])]
            self._empty(1 << (2 * (self.n + len(hashes))).bit_length())
            self.add(old)
        at, numbers = self._first(hashes), np.arange(self.n, self.n + len(hashes), dtype=np.int32)
        left = np.arange(len(hashes))
        while len(left):
            free = left[self.numbers[at[left]] < 0]
            self.numbers[at[free]] = numbers[free]
            placed = self.numbers[at[left]] == numbers[left]
            self.keys[at[left[placed]]] = hashes[left[placed]]
            left = left[~placed]
            at[left] = (at[left] + 1) & (len(self.keys) - 1)
        self.n += len(hashes)


class _Encoder:
    """Whole texts to packed ids, through a memo of words and pieces."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.known = _cuts_known(json.loads(self.tokenizer.to_str()))
        self.forget()

    def encoded(self, folded: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                whole: np.ndarray) -> tuple[list[int], list[int]]:
        """Ids of the units and where each one's end. Words go to the tokenizer's
        model, which is what it gives them to; whole pieces through all of it."""
        text = folded.tobytes()
        units = [text[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        pieces = [u.decode() for u, w in zip(units, whole.tolist(), strict=True) if w]
        words = [u for u, w in zip(units, whole.tolist(), strict=True) if not w]
        ids, stops, tokenize = [], [], self.tokenizer.model.tokenize
        for word in b" ".join(words).decode("latin-1").translate(_SPELLED).split(" ") if words else []:
            ids += [token.id for token in tokenize(word)]
            stops.append(len(ids))
        for found in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False):
            ids += found.ids
            stops.append(len(ids))
        return ids, stops

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts ``data[offsets[i]:offsets[i + 1]]`` one after another,
        and how many each has."""
        if self.places.n > MEMO or self.stops[self.places.n] > MEMO_IDS:
            self.forget()
        folded, hashes, starts, ends, whole, counts = _units(data, offsets, self.known)
        rows = self.places.find(hashes)
        missing = np.flatnonzero(rows < 0)
        if len(missing):
            new, first = np.unique(hashes[missing], return_index=True)
            at = missing[first]
            order = np.argsort(whole[at], kind="stable")  # words first, as ``encoded`` gives them
            new, at = new[order], at[order]
            self._remember(new, *self.encoded(folded, starts[at], ends[at], whole[at]))
            rows[missing] = self.places.find(hashes[missing])
        begins = self.stops[rows]
        sizes = self.stops[rows + 1] - begins
        until = np.concatenate([[0], np.cumsum(sizes)])
        shift = np.repeat(begins - until[:-1], sizes)
        edges = until[np.concatenate([[0], np.cumsum(counts)])]
        return self.flat[shift + np.arange(len(shift))], np.diff(edges)

    def forget(self) -> None:
        self.places = _Places()
        self.stops = np.zeros(1 << 12, dtype=np.int64)
        self.flat = np.zeros(1 << 14, dtype=f"<u{self.width}")

    def _remember(self, hashes: np.ndarray, ids: list[int], stops: list[int]) -> None:
        n, used = self.places.n, int(self.stops[self.places.n])
        self.places.add(hashes)
        if self.places.n >= len(self.stops):
            self.stops = np.resize(self.stops, 2 * self.places.n)
        if used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * (used + len(ids)))
        self.stops[n + 1:self.places.n + 1] = np.array(stops, dtype=np.int64) + used
        self.flat[used:used + len(ids)] = ids


_encoders: dict[str, _Encoder] = {}


def _encoded(path: str, batches):
    if path not in _encoders:
        _encoders[path] = _Encoder(path)
    encoder = _encoders[path]
    kind = f"<u{encoder.width}"
    end = np.array([END_ID], dtype=kind).tobytes()
    for batch in released(batches):
        doc_ids = batch.column(0).to_pylist()
        data, offsets = text_buffers(batch.column(1))
        out, open_parts, last = [], [], 0

        def close(upto):
            """Frames of texts before ``upto``: one text may have been read in parts."""
            nonlocal last, open_parts
            for k in range(last, upto):
                ids = b"".join(open_parts if k == last else []) + end
                head = _PAYLOAD.pack(doc_ids[k] or 0, doc_ids[k] is None, encoder.width, len(ids) // encoder.width)
                out.append(frame(head + ids))
                open_parts = []
            last = max(last, upto)

        for first, group in parts(data, offsets, CHUNK):
            close(first)
            ids, sizes = encoder.ids(data, group)
            edges = np.concatenate([[0], np.cumsum(sizes)]).tolist()
            for k in range(len(sizes)):
                if k:
                    close(first + k)
                open_parts.append(ids[edges[k]:edges[k + 1]].tobytes())
            if len(out) > 1_000:
                yield pa.RecordBatch.from_arrays([pa.array(out, type=pa.binary())], names=["frame"])
                out.clear()
        close(len(doc_ids))
        yield pa.RecordBatch.from_arrays([pa.array(out, type=pa.binary())], names=["frame"])


def write_records(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Encode ``docs`` (``doc_id``, ``text``) into shards below ``path/records``
    and index them below ``path/index``. ``tokenizer``: a file that every
    worker can read. There are as many shards as the texts fill ``SHARD_BYTES``."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    rows = rows.repartitionByRange(int(size // SHARD_BYTES) + 1, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    encoded = rows.select("doc_id", "text").mapInArrow(lambda batches: _encoded(tokenizer, batches), "frame binary")
    encoded.select(F.col("frame").cast("string")).write.option("lineSep", "\n").text(f"{path}/records")
    _shards(docs.sparkSession, path).mapInArrow(_heads, HEADS).write.parquet(f"{path}/index")


HEADS = "shard int, doc_id long, offset long, length long, n_tokens long"


def _heads(batches):
    """Index rows from the heads of the frames."""
    for batch in released(batches):
        for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            shard, content, rows, at = int(re.search(r"part-(\d+)", name)[1]), content.as_py(), [], 0
            while at < len(content):
                size, _ = _HEAD.unpack_from(content, at)
                doc_id, null, _, n = _PAYLOAD.unpack_from(content, at + _HEAD.size)
                rows.append((shard, None if null else doc_id, at, size + _HEAD.size + 5, n))
                at += size + _HEAD.size + 5
            yield _rows(rows, HEADS)


SCAN = ("shard int, doc_id long, offset long, length long, start_in_shard long, n_tokens long, "
        "ids_crc32 long")


def _scan(batches):
    for batch in released(batches):
        for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            shard = int(re.search(r"part-(\d+)", name)[1])
            rows, start = [], 0
            for offset, length, payload in frames(content.as_py()):
                doc_id, ids = token_ids(payload)
                rows.append((shard, doc_id, offset, length, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                start += len(ids)
                if len(rows) == 10_000:
                    yield _rows(rows, SCAN)
                    rows = []
            yield _rows(rows, SCAN)


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [part.split()[0] for part in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    kinds = [pa.int32()] + [pa.int64()] * (len(names) - 1)
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)], names=names)


def scan_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the shards below ``path``, read back and checked. A
    shard is read whole by one task; Spark's advisory partition size bounds it."""
    return _shards(spark, path).mapInArrow(_scan, SCAN)


def _shards(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/records")
    return files.select("path", "content")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` from the files: ``start`` is the
    number of ids of all documents before this one."""
    rows = scan_records(spark, path)
    sizes = spark.read.parquet(f"{path}/index").groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    bases = sizes.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return rows.join(bases, "shard").select("doc_id", (F.col("base") + F.col("start_in_shard")).alias("start"),
                                            "n_tokens", "ids_crc32")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)
