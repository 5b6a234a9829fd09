"""Secret scan: fixed forms, and strings that stay novel to a primed compressor.

Fixed forms, leftmost and without overlap within a kind: ``assign`` (a name
such as password or token, ``:`` or ``=``, a value of ``LEAST_VALUE`` characters or more),
``access`` (``AKIA...``, 20 characters or more) and ``hex`` (24 lower-case digits or
more). Matches that are too short go, but they do use up their text.

The method adds ``novel`` spans. A candidate is a run of ``LEAST_NOVEL`` or more
characters of the secret alphabet in a sensitive context: a word such as key,
auth or credential up to ``REACH`` bytes before it on its line. Its novelty is
what zstandard needs for it beyond its surroundings, in bytes a character::

    (size(surroundings + candidate) - size(surroundings)) / length

with the identifiers of the whole corpus as a raw dictionary and ``WINDOW``
bytes from either side as surroundings. Names, paths and repeated values are
matched there and cost little; a string that stays above ``NOVELTY`` and mixes
letters with digits, or lower with upper case, is reported.

The dictionary holds the names that occur most often over all documents, down
to the frequency whose names still fit ``DICTIONARY`` bytes, the commonest last (the compressor reaches the
end most cheaply). Names are letters and ``_`` that stand alone ``NAME_COUNT`` times
or more, so no piece of a key gets in.

Defined cases: a null or empty text holds nothing; rows that repeat give the
same result each; extra columns are ignored; an empty table gives no row and an
empty dictionary. A text is scanned whole, as its UTF-8 bytes; every pattern is
ASCII, so bytes and characters agree, and places are turned into code points
at the end. Equally common names are ordered by themselves.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.components import stored
from strata.llm.words import released, text_buffers

KINDS = ("assign", "access", "hex", "novel")
LEAST_VALUE = 6
LEAST_NOVEL = 16
REACH = 48
WINDOW = 256
#: Bytes a character, for any string and for hexadecimal digits, which hold four bits each.
NOVELTY, NOVELTY_HEX = 0.85, 0.65
#: From this length on a candidate is entropy coded by itself, down to its bits.
CODED, NOVELTY_CODED, NOVELTY_CODED_HEX = 63, 0.72, 0.5
LEVEL = 3
DICTIONARY = 64 * 1024
NAME_BYTES, NAME_COUNT = (4, 32), 3
_HELD = 200_000

#: Over text whose A-Z are lower-cased.
_ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(rb"[0-9a-f]{24,}")
_CONTEXT = re.compile(rb"password|passwd|passphrase|secret|token|credential|auth|bearer|signature"
                      rb"|(?:api|access|private|encryption|signing|client|license|session)[_ -]?(?:key|id)")
_RUN = re.compile(rb"[A-Za-z0-9+/_][A-Za-z0-9+/_.=-]{%d,}[A-Za-z0-9+/_=]" % (LEAST_NOVEL - 2))
_DIGITS = re.compile(rb"[0-9A-Fa-f-]+")
_TOKEN = re.compile(rb"[A-Za-z0-9+/_]{%d,}" % NAME_BYTES[0])
_NAME = re.compile(rb"[A-Za-z_]{%d,%d}" % NAME_BYTES)


def base_spans(data: bytes, lowered: bytes) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed forms, in bytes, sorted."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(lowered) if m.end(1) - m.start(1) >= LEAST_VALUE]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(data)] if b"AKIA" in data else []
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(data)]
    return sorted(found)


class Novelty:
    """Marginal compressed size of strings against identifiers and surroundings."""

    def __init__(self, names: list[bytes]):
        content = b"\n".join(reversed(names))
        # The compressor takes dictionaries of eight bytes and more.
        primed = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(content) > 8 else None
        if primed:
            primed.precompute_compress(level=LEVEL)
        self.zstd = zstandard.ZstdCompressor(level=LEVEL, dict_data=primed, write_content_size=False, write_checksum=False)

    def of(self, data: bytes, start: int, end: int) -> float:
        around = data[max(0, start - WINDOW):start] + data[end:end + WINDOW] + b"\n"
        alone, together = self.zstd.compress(around), self.zstd.compress(around + data[start:end])
        return (len(together) - len(alone)) / (end - start)


def novel(text: bytes, novelty: float) -> bool:
    digits = _DIGITS.fullmatch(text) is not None
    if len(text) < CODED:
        return novelty >= (NOVELTY_HEX if digits else NOVELTY)
    return novelty >= (NOVELTY_CODED_HEX if digits else NOVELTY_CODED)


def mixed(text: bytes) -> bool:
    """A quarter of letters or more, with two digits at least, or changing case all along."""
    letters = sum(65 <= c < 91 or 97 <= c < 123 for c in text)
    digits = sum(48 <= c < 58 for c in text)
    rises = sum(97 <= a < 123 and 65 <= b < 91 for a, b in zip(text, text[1:]))
    return 4 * letters >= len(text) and (digits >= 2 or 6 * rises >= len(text))


def novel_spans(data: bytes, lowered: bytes, base: list[tuple[int, int, int]], novelty: Novelty):
    """``(start, 3, end)`` of candidates beside the spans of ``base`` that compress badly."""
    found, at = [], 0
    for near in _CONTEXT.finditer(lowered):
        line = lowered.find(b"\n", near.end(), near.end() + REACH)
        stop = near.end() + REACH if line < 0 else line
        at = max(at, near.end())
        while (hit := _RUN.search(data, at, stop + LEAST_NOVEL)) and hit.start() < stop:
            run = _RUN.match(data, hit.start())
            start, at = run.span()
            if any(start < b and a < at for a, _, b in base) or not mixed(run[0]):
                continue
            if novel(run[0], novelty.of(data, start, at)):
                found.append((start, 3, at))
    return found


def _names(batches):
    """Counts of names, in rows ``(name, n)``."""
    held: Counter = Counter()

    def flush():
        names = {token: n for token, n in held.items() if _NAME.fullmatch(token)}
        out = pa.RecordBatch.from_arrays(
            [pa.array(list(names), type=pa.binary()), pa.array(list(names.values()), type=pa.int64())], names=["name", "n"])
        held.clear()
        return out

    for batch in released(batches):
        data, offsets = text_buffers(batch.column(0))
        for i in range(len(offsets) - 1):
            text = data[offsets[i]:offsets[i + 1]].tobytes()
            for at in range(0, len(text), 1 << 20):  # a name cut here counts as its pieces
                held.update(_TOKEN.findall(text, at, at + (1 << 20)))
                if len(held) > _HELD:
                    yield flush()
    yield flush()


def identifiers(docs: DataFrame) -> list[bytes]:
    """The commonest names of all documents that fit ``DICTIONARY`` bytes, all of a
    frequency (in eighths of a power of two) or none."""
    counts = docs.filter("text IS NOT NULL").select("text").mapInArrow(_names, "name binary, n long")
    counts = stored(counts.groupBy("name").agg(F.sum("n").alias("n")).filter(F.col("n") >= NAME_COUNT).select(
        "name", "n", F.floor(F.log2("n") * 8).alias("level")), "names")
    levels = counts.groupBy("level").agg(F.sum(F.octet_length("name") + 1).alias("size")).orderBy(F.desc("level")).collect()
    size, least = 0, None
    for row in levels:
        size += row["size"]
        if size > DICTIONARY:
            break
        least = row.level
    if least is None:
        return []
    return [bytes(r.name) for r in counts.filter(F.col("level") >= least).orderBy(F.desc("n"), "name").collect()]


SPANS = "array<struct<kind:string,start:long,end:long,value:string>>"


def _spans(novelty: Novelty, batches):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))
    for batch in released(batches):
        data, offsets = text_buffers(batch.column(1))
        out = []
        for i in range(len(offsets) - 1):
            text = data[offsets[i]:offsets[i + 1]].tobytes()
            lowered = text.lower()
            found = base_spans(text, lowered)
            found = sorted(found + novel_spans(text, lowered, found, novelty))
            out.append(_in_code_points(text, found))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, type=kind)], names=["doc_id", "spans"])


def _in_code_points(text: bytes, spans) -> list[dict]:
    if not spans:
        return []
    edges = sorted({x for start, _, end in spans for x in (start, end)})
    starts = (np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80
    chars, at, place = {}, 0, 0
    for edge in edges:
        place += int(np.count_nonzero(starts[at:edge]))
        chars[edge], at = place, edge
    return [{"kind": KINDS[kind], "start": chars[a], "end": chars[b], "value": text[a:b].decode()} for a, kind, b in spans]


def scanned(docs: DataFrame, names: list[bytes]) -> DataFrame:
    """``(doc_id, spans)`` for every row of ``docs`` (``doc_id``, ``text``): spans with
    ``kind``, ``start`` and ``end`` (code points, end exclusive) and ``value``, by
    start, then kind. ``names``: the dictionary of :func:`identifiers`."""
    shared = docs.sparkSession.sparkContext.broadcast(names)
    return docs.select("doc_id", "text").mapInArrow(
        lambda batches: _spans(Novelty(shared.value), batches), f"doc_id long, spans {SPANS}")


def digest(found: DataFrame) -> DataFrame:
    """Counts per fixed kind, the hash of the fixed spans and all spans as text."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def counted(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return found.select("doc_id", *map(counted, KINDS[:3]), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"), counted("novel"))
