"""Vectorised word hashing over Arrow string columns.

A word is a run of bytes other than space and ``\\t\\n\\v\\f\\r``. Hashing works
on the UTF-8 buffer of an Arrow column: no Python string is made. A word's
hash is the polynomial ``sum(T[byte] * B**i)`` mod 2**64 (random byte table,
odd base), finished by a 64-bit mixer. Prefix sums over a stretch of text give
all word hashes at once: ``(C[end] - C[start]) * B**-start``.

Texts are handled in stretches of about ``STRETCH`` bytes cut at white space,
so memory beside the result stays bounded however long a text is.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

STRETCH = 1 << 18
_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finisher of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def seeds(n: int, start: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    with np.errstate(over="ignore"):
        return mix64((np.arange(n, dtype=_U) + _U(start)) * _U(0x9E3779B97F4A7C15))


_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTES = seeds(256, 1)
_LOWERED = _BYTES.copy()
_LOWERED[65:91] = _BYTES[97:123]
_powers: list[np.ndarray] = []


def word_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, 2 * STRETCH)
        with np.errstate(over="ignore"):
            up = np.full(size, _BASE, dtype=_U)
            down = np.full(size, _INVERSE, dtype=_U)
            up[0] = down[0] = 1
            _powers[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _powers[0], _powers[1]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = _BYTES) -> np.ndarray:
    """Hashes of the spans ``data[starts[i]:ends[i]]``."""
    up, down = word_powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum(table[data] * up[: len(data)], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts])


def _stretch(data: np.ndarray, breaks: np.ndarray, table: np.ndarray, separators: np.ndarray):
    """Hashes, starts and ends of the words of one stretch. ``breaks``:
    positions where a text begins, so no word runs over them."""
    word = ~separators[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    inside = breaks[breaks < len(data)]
    first[inside] = word[inside]
    last = word.copy()
    last[:-1] &= ~word[1:]
    before = inside[inside > 0] - 1
    last[before] = word[before]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return hash_spans(data, starts, ends, table), starts, ends


def _cut(data: np.ndarray, at: int, end: int, stop: int) -> int:
    """Last white space before ``end``, or the next one after a word that
    fills the whole stretch."""
    gaps = np.flatnonzero(SPACE[data[at:end]])
    if len(gaps):
        return at + int(gaps[-1]) + 1
    while end < stop:
        ahead = min(end + STRETCH, stop)
        after = np.flatnonzero(SPACE[data[end:ahead]])
        if len(after):
            return end + int(after[0])
        end = ahead
    return stop


def hash_words(data: np.ndarray, offsets: np.ndarray, lower: bool = True, separators: np.ndarray = SPACE):
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``.

    Returns their hashes, their byte ranges in ``data`` and how many each text
    has. ``lower`` hashes A-Z like a-z. ``separators`` flags the bytes that stand
    between words; white space must be among them.
    """
    table = _LOWERED if lower else _BYTES
    base, stop = int(offsets[0]), int(offsets[-1])
    parts, at = [], base
    with np.errstate(over="ignore"):
        while at < stop:
            end = min(at + STRETCH, stop)
            if end < stop and not SPACE[data[end]]:
                end = _cut(data, at, end, stop)
            inner = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, end)] - at
            h, s, e = _stretch(data[at:end], inner, table, separators)
            parts.append((h, s + at, e + at))
            at = end
    if not parts:
        none = np.zeros(0, dtype=np.int64)
        return np.zeros(0, dtype=_U), none, none, np.zeros(len(offsets) - 1, dtype=np.int64)
    hashes = np.concatenate([p[0] for p in parts])
    starts = np.concatenate([p[1] for p in parts])
    ends = np.concatenate([p[2] for p in parts])
    counts = np.diff(np.searchsorted(starts, offsets))
    return hashes, starts, ends, counts


def released(batches):
    """``batches``, and after the last one unused memory of Arrow's pool and
    the C heap goes back to the system: workers outlive their tasks."""
    yield from batches
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    n = len(column)
    if offsets is None or n == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(n + 1, dtype=np.int64)
    offsets = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data, offsets


def runs(offsets: np.ndarray, limit: int = STRETCH, most: int = 512) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together, of one text at least
    and ``most`` at most."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        j = min(j, n, i + most)
        yield i, j
        i = j


def parts(data: np.ndarray, offsets: np.ndarray, limit: int, separators: np.ndarray = SPACE,
          most: int = 10_000) -> Iterator[tuple[int, np.ndarray]]:
    """``(first, offsets)`` of groups of texts of about ``limit`` bytes together, the
    first text's number and the group's offsets. A text that is longer comes in
    parts cut at ``separators``, each a group of its own with that text's number."""
    for i, j in runs(offsets, limit, most):
        at, stop = int(offsets[i]), int(offsets[j])
        if j > i + 1 or stop - at <= limit:
            yield i, offsets[i:j + 1]
            continue
        while at < stop:
            end = min(at + limit, stop)
            while end < stop and not separators[data[end]]:
                gaps = np.flatnonzero(separators[data[end:end + 4096]])
                end = min(end + (int(gaps[0]) if len(gaps) else 4096), stop)
            yield i, np.array([at, end])
            at = end
