"""Vectorised text primitives used inside Arrow tasks: words, hashes, windows.

A *word* is a maximal run of ``[^\\x20\\x09-\\x0D]``. All functions work on a
:class:`Flat` view (one contiguous byte buffer for a slice of rows), so the
cost per byte is a few numpy passes and memory is bounded by the slice size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on uint64 (xor-shift / multiply rounds)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * _U(_BASE))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_NORMAL = _LOWER.copy()
_NORMAL[48:58] = 48

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """``base ** i mod 2**64`` for i < n; tables are kept up to 4 Mi entries."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 1 << 22:
            _powers[base] = have
    return have[:n]


def _prefix(codes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * _power(_BASE, len(codes)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span from a prefix table; equal spans get equal hashes."""
    return mix64((prefix[end] - prefix[start]) * _power(_INVERSE, len(prefix))[start])


def with_newline(col: pa.Array) -> pa.Array:
    """Every text (null: empty) followed by one newline, so rows never touch."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    return pc.binary_join_element_wise(col, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))


class Flat:
    """Words of a slice of texts in one byte buffer.

    ``word_from`` / ``word_to`` are byte positions, ``words_of`` the word index
    where each row starts (length rows + 1), ``row_at`` the byte offsets of rows.
    """

    def __init__(self, col: pa.Array, fold: str = "none"):
        col = with_newline(col)
        ends = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + len(col) + 1]
        raw = np.frombuffer(col.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]] if len(col) else np.zeros(0, np.uint8)
        self.rows = len(col)
        self.row_at = ends - (ends[0] if len(ends) else 0)
        self.raw = raw
        self.data = _LOWER[raw] if fold == "lower" else _NORMAL[raw] if fold == "normal" else raw
        self.solid = ~_SPACE[raw]
        edge = np.flatnonzero(self.solid[1:] != self.solid[:-1]) + 1
        if len(raw) and self.solid[0]:
            edge = np.concatenate([[0], edge])
        self.word_from, self.word_to = edge[0::2], edge[1::2]
        self.words_of = np.searchsorted(self.word_from, self.row_at)
        self.n_words = np.diff(self.words_of)

    def byte_prefix(self) -> np.ndarray:
        return _prefix(_BYTE_CODE[self.data])

    def word_hash(self) -> np.ndarray:
        return span_hash(self.byte_prefix(), self.word_from, self.word_to)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.n_words)


def windows(word_hash: np.ndarray, words_of: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(start word, hash) of every window of ``size`` consecutive words inside one row."""
    n = len(word_hash)
    if n < size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    prefix = _prefix(word_hash)
    ok = np.ones(n, dtype=bool)
    row_end = np.repeat(words_of[1:], np.diff(words_of))
    ok = np.arange(n) + size <= row_end
    start = np.flatnonzero(ok)
    return start, span_hash(prefix, start, start + size)


def span_of_words(word_hash: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each word range."""
    return span_hash(_prefix(word_hash), start, end)


def slices(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of about ``limit`` text bytes (a longer text is a slice of its own)."""
    n = batch.num_rows
    if not n:
        return
    size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
    upto = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    at = 0
    while at < n:
        base = upto[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(upto, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def list_column(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the number of values of each row."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))

