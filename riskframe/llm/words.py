"""Vectorised words, word hashes and n-gram hashes of Arrow text columns.

A word is a maximal run of bytes other than space and tab..carriage return
(``[^\\x20\\x09-\\x0D]+``); UTF-8 never uses those bytes inside another
character, so working on bytes is exact.  Hashes are 64-bit polynomials over
bytes (or over word hashes) followed by a bit mixer, and depend on nothing but
the text, so every executor and every retry computes the same values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_GRAM = np.uint64(0xD6E8FEB86659FD93)
_GRAM_INV = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
_tables: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept per process and grown on demand."""
    have = _tables.get(int(base))
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _tables[int(base)] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser (shift-xor-multiply) over uint64."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets): one entry per row, NULL as an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    buffers = column.buffers()
    offs = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if buffers[2] is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(buffers[2], np.uint8)[offs[0]:offs[-1]], offs - offs[0]


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and each row's first word index (rows + 1 entries)."""
    solid = (data != 32) & ((data < 9) | (data > 13))
    n = len(data)
    opens, closes = solid.copy(), solid.copy()
    if n:
        opens[1:] &= ~solid[:-1]
        closes[:-1] &= ~solid[1:]
        first = offs[:-1][offs[:-1] < offs[1:]]
        last = offs[1:][offs[:-1] < offs[1:]] - 1
        opens[first] = solid[first]
        closes[last] = solid[last]
    start = np.flatnonzero(opens)
    return start, np.flatnonzero(closes) + 1, np.searchsorted(start, offs)


def word_hashes(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, row offsets into it); ``lower`` folds A-Z only."""
    data, offs = text_bytes(column)
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    start, end, rows = word_spans(data, offs)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), out=total[1:])
    h = (total[end] - total[start]) * _powers(_BASE_INV, len(data) + 1)[start]
    return mix(h ^ ((end - start).astype(np.uint64) << np.uint64(40))), rows


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Rolling (Rabin-Karp) hash of the n words from each position; positions that lack n words are absent.

    Windows run across row borders: callers keep those inside a row (``inside``).
    """
    if len(words) < n:
        return np.empty(0, np.uint64)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * _powers(_GRAM, len(words)), out=total[1:])
    return mix((total[n:] - total[:-n]) * _powers(_GRAM_INV, len(words) + 1)[:len(words) - n + 1])


def window_starts(rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Global starts of all n-word windows inside rows, and the row of each."""
    count = np.maximum(np.diff(rows) - n + 1, 0)
    row = np.repeat(np.arange(len(count)), count)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    return rows[:-1][row] + inner, row


def slices(batches, column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``limit`` bytes in each (one row at least)."""
    for batch in batches:
        text = batch.column(batch.schema.get_field_index(column))
        size = pc.binary_length(text).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        which = np.cumsum(size) // limit
        edge = [0, *(np.flatnonzero(np.diff(which)) + 1).tolist(), len(batch)]
        for a, b in zip(edge, edge[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def to_planes(values: np.ndarray, dtype: str) -> bytes:
    """Integers as byte planes: all lowest bytes, then all second bytes ... (zero planes compress to nothing)."""
    return np.ascontiguousarray(values, dtype).view(np.uint8).reshape(len(values), -1).T.tobytes()


def from_planes(blob: bytes, dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.frombuffer(blob, np.uint8).reshape(width, -1).T.copy().view(dtype).ravel()


def edges(key: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of each run of equal values."""
    if not len(key):
        return []
    at = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
    return list(zip(at, at[1:]))


def by_part(batches, settle):
    """Packed rows arrive sorted by ``part``; hand all rows of a part to ``settle`` together."""
    held, now = [], None
    for b in batches:
        part = b.column("part").to_numpy()
        for s, e in edges(part):
            if held and part[s] != now:
                yield settle(int(now), [r for x in held for r in x.to_pylist()])
                held = []
            held.append(b.slice(s, e - s))
            now = part[s]
    if held:
        yield settle(int(now), [r for x in held for r in x.to_pylist()])
