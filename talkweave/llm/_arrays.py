"""Arrow columns as flat numpy arrays, word boundaries and word hashes without per-word Python."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are taken at once from a larger batch; a longer text comes alone.
SLICE_BYTES = 1_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], np.uint64)
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def as_strings(column: pa.Array) -> pa.Array:
    """The column with every null replaced by an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        return pa.array([""] * len(column), pa.string())
    return column.fill_null("") if column.null_count else column


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after the other, and where each starts (one more for the end)."""
    column = as_strings(column)
    wide = pa.types.is_large_string(column.type)
    _, at, data = column.buffers()
    if at is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):
    _trim = None


def released() -> None:
    """Gives memory that is free but held by allocators back to the system: a worker keeps running between tasks, beside others."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about SLICE_BYTES of text, so that temporary arrays stay small."""
    if not batch.num_rows:
        return
    _, offsets = flat(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + SLICE_BYTES, "right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop
    released()


def words(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word (run of non-blank bytes within one text), and the first word of each text.

    blank: which bytes separate words.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    ink = ~blank[data]
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    first = ink.copy()
    first[1:] &= ~ink[:-1] | border[1:n]
    last = ink.copy()
    last[:-1] &= ~ink[1:] | border[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, read eight bytes at a time."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    loads = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    size = ends - starts
    h = mix((loads[starts] & _MASK[np.minimum(size, 8)]) + size.astype(np.uint64) * U(0x9E3779B97F4A7C15))
    left, at = np.flatnonzero(size > 8), 8
    while len(left):
        h[left] = mix(h[left] * U(0x100000001B3) + (loads[starts[left] + at] & _MASK[np.minimum(size[left] - at, 8)]))
        at += 8
        left = left[size[left] > at]
    return h


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start and length, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))
