"""Texts of an Arrow batch as one byte array: word and shingle hashes without Python objects.

Spark hands ``mapInArrow`` a column of UTF-8 texts as one buffer with offsets; everything here
works on such a buffer with whole-array numpy steps, a bounded slice of rows at a time.
Hashes are 64-bit; they are the same in every task and session.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once (a single longer text is a slice of its own).
SLICE_BYTES = 1 << 20
U64 = np.uint64
_TABLE = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=U64) | U64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finaliser."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def slices(data: np.ndarray, offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of consecutive rows of about ``most`` bytes."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def _powers(n: int, base: int, cache: dict = {}) -> np.ndarray:  # noqa: B006 - kept between calls on purpose
    have = cache.get(base)
    if have is None or len(have) < n:
        out = np.full(1 << max(20, int(n).bit_length()), base, U64)
        out[0] = 1
        cache[base] = have = np.multiply.accumulate(out)
    return have[:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = sum of table[byte] * base^position over i..j-1, modulo 2^64."""
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(_TABLE[data] * _powers(len(data), _BASE), out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span, wherever it lies."""
    back = _powers(len(sums), _BACK)
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(U64))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each text and their number) of runs without ASCII white space."""
    n = len(data)
    full = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[1:], after[:-1] = full[:-1], full[1:]
    if n:
        before[0] = after[-1] = False
    starts = np.flatnonzero(full & (~before | edge[:-1]))
    ends = np.flatnonzero(full & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, A-Z lower-cased; index of each text's first word, then the total)."""
    low = _LOWER[data]
    starts, ends, first = words(low, offsets)
    return span_hashes(prefix_sums(low), starts, ends), first


def shingles(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, index of each text's first shingle): all runs of ``size`` words of a text; a
    shorter text that has words is one shingle."""
    counts = np.diff(first)
    number = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    at = np.concatenate([[0], np.cumsum(number)])
    where = np.repeat(first[:-1] - at[:-1], number) + np.arange(at[-1])
    length = np.repeat(np.minimum(counts, size), number)
    padded = np.concatenate([hashes, np.zeros(size, U64)])
    out = np.zeros(len(where), U64)
    for j in range(size):
        out = np.where(j < length, mix(out + U64(_BASE)) + padded[where + j], out)
    return mix(out + length.astype(U64)), at


def distinct(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each group's sorted distinct values, and their new bounds."""
    parts = [np.unique(values[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return (np.concatenate(parts) if parts else values[:0]), bounds


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> pa.Array:
    """The texts made of given words, one space between them. ``first``: index of each text's first word, then the total."""
    size = ends - starts
    last = np.zeros(len(size), bool)
    last[first[1:][np.diff(first) > 0] - 1] = True
    room = size + ~last
    to = np.concatenate([[0], np.cumsum(room)])
    out = np.full(int(to[-1]), 32, np.uint8)
    before = np.cumsum(size) - size
    step = np.arange(int(size.sum()))
    out[step + np.repeat(to[:-1] - before, size)] = data[step + np.repeat(starts - before, size)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first) - 1,
                                            [None, pa.py_buffer(to[first].astype(np.int64).tobytes()), pa.py_buffer(out)]).cast(pa.large_string())
