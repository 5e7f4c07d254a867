"""Arrow text columns as numpy byte slices, and vectorised word hashing."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The white space that ends a word: space and bytes 9 to 13.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

#: Words longer than this are hashed one by one.
LONG_WORD = 256
_LOW = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def flat(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow array; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    kind = np.int64 if wide else np.int32
    if offs is None or len(col) == 0:
        return np.empty(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offsets = np.frombuffer(offs, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def released(batches: Iterable) -> Iterator:
    """The batches of a task; when they are done, memory that the worker has
    freed goes back to the system, since workers live on between stages."""
    yield from batches
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges that hold about ``limit`` bytes each, one row at least."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply, wrapping)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each byte of an array on, as one word (zeros behind the end)."""
    raw = np.concatenate([np.ascontiguousarray(data).view(np.uint8), np.zeros(8, np.uint8)])
    return np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))


def packed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: int) -> list[np.ndarray]:
    """The spans' bytes as columns of 64-bit words, zeros behind their ends.
    With its length this is the whole span, if it has no more bytes."""
    eight, out = eights(data), []
    at, left = starts * data.itemsize, (ends - starts) * data.itemsize
    for k in range(words):
        column = np.zeros(len(starts), np.uint64)
        here = np.flatnonzero(left > 8 * k)
        column[here] = eight[at[here] + 8 * k] & _LOW[np.minimum(left[here] - 8 * k, 8)]
        out.append(column)
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of all words of the rows of one slice.

    ``data`` and ``offsets`` are as from :func:`flat`, cut to the slice.  A
    word ends at white space and at the end of its row.
    """
    n = len(data)
    if n == 0:
        return (np.empty(0, np.int64),) * 3
    word = ~SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | edge[1:n]
    end = word.copy()
    end[:-1] &= ~word[1:] | edge[1:n]
    starts = np.flatnonzero(start)
    ends = np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each span of bytes, the same wherever it stands.

    Eight bytes at a time go through a finaliser that is not linear, so texts
    of a regular make do not collide by algebra.  Who must not be able to write
    colliding words draws a ``seed`` for each run.
    """
    size = ends - starts
    with np.errstate(over="ignore"):
        h = mix(size.astype(np.uint64) ^ mix(np.array([seed & (1 << 64) - 1], np.uint64)))
        eight, live, k = eights(data), np.flatnonzero((size > 0) & (size <= LONG_WORD)), 0
        while len(live):
            block = eight[starts[live] + 8 * k] & _LOW[np.minimum(size[live] - 8 * k, 8)]
            h[live] = mix((h[live] + np.uint64(0x9E3779B97F4A7C15)) ^ mix(block + np.uint64(0xD6E8FEB86659FD93)))
            k += 1
            live = live[size[live] > 8 * k]
    key = (seed & (1 << 64) - 1).to_bytes(8, "little")
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        h[i] = int.from_bytes(blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8, key=key).digest(), "little")
    return h


def shingle_hashes(words: np.ndarray, row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of all runs of ``size`` words; a row of fewer words, one at
    least, has one shingle of all its words."""
    n = len(words)
    if n == 0:
        return words, row
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        same = np.ones(n, bool)
        for k in range(size):
            shifted = np.zeros(n, np.uint64)
            at = np.full(n, -1, row.dtype)
            shifted[: max(0, n - k)] = words[k:]
            at[: max(0, n - k)] = row[k:]
            here = at == row
            h = np.where(here, mix(h * np.uint64(0xD6E8FEB86659FD93) + shifted + np.uint64(k)), h)
            same &= here
        first = np.ones(n, bool)
        first[1:] = row[1:] != row[:-1]
        keep = same | (first & ~same)
        return h[keep], row[keep]
