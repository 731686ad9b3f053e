"""Numpy arrays as compressed binary cells, and keyed rows dealt to buckets.

Counting n-grams or matching signatures row by row costs the JVM about a microsecond
and thirty bytes a row. Here a task sends, for each bucket of hashes, one row with a
sorted array, so a shuffle moves a few bytes for each distinct entry.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def pack(a: np.ndarray) -> bytes:
    """a with its bytes by significance (which makes them compressible) under zstd."""
    a = np.ascontiguousarray(a)
    planes = a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() if len(a) else b""
    return np.int64(len(a)).tobytes() + (pa.Codec("zstd", compression_level=3).compress(planes, asbytes=True) if planes else b"")


def unpack(cell: bytes, dtype) -> np.ndarray:
    dtype, n = np.dtype(dtype), int(np.frombuffer(cell[:8], np.int64)[0])
    if not n:
        return np.zeros(0, dtype)
    planes = pa.decompress(cell[8:], decompressed_size=n * dtype.itemsize, codec="zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(dtype.itemsize, n).T.copy().view(dtype).reshape(n)


def pack_sorted(a: np.ndarray) -> bytes:
    """An ascending uint64 array, as differences."""
    return pack(np.diff(a, prepend=np.uint64(0)))


def unpack_sorted(cell: bytes) -> np.ndarray:
    return np.cumsum(unpack(cell, np.uint64), dtype=np.uint64)


def bucket_of(h: np.ndarray, n: int) -> np.ndarray:
    """0..n-1 by the upper bits, ascending with h."""
    return ((h >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def dealt(h: np.ndarray, n: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) for an ascending array."""
    cuts = np.searchsorted(bucket_of(h, n), np.arange(n + 1))
    for b in np.flatnonzero(np.diff(cuts)):
        yield int(b), int(cuts[b]), int(cuts[b + 1])
