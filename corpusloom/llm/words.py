"""Words, word hashes and shingles of whole batches of texts, as numpy arrays.

A word is a maximal run of characters other than space and \\x09-\\x0D, which is
what bytes.split() yields; lower-casing touches A-Z only, as bytes.lower() does.
Texts come from Spark as binary, so nothing is decoded.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from contextlib import suppress
from functools import wraps

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step takes; longer texts go alone.
STEP = 4 << 20
#: Distinct words a task keeps hashed; then the table starts anew.
VOCABULARY = 1 << 18
MIX1, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def trimming(step):
    """step, giving the memory that it frees back when its task ends: worker processes
    live on, and the C library keeps what is freed."""

    @wraps(step)
    def run(*args):
        yield from step(*args)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):  # another C library has no such call
            ctypes.CDLL("libc.so.6").malloc_trim(0)

    return run


def as_bytes(text: str | Column) -> Column:
    """The UTF-8 of a text column; null is empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


class Words(dict):
    """word -> 64-bit hash, computed once for each distinct word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= VOCABULARY:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def steps(batch: pa.RecordBatch, text: str) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of a batch in pieces of about STEP bytes."""
    column, start, size, out = batch.column(text), 0, 0, []
    for i in range(batch.num_rows):
        b = column[i].as_py() or b""
        if out and size + len(b) > STEP:
            yield start, out
            start, size, out = i, 0, []
        out.append(b)
        size += len(b)
    if out:
        yield start, out


def hashed(texts: list[bytes], vocabulary: Words, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """All words' hashes one after another, and each text's number of words."""
    counts = np.zeros(len(texts), np.int64)
    get, parts = vocabulary.__getitem__, []
    for i, b in enumerate(texts):
        words = (b.lower() if lower else b).split()
        counts[i] = len(words)
        parts.append(np.fromiter(map(get, words), np.uint64, len(words)))
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), counts


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that sums and products of hashes stay well spread."""
    h = h.copy()
    h ^= h >> np.uint64(29)
    h *= MIX2
    h ^= h >> np.uint64(32)
    h *= MIX1
    h ^= h >> np.uint64(31)
    return h


def windows(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each n-word window that lies in one text, and that text's index."""
    owner = np.repeat(np.arange(len(counts)), counts)
    if len(words) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    m = len(words) - n + 1
    h = np.zeros(m, np.uint64)
    for k in range(n):
        h = (h + words[k : k + m]) * MIX1
        h ^= h >> np.uint64(32)
    inside = owner[:m] == owner[n - 1 :]
    return mixed(h[inside]), owner[:m][inside]


def shingle_sets(texts: list[bytes], vocabulary: Words, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-word shingles of each text, sorted, one text after another, and
    the size of each set. A text of fewer words has its whole sequence as one."""
    words, counts = hashed(texts, vocabulary)
    h, owner = windows(words, counts, n)
    sizes = np.bincount(owner, minlength=len(texts)).astype(np.int64)
    few = np.flatnonzero((counts > 0) & (counts < n))
    if len(few):
        starts = np.cumsum(counts) - counts
        whole = [xxhash.xxh3_64_intdigest(words[starts[i] : starts[i] + counts[i]].tobytes(), seed=int(counts[i])) for i in few]
        h = np.insert(h, (np.cumsum(sizes) - sizes)[few], np.array(whole, np.uint64))
        sizes[few] = 1
    ends = np.cumsum(sizes)
    for a, b in zip((ends - sizes).tolist(), ends.tolist()):
        if b - a > 1:
            h[a:b].sort()  # a text's own, in place: much cheaper than one sort by both
    if len(h):
        owner = np.repeat(np.arange(len(texts)), sizes)
        first = np.ones(len(h), bool)
        first[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        h, sizes = h[first], np.bincount(owner[first], minlength=len(texts)).astype(np.int64)
    return h, sizes
