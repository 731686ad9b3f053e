"""Token ids of documents in flat files with Elias-Fano document boundaries.

A file holds a range of documents in ascending order of id, about FILE_IDS ids of them
(a task closes one and begins the next): the ids one after another
in 16 or 32 bits, and the n+1 boundaries, a monotone sequence up to the number of ids,
in Elias-Fano form: floor(log2(u/n)) low bits of each as they are, the rest in unary,
about 2 + log2(u/n) bits a boundary. A directory of set bits, one 32-bit count for each
512 bits, makes select (the i-th boundary) one search and one look at 64 bytes.

    bytes    content, all little-endian
    0-7      magic LOOMEF01
    8-47     documents, ids, low bits, bytes of the upper part, bytes of document ids
    then     lower part, upper part, directory, document ids, token ids

Texts are encoded by the tokenizers library word by word, each distinct word once: the
tokenizer splits at white space, so a text's ids are those of its words in turn.

Defined results: a null or empty text has the end id only; null document ids come
first; documents of one id are ordered by the hash of their text; repeated rows are each
written; a very long text is one document of one file; other columns are not read; an
empty table writes no files and gives no rows.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import words as W
from corpusloom.llm.packed import pack, unpack
from corpusloom.session import parts_for, scratch, table
from corpusloom.sources.files import read_bytes, replacing

END_ID = 1
#: A file is closed with the first document that brings it to so many ids.
FILE_IDS = 1 << 24
#: Documents of a file that are read at a time.
READ_DOCS = 1 << 13
MAGIC = b"LOOMEF01"
BLOCK_BITS = 512
NO_ID = -(1 << 63)


class EliasFano:
    """A monotone sequence of integers from 0 to its last one."""

    def __init__(self, low_bits: int, lower: bytes, upper: bytes, directory: np.ndarray, n: int):
        self.low_bits, self.n, self.directory = low_bits, n, directory
        self.lower, self.upper = lower, upper

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        n, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        shifts = np.arange(low_bits, dtype=np.uint64)
        lower = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes()
        at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(-(-(int(at[-1]) + 1 if n else 0) // BLOCK_BITS) * BLOCK_BITS, np.uint8)
        bits[at] = 1
        before = np.cumsum(bits.reshape(-1, BLOCK_BITS).sum(1, dtype=np.int64))
        return cls(low_bits, lower, np.packbits(bits, bitorder="little").tobytes(), np.concatenate([[0], before[:-1]]).astype(np.uint32) if len(before) else np.zeros(0, np.uint32), n)

    def select(self, i: np.ndarray, step: int = 4096) -> np.ndarray:
        """The i-th values. Looks at the directory and at one block for each."""
        i = np.asarray(i, np.int64)
        out = np.empty(len(i), np.int64)
        blocks = np.frombuffer(self.upper, np.uint8).reshape(-1, BLOCK_BITS // 8)
        low = np.frombuffer(self.lower, np.uint8)
        for s in range(0, len(i), step):
            own = i[s : s + step]
            block = np.searchsorted(self.directory, own, side="right") - 1
            ones = np.cumsum(np.unpackbits(blocks[block], axis=1, bitorder="little"), axis=1, dtype=np.int32)
            place = (ones < (own - self.directory[block] + 1)[:, None]).sum(1)
            high = block * BLOCK_BITS + place - own
            at = own[:, None] * self.low_bits + np.arange(self.low_bits)
            bits = (low[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(np.int64) if self.low_bits else np.zeros((len(own), 0), np.int64)
            out[s : s + step] = (high << self.low_bits) + (bits << np.arange(self.low_bits)).sum(1)
        return out


def file_bytes(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """A file's content."""
    ends = EliasFano.encode(np.concatenate([[0], np.cumsum(counts)]))
    wide = int(ids.max(initial=0)) >= 1 << 16
    names = pack(doc_ids)
    head = struct.pack("<5q", len(doc_ids), len(ids) << 1 | wide, ends.low_bits, len(ends.upper), len(names))
    return b"".join([MAGIC, head, ends.lower, ends.upper, ends.directory.astype("<u4").tobytes(), names, ids.astype("<u4" if wide else "<u2").tobytes()])


class TokenFile:
    """A file's documents by position, in ascending order of id."""

    def __init__(self, content: bytes):
        if content[:8] != MAGIC:
            raise ValueError("not a token file")
        n, ids, low_bits, upper, names = struct.unpack_from("<5q", content, 8)
        self.n, self.n_ids, wide = n, ids >> 1, ids & 1
        at = 48
        lower = -(-(n + 1) * low_bits // 8)
        blocks = upper // (BLOCK_BITS // 8)
        low, at = content[at : at + lower], at + lower
        up, at = content[at : at + upper], at + upper
        directory, at = np.frombuffer(content, "<u4", blocks, at), at + 4 * blocks
        self.doc_ids, at = unpack(content[at : at + names], np.int64), at + names
        self.ids = np.frombuffer(content, "<u4" if wide else "<u2", self.n_ids, at)
        self.ends = EliasFano(low_bits, low, up, directory, n + 1)

    def offsets(self, first: int, last: int) -> np.ndarray:
        """Boundaries first..last, both included."""
        return self.ends.select(np.arange(first, last + 1))

    def document(self, i: int) -> np.ndarray:
        a, b = self.offsets(i, i + 1)
        return self.ids[a:b]


def plain(text: bytes) -> bytes:
    """text with A-Z lowered where that cannot change its ids: the tokenizer lowers it
    too, but after composing letters with the marks U+0300 to U+037F, and its special
    tokens are told from others by case."""
    return text if b"\xcc" in text or b"\xcd" in text or b"<|" in text else text.lower()


class WordIds(dict):
    """word -> place in a table of ids, filled by encoding each new word once.

    A worker process keeps one for all its tasks; at most words it starts anew.
    """

    def __init__(self, path: str, most: int = 1 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.new: list[bytes] = []
        self.starts, self.flat = np.zeros(1, np.int64), np.zeros(0, np.int32)

    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self)
        self.new.append(word)
        return i

    def fill(self, step: int = 10_000) -> None:
        lengths, flat = [], [self.flat]
        for i in range(0, len(self.new), step):
            got = [e.ids for e in self.tokenizer.encode_batch_fast([w.decode() for w in self.new[i : i + step]], add_special_tokens=False)]
            lengths.append(np.fromiter(map(len, got), np.int64, len(got)))
            flat.append(np.fromiter(chain.from_iterable(got), np.int32, int(lengths[-1].sum())))
        if self.new:
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate(lengths))])
            self.flat = np.concatenate(flat)
            self.new = []

    def encode(self, texts: list[bytes], end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, how many each has); end closes each text."""
        if len(self) > self.most:
            self.reset()
        parts = []
        for b in texts:
            own = plain(b).split()
            at = np.full(len(own) + (end is not None), -1, np.int32)
            at[: len(own)] = np.fromiter(map(self.__getitem__, own), np.int32, len(own))
            parts.append(at)
        self.fill()
        at = np.concatenate(parts)
        # the end stands after all words' ids, so place -1 is found there
        starts = np.append(self.starts, self.starts[-1] + 1)
        at[at < 0] = len(starts) - 2
        first = starts[at]
        lengths = starts[at + 1] - first
        total = np.cumsum(lengths)
        gather = np.repeat(first - (total - lengths), lengths)
        gather += np.arange(len(gather))
        ids = np.append(self.flat, np.int32(-1 if end is None else end))[gather]
        sums = np.concatenate([[0], total])[np.cumsum([0, *map(len, parts)])]
        return ids, np.diff(sums)


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def _write(folder: str, tokenizer: str):
    @W.trimming
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        names, counts, ids = [], [], []

        def closed() -> pa.RecordBatch:
            nonlocal number
            path, flat = f"{folder}/part-{part:06d}-{number:04d}.tokens", np.concatenate(ids)
            with replacing(path) as out:
                out.write(file_bytes(np.array(names, np.int64), np.concatenate(counts), flat))
            row = {"part": part, "number": number, "path": path, "docs": len(names), "ids": len(flat)}
            number += 1
            for kept in (names, counts, ids):
                kept.clear()
            return pa.RecordBatch.from_pylist([row])

        for batch in batches:
            for first, texts in W.steps(batch, "text"):
                own, n = word_ids(tokenizer).encode(texts, END_ID)
                ids.append(own.astype(np.uint16 if own.max() < 1 << 16 else np.uint32))
                counts.append(n)
                names += [NO_ID if x is None else x for x in batch.column("doc_id").slice(first, len(texts)).to_pylist()]
                if sum(map(len, ids)) >= FILE_IDS:
                    yield closed()
        if names:
            yield closed()

    return write


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", parts: int | None = None) -> list[dict]:
    """Encode and write; the files' part, number, path, docs and ids in ascending order."""
    n = parts or parts_for(docs)
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), W.as_bytes(text).alias("text"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("tie"))
    dealt = narrow.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    files = dealt.mapInArrow(_write(folder, tokenizer), "part long, number long, path string, docs long, ids long").collect()  # one row a file
    return sorted((r.asDict() for r in files), key=lambda r: (r["part"], r["number"]))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            f = TokenFile(read_bytes(row["path"]))
            for first in range(0, f.n, READ_DOCS):  # a block's boundaries are looked up at a time
                last = min(f.n, first + READ_DOCS)
                ends, own = f.offsets(first, last), f.doc_ids[first:last]
                crc = [zlib.crc32(f.ids[a:b].astype("<u4").tobytes()) for a, b in zip(ends, ends[1:])]
                names = pa.array(own, mask=own == NO_ID)
                yield pa.RecordBatch.from_arrays([names, pa.array(ends[:-1] + row["start"]), pa.array(np.diff(ends)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_files(spark, files: list[dict]) -> DataFrame:
    """One row for each document: doc_id, start over all files, n_tokens, ids_crc32."""
    rows, start = [], 0
    for f in files:
        rows.append((f["path"], start))
        start += f["ids"]
    listed = spark.createDataFrame(rows, "path string, start long").repartition(max(1, len(rows)))
    return listed.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op7_elias_fano(spark, sf_dir, tokenizer: str | None = None):
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    folder = scratch(spark, "tokens")
    return read_token_files(spark, write_token_files(table(spark, sf_dir, "documents"), folder, tokenizer))
