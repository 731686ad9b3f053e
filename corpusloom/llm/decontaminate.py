"""Benchmark decontamination: approximate passages of test items in documents.

Text and items are compared lower-cased with each run of white space as one space. An
item of n characters may be found with k = floor(n * error_rate) edits. It is split
into k+1 pieces; by the pigeonhole principle every occurrence with at most k edits
has a piece unchanged. All pieces of all items are searched for at once with an
Aho-Corasick automaton over each whole document. Around every hit Myers' bit-parallel
algorithm, on Python's long integers, gives the least edit distance to any part of the
window: first of two or three neighbouring pieces to their share of the budget, which
ends most accidental hits, then of ever larger parts up to the whole item.

Documents are read once and never shuffled. The items' pieces are sent to the tasks in
blocks of at most BLOCK_CHARS characters of items; more items mean more blocks, each of
them one more pass, so no broadcast grows with the benchmark.

Defined results: null or empty texts and items have no matches; an item so short that it
may have no edit is matched exactly, where it neither begins nor ends inside a word;
repeated items and documents are each returned; very long texts are searched whole;
columns of other names are kept by clean_documents and not read otherwise; empty tables
give an empty result.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import words as W
from corpusloom.session import table

ERROR_RATE = 0.1
#: Matchers that a worker process keeps.
MATCHERS = 2
BLOCK_CHARS = 4_000_000
_SPACE = re.compile(r"[\x20\x09-\x0D]+")


def folded(text: str | None) -> str:
    return _SPACE.sub(" ", text or "").strip(" ").lower()


def budget(item: str, error_rate: float) -> int:
    return int(len(item) * error_rate)


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece): k+1 parts of nearly equal length that make up the item."""
    cuts = [i * len(item) // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


def masks(item: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << i
    return out


def myers(n: int, peq: dict[str, int], text: str) -> tuple[int, int]:
    """Least edit distance of a pattern of n characters, of which peq are the masks, to
    any substring of text, and where the first such substring ends (exclusive)."""
    full, top = (1 << n) - 1, 1 << (n - 1)
    pv, mv, score, best, at = full, 0, n, n, 0
    get = peq.get
    for j, c in enumerate(text, 1):
        eq = get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & full
        mh = mh << 1 & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
        if score < best:
            best, at = score, j
    return best, at


def ladder(item: str, parts: list[tuple[int, str]]) -> list[list[tuple[int, int, int, dict[str, int]]]]:
    """For each piece, the nodes above it, lowest first: (offset, length, budget, masks).

    A node of c pieces may have c-1 edits and is split into halves; if it has no more,
    one of its halves keeps its own budget too. So an occurrence of the item shows at
    some piece exactly and at every node above that piece within its budget.
    """
    out: list[list] = [[] for _ in parts]

    def split(first: int, last: int) -> None:
        if last - first < 2:
            return
        start = parts[first][0]
        end = parts[last - 1][0] + len(parts[last - 1][1])
        middle = (first + last) // 2
        split(first, middle)
        split(middle, last)
        node = (start, end - start, last - first - 1, masks(item[start:end]))
        for p in range(first, last):
            out[p].append(node)

    split(0, len(parts))
    return out


def _inside_word(text: str, start: int, end: int) -> bool:
    """Whether text[start:end] begins or ends in the middle of a word."""
    word = lambda i: 0 <= i < len(text) and (text[i].isalnum() or text[i] == "_")
    return (word(start - 1) and word(start)) or (word(end - 1) and word(end))


class Matcher:
    """Finds all items of a block in texts."""

    def __init__(self, items: list[tuple[object, str]], error_rate: float):
        self.items = [(i, t, budget(t, error_rate)) for i, t in items if t]
        self.automaton = ahocorasick.Automaton()
        owners: dict[str, list[tuple[int, int, list]]] = {}
        for n, (_, t, k) in enumerate(self.items):
            parts = pieces(t, k)
            for (offset, piece), above in zip(parts, ladder(t, parts)):
                owners.setdefault(piece, []).append((n, offset, above))
        for piece, own in owners.items():
            self.automaton.add_word(piece, (len(piece), own))
        if owners:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[object, int]]:
        """(item, least distance) of the items that are in the folded text."""
        if not text or not self.items:
            return []
        best: dict[int, int] = {}
        for end, (length, own) in self.automaton.iter(text):
            for n, offset, above in own:
                _, t, k = self.items[n]
                if best.get(n) == 0:
                    continue
                start = end + 1 - length - offset  # of the item, if nothing shifts it
                if not k:
                    if not _inside_word(text, start, start + len(t)):
                        best[n] = 0
                elif start >= 0 and text.startswith(t, start):
                    best[n] = 0
                else:
                    d = k + 1
                    for at, size, most, peq in above:
                        d = myers(size, peq, text[max(0, start + at - most) : start + at + size + most])[0]
                        if d > most:
                            break
                    else:
                        best[n] = min(d, best.get(n, d))
        return [(self.items[n][0], d) for n, d in best.items()]


_MATCHERS: dict[tuple[str, float], Matcher] = {}


def _matcher(name: str, items, error_rate: float) -> Matcher:
    """The block's matcher, of which a worker process keeps a few for all its tasks."""
    key = name, error_rate
    if key not in _MATCHERS:
        while len(_MATCHERS) >= MATCHERS:
            del _MATCHERS[next(iter(_MATCHERS))]
        _MATCHERS[key] = Matcher([(i, t) for i, (_, t) in enumerate(items.value)], error_rate)
    return _MATCHERS[key]


def _matches(name, items, error_rate):
    @W.trimming
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(name, items, error_rate)
        for batch in batches:
            at, found, distance = [], [], []
            for row, text in enumerate(batch.column("__text")):
                for item, d in matcher.find(folded(text.as_py())):
                    at.append(row)
                    found.append(items.value[item][0])
                    distance.append(d)
            rest = batch.drop_columns("__text").take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(found, pa.int64()), pa.array(distance, pa.int32())], names=[*rest.schema.names, "item_id", "distance"])

    return match


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[object, str]]]:
    block, size = [], 0
    rows = benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t")).where("t is not null")
    for r in rows.toLocalIterator():  # a partition at a time
        t = folded(r["t"])
        if block and size + len(t) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        if t:
            block.append((r["i"], t))
            size += len(t)
    if block:
        yield block


def leaks(docs: DataFrame, benchmark: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text", item_id: str = "item_id", item_text: str = "text", error_rate: float = ERROR_RATE) -> DataFrame:
    """One row for each document and item found in it: keys, item_id, distance."""
    narrow = docs.select(*keys, F.col(text).alias("__text"))
    schema = T.StructType([*(f for f in narrow.schema.fields if f.name != "__text"), T.StructField("item_id", T.LongType()), T.StructField("distance", T.IntegerType())])
    out = None
    for block in _blocks(benchmark, item_id, item_text):
        sent = docs.sparkSession.sparkContext.broadcast(block)
        part = narrow.mapInArrow(_matches(uuid.uuid4().hex, sent, error_rate), schema)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", error_rate: float = ERROR_RATE) -> DataFrame:
    """docs without those in which an item is found; all columns as they were."""
    out = docs
    for block in _blocks(benchmark, "item_id", "text"):
        sent = docs.sparkSession.sparkContext.broadcast(block)
        out = out.mapInArrow(_kept(uuid.uuid4().hex, sent, text, error_rate), docs.schema)
    return out


def _kept(name, items, text, error_rate):
    @W.trimming
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(name, items, error_rate)
        for batch in batches:
            yield batch.filter(pa.array([not matcher.find(folded(t.as_py())) for t in batch.column(text)], pa.bool_()))

    return keep


def op8_edit_matches(spark, sf_dir):
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
