"""Deleted interpolation: n-gram maximum-likelihood estimates mixed by buckets of the
context's frequency, with weights learned by expectation-maximisation.

The model of order 2 gives token w after u
    P(w|u) = a0/(V+1) + a1 c(w)/N + a2 c(u,w)/c(u),
where (a0, a1, a2) depend on the bucket of log2 c(u). Every training token is counted.
The weights come from deleted counts: one training fold in nine is left out, estimates
are made from the rest, and EM maximises the probability of the fold left out. Its
E-step needs only ratios of the three estimates, so the tokens of that fold are summed
in a histogram of log-ratios (a quarter of a bit each) of bounded size; EM then runs
over that histogram.

Texts become blocks of about BLOCK bytes, each with ids local to it. Blocks send their
distinct n-grams with counts, dealt by hash to buckets, get corpus counts back, and
score their documents: two shuffles of a few bytes for each distinct n-gram of a block
and one of the ids, whatever the frequency of a word. Nothing that grows with the
corpus is broadcast or collected.

Defined results: a null or empty text is one end token; a null id is held out; repeated
rows count each; an empty table gives no rows; without training documents every token
has the uniform probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import words as W
from corpusloom.llm.packed import bucket_of, dealt, pack, pack_sorted, unpack, unpack_sorted
from corpusloom.session import table, written

BLOCK = 14 << 20
#: Tokens whose probabilities are computed at once.
SLICE = 1 << 18
FOLDS, HELD_OUT, DELETED = 10, 0, 1
CONTEXT_BUCKETS = 48
#: Bins of a log-ratio: quarters of a bit, up to 2**±RANGE.
FINE, RANGE = 4, 48
NONE = -FINE * RANGE - 1
ENTRIES = 1 << 20
END, START = np.uint64(0x656E64_656E64), np.uint64(0x737461_727473)
BLOCKS = "block long, doc_id array<long>, folds binary, counts binary, hashes binary, ids binary, entries long"


class _Local(dict):
    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self) + 1
        return i


@W.trimming
def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, fold, text) -> BLOCKS. Local id 0 is the end token, 1.. are words."""
    from pyspark import TaskContext

    first, seq = TaskContext.get().partitionId() << 32, 0
    ids, folds, parts, counts, local, size = [], [], [], [], _Local(), 0

    def row() -> pa.RecordBatch:
        nonlocal seq
        hashes = np.concatenate([[END], np.fromiter(map(xxhash.xxh3_64_intdigest, local), np.uint64, len(local))]).astype(np.uint64)
        flat = np.concatenate(parts)
        # frequent words get small ids, which compress; the end stays 0
        often = np.argsort(-np.bincount(flat, minlength=len(hashes))[1:], kind="stable") + 1
        place = np.zeros(len(hashes), np.int32)
        place[often] = np.arange(1, len(hashes))
        flat, hashes = place[flat], hashes[np.append(0, often)]
        cells = [first + seq, ids, pack(np.array(folds, np.int8)), pack(np.array(counts, np.int64)), pack(hashes), pack(flat), len(hashes) + len(flat)]
        kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 4, pa.int64()]
        seq += 1
        return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)], names=[x.split()[0] for x in BLOCKS.split(", ")])

    for batch in batches:
        for doc_id, fold, text in zip(batch.column("doc_id").to_pylist(), batch.column("fold").to_pylist(), batch.column("text")):
            b = text.as_py()
            if parts and size + len(b) > BLOCK:
                yield row()
                ids, folds, parts, counts, local, size = [], [], [], [], _Local(), 0
            words = b.lower().split()
            tokens = np.zeros(len(words) + 1, np.int32)
            tokens[:-1] = np.fromiter(map(local.__getitem__, words), np.int32, len(words))
            parts.append(tokens)
            ids.append(doc_id)
            folds.append(fold)
            counts.append(len(tokens))
            size += len(b)
    if parts:
        yield row()


class _Block:
    """A block's arrays: tokens, their predecessors (0: start of a text), and folds."""

    def __init__(self, row: dict):
        self.folds, self.counts, self.ids = unpack(row["folds"], np.int8), unpack(row["counts"], np.int64), unpack(row["ids"], np.int32)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)[:-1]]).astype(np.int64)
        before = np.empty(len(self.ids), np.int64)
        before[1:] = self.ids[:-1]
        before[self.starts] = 0  # the end token is no context, so 0 can stand for the start
        self.before, self.width = before, int(self.ids.max()) + 1
        self.fold = np.repeat(self.folds, self.counts)

    def slices(self) -> Iterator[tuple[int, int, slice]]:
        """(first document, last, their tokens), about SLICE tokens at a time."""
        i, ends = 0, self.starts + self.counts
        while i < len(ends):
            j = max(i + 1, int(np.searchsorted(ends, self.starts[i] + SLICE, side="right")))
            yield i, j, slice(int(self.starts[i]), int(ends[j - 1]))
            i = j

    def pairs(self):
        """Distinct (before, token) as one number, and each token's place among them."""
        return np.unique(self.before * self.width + self.ids, return_inverse=True)

    def sums(self, inverse: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Training and deleted occurrences."""
        train = np.bincount(inverse[self.fold != HELD_OUT], minlength=n)
        return train.astype(np.uint32), np.bincount(inverse[self.fold == DELETED], minlength=n).astype(np.uint32)


def _pair_hashes(keys: np.ndarray, width: int, hashes: np.ndarray) -> np.ndarray:
    u = keys // width
    left = np.where(u == 0, START, hashes[u])
    return W.mixed(left * W.MIX1 + W.mixed(hashes[keys % width]))


def _entries(n_buckets: int):
    """Blocks -> rows (order, bucket, block, hashes, train, deleted)."""

    @W.trimming
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block, hashes = _Block(row), unpack(row["hashes"], np.uint64)
                keys, inverse = block.pairs()
                levels = ((1, hashes, block.ids), (2, _pair_hashes(keys, block.width, hashes), inverse))
                for order, h, at in levels:
                    sums, by = block.sums(at, len(h)), np.argsort(h, kind="stable")
                    h = h[by]
                    out = [(order, b, row["block"], pack_sorted(h[i:j]), *(pack(s[by[i:j]]) for s in sums)) for b, i, j in dealt(h, n_buckets)]
                    if out:
                        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["order", "bucket", "block", "hashes", "train", "deleted"])

    return entries


def _answers(rows: pa.Table) -> pa.Table:
    """All blocks' entries of one bucket -> corpus counts for each block, in its order.

    The first row also carries how many tokens and distinct ones the bucket has.
    """
    hs = [unpack_sorted(c.as_py()) for c in rows["hashes"]]
    sizes = [len(h) for h in hs]
    known, at = np.unique(np.concatenate(hs), return_inverse=True)
    own = [np.concatenate([unpack(c.as_py(), np.uint32) for c in rows[name]]) for name in ("train", "deleted")]
    sums = [np.bincount(at, x, len(known)).astype(np.int64) for x in own]
    first = rows["order"][0].as_py() == 1
    base = sums[0] - sums[1]
    stats = np.zeros((4, len(sizes)), np.int64)
    if first:
        stats[:, 0] = sums[0].sum(), (sums[0] > 0).sum(), base.sum(), (base > 0).sum()
    # deleted counts serve the deleted fold's own tokens only; elsewhere 0 does
    answers = (sums[0][at], np.where(own[1] > 0, sums[1][at], 0))
    cells = [[pack(x) for x in np.split(a, np.cumsum(sizes)[:-1])] for a in answers]
    return pa.table({"block": rows["block"], "order": rows["order"], "bucket": rows["bucket"], "train": pa.array(cells[0], pa.binary()), "deleted": pa.array(cells[1], pa.binary())} | {n: pa.array(s) for n, s in zip(STATS, stats)})


STATS = ("tokens", "types", "base_tokens", "base_types")
ANSWERS = "block long, order int, bucket int, train binary, deleted binary, " + ", ".join(f"{n} long" for n in STATS)
COUNTED = "block long, doc_id array<long>, folds binary, counts binary, ids binary, one_train binary, one_deleted binary, two_train binary, two_deleted binary, docs long, base_docs long, " + ", ".join(f"{n} long" for n in STATS)


def _counted(blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """A block with its corpus counts, in the order of its ids and of its pairs."""
    (row,) = blocks.to_pylist()
    block, hashes = _Block(row), unpack(row["hashes"], np.uint64)
    keys, _ = block.pairs()
    out = {n: row[n] for n in ("block", "doc_id", "folds", "counts", "ids")}
    got = sorted(answers.to_pylist(), key=lambda a: (a["order"], a["bucket"]))
    for order, name, h in ((1, "one", hashes), (2, "two", _pair_hashes(keys, block.width, hashes))):
        by = np.argsort(h, kind="stable")
        for kind in ("train", "deleted"):
            counts = np.empty(len(h), np.int64)
            counts[by] = np.concatenate([unpack(a[kind], np.int64) for a in got if a["order"] == order])
            out[f"{name}_{kind}"] = pack(counts)
    out["docs"], out["base_docs"] = int((block.folds != HELD_OUT).sum()), int(((block.folds != HELD_OUT) & (block.folds != DELETED)).sum())
    out |= {n: sum(a[n] for a in got) for n in STATS}
    return pa.table({k: pa.array([v], pa.binary() if isinstance(v, bytes) else pa.list_(pa.int64()) if isinstance(v, list) else pa.int64()) for k, v in out.items()})


def counted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Blocks of documents with the corpus counts of all their n-grams."""
    fold = F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(0)) % FOLDS
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), fold.cast("int").alias("fold"), W.as_bytes(text).alias("text"))
    blocks = written(narrow.mapInArrow(_blocks, BLOCKS), "blocks")
    total = blocks.agg(F.sum("entries")).first()[0] or 0
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / ENTRIES))
    entries = blocks.mapInArrow(_entries(n), "order int, bucket int, block long, hashes binary, train binary, deleted binary")
    answers = entries.groupBy("order", "bucket").applyInArrow(_answers, ANSWERS)
    both = blocks.groupBy("block").cogroup(answers.groupBy("block"))
    return written(both.applyInArrow(_counted, COUNTED), "counted")


def context_bucket(count: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else 1 + floor(log2 count), CONTEXT_BUCKETS-1 at most."""
    return np.minimum(np.where(count > 0, np.frexp(np.maximum(count, 1))[1], 0), CONTEXT_BUCKETS - 1)


class _Estimates:
    """What the tokens' estimates need, from all training counts or without the deleted."""

    def __init__(self, row: dict, totals: dict, base: bool):
        self.block = block = _Block(row)
        _, at = block.pairs()
        minus = 1 if base else 0
        one = unpack(row["one_train"], np.int64) - minus * unpack(row["one_deleted"], np.int64)
        two = unpack(row["two_train"], np.int64) - minus * unpack(row["two_deleted"], np.int64)
        v, docs = (totals[k] for k in (("base_types", "base_docs") if base else ("types", "docs")))
        self.count = one[block.ids]
        self.context = np.where(block.before == 0, docs, one[block.before])
        self.p0 = 1 / (v + 1)
        self.p2 = two[at] / np.maximum(self.context, 1)
        self.bucket = context_bucket(self.context).astype(np.int8)


def _bin(p: np.ndarray, p0: float) -> np.ndarray:
    with np.errstate(divide="ignore"):
        bins = np.clip(np.rint(FINE * np.log2(p / p0)), NONE + 1, FINE * RANGE)
    return np.where(p > 0, bins, NONE).astype(np.int64)


def _histogram(totals: dict):
    @W.trimming
    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                e = _Estimates(row, totals, True)
                own = e.block.fold == DELETED
                cells = np.stack([e.bucket[own], _bin(e.count[own] / max(totals["base_tokens"], 1), e.p0), _bin(e.p2[own], e.p0)])
                cells, n = np.unique(cells, axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cells), pa.array(n, pa.int64())], names=["bucket", "one", "two", "n"])

    return histogram


def learn(cells: np.ndarray, n: np.ndarray, rounds: int = 200) -> np.ndarray:
    """EM: weights of (uniform, unigram, bigram) for each context bucket.

    cells: rows (bucket, bin of p1/p0, bin of p2/p0). A bucket that the deleted fold
    lacks takes the weights of the corpus as a whole.
    """
    ratio = lambda b: np.where(b == NONE, 0.0, 2.0 ** (np.maximum(b, NONE + 1) / FINE))
    weights = np.tile([0.1, 0.4, 0.5], (CONTEXT_BUCKETS, 1))
    p = np.stack([np.ones(len(cells)), ratio(cells[:, 1]), ratio(cells[:, 2])], axis=1) if len(cells) else np.ones((0, 3))

    def em(own: np.ndarray, start: np.ndarray) -> np.ndarray:
        w, q, m = start, p[own], n[own]
        for _ in range(rounds):
            share = q * w
            new = (share / share.sum(1, keepdims=True) * m[:, None]).sum(0) / m.sum()
            if np.abs(new - w).max() < 1e-9:
                break
            w = new
        return w

    if len(cells):
        weights[:] = em(np.ones(len(cells), bool), weights[0])
        for b in np.unique(cells[:, 0]):
            weights[b] = em(cells[:, 0] == b, weights[b])
    # never zero: every token keeps a positive probability; no bigram without a context
    weights = np.maximum(weights, 1e-9)
    weights[0, 2] = 0
    return weights / weights.sum(1, keepdims=True)


def _scores(totals: dict, weights: list[list[float]]):
    w = np.array(weights)

    @W.trimming
    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                e = _Estimates(row, totals, False)
                n, v = totals["tokens"], totals["types"]
                known, base, score = (np.zeros(len(e.block.counts), t) for t in (np.int64, float, float))
                for i, j, own in e.block.slices():
                    a, c = w[e.bucket[own]], e.count[own]
                    p = a[:, 0] * e.p0 + a[:, 1] * c / max(n, 1) + a[:, 2] * e.p2[own]
                    for out, x in ((known, (c > 0).astype(np.int64)), (base, np.log10((c + 0.1) / (n + 0.1 * (v + 1)))), (score, np.log10(p))):
                        out[i:j] = np.add.reduceat(x, e.block.starts[i:j] - own.start)
                columns = [(row["doc_id"], pa.int64()), (e.block.folds == HELD_OUT, pa.bool_()), (e.block.counts, pa.int64()), (known, pa.int64()), (np.full(len(known), n), pa.int64()), (base, pa.float64()), (score, pa.float64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], names=SCORED)

    return scores


SCORED = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def fitted(blocks: DataFrame) -> tuple[dict, np.ndarray]:
    """(totals of the training tokens, weights) of counted() blocks."""
    names = [*STATS, "docs", "base_docs"]
    totals = {k: v or 0 for k, v in blocks.agg(*(F.sum(n).alias(n) for n in names)).first().asDict().items()}
    cells = blocks.mapInArrow(_histogram(totals), "bucket long, one long, two long, n long")
    # at most CONTEXT_BUCKETS * (2 * FINE * RANGE + 2)**2 cells, whatever the corpus
    rows = cells.groupBy("bucket", "one", "two").agg(F.sum("n").alias("n")).toPandas()
    return totals, learn(rows[["bucket", "one", "two"]].to_numpy(np.int64), rows["n"].to_numpy(np.float64))


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: SCORES."""
    blocks = counted(docs, doc_id, text)
    totals, weights = fitted(blocks)
    return blocks.mapInArrow(_scores(totals, weights.tolist()), SCORES)


def op2_deleted_interpolation(spark, sf_dir):
    return score(table(spark, sf_dir, "documents"))
