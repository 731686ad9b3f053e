"""N-gram Jaccard self-join by PartEnum signatures.

A document's set is its distinct 5-word shingles, hashed to 64 bits. Sizes fall in
bands I_0, I_1, ... with r_i = floor(l_i / 0.8), so linked sets are in one band or in
neighbouring ones. Instance i joins the sets of I_(i-1) and I_i: linked sets there
differ in at most k = floor(2 r_i / 9) shingles. The domain is split by hash into n1
first-level parts of three second-level parts each, and every pair of second-level parts
of one first-level part is a signature: 3 n1 for each set. However k differences fall,
two linked sets have at least 2 n1 - k signatures in common.

Common passages must not make common signatures. A signature is weak if all shingles in
its parts are common, or if it has none. A set with fewer than 2 n1 - k weak signatures
shares a strong one with every set it is linked to, so it sends strong ones only; other
sets (copies of a text that is itself common) send all. Either way no link can be missed:
equal signatures are equally weak. Which shingles count as common is read from a table of
2**CELL_BITS counters, the same for all tasks; it may err without harm.

The sets that share signatures of one least member are a block. Each is compared with
that least member first; verified links make components. In a block with more than one
component the sets outside the largest one are then compared with all others, by size and
by a histogram of the set with about one bin of two bits for each shingle, whose distance
bounds the sets' difference from below (counts cut at three differ by no more than whole
ones) and so excludes all but the nearly linked: first each component and its nearest
one, then all that are left. Members of one component need no
further comparison, so a group of copies costs its size, not its square. What an exact
bound leaves over is verified on the texts.

The links found so far make the components, but are not all. Linked sets are always in
one component, so the number of links compares every two sets of each component: its
sets are dealt to blocks of two chunks, a block gets each text once, and what leaves it
is each set's number of linked documents. No pair is a row. The work is the square of a
component's distinct sets, which is what its links may number.

Sets and classes are told by 128 bits of hash, rows by 64 bits of that of id and text.

Defined results: a null or empty text, or one without words, has an empty set and is
linked with nothing; repeated rows share a class; documents with null ids are matched
but never give a component its id; very long texts are handled whole; other columns are
not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import words as W
from corpusloom.llm.packed import dealt, pack, pack_sorted, unpack, unpack_sorted
from corpusloom.operators.graph import connected_components
from corpusloom.session import table, written

SHINGLE = 5
#: Linked when 100 * intersection >= PERCENT * union; the bands and k follow from it.
PERCENT = 80
CELL_BITS, CELL_CHUNKS = 20, 16
#: A counter is common when it is above its chunk's median by this many times the median
#: deviation, and by LEAST_COMMON: a bound that grows as the root of the input, not as it.
DEVIATIONS, LEAST_COMMON = 8, 64
#: A histogram has the least power of two of bins, in these bounds, that holds the set.
LEAST_BINS, MOST_BINS = 64, 1 << 14
CHUNK = 2000
#: Sets of a component that a chunk of its blocks has, about.
BLOCK = 256
#: Histogram cells that are compared at once.
CELLS = 1 << 23
#: Rounds that compare each component with its nearest one only, before the last.
NEAREST_ROUNDS = 1
BROADCAST_BYTES = 8 << 20
BLOCK_SIGNATURES = 1 << 21
ENTRIES = 1 << 21
#: Sets whose copies a task has sent already, at most; then it forgets them.
SEEN = 1 << 20
_EMPTY = np.uint64(0xA0761D6478BD642F)


@lru_cache(maxsize=1)
def bands(upto: int = 1 << 40) -> np.ndarray:
    """r_0, r_1, ...: the largest size of each band."""
    out = [1]
    while out[-1] < upto:
        out.append((out[-1] + 1) * 100 // PERCENT)
    return np.array(out, np.int64)


def parameters(band: int) -> tuple[int, int]:
    """(k, n1) of an instance; with k = 0 linked sets are equal and need no signature."""
    k = int(bands()[band]) * 2 * (100 - PERCENT) // (100 + PERCENT)
    return k, -(-(k + 1) // 2) + 1 + k // 16


def bins_of(n: np.ndarray) -> np.ndarray:
    """How many bins the histogram of a set of n shingles has; ascends with n."""
    up = np.int64(1) << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64)
    return np.clip(up, LEAST_BINS, MOST_BINS)


@W.trimming
def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, doc_id, text) -> a row for each document, and the task's counters."""
    vocabulary, cells = W.Words(), np.zeros(1 << CELL_BITS, np.int64)
    names = ["kind", "rid", "doc_id", "n", "node", "histogram", "chunk", "cells"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.binary()]

    def rows(kind, count, **columns):
        return pa.RecordBatch.from_arrays([pa.array([kind] * count if x == "kind" else columns.get(x, [None] * count), t) for x, t in zip(names, kinds)], names=names)

    for batch in batches:
        for first, texts in W.steps(batch, "text"):
            h, sizes = W.shingle_sets(texts, vocabulary, SHINGLE)
            cells += np.bincount((h >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=len(cells))
            bins = np.where(sizes > 0, bins_of(sizes), 0)
            upto = np.cumsum(bins)
            at = np.repeat(upto - bins, sizes) + (h & np.repeat((bins - 1).astype(np.uint64), sizes)).astype(np.int64)
            cut = np.minimum(np.bincount(at, minlength=int(upto[-1])), 3).astype(np.uint8).reshape(-1, 4)
            flat = (cut << np.uint8([0, 2, 4, 6])).sum(1, dtype=np.uint8).tobytes()
            ends = np.cumsum(sizes)
            nodes = [node_of(h[e - n : e]) if n else None for e, n in zip(ends, sizes)]
            own = batch.slice(first, len(texts))
            yield rows(0, len(texts), rid=own.column("rid"), doc_id=own.column("doc_id").cast(pa.int64()), n=sizes, node=nodes, histogram=[flat[(u - b) // 4 : u // 4] if b else None for u, b in zip(upto.tolist(), bins.tolist())])
    if cells.any():
        yield rows(1, CELL_CHUNKS, chunk=list(range(CELL_CHUNKS)), cells=[pack(c.astype(np.uint32)) for c in np.split(cells, CELL_CHUNKS)])


def node_of(shingles: np.ndarray) -> bytes:
    """The class of a set: 128 bits of its hash."""
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _common(rows: pa.Table) -> pa.Table:
    """One chunk's counters of all tasks -> which are common, as bits."""
    total = sum(unpack(c.as_py(), np.uint32).astype(np.int64) for c in rows["cells"])
    middle = np.median(total)
    bits = np.packbits(total > middle + max(LEAST_COMMON, DEVIATIONS * np.median(np.abs(total - middle))))
    return pa.table({"chunk": pa.array([rows["chunk"][0].as_py()], pa.int32()), "bits": pa.array([bits.tobytes()], pa.binary())})


def signatures(h: np.ndarray, sizes: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All signatures of the sets, and the index of the set of each."""
    own = np.searchsorted(bands(), sizes)
    out, owners = [], []
    ends = np.cumsum(sizes)
    weak = common[(h >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
    place = W.mixed(h + _EMPTY)
    one, two = [0, 0, 1], [1, 2, 2]
    for band in sorted({int(b) + d for b in np.unique(own[sizes > 0]) for d in (0, 1)}):
        sets = np.flatnonzero((sizes > 0) & ((own == band) | (own == band - 1)))
        k, n1 = parameters(band)
        if not k:
            continue
        n = sizes[sets]
        offsets = np.cumsum(n) - n
        at = np.repeat(ends[sets] - n - offsets, n) + np.arange(n.sum())
        part = np.repeat(np.arange(len(sets)) * (3 * n1), n) + (place[at] % np.uint64(3 * n1)).astype(np.int64)
        total = np.zeros(len(sets) * 3 * n1, np.uint64)
        np.add.at(total, part, place[at] * W.MIX1)
        strong = np.bincount(part[~weak[at]], minlength=len(total)) > 0
        total, strong = total.reshape(-1, 3), strong.reshape(-1, 3)
        strong = (strong[:, one] | strong[:, two]).reshape(len(sets), -1)
        good = 3 * n1 - strong.sum(1) < 2 * n1 - k
        send = (strong | ~good[:, None]).ravel()
        which = np.tile(np.arange(3 * n1), len(sets)).astype(np.uint64)[send]
        both = (W.mixed(total[:, one] + W.MIX2) * W.MIX1 + total[:, two]).ravel()[send]
        sig = W.mixed(both + W.mixed((which + np.uint64(band << 32)) * W.MIX2 + _EMPTY))
        out.append(sig)
        owners.append(np.repeat(sets, 3 * n1)[send])
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(owners)


def _signed(bits: bytes, n_buckets: int):
    """(text) -> (bucket, signatures, tags), a row for each block and bucket. A set's tag
    is the first 64 bits of its node."""

    @W.trimming
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool) if bits else np.zeros(1 << CELL_BITS, bool)
        vocabulary, seen = W.Words(), set()
        parts: list[tuple[np.ndarray, np.ndarray]] = []

        def rows() -> Iterator[pa.RecordBatch]:
            # forty bits of a signature do: an accidental match is a candidate too many
            sig = np.concatenate([p[0] for p in parts]) >> np.uint64(24) << np.uint64(24)
            tags = np.concatenate([p[1] for p in parts])
            parts.clear()
            by = np.argsort(sig, kind="stable")
            sig, tags = sig[by], tags[by]
            for b, i, j in dealt(sig, n_buckets):
                own, place = np.unique(tags[i:j], return_inverse=True)  # each tag once in a row
                columns = [[b], [pack_sorted(sig[i:j] >> np.uint64(24))], [own.tobytes()], [pack(place.astype(np.uint32))]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int32(), pa.binary(), pa.binary(), pa.binary()])], names=["bucket", "signatures", "tags", "places"])

        for batch in batches:
            for first, texts in W.steps(batch, "text"):
                h, sizes = W.shingle_sets(texts, vocabulary, SHINGLE)
                tags = np.zeros(len(texts), np.int64)
                ends, new = np.cumsum(sizes), np.zeros(len(texts), bool)
                if len(seen) > SEEN:
                    seen.clear()
                for i, (e, n) in enumerate(zip(ends, sizes)):
                    if n and (node := node_of(h[e - n : e])) not in seen:
                        seen.add(node)
                        new[i], tags[i] = True, int.from_bytes(node[:8], "big", signed=True)
                h, sizes = h[np.repeat(new, sizes)], np.where(new, sizes, 0)
                sig, owner = signatures(h, sizes, common)
                if len(sig):
                    parts.append((sig, tags[owner]))
                if sum(len(p[0]) for p in parts) >= BLOCK_SIGNATURES:
                    yield from rows()
        if parts:
            yield from rows()

    return signed


def _shared(rows: pa.Table) -> pa.Table:
    """One bucket -> (least, tag): the sets that share a signature, by its least one."""
    sig = np.concatenate([unpack_sorted(c.as_py()) for c in rows["signatures"]])
    tags = np.concatenate([np.frombuffer(t.as_py(), np.int64)[unpack(c.as_py(), np.uint32)] for t, c in zip(rows["tags"], rows["places"])])
    by = np.lexsort((tags, sig))
    sig, tags = sig[by], tags[by]
    starts = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
    sizes = np.diff(np.append(starts, len(sig)))
    least = np.repeat(tags[starts], sizes)
    several = np.repeat(tags[starts] != tags[starts + sizes - 1], sizes)
    least, tags = least[several], tags[several]
    by = np.lexsort((tags, least))
    least, tags = least[by], tags[by]
    first = np.append(True, (least[1:] != least[:-1]) | (tags[1:] != tags[:-1]))[: len(tags)]
    return pa.table({"least": pa.array(least[first]), "tag": pa.array(tags[first])})


def histogram(cell: bytes) -> np.ndarray:
    """The counts, 0 to 3, of a set's bins."""
    return (np.frombuffer(cell, np.uint8)[:, None] >> np.uint8([0, 2, 4, 6]) & np.uint8(3)).ravel()


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A lower bound on the symmetric difference: between each row of a and the vector b.
    Bins are the low bits of a shingle, so a histogram folds onto one of fewer bins."""
    bins = min(a.shape[1], len(b))
    if a.shape[1] > bins:
        a = a.reshape(len(a), -1, bins).sum(1, dtype=np.int16)
    if len(b) > bins:
        b = b.reshape(-1, bins).sum(0, dtype=np.int16)
    return np.abs(a.astype(np.int16) - b).sum(1, dtype=np.int64)


def most(na, nb):
    """The largest symmetric difference of linked sets of these sizes."""
    return (na + nb) * (100 - PERCENT) // (100 + PERCENT)


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(least, a, node, na, nb, ha, hb) -> (least, a, node, near): whether the two may be linked."""
    for batch in batches:
        na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
        keep = 100 * np.minimum(na, nb) >= PERCENT * np.maximum(na, nb)
        last = None
        for i in np.flatnonzero(keep):
            x = batch.column("ha")[i].as_buffer()
            if last is None or x != last[0]:
                last = x, histogram(x)
            keep[i] = distance(last[1][None, :], histogram(batch.column("hb")[i].as_buffer()))[0] <= most(na[i], nb[i])
        yield pa.RecordBatch.from_arrays([*batch.select(["least", "a", "node"]).columns, pa.array(keep)], names=["least", "a", "node", "near"])


def _near_pairs(n: np.ndarray, hist: list[np.ndarray], comp: np.ndarray, rank: np.ndarray, rest: np.ndarray, side: np.ndarray, nearest: bool) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the pairs (of side 0, of side 1) of different components that may be
    linked; of two sets of the rest, that of ascending rank. nearest: for each component
    only its pair of least distance."""
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    right = right[np.argsort(n[right], kind="stable")]
    rn = n[right]
    bins = np.array([len(hist[j]) for j in right])
    classes = [(hist_of, a, b) for a, b in _runs(bins) for hist_of in [np.stack([hist[j] for j in right[a:b]])]]
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for i in left:
        low, high = np.searchsorted(rn, -(-n[i] * PERCENT // 100)), np.searchsorted(rn, n[i] * 100 // PERCENT, side="right")
        for table, a, b in classes:
            lo, hi = max(low, a), min(high, b)
            step = max(1, CELLS // table.shape[1])
            for s in range(lo, hi, step):
                j = np.arange(s, min(hi, s + step))
                own = right[j]
                j = j[(comp[own] != comp[i]) & (~rest[own] | (rank[own] > rank[i]))]
                if not len(j):
                    continue
                d = distance(table[j - a], hist[i])
                near = d <= most(n[i], rn[j])
                out.append((np.full(near.sum(), i), right[j[near]], d[near]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x, y, d = (np.concatenate(c) for c in zip(*out))
    if nearest and len(x):
        ends, pair = np.concatenate([comp[x], comp[y]]), np.tile(np.arange(len(x)), 2)
        order = np.lexsort((pair, np.tile(d, 2), ends))
        e = ends[order]
        pick = np.unique(pair[order[np.append(True, e[1:] != e[:-1])]])
        x, y = x[pick], y[pick]
    return x, y


def _runs(a: np.ndarray) -> list[tuple[int, int]]:
    """(from, to) of the runs of equal values."""
    cuts = [0, *(np.flatnonzero(a[1:] != a[:-1]) + 1).tolist(), len(a)] if len(a) else [0]
    return list(zip(cuts, cuts[1:]))


@W.trimming
def _cross(nearest: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (least, i, j), all of a group in one task -> candidates (a, b)."""
    kept: list[pa.RecordBatch] = []
    sent: set[tuple[bytes, bytes]] = set()

    def group(rows: pa.Table) -> pa.RecordBatch:
        node = rows["node"].to_pylist()
        names = rows["component"].to_pylist()
        code = {c: x for x, c in enumerate(dict.fromkeys(names))}
        rank = np.argsort(np.argsort(np.array(node, object), kind="stable"))
        hist = [histogram(h) for h in rows["histogram"].to_pylist()]
        x, y = _near_pairs(rows["n"].to_numpy(), hist, np.array([code[c] for c in names]), rank, rows["rest"].to_numpy(), rows["side"].to_numpy(), nearest)
        pairs = {(min(node[i], node[j]), max(node[i], node[j])) for i, j in zip(x.tolist(), y.tolist())} - sent
        if len(sent) > SEEN:
            sent.clear()
        sent.update(pairs)
        a, b = zip(*sorted(pairs)) if pairs else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    def done(rows: pa.Table, last: bool) -> tuple[list[pa.RecordBatch], list[pa.RecordBatch]]:
        keys = [rows[c].to_numpy() for c in ("least", "i", "j")]
        number = np.cumsum(np.append(False, np.any([k[1:] != k[:-1] for k in keys], axis=0)))
        runs = _runs(number)
        whole = runs if last else runs[:-1]
        out = [group(rows.slice(s, e - s)) for s, e in whole]
        return [x for x in out if x.num_rows], rows.slice(whole[-1][1] if whole else 0).to_batches()

    for batch in batches:
        if batch.num_rows:
            kept.append(batch)
            out, kept = done(pa.Table.from_batches(kept).combine_chunks(), False)
            yield from out
    if kept and sum(b.num_rows for b in kept):
        yield from done(pa.Table.from_batches(kept).combine_chunks(), True)[0]


@W.trimming
def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, ta, tb) -> (a, b) whose texts' sets are similar enough.

    Texts were found by document id; one that is not its node's is another row's.
    """
    vocabulary = W.Words()

    @lru_cache(maxsize=64)
    def shingles(text: bytes) -> tuple[np.ndarray, bytes]:
        h = W.shingle_sets([text], vocabulary, SHINGLE)[0]
        return h, node_of(h)

    for batch in batches:
        keep = []
        for a, b, x, y in zip(*(batch.column(c) for c in ("a", "b", "ta", "tb"))):
            (x, of_x), (y, of_y) = shingles(x.as_py()), shingles(y.as_py())
            both = len(x) + len(y) - len(np.union1d(x, y))
            keep.append(of_x == a.as_py() and of_y == b.as_py() and 100 * both >= PERCENT * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _bounded(df: DataFrame, row_bytes: int) -> DataFrame:
    """df, to be broadcast if its rows are counted to fit in BROADCAST_BYTES."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(rid, doc_id, text): rid tells rows of different ids or texts apart."""
    return docs.select(_rid(doc_id, text).alias("rid"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"), W.as_bytes(F.col(f"`{text}`")).alias("text"))


def _rid(doc_id: str, text: str) -> Column:
    return F.xxhash64(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`"))


def _verified(pairs: DataFrame, profile: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs that are linked. profile: node, rid; texts: rid, text.

    Only texts of the pairs' nodes leave their scan; each pair's two meet in one shuffle
    on the pair.
    """
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    ids = _bounded(written(profile.select("node", "rid").join(ends, "node"), "ends"), 48)
    own = texts.join(ids, "rid").select("node", "text")
    sent = _bounded(pairs, 64)
    left = own.select(F.col("node").alias("a"), F.col("text").alias("ta")).join(sent, "a")
    right = own.select(F.col("node").alias("b"), F.col("text").alias("tb")).join(sent, "b")
    return left.join(right, ["a", "b"]).select("a", "b", "ta", "tb").mapInArrow(_linked, "a binary, b binary").distinct()


def profiles(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, bytes]:
    """(rid, doc_id, n, node, histogram) of every document, and the common counters."""
    rows = written(_rows(docs, doc_id, text).mapInArrow(_profiles, "kind int, rid long, doc_id long, n long, node binary, histogram binary, chunk int, cells binary"), "profiles")
    of = rows.where("kind = 0").select("rid", "doc_id", "n", "node", "histogram")
    bits = rows.where("kind = 1").select("chunk", "cells").groupBy("chunk").applyInArrow(_common, "chunk int, bits binary")
    return of, b"".join(r["bits"] for r in bits.orderBy("chunk").collect())  # 2**CELL_BITS bits


def links(docs: DataFrame, of: DataFrame, bits: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Verified links (a, b) between nodes; they connect whatever all links connect, and
    link_counts() has the number of all."""
    narrow = _rows(docs, doc_id, text)
    spark = docs.sparkSession
    total = of.agg(F.sum("n")).first()[0] or 0
    n_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total * 0.8 / ENTRIES))
    packed = narrow.select("text").mapInArrow(_signed(bits, n_buckets), "bucket int, signatures binary, tags binary, places binary")
    shared = written(packed.groupBy("bucket").applyInArrow(_shared, "least long, tag long").distinct(), "shared")
    tag = F.conv(F.hex(F.substring("node", 1, 8)), 16, -10).cast("long")
    classes = of.where("n > 0").groupBy("node").agg(F.min("rid").alias("rid"), F.first("n").alias("n"), F.first("histogram").alias("h")).withColumn("tag", tag)
    profile = written(classes.join(shared.select("tag").distinct(), "tag", "left_semi"), "profile")
    own = shared.join(profile.select("tag", "node", F.col("n").alias("nb"), F.col("h").alias("hb")), "tag").drop("tag")
    heads = profile.select(F.col("tag").alias("least"), F.col("node").alias("a"), F.col("n").alias("na"), F.col("h").alias("ha"))
    members = own.join(heads, "least").select("least", "a", "node", "na", "nb", "ha", "hb")
    members = written(members.mapInArrow(_near, "least long, a binary, node binary, near boolean"), "members")
    close = members.where("near and node <> a").select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b"))
    tested = close
    found = written(_verified(tested, profile, narrow), "links")
    label, new = connected_components(found), found
    # a block of two has no pair but that of its least member
    large = members.groupBy("least").agg(F.count(F.lit(1)).alias("members")).where("members > 2").select("least")
    blocks = written(members.join(large, "least").select("least", "node").distinct(), "blocks")
    for turn in range(NEAREST_ROUNDS + 1):
        every = turn == NEAREST_ROUNDS
        pairs = written(_crossed(blocks, label, profile, not every).join(tested, ["a", "b"], "left_anti"), "candidates")
        new = written(_verified(pairs, profile, narrow), "links")
        tested, found = tested.unionByName(pairs), found.unionByName(new)
        if not every and new.head(1):
            label = connected_components(label.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(new))
    return found


def _crossed(blocks: DataFrame, label: DataFrame, profile: DataFrame, nearest: bool) -> DataFrame:
    """Candidate pairs (a, b) of the blocks (least, node).

    Of a block with more than one component, sets outside its largest one meet all its
    sets. Both sides are dealt to chunks of CHUNK sets, so a block's rows are as many as
    its sets while those outside the largest component fit in a chunk."""
    apart = blocks.join(label, "node", "left").select("least", "node", F.coalesce("component", "node").alias("component"))
    counts = apart.groupBy("least", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = counts.groupBy("least").agg(F.sum("n").alias("members"), F.max(F.struct("n", "component")).alias("top"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    chunks = lambda n: F.ceil(n / CHUNK).cast("int")
    mixed = mixed.select("least", F.col("top.component").alias("top"), chunks(F.col("members") - F.col("top.n")).alias("rows"), chunks(F.col("members")).alias("columns"))
    apart = apart.join(mixed, "least").withColumn("rest", F.col("component") != F.col("top"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    columns = ("least", "i", "j", "side", "node", "component", "rest")
    first = apart.where("rest").withColumn("side", F.lit(0)).withColumn("i", own("rows")).withColumn("j", every("columns")).select(*columns)
    second = apart.withColumn("side", F.lit(1)).withColumn("j", own("columns")).withColumn("i", every("rows")).select(*columns)
    full = written(first.unionByName(second), "sides").join(profile.select("node", "n", F.col("h").alias("histogram")), "node")
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt_out = full.select(*columns, "n", "histogram").repartition(parts, "least", "i", "j").sortWithinPartitions("least", "i", "j")
    return dealt_out.mapInArrow(partial(_cross, nearest), "a binary, b binary").distinct()


def _counted(rows: pa.Table) -> pa.Table:
    """A block (node, size, side, text) -> each node's number of linked documents there.

    Blocks of one chunk have side 0 only and every pair; others have pairs of both sides.
    Texts were found by document id; one that is not its node's is another row's."""
    vocabulary, sets, sides, sizes = W.Words(), {}, [], []
    for node, size, side, text in zip(*(rows.column(c).to_pylist() for c in ("node", "size", "side", "text"))):
        if node not in sets and node_of(h := W.shingle_sets([text], vocabulary, SHINGLE)[0]) == node:
            sets[node] = h
            sides.append(side)
            sizes.append(size)
    side, size = np.array(sides, np.int64), np.array(sizes, np.int64)
    n = np.array([len(h) for h in sets.values()], np.int64)
    total = np.zeros(len(n), np.int64)
    if len(n) > 1:
        names, flat = np.unique(np.concatenate(list(sets.values())), return_inverse=True)
        starts, has = np.cumsum(n) - n, np.zeros(len(names), bool)
        both = side.min() != side.max()
        for i in range(len(n)):
            own = flat[starts[i] : starts[i] + n[i]]
            has[own] = True
            common = np.add.reduceat(has[flat], starts, dtype=np.int64)
            has[own] = False
            linked = 100 * common >= PERCENT * (n + n[i] - common)
            linked[i] = False
            total[i] = size[linked & (side != side[i]) if both else linked].sum()
    return pa.table({"node": pa.array(list(sets), pa.binary()), "linked": pa.array(total, pa.int64())})


def link_counts(docs: DataFrame, of: DataFrame, label: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(node, linked): the documents, other than its own copies, that a node is linked with;
    nodes without a component are left out."""
    texts = _rows(docs, doc_id, text).select("rid", "text")
    classes = of.where("n > 0").groupBy("node").agg(F.min("rid").alias("rid"), F.count(F.lit(1)).alias("size"))
    chunks = label.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("chunks"))
    nodes = written(label.join(chunks, "component").join(classes, "node"), "counted")
    full = nodes.join(texts, "rid").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    full = full.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    lo, hi = F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi")
    full = full.select("component", lo, hi, "node", "size", F.when(F.col("mine") == F.col("other"), 0).otherwise(F.when(F.col("mine") < F.col("other"), 0).otherwise(1)).alias("side"), "text")
    counted = full.groupBy("component", "lo", "hi").applyInArrow(_counted, "node binary, linked long")
    return counted.groupBy("node").agg(F.sum("linked").alias("linked"))


def _labelled(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents with component_id and class_id; profiles; nodes' components."""
    of, bits = profiles(docs, doc_id, text)
    label = connected_components(links(docs, of, bits, doc_id, text))
    classes = of.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("class_id"))
    grouped = classes.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = grouped.groupBy("component").agg(F.min("class_id").alias("component_id"))
    known = grouped.join(least, "component").select("node", "class_id", "component_id")
    out = of.join(known, "node", "left")
    return out.select("node", "rid", "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("class_id", "doc_id").alias("class_id")), of, label


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id, class_id (of equal sets)."""
    return _labelled(docs, doc_id, text)[0].drop("node", "rid")


def counted_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """components() and n_links: how many other documents each one is linked with, copies
    included."""
    found, of, label = _labelled(docs, doc_id, text)
    counts = link_counts(docs, of, label, doc_id, text)
    copies = of.where("n > 0").groupBy("node").agg((F.count(F.lit(1)) - 1).alias("copies"))
    out = found.join(copies, "node", "left").join(counts, "node", "left")
    return out.select("doc_id", "n_shingles", "component_id", "class_id", (F.coalesce("copies", F.lit(0)) + F.coalesce("linked", F.lit(0))).alias("n_links"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without the documents whose component has a smaller id; repeated rows of the
    id and text that stay, and documents without id or words, stay as they are. Rows are
    told by id and text, so another text of a dropped row's id stays."""
    found = _labelled(docs, doc_id, text)[0]
    gone = found.where("doc_id <> component_id").select(F.col("rid").alias("__rid")).distinct()
    return docs.join(gone, _rid(doc_id, text) == F.col("__rid"), "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def op5_partenum(spark, sf_dir):
    return components(table(spark, sf_dir, "documents"))


def op5_partenum_links(spark, sf_dir):
    """op5_partenum, whose SQL has no number of links, with the number of links."""
    return counted_components(table(spark, sf_dir, "documents"))
