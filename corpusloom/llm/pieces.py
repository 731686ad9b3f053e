"""SentencePiece BPE encoding with seeded merge-dropout, and lossless decoding.

Encoding starts from single characters. The agenda of a word holds its adjacent pairs
whose union is a piece; the best-scored, leftmost one is merged next. Each candidate is
skipped if a hash keyed by seed, document, the word's position in it and the candidate's
span falls below the dropout rate, so a text's segmentation is a function of (seed,
variant, text), is the same on any executor or retry, and each occurrence of a word is
segmented for itself. A document's variant is a 64-bit hash of its id. With rate 0 the
ids are those of the library.

No piece has a space mark after another character, so the words of a text (with the
spaces before them) are independent. What does not depend on the key is kept: for a word
and the candidates skipped so far, the candidates drawn next if none of them is skipped,
and the pieces that come out then (a node, kept from its second use on). Words of more
than LONG characters are never kept; a heap holds the agenda of each. An occurrence draws its own hash for each
candidate, and the first one that is skipped leads to the next node. New nodes of a batch
are worked out together, one merge of each per step, and so are occurrences without one.

Characters without a piece, and literal space marks (U+2581), become byte pieces, which
makes decoding lossless for every text: it concatenates the pieces' bytes and drops the
one space put in front.

Defined results: a null or empty text has no pieces; a null id has variant 0; repeated
rows get equal results; very long texts and words are encoded whole; other columns than
the keys are not read; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import words as W
from corpusloom.session import table

RATE, SEED = 0.1, 20240229
MARK = "▁"
NEVER = np.int32(2**31 - 1)
WORDS = 1 << 18
#: Occurrences of words that are drawn for at once.
DRAWS = 1 << 15
#: A word with more candidates than this skips some at almost every occurrence, and its
#: occurrences are segmented one by one, by the same hashes, as no node would be met again.
MANY = 64
#: Words of more characters than this are segmented by a heap, one by one.
LONG = 256
_WORD = re.compile(r"\n| *[^ \n]+| +")


class Model:
    """The vocabulary of a SentencePiece BPE model with byte pieces."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i) for i in range(n)]
        self.byte_id = np.zeros(256, np.int32)
        self.bytes = [b""] * n
        for i, name in enumerate(names):
            if sp.is_byte(i):
                self.byte_id[int(name[3:5], 16)] = i
                self.bytes[i] = bytes([int(name[3:5], 16)])
            elif not special[i]:
                self.bytes[i] = name.replace(MARK, " ").encode()
        pieces = {name: i for i, name in enumerate(names) if not special[i]}
        self.chars = {c: i for c, i in pieces.items() if len(c) == 1 and c != MARK} | {" ": pieces[MARK]}
        #: The piece of each code point, or -1.
        self.of_point = np.full(0x110000, -1, np.int32)
        for c, i in self.chars.items():
            self.of_point[ord(c)] = i
        order = sorted(pieces.values(), key=lambda i: (-sp.get_score(i), i))
        rank = np.zeros(n, np.int32)
        rank[order] = np.arange(len(order))
        keys, merged = [], []
        for name, i in pieces.items():
            for cut in range(1, len(name)):
                a, b = pieces.get(name[:cut]), pieces.get(name[cut:])
                if a is not None and b is not None:
                    keys.append(a * n + b)
                    merged.append(i)
        by = np.argsort(keys)
        self.keys, self.merged = np.array(keys, np.int64)[by], np.array(merged, np.int32)[by]
        self.rank = rank
        self._hashed()
        self.piece_size = np.fromiter(map(len, self.bytes), np.int64, n)
        self.piece_start = np.cumsum(self.piece_size) - self.piece_size
        self.piece_bytes = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.pairs: dict[int, int] = {}

    def unions(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece of each pair's union, or -1. Negative ids have none."""
        key = a.astype(np.int64) * self.size + b
        key[(a < 0) | (b < 0)] = -1
        at = self._slot(key)
        got = self.slot_key[at]
        out = self.slot_union[at]
        wrong = np.flatnonzero(got != key)
        out[wrong] = -1
        wrong = wrong[got[wrong] >= 0]  # a slot that another pair has: look at the next
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & self.slot_mask
            got = self.slot_key[at[wrong]]
            hit = got == key[wrong]
            out[wrong[hit]] = self.slot_union[at[wrong[hit]]]
            wrong = wrong[~hit & (got >= 0)]
        return out

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * W.MIX1 >> self.slot_shift).astype(np.int64)

    def _hashed(self) -> None:
        """The pairs in a table of which a quarter is used at most, so that a look-up takes
        one step, seldom more."""
        bits = max(4, (4 * len(self.keys) - 1).bit_length())
        self.slot_shift, self.slot_mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slot_key, self.slot_union = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        left, at = np.arange(len(self.keys)), self._slot(self.keys)
        while len(left):
            _, first = np.unique(at, return_index=True)
            first = first[self.slot_key[at[first]] < 0]
            self.slot_key[at[first]], self.slot_union[at[first]] = self.keys[left[first]], self.merged[left[first]]
            stay = np.ones(len(left), bool)
            stay[first] = False
            left, at = left[stay], (at[stay] + 1) & self.slot_mask


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    return Model(path)


def segment(m: Model, words: list[str], skipped: list[tuple[int, ...]] | None = None, seeds: np.ndarray | None = None, limit: np.uint64 = np.uint64(0)) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Piece ids of all words, byte pieces included, and how many each word has; spans of
    the candidates that each word draws, in order, and how many.

    skipped: for each word, the spans that dropout skips. seeds: instead, what keys each
    word's own hashes, of which those below limit skip.
    """
    chars = "".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ids = m.of_point[np.frombuffer(chars.encode("utf-32-le"), np.uint32)]
    word = np.repeat(np.arange(len(words)), sizes)
    first = np.arange(len(chars))  # a symbol's first character, in chars
    base = np.cumsum(sizes) - sizes
    skipped = skipped or [()] * len(words)
    most = max(map(len, skipped), default=0)
    gone_spans = np.array([x + (-1,) * (most - len(x)) for x in skipped], np.int64).reshape(len(words), most)
    drawn: list[tuple[np.ndarray, np.ndarray]] = []
    done: list[tuple[np.ndarray, np.ndarray]] = []

    def candidates(i: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, union) of the pairs (i, i+1); last: the end of i+1, in chars."""
        union = m.unions(ids[i], ids[i + 1])
        rank = np.where(union >= 0, m.rank[union], NEVER)
        w = word[i]
        span = ((first[i] - base[w]) << 42) + ((first[i + 1] - base[w]) << 21) + (last - base[w])
        real = union >= 0
        drawn.append((w[real], span[real]))
        if most:
            rank[(gone_spans[w] == span[:, None]).any(1)] = NEVER
        if seeds is not None:
            rank[W.mixed(seeds[w] + span.astype(np.uint64) * W.MIX1) < limit] = NEVER
        return rank, union

    def ends() -> np.ndarray:
        out = np.empty(len(first), np.int64)
        out[:-1] = first[1:]
        tail = np.append(word[1:] != word[:-1], True)
        out[tail] = (base + sizes)[word[tail]]
        return out

    def table() -> tuple[np.ndarray, np.ndarray]:
        rank, union = np.full(len(ids), NEVER, np.int32), np.full(len(ids), -1, np.int32)
        i = np.flatnonzero(word[1:] == word[:-1])
        if len(i):
            rank[i], union[i] = candidates(i, ends()[i + 1])
        return rank, union

    rank, union = table()
    while len(ids):
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        best = np.minimum.reduceat(rank, starts)
        live = best < NEVER
        lengths = np.diff(np.append(starts, len(ids)))
        if not live.all():  # words without candidates are finished
            over = np.repeat(~live, lengths)
            done.append((first[over], ids[over]))
            keep = ~over
            ids, word, first, rank, union = ids[keep], word[keep], first[keep], rank[keep], union[keep]
            starts, best, lengths = None, best[live], lengths[live]
            if not len(ids):
                break
        hits = np.flatnonzero(rank == np.repeat(best, lengths))
        i = hits[np.append(True, word[hits[1:]] != word[hits[:-1]])]  # the leftmost
        ids[i] = union[i]
        gone = np.ones(len(ids), bool)
        gone[i + 1] = False
        moved = np.cumsum(gone) - 1
        ids, word, first, rank, union = ids[gone], word[gone], first[gone], rank[gone], union[gone]
        i = moved[i]
        last = ends()
        rank[i], union[i] = NEVER, -1
        right = i[(i + 1 < len(ids)) & (word[np.minimum(i + 1, len(ids) - 1)] == word[i])]
        left = i[(i > 0) & (word[i - 1] == word[i])] - 1
        again = np.concatenate([right, left])
        if len(again):
            rank[again], union[again] = candidates(again, last[again + 1])
    at = np.concatenate([d[0] for d in done]) if done else np.zeros(0, np.int64)
    flat = np.concatenate([d[1] for d in done]) if done else np.zeros(0, np.int32)
    by = np.argsort(at, kind="stable")
    at, flat = at[by], flat[by]
    owner = np.repeat(np.arange(len(words)), sizes)[at] if len(at) else np.zeros(0, np.int64)
    w = np.concatenate([d[0] for d in drawn]) if drawn else np.zeros(0, np.int64)
    by = np.argsort(w, kind="stable")  # each word's in the order drawn
    spans = np.concatenate([d[1] for d in drawn])[by] if drawn else np.zeros(0, np.int64)
    draws = np.bincount(w, minlength=len(words))
    plain = flat >= 0
    if plain.all():
        return flat, np.bincount(owner, minlength=len(words)), spans, draws
    width = np.ones(len(flat), np.int64)
    odd = np.flatnonzero(~plain)
    raw = [chars[at[o]].encode() for o in odd]
    width[odd] = [len(r) for r in raw]
    out = np.repeat(flat, width)
    out[out < 0] = m.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
    return out, np.bincount(owner, width, minlength=len(words)).astype(np.int64), spans, draws


def _mixed(h: int) -> int:
    """words.mixed of one number."""
    h ^= h >> 29
    h = h * int(W.MIX2) % 2**64
    h ^= h >> 32
    h = h * int(W.MIX1) % 2**64
    return h ^ h >> 31


def segment_long(m: Model, word: str, seed: int, limit: int) -> list[int]:
    """The ids that segment gives one word; the agenda is a heap, so that a run of n
    characters takes n log n steps."""
    if not m.pairs:
        m.pairs = dict(zip(m.keys.tolist(), m.merged.tolist()))
    ids = [m.chars.get(c, -1) for c in word]
    n, size, pairs, rank, mix = len(ids), m.size, m.pairs, m.rank.tolist(), int(W.MIX1)
    end, right, left = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    agenda: list[tuple[int, int, int, int, int]] = []

    def candidate(i: int, j: int) -> None:
        if ids[i] < 0 or ids[j] < 0 or (union := pairs.get(ids[i] * size + ids[j])) is None:
            return
        span = (i << 42) + (j << 21) + end[j]
        if not limit or _mixed((seed + span * mix) % 2**64) >= limit:
            heapq.heappush(agenda, (rank[union], i, j, end[j], union))

    for i in range(n - 1):
        candidate(i, i + 1)
    while agenda:
        _, i, j, last, union = heapq.heappop(agenda)
        if right[i] != j or end[j] != last or end[i] != j:
            continue  # one of the two has been merged since
        ids[i], end[i], right[i] = union, last, right[j]
        end[j], right[j] = -1, -1
        if right[i] < n:
            left[right[i]] = i
            candidate(i, right[i])
        if left[i] >= 0:
            candidate(left[i], i)
    out, i = [], 0
    while i < n:
        if ids[i] >= 0:
            out.append(ids[i])
        else:
            out += m.byte_id[np.frombuffer(word[i].encode(), np.uint8)].tolist()
        i = right[i]
    return out


def segment_each(m: Model, words: list[str], seeds: np.ndarray, limit: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words by their own hashes, and how many each has."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    long = np.flatnonzero(size > LONG)
    if not len(long):
        return segment(m, words, None, seeds, limit)[:2]
    short = np.flatnonzero(size <= LONG)
    flat, n, _, _ = segment(m, [words[i] for i in short], None, seeds[short], limit)
    found: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
    for i, own in zip(short.tolist(), np.split(flat, np.cumsum(n)[:-1]) if len(short) else []):
        found[i] = own
    for i in long.tolist():
        found[i] = np.array(segment_long(m, words[i], int(seeds[i]), int(limit)), np.int32)
    return np.concatenate(found), np.fromiter(map(len, found), np.int64, len(found))


class Grown:
    """An array that grows at its end."""

    def __init__(self, dtype):
        self.room, self.n = np.zeros(1024, dtype), 0

    def add(self, new: np.ndarray) -> None:
        if self.n + len(new) > len(self.room):
            self.room = np.concatenate([self.room[: self.n], np.zeros(self.n + 2 * len(new), self.room.dtype)])
        self.room[self.n : self.n + len(new)] = new
        self.n += len(new)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... of each size, one after another."""
    total = np.cumsum(sizes)
    return np.repeat(starts - (total - sizes), sizes) + np.arange(int(total[-1]) if len(total) else 0)


class Known(dict):
    """word -> node. A word gets its node at its second occurrence; at the first it is -1
    and goes to single."""

    def __init__(self, most: int):
        self.most, self.once, self.single, self.new = most, set(), [], []
        self.count = 0

    def __missing__(self, word: str) -> int:
        if len(word) > LONG:  # never kept
            self.single.append(word)
            return -1
        if word not in self.once:
            if len(self.once) >= self.most:
                self.once.clear()
            self.once.add(word)
            self.single.append(word)
            return -1
        i = self[word] = self.count + len(self.new)
        self.new.append((word, (), 0))
        return i


class Encoder:
    """Encodes texts; keeps the nodes of the words it has met."""

    def __init__(self, m: Model, rate: float = RATE, seed: int = SEED, most: int = WORDS):
        self.m, self.rate, self.seed, self.most = m, rate, seed, most
        self.limit = np.uint64(min(int(rate * 2.0**64), 2**64 - 1))
        self.reset()

    def reset(self) -> None:
        self.known = Known(self.most)
        self.words: list[str] = []
        self.skipped: list[tuple[int, ...]] = []
        #: For each node its number of pieces, where its draws are, and how many went before.
        self.size, self.first, self.draws, self.before = (Grown(np.int64) for _ in range(4))
        self.flat = Grown(np.int32)
        #: For each draw its span, its node, and the node that skipping it leads to: -1 if
        #: that was never met, -2 if once.
        self.span, self.owner, self.child = (Grown(np.int64) for _ in range(3))

    def _work_out(self) -> None:
        """Adds the new nodes (word, skipped spans, how many draws went before)."""
        new, count = self.known.new, self.known.count
        if not new:
            return
        flat, sizes, spans, draws = segment(self.m, [x[0] for x in new], [x[1] for x in new])
        before = np.array([x[2] for x in new], np.int64)
        left = draws - before
        self.size.add(sizes)
        self.flat.add(flat)
        self.before.add(before)
        self.first.add(self.span.n + np.cumsum(left) - left)
        self.draws.add(left)
        self.span.add(spans[ranges(np.cumsum(draws) - left, left)])
        self.owner.add(np.repeat(np.arange(count, count + len(new)), left))
        self.child.add(np.full(int(left.sum()), -1))
        self.words += [x[0] for x in new]
        self.skipped += [x[1] for x in new]
        self.known.count += len(new)
        new.clear()

    def _drawn(self, node: np.ndarray, seeds: np.ndarray) -> list[str]:
        """Leads each occurrence from its word's node to the one of its own draws, or to -1
        if that is not kept; the words of those that it set to -1, in order."""
        alone: dict[int, str] = {}
        live = np.flatnonzero(node >= 0)
        many = self.draws.room[node[live]] > MANY
        for i in live[many].tolist():
            alone[i] = self.words[node[i]]
        live = live[~many]
        while len(live):
            n = self.draws.room[node[live]]
            at = ranges(self.first.room[node[live]], n)
            hit = np.flatnonzero(W.mixed(np.repeat(seeds[live], n) + self.span.room[at].astype(np.uint64) * W.MIX1) < self.limit)
            whose = np.searchsorted(np.cumsum(n), hit, side="right")
            first = np.append(True, whose[1:] != whose[:-1])[: len(hit)]
            at, live = at[hit[first]], live[whose[first]]
            unmet, times = np.unique(at[self.child.room[at] < 0], return_counts=True)
            again = (times > 1) | (self.child.room[unmet] == -2)
            self.child.room[unmet[~again]] = -2
            for p in unmet[again].tolist():
                o = int(self.owner.room[p])
                self.child.room[p] = self.known.count + len(self.known.new)
                self.known.new.append((self.words[o], (*self.skipped[o], int(self.span.room[p])), int(self.before.room[o]) + p - int(self.first.room[o]) + 1))
            self._work_out()
            kept = self.child.room[at] >= 0
            for i in live[~kept].tolist():
                alone[i] = self.words[node[i]]
            node[live[kept]] = self.child.room[at[kept]]
            live = live[kept]
        out = sorted(alone)
        node[out] = -1
        return [alone[i] for i in out]

    def encode(self, texts: list[str], variants: list[int]) -> list[np.ndarray]:
        if self.known.count > self.most:
            self.reset()
        get = self.known.__getitem__
        parts = [np.fromiter(map(get, words), np.int64, len(words)) for words in (_WORD.findall(" " + t) if t else [] for t in texts)]
        if not parts:
            return []
        self._work_out()
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        node = np.concatenate(parts)
        documents = W.mixed(np.array([(v ^ self.seed * 0x9E3779B97F4A7C15) % 2**64 for v in variants], np.uint64))
        seeds = W.mixed(np.repeat(documents, sizes) + (ranges(np.zeros(len(sizes), np.int64), sizes) + 1).astype(np.uint64) * W.MIX2)
        alone = np.flatnonzero(node < 0)
        words = np.empty(len(node), object)
        words[alone] = self.known.single
        self.known.single.clear()
        if self.rate:
            for i in range(0, len(node), DRAWS):
                own = node[i : i + DRAWS]
                was = own < 0
                found = self._drawn(own, seeds[i : i + DRAWS])
                words[i + np.flatnonzero((own < 0) & ~was)] = found
            alone = np.flatnonzero(node < 0)
        # occurrences whose node is not kept are segmented by their own hashes
        flats, lengths = [self.flat.room[: self.flat.n]], [self.size.room[: self.size.n]]
        for i in range(0, len(alone), DRAWS):
            part = alone[i : i + DRAWS]
            flat, n = segment_each(self.m, words[part].tolist(), seeds[part], self.limit)
            flats.append(flat)
            lengths.append(n)
        node[alone] = self.known.count + np.arange(len(alone))
        flat, n = np.concatenate(flats), np.concatenate(lengths)
        starts = np.cumsum(n) - n
        return [flat[ranges(starts[at], n[at])] for at in np.split(node, np.cumsum(sizes)[:-1])]


def decode(m: Model, ids: np.ndarray) -> bytes:
    """The text of ids, as UTF-8."""
    return b"".join(map(m.bytes.__getitem__, ids.tolist()))[1:]


def lossless(m: Model, found: list[np.ndarray], flat: np.ndarray, texts: list[bytes]) -> list[bool]:
    """Whether each text's ids decode to it; flat has all ids. All are decoded at once, and
    one by one only if some are not as they should be."""
    size = m.piece_size[flat]
    ends = np.cumsum([0, *map(len, found)])
    upto = np.append(0, np.cumsum(size))[ends]
    if np.array_equal(np.diff(upto), [len(t) + bool(t) for t in texts]):
        if m.piece_bytes[ranges(m.piece_start[flat], size)].tobytes() == b"".join(b" " + t for t in texts if t):
            return [True] * len(texts)
    return [decode(m, ids) == t for ids, t in zip(found, texts)]


def _encoded(path: str, text: str, rate: float, seed: int):
    @W.trimming
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, encoder = model(path), None
        for batch in batches:
            encoder = encoder or Encoder(m, rate, seed)
            for first, texts in W.steps(batch, text):
                own = batch.slice(first, len(texts))
                found = encoder.encode([b.decode() for b in texts], own.column("variant").to_pylist())
                flat = np.concatenate(found).astype(np.int32)
                whole = lossless(m, found, flat, texts)
                rest = own.drop_columns(text)
                ids = pa.ListArray.from_arrays(np.cumsum([0, *map(len, found)]).astype(np.int32), flat)
                crc = pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in found], pa.int64())
                yield pa.RecordBatch.from_arrays([*rest.columns, ids, pa.array(list(map(len, found)), pa.int64()), crc, pa.array(whole, pa.bool_())], names=[*rest.schema.names, *ADDED])

    return encoded


ADDED = ("ids", "n_pieces", "ids_crc32", "lossless")


def encode_documents(docs: DataFrame, path: str, keys: tuple[str, ...] = ("doc_id",), text: str = "text", rate: float = RATE, seed: int = SEED) -> DataFrame:
    """keys, variant, ids, n_pieces, ids_crc32 and whether decoding gives the text."""
    variant = F.when(F.col(keys[0]).isNull(), 0).otherwise(F.xxhash64(F.lit(seed), F.col(keys[0]))) if keys else F.lit(0).cast("long")
    narrow = docs.select(*keys, variant.alias("variant"), W.as_bytes(text).alias("__text"))
    fields = [f for f in narrow.schema.fields if f.name != "__text"]
    kinds = (T.ArrayType(T.IntegerType()), T.LongType(), T.LongType(), T.BooleanType())
    schema = T.StructType(fields + [T.StructField(n, k) for n, k in zip(ADDED, kinds)])
    return narrow.mapInArrow(_encoded(path, "__text", rate, seed), schema)


def decode_documents(encoded: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """Adds the text that ids stand for."""
    schema = T.StructType([*encoded.schema.fields, T.StructField(text, T.StringType())])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            texts = [None if x is None else decode(m, np.array(x, np.int64)).decode() for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, text])

    return encoded.mapInArrow(decoded, schema)


def public_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op3_merge_dropout(spark, sf_dir, path: str | None = None):
    return encode_documents(table(spark, sf_dir, "documents"), path or public_model())
