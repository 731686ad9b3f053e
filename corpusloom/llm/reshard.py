"""Resharding by minimum-cost flow.

Old shards' sizes and new shards' capacities make a small flow network: staying costs
nothing, a byte moved from one shard to another costs one. The cheapest flow says how
many bytes each old shard keeps and hands to each other one. Inside an old shard
documents stand in order of (hash of text, hash of id), and its outgoing blocks are
ranges of that order, so a document's new shard is a function of its own hashes and of a
few cut points. A shard's files hold ranges of the order too. Those that lie between two
cuts are kept or moved as they are; only the few that a cut divides are rewritten, and
that needs no shuffle.

Cut points come from radix histograms: bytes by the next ten bits of the hash, summed
on the executors, only inside the buckets where a cut falls, until a bucket is one
document. Equal texts are neighbours; a group of up to GROUP of a capacity is kept
whole at a cut, a larger one is split so that sizes stay near equal.

Slots number a shard's documents: counts by (shard, bucket) give offsets, and rows are
numbered inside a bucket, so no task sees a whole shard.

Defined results: a null text has size 1 and the checksum of nothing; null ids and
repeated rows are documents like others, each with a slot of its own; very long texts
are handled whole, and may make their shard larger than others by their size; an empty
table gives no rows; all columns of the documents are carried, in a struct, so that their
names cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from corpusloom.session import scratch, table, written

BITS = 10
#: Ranges of an old shard's order, each of which is a folder of files.
PART_BITS = 4
PARTS = 1 << PART_BITS
GROUP = 0.005
SLOT_ROWS = 20_000


def min_cost_flow(sizes: list[int], capacities: list[int]) -> list[list[int]]:
    """bytes[i][j] from old shard i to new shard j, moving the fewest bytes.

    Successive shortest paths over source -> old -> new -> sink. The capacities' sum
    must be the sizes' sum at least.
    """
    if sum(capacities) < sum(sizes):
        raise ValueError("the capacities do not hold the shards")
    n, m = len(sizes), len(capacities)
    source, sink = n + m, n + m + 1
    edges: list[list[int]] = []  # to, capacity left, cost
    out: list[list[int]] = [[] for _ in range(n + m + 2)]

    def edge(a: int, b: int, capacity: int, cost: int) -> int:
        out[a].append(len(edges))
        edges.append([b, capacity, cost])
        out[b].append(len(edges))
        edges.append([a, 0, -cost])
        return len(edges) - 2

    for i, s in enumerate(sizes):
        edge(source, i, s, 0)
    between = [[edge(i, n + j, s, int(i != j)) for j in range(m)] for i, s in enumerate(sizes)]
    for j, c in enumerate(capacities):
        edge(n + j, sink, c, 0)
    while True:
        far = [math.inf] * len(out)
        via, far[source] = [-1] * len(out), 0
        for _ in range(len(out)):  # Bellman-Ford: residual edges have negative costs
            changed = False
            for a, own in enumerate(out):
                for e in own:
                    b, left, cost = edges[e]
                    if left and far[a] + cost < far[b]:
                        far[b], via[b], changed = far[a] + cost, e, True
            if not changed:
                break
        if far[sink] == math.inf:
            break
        path, at = [], sink
        while at != source:
            path.append(via[at])
            at = edges[via[at] ^ 1][0]
        most = min(edges[e][1] for e in path)
        for e in path:
            edges[e][1] -= most
            edges[e ^ 1][1] += most
    return [[edges[e ^ 1][1] for e in row] for row in between]


def _bits(c: str, level: int) -> Column:
    """The level-th ten bits of a 64-bit hash, in its signed order."""
    flipped = F.col(c).bitwiseXOR(F.lit(-(1 << 63)))
    shift = 64 - BITS * (level + 1)
    if shift >= 0:
        return F.shiftrightunsigned(flipped, shift).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")
    return F.shiftleft(flipped, -shift).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")


DIGITS = [(c, level) for c in ("th", "dh") for level in range(-(-64 // BITS))]


def cut_points(narrow: DataFrame, targets: dict[int, list[int]], capacity: int) -> dict[int, list[tuple[int, ...]]]:
    """For each old shard, the digit prefixes at which its order is cut.

    A document belongs after a cut when its digits (of th, then dh) are not below the
    prefix. narrow: old, th, dh, size.
    """
    #: open cuts: (old, cut's number) -> (prefix so far, bytes before it)
    state = {(o, k): ((), 0) for o, ts in targets.items() for k in range(len(ts))}
    done: dict[tuple[int, int], tuple[int, ...]] = {}
    for depth, (c, level) in enumerate(DIGITS):
        open_ = {(o, p) for (o, _), (p, _) in state.items()}
        if not open_:
            break
        inside = None
        for o, prefix in sorted(open_):
            own = F.col("old") == o
            for (pc, pl), digit in zip(DIGITS, prefix):
                own = own & (_bits(pc, pl) == digit)
            inside = own if inside is None else inside | own
        digits = [_bits(pc, pl).alias(f"b{i}") for i, (pc, pl) in enumerate(DIGITS[: depth + 1])]
        names = [f"b{i}" for i in range(depth + 1)]
        rows = narrow.where(inside).select("old", "th", "size", *digits).groupBy("old", *names).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("docs"), (F.min("th") == F.max("th")).alias("one")).collect()  # 1024 for each open cut at most
        tree: dict[tuple, list] = {}
        for r in sorted(rows, key=lambda r: (r["old"], *(r[x] for x in names))):
            tree.setdefault((r["old"], tuple(r[x] for x in names[:-1])), []).append(r)
        for (o, k), (prefix, before) in list(state.items()):
            target, at, here = targets[o][k], None, before
            for r in tree.get((o, prefix), []):
                if here + r["bytes"] > target:
                    at = r
                    break
                here += r["bytes"]
            if at is None:  # all of the bucket lies before the cut
                done[o, k] = (*prefix[:-1], prefix[-1] + 1) if prefix else (1 << BITS,)
                del state[o, k]
                continue
            digit = at[names[-1]]
            whole = at["docs"] == 1 or (at["one"] and at["bytes"] <= GROUP * capacity) or depth == len(DIGITS) - 1
            if whole or here == target:
                after = target - here > at["bytes"] / 2
                done[o, k] = (*prefix, digit + int(after))
                del state[o, k]
            else:
                state[o, k] = ((*prefix, digit), here)
    return {o: [done[o, k] for k in range(len(ts))] for o, ts in targets.items()}


def _key(prefix: tuple[int, ...]) -> str:
    """The least (th, dh) at or after a cut, as 32 hexadecimal digits; "G" is after all."""
    value, per = 0, -(-64 // BITS)
    for i in range(2 * per):
        digit = prefix[i] if i < len(prefix) else 0
        level = i % per
        width = BITS if 64 - BITS * (level + 1) >= 0 else 64 - BITS * level
        # the last level's digits are shifted up to ten bits
        value = (value << width) + (digit if width == BITS else -(-digit >> (BITS - width)))
    return "G" if value >= 1 << 128 else f"{value:032X}"


def _hex_key() -> Column:
    """A document's (th, dh) as 32 hexadecimal digits, in their signed order."""
    return F.concat(*(F.lpad(F.hex(F.col(c).bitwiseXOR(F.lit(-(1 << 63)))), 16, "0") for c in ("__th", "__dh")))


def assignment(narrow: DataFrame, new: int, old_shards: int) -> tuple[list[tuple[int, list[str], list[int]]], list[list[int]]]:
    """(for each old shard its cuts, as keys, and the new shards between them; the flow).
    narrow: old, th, dh, size."""
    by = {r["old"]: r["bytes"] for r in narrow.groupBy("old").agg(F.sum("size").alias("bytes")).collect()}
    sizes = [by.get(o, 0) for o in range(old_shards)]
    total = sum(sizes)
    capacities = [total * (j + 1) // new - total * j // new for j in range(new)]
    flow = min_cost_flow(sizes, capacities)
    targets, goes = {}, {}
    for o, row in enumerate(flow):
        order = sorted((j for j, b in enumerate(row) if b), key=lambda j: (j != o, j))
        goes[o] = order or [min(o, new - 1)]
        sums = [sum(row[j] for j in order[: k + 1]) for k in range(len(order) - 1)]
        targets[o] = sums
    cuts = cut_points(narrow, targets, max(1, total // new))
    return [(o, [_key(c) for c in cuts[o]], goes[o]) for o in goes], flow


def _shard(df: DataFrame, plan: list[tuple[int, list[str], list[int]]]) -> DataFrame:
    """df (__old, __th, __dh) with __shard: a look into its old shard's few cuts."""
    cuts = df.sparkSession.createDataFrame(plan, "__old int, __cuts array<string>, __goes array<int>")  # a row a shard
    key = _hex_key()
    after = F.size(F.filter("__cuts", lambda c: c <= key))
    return df.join(F.broadcast(cuts), "__old").withColumn("__shard", F.element_at("__goes", after + 1)).drop("__cuts", "__goes")


def write_shards(docs: DataFrame, old: Column | None = None, old_shards: int = 5, doc_id: str = "doc_id", text: str = "text") -> str:
    """Lays docs out as old shards: a folder for each shard and each of its PARTS ranges of
    the order. The rows keep all their columns, whatever their names, in a struct.

    old: each document's old shard, 0 to old_shards-1; by default by its text's checksum."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    crc = F.crc32(body.cast("binary"))
    th = F.xxhash64(body)
    part = F.shiftrightunsigned(th.bitwiseXOR(F.lit(-(1 << 63))), 64 - PART_BITS).cast("int")
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), (F.octet_length(body) + 1).cast("long").alias("__size"), crc.alias("__crc"), th.alias("__th"), F.xxhash64(F.col(f"`{doc_id}`")).alias("__dh"),
        ((crc % old_shards) if old is None else old).cast("int").alias("__old"), part.alias("__part"))
    path = scratch(docs.sparkSession, "old-shards")
    rows.write.option("compression", "zstd").partitionBy("__old", "__part").parquet(path)
    return path


def reshard(spark, path: str, schema, new: int = 8, old_shards: int = 5) -> tuple[DataFrame, DataFrame, list[list[int]]]:
    """(the new shards' rows, a manifest of the parts, the flow) of shards that
    write_shards laid out for documents of this schema.

    A part all of whose documents go to one shard is not rewritten: the manifest (old,
    part, docs, bytes, shard) lists its files under that shard, and moves them as they
    are if it is another. Only parts that a cut divides are read and written again, in a
    folder for each new shard. Rows: row, size, text_crc32, old_shard, shard."""
    kind = T.StructType([T.StructField("row", schema), *(T.StructField(n, T.LongType()) for n in ("__size", "__crc", "__th", "__dh")), *(T.StructField(n, T.IntegerType()) for n in ("__old", "__part"))])
    files = spark.read.schema(kind).option("basePath", path).parquet(path)
    narrow = files.select(F.col("__old").alias("old"), F.col("__th").alias("th"), F.col("__dh").alias("dh"), F.col("__size").alias("size"))
    plan, flow = assignment(narrow, new, old_shards)
    ends = _shard(files.select("__old", "__part", "__th", "__dh", "__size"), plan).groupBy("__old", "__part")
    ends = ends.agg(F.min("__shard").alias("lo"), F.max("__shard").alias("hi"), F.count(F.lit(1)).alias("docs"), F.sum("__size").alias("bytes"))
    parts = [tuple(r) for r in ends.collect()]  # PARTS rows for each old shard
    manifest = spark.createDataFrame([(o, p, n, b, lo if lo == hi else None) for o, p, lo, hi, n, b in parts], "old int, part int, docs long, bytes long, shard int")
    whole = F.broadcast(manifest.where("shard is not null").select(F.col("old").alias("__old"), F.col("part").alias("__part"), F.col("shard").alias("__shard")))
    cut = F.broadcast(manifest.where("shard is null").select(F.col("old").alias("__old"), F.col("part").alias("__part")))
    moved = scratch(spark, "new-shards")
    divided = _shard(files.join(cut, ["__old", "__part"], "left_semi"), plan)
    divided.select(*kind.names, "__shard").write.option("compression", "zstd").partitionBy("__shard").parquet(moved)
    again = spark.read.schema(T.StructType([*kind.fields, T.StructField("__shard", T.IntegerType())])).parquet(moved)
    rows = files.join(whole, ["__old", "__part"]).select(*kind.names, "__shard").unionByName(again)
    out = rows.select("row", F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"), F.col("__old").alias("old_shard"), F.col("__shard").alias("shard"))
    return out, manifest, flow


def with_slots(files: DataFrame, keys: tuple[str, ...] = ("doc_id", "text_crc32")) -> DataFrame:
    """Adds slot: 0, 1, ... without a gap in each shard."""
    rows = files.count()
    buckets = max(1, math.ceil(rows / SLOT_ROWS))
    dealt = files.withColumn("__b", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy("shard", "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy("shard").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("shard", "__b", before.alias("__o"))
    place = F.row_number().over(Window.partitionBy("shard", "__b").orderBy(*keys))
    return dealt.withColumn("__r", place).join(offsets, ["shard", "__b"]).withColumn("slot", F.col("__o") + F.col("__r") - 1).drop("__b", "__o", "__r")


def op6_min_cost_flow(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    files, _, _ = reshard(spark, write_shards(docs), docs.schema)
    back = F.coalesce(F.col("row.text"), F.lit(""))
    rows = files.select("row.doc_id", (F.octet_length(back) + 1).cast("long").alias("size"), F.crc32(back.cast("binary")).alias("text_crc32"), "shard", "old_shard")
    out = with_slots(written(rows, "sharded"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard")
