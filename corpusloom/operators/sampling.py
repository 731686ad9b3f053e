"""Hash-ranked samples, quotas and diverse selections; group-wise splits."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def hash_ranked(df: DataFrame, group: str, key: str, salt: str, share: Column) -> DataFrame:
    """Of each group the first floor(share * size) rows by the hash of salt and key.

    The hash's first digits make 4,096 ranges of a group. Their counts tell which range
    the cut falls in; rows are ranked inside a range only, so that no task sorts a group.
    Null groups are a group."""
    rank_key = F.sha2(F.concat_ws("\u0000", F.lit(salt), F.col(group).cast("string"), F.col(key).cast("string")), 256)
    ranged = df.withColumn("__h", rank_key).withColumn("__p", F.substring("__h", 1, 3))
    counts = ranged.groupBy(F.col(group).alias("__g"), F.col("__p").alias("__q")).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy("__g")
    before = F.coalesce(F.sum("__n").over(w.orderBy("__q").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    need = F.floor(F.sum("__n").over(w) * share) - before
    open_ = counts.select("__g", "__q", need.alias("__need")).where("__need > 0")
    j = ranged.join(open_, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__p") == F.col("__q")))
    place = F.row_number().over(Window.partitionBy("__g", "__q").orderBy("__h", key))
    return j.withColumn("__r", place).where("__r <= __need").select(*df.columns)


def quotas(counts: DataFrame, group: str, n: str, total: int) -> DataFrame:
    """Largest-remainder shares of total in proportion to n: (group, quota)."""
    whole = counts.agg(F.sum(n)).first()[0] or 1
    share = F.col(n).cast("decimal(38,0)") * F.lit(total)  # whole numbers throughout
    rest = share % F.lit(whole)
    parts = counts.select(group, ((share - rest) / F.lit(whole)).cast("long").alias("base"), rest.alias("rest"))
    left = total - (parts.agg(F.sum("base")).first()[0] or 0)
    rank = F.row_number().over(Window.orderBy(F.desc("rest"), group))  # one row a group
    return parts.select(group, (F.col("base") + F.when(rank <= left, 1).otherwise(0)).cast("long").alias("quota"))


def capped_quotas(shares: dict[str, float], available: dict[str, int], total: int) -> dict[str, int]:
    """Largest-remainder shares of total, none above what is available; what a full group
    cannot take is shared among the others. For a few groups."""
    quota = dict.fromkeys(shares, 0)
    open_ = {g for g in shares if available.get(g, 0) > 0 and shares[g] > 0}
    left = min(total, sum(available.get(g, 0) for g in open_))
    while left and open_:
        weight = sum(shares[g] for g in open_)
        exact = {g: left * shares[g] / weight for g in open_}
        give = {g: int(exact[g]) for g in open_}
        for g in sorted(open_, key=lambda g: (give[g] - exact[g], g))[: left - sum(give.values())]:
            give[g] += 1
        for g in sorted(open_):
            quota[g] += min(give[g], available[g] - quota[g])
        left = min(total, sum(available.get(g, 0) for g in shares if shares[g] > 0)) - sum(quota.values())
        open_ = {g for g in open_ if quota[g] < available[g]}
    return quota


def diverse(profiles: list[tuple[str, set[str]]], n: int, freq: dict[str, int] | None = None) -> list[str]:
    """n keys, each time the one with the rarest and least chosen features; ties by key.
    For a table of profiles that a caller has bounded; freq: the features' counts, if
    they are of more profiles than these."""
    if freq is None:
        freq = {}
        for _, features in profiles:
            for f in features:
                freq[f] = freq.get(f, 0) + 1
    chosen: list[str] = []
    taken: dict[str, int] = {}
    left = {k: sorted(features) for k, features in profiles}
    while left and len(chosen) < n:
        key = min(left, key=lambda k: (-sum(1 / (freq[f] ** 0.5 * (1 + taken.get(f, 0))) for f in left[k]), k))
        for f in left.pop(key):
            taken[f] = taken.get(f, 0) + 1
        chosen.append(key)
    return chosen


def diverse_keys(profiles: DataFrame, key: str, features: str, n: int) -> list:
    """diverse() over all rows of profiles, one a key with its array of distinct features.

    Keys of one feature set score alike and go by key, so that n keys of each set are all
    that can be chosen; the driver gets those and the number of keys of each set."""
    sets = profiles.where(F.col(key).isNotNull()).select(key, F.array_sort(features).alias("__set"))
    rank = F.row_number().over(Window.partitionBy("__set").orderBy(key))
    first = sets.withColumn("__r", rank).where(F.col("__r") <= n).select(key, "__set").collect()
    freq: dict[str, int] = {}
    for r in sets.groupBy("__set").agg(F.count(F.lit(1)).alias("n")).collect():
        for f in r["__set"]:
            freq[f] = freq.get(f, 0) + r["n"]
    return diverse([(r[key], set(r["__set"])) for r in first], n, freq)


def split_objective(totals: dict[str, dict[str, int]], whole: dict[str, int], shares: dict[str, float], labels: list[str], bounds: dict[str, tuple[float, float]]) -> float:
    """How far splits are from their shares: of rows (weight 8), of each label, and from
    the bounds of their part of the rows (weight 10,000). whole, totals: "" has the rows."""
    score, rows = 0.0, whole[""]
    for split, share in shares.items():
        got = totals[split]
        score += 8.0 * ((got[""] - rows * share) / max(rows * share, 1)) ** 2
        for label in labels:
            target = whole[label] * share
            score += ((got[label] - target) / max(target, 1)) ** 2
        if split in bounds and rows:
            part, (low, high) = got[""] / rows, bounds[split]
            score += 10000 * (max(low - part, 0) ** 2 + max(part - high, 0) ** 2)
    return score


def assign_groups(sizes: dict, shares: dict[str, float], steps: int = 30000, seed: int = 42, labels: dict[object, dict[str, int]] | None = None, bounds: dict[str, tuple[float, float]] | None = None) -> dict:
    """Whole groups to splits: those with the rarest labels first, each to the split that
    makes split_objective() least, then seeded moves and swaps that lessen it.

    labels: of each group its number of rows with each label; all in the driver's memory."""
    own = labels or {}
    names = sorted({x for counts in own.values() for x in counts})
    count = {g: {"": sizes[g]} | {x: own.get(g, {}).get(x, 0) for x in names} for g in sizes}
    whole = {x: sum(c[x] for c in count.values()) for x in ["", *names]}
    totals = {s: dict.fromkeys(whole, 0) for s in shares}
    bounds, rng = bounds or {}, random.Random(seed)
    keys, splits = sorted(sizes), list(shares)
    tie = {g: rng.random() for g in keys}
    out: dict = {}

    def put(g, split: str, sign: int = 1) -> None:
        for x, n in count[g].items():
            totals[split][x] += sign * n

    def cost() -> float:
        return split_objective(totals, whole, shares, names, bounds)

    def tried(g, split: str) -> tuple[float, str]:
        put(g, split)
        score = cost()
        put(g, split, -1)
        return score, split

    for g in sorted(keys, key=lambda g: (sum(count[g][x] / max(whole[x], 1) for x in names), sizes[g], tie[g]), reverse=True):
        out[g] = min(tried(g, s) for s in splits)[1]
        put(g, out[g])
    now = cost()
    for _ in range(steps if keys and len(splits) > 1 else 0):
        if len(keys) < 2 or rng.random() < 0.55:
            g = rng.choice(keys)
            changes = [(g, rng.choice([s for s in splits if s != out[g]]))]
        else:
            a, b = rng.sample(keys, 2)
            if out[a] == out[b]:
                continue
            changes = [(a, out[b]), (b, out[a])]
        for g, s in changes:
            put(g, out[g], -1)
            put(g, s)
        if (new := cost()) + 1e-12 < now:
            now = new
            out.update(changes)
        else:
            for g, s in changes:
                put(g, s, -1)
                put(g, out[g])
    return out
