"""Array-membership joins, coverage, fallbacks, quarantine and leakage between splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def array_join_ordered(df: DataFrame, key: str, array: str, right: DataFrame, right_key: str, value: str) -> DataFrame:
    """For each row, the values of right for its array's elements, in the array's order;
    elements without a match are left out, rows without any get an empty array."""
    pairs = df.select(key, F.posexplode(array).alias("pos", "element"))
    found = pairs.join(right.select(F.col(right_key).alias("element"), value), "element")
    nested = found.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", value))).alias("v"))
    values = F.transform("v", lambda x: x[value])
    empty = F.array().cast(f"array<{right.schema[value].dataType.simpleString()}>")
    return df.select(key).join(nested, key, "left").select(key, F.coalesce(values, empty).alias("values"))


def coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of one side only, with the side."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    only = lambda x, y, name: x.exceptAll(y).withColumn("only_in", F.lit(name))  # noqa: E731  (null equals null)
    return only(a, b, "left").unionByName(only(b, a, "right"))


def differing(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Per column, how many keys that both have differ; null equals null."""
    both = left.alias("l").join(right.alias("r"), key)
    counts = [F.count_if(~F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))).alias(c) for c in columns]
    return both.agg(*counts)


def resolved(candidates: list[tuple[str, Column]]) -> tuple[Column, Column]:
    """(first non-null candidate, its source's name)."""
    value = F.coalesce(*(c for _, c in candidates))
    source = F.coalesce(*(F.when(c.isNotNull(), F.lit(n)) for n, c in candidates))
    return value, source


def quarantine(df: DataFrame, bad: DataFrame, key: str) -> DataFrame:
    """All rows, routed: accepted, or review for every row of a key with a bad one."""
    marked = bad.select(key).distinct().withColumn("__bad", F.lit(True))
    return df.join(marked, key, "left").withColumn("route", F.when(F.col("__bad"), "review").otherwise("accepted")).drop("__bad")


def leaking(df: DataFrame, entity: str, split: str) -> DataFrame:
    """Entities that are in more than one split."""
    return df.groupBy(entity).agg(F.countDistinct(split).alias("n_splits")).where("n_splits > 1")


def overlaps(df: DataFrame, entity: str, split: str) -> DataFrame:
    """For each pair of splits, how many entities both have."""
    seen = df.select(entity, split).distinct()
    right = seen.select(entity, F.col(split).alias("right"))
    return seen.withColumnRenamed(split, "left").join(right, entity).where(F.col("left") < F.col("right")).groupBy("left", "right").agg(F.count(F.lit(1)).alias("n"))


def failures(rules: dict[str, Column]) -> Column:
    """Codes of the rules that fail, in order; a rule that is null fails."""
    return F.array_compact(F.array(*(F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items())))


def opposites(df: DataFrame, key: list[str], value: str, one: str, other: str) -> DataFrame:
    """Keys that have both values."""
    both = df.groupBy(*key).agg(F.count_if(F.col(value) == one).alias("n_one"), F.count_if(F.col(value) == other).alias("n_other"))
    return both.where("n_one > 0 and n_other > 0")


def same_order(left: DataFrame, right: DataFrame, position: str, key: str) -> DataFrame:
    """Positions at which two tables do not have the same key, or one has no row."""
    a, b = left.select(position, F.col(key).alias("left")), right.select(position, F.col(key).alias("right"))
    return a.join(b, position, "full").where(~F.col("left").eqNullSafe(F.col("right")))


def conserved(whole: DataFrame, parts: dict[str, DataFrame], key: str) -> DataFrame:
    """Keys that are not in the parts as often as in the whole: lost, added or in two."""
    of = lambda df, n: df.select(key, F.lit(n).alias("n"))
    signed = of(whole, 1)
    for part in parts.values():
        signed = signed.unionByName(of(part, -1))
    return signed.groupBy(key).agg(F.sum("n").alias("missing")).where("missing <> 0")


def mentions(text: str, terms: list[str]) -> Column:
    """The terms that occur in the text as whole words, in the order given; they are
    constants of the plan, so no join is needed."""
    whole = lambda t: F.lower(text).rlike(rf"(?<![\p{{L}}\p{{N}}_])\Q{t.lower()}\E(?![\p{{L}}\p{{N}}_])")
    return F.array_compact(F.array(*(F.when(whole(t), F.lit(t)) for t in terms)))


def required_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """An inner join in which every row of left must find its key; else an error that
    names some of those that do not."""
    missing = [r[0] for r in left.join(right, key, "left_anti").select(key).limit(5).collect()]
    if missing:
        raise ValueError(f"no {key} for {missing}")
    return left.join(right, key)


def renested(df: DataFrame, key: str, array: str, right: DataFrame, right_key: str, fields: list[str]) -> DataFrame:
    """(key, rows): for each row the structs of right for its array's keys, in order."""
    pairs = df.select(key, F.posexplode(array).alias("pos", "__k"))
    found = pairs.join(right.select(F.col(right_key).alias("__k"), *fields), "__k")
    rows = F.array_sort(F.collect_list(F.struct("pos", *fields)))
    nested = found.groupBy(key).agg(F.transform(rows, lambda r: F.struct(*(r[f].alias(f) for f in fields))).alias("rows"))
    return df.select(key).join(nested, key, "left")


def resolved_delta(base: DataFrame, delta: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """base with its columns overridden by the delta's where that has one; null inherits."""
    d = delta.select(key, *(F.col(c).alias(f"__{c}") for c in columns))
    joined = base.join(d, key, "left")
    changed = [F.coalesce(f"__{c}", c).alias(c) for c in columns]
    same = [c for c in base.columns if c not in columns]
    hit = F.coalesce(*(F.when(F.col(f"__{c}").isNotNull(), F.lit(True)) for c in columns), F.lit(False))
    return joined.select(*same, *changed, hit.alias("overridden"))


def routes(candidates: list[tuple[str, Column]], default: str) -> Column:
    """The name of the first condition that holds."""
    out = F.lit(default)
    for name, c in reversed(candidates):
        out = F.when(c, F.lit(name)).otherwise(out)
    return out
