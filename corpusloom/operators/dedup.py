"""Keep-first, caps, contradictions, tri-state merges and provenance of what was dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key. The least order key of each group comes from a partial
    aggregate, so a key with most of the rows does not meet in one task."""
    least = df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("__o"))
    on = [df[k].eqNullSafe(least[k]) for k in keys]
    return df.join(least, [*on, F.struct(*(df[o] for o in order)) == F.col("__o")], "left_semi")


def dropped(df: DataFrame, keys: list[str], key: str) -> DataFrame:
    """Rows that keep_first drops, with the kept row's key."""
    least = df.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(F.min(key).alias("kept"))
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]  # a null key is a group, as in keep_first
    return df.join(least, on).drop(*(f"__{k}" for k in keys)).where(F.col(key) != F.col("kept"))


def cap(df: DataFrame, keys: list[str], order: list[str], limit: Column) -> DataFrame:
    """At most limit rows of each key, in order; limit may depend on the row."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__r", rank).where(F.col("__r") <= limit).drop("__r")


def contradictions(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys with more than one value."""
    return df.groupBy(*keys).agg(F.countDistinct(value).alias("n_values"), F.count(F.lit(1)).alias("n_rows")).where("n_values > 1")


def changes(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Rows whose value differs from that of the row before it with the same key."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("previous", before).where(F.col("previous") != F.col(value))


def merge_tristate(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """null joined with v is v; two values make null and a flag that sticks."""
    out = []
    for c in columns:
        n = F.countDistinct(c)
        out += [F.when(n == 1, F.min(c)).alias(c), (n > 1).alias(f"conflicting_{c}")]
    return df.groupBy(*keys).agg(*out)


def majority(train: DataFrame, key: str, label: str) -> DataFrame:
    """The most frequent label of each key; ties go to the least label."""
    counts = train.groupBy(key, label).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(key).agg(F.min(F.struct(-F.col("n"), F.col(label))).alias("m")).select(key, F.col(f"m.{label}").alias("predicted"))


def representative(df: DataFrame, key: list[str], by: list[str], columns: list[str]) -> DataFrame:
    """Of each key the row that is greatest by the given columns, in their order."""
    return df.groupBy(*key).agg(F.max_by(F.struct(*columns), F.struct(*by)).alias("__row")).select(*key, "__row.*")


def last_rows(df: DataFrame, key: list[str], order: list[str], n: int) -> DataFrame:
    """Of each key its last n rows by the order."""
    w = Window.partitionBy(*key).orderBy(*(F.desc(c) for c in order))
    return df.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= n).drop("__rank")
