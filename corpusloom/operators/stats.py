"""Distribution statistics, frequencies and baselines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.dedup import majority


def describe(df: DataFrame, by: str, value: str) -> DataFrame:
    """n, mean, sample deviation (0 for one row), minimum, quartiles, p95, maximum."""
    q = lambda p: F.round(F.percentile(value, F.lit(p)), 3)
    return df.groupBy(by).agg(
        F.count(value).alias("n"), F.round(F.mean(value), 3).alias("mean"), F.round(F.coalesce(F.stddev_samp(value), F.lit(0.0)), 3).alias("sd"),
        F.min(value).alias("min"), q(0.25).alias("p25"), q(0.5).alias("median"), q(0.75).alias("p75"), q(0.95).alias("p95"), F.max(value).alias("max"),
    )


def value_shares(df: DataFrame, value: str, split: str, splits: list[str]) -> DataFrame:
    """Counts of each value by split, in all, and in per cent of all."""
    counts = df.groupBy(value).pivot(split, splits).agg(F.count(F.lit(1))).na.fill(0, splits)
    total = sum((F.col(s) for s in splits[1:]), F.col(splits[0]))
    n = df.count()
    return counts.withColumn("total", total).withColumn("pct", F.round(1e2 * F.col("total") / F.lit(n), 4))


def most_common(tokens: DataFrame, token: str, n: int) -> DataFrame:
    """The n most frequent; ties by the token."""
    return tokens.groupBy(token).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), token).limit(n)


def majority_baseline(train: DataFrame, test: DataFrame, key: str, label: str, by: list[str] | None = None) -> DataFrame:
    """Accuracy and coverage of predicting each key's majority label, the global one for
    unseen keys; by: for each value of these columns."""
    top = train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), label).first()
    joined = test.join(majority(train, key, label), key, "left")
    guess = F.coalesce("predicted", F.lit(top[label] if top else None))
    return joined.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("n"), F.avg((guess == F.col(label)).cast("double")).alias("accuracy"), F.avg(F.col("predicted").isNotNull().cast("double")).alias("coverage"))


def rare(df: DataFrame, value: str, below: int) -> DataFrame:
    """Values that occur less often than below."""
    return df.groupBy(value).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < below)


def summed_distinct(df: DataFrame, split: str, columns: list[str]) -> DataFrame:
    """Distinct counts in each split, added up: a value in two splits counts twice."""
    counts = df.groupBy(split).agg(*(F.countDistinct(c).alias(c) for c in columns))
    return counts.agg(*(F.sum(c).alias(c) for c in columns))


def first_seen_order(df: DataFrame, value: str, position: str, n: int) -> DataFrame:
    """The n most frequent values with their rank; ties by where each was seen first.
    The limit comes before the ranks, so one task numbers n rows only."""
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("n"), F.min(position).alias("first"))
    top = counts.orderBy(F.desc("n"), "first", value).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "first", value)))


def map_sums(df: DataFrame, column: str) -> DataFrame:
    """(key, total) over all rows' maps of counters; a null counter counts as none."""
    return df.select(F.explode(column).alias("key", "value")).groupBy("key").agg(F.sum("value").alias("total"))


def counted_examples(df: DataFrame, code: str, example: str, most: int = 10) -> DataFrame:
    """For each code its number of rows and its least examples, most of them at most.

    The examples are cut by rank before they are gathered, so a code that most rows
    have does not gather them."""
    counts = df.groupBy(code).agg(F.count(F.lit(1)).alias("n"))
    ranked = df.select(code, example).withColumn("__rank", F.row_number().over(Window.partitionBy(code).orderBy(example)))
    few = ranked.where(F.col("__rank") <= most).groupBy(code).agg(F.array_sort(F.collect_list(example)).alias("examples"))
    return counts.join(few, code)


def box_counts(df: DataFrame, by: str, boxes: str) -> DataFrame:
    """Rows, boxes, rows with a box, and boxes without a positive width and height."""
    bad = F.size(F.filter(boxes, lambda b: ~((b[2] > b[0]) & (b[3] > b[1]))))
    n = F.coalesce(F.array_size(boxes), F.lit(0))
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.sum(n).alias("boxes"), F.count_if(n > 0).alias("with_box"), F.sum(F.when(n > 0, bad).otherwise(0)).alias("invalid"))
