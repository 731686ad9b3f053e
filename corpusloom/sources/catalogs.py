"""Lookup tables, unions of sources and listings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_written(df: DataFrame, key: Column, order: str, *values: str) -> DataFrame:
    """(key, values): of each non-null key the row that was written last."""
    keyed = df.withColumn("__key", key).where("__key is not null")
    last = keyed.groupBy("__key").agg(F.max_by(F.struct(*values), order).alias("__row"))
    return last.select(F.col("__key").alias("key"), "__row.*")


def union_sources(sources: list[tuple[str, DataFrame, str]], path: str) -> DataFrame:
    """The rows of all sources whose path fits the source's pattern, with source_group.
    Columns that a source lacks are null."""
    parts = [df.where(F.col(path).rlike(pattern)).withColumn("source_group", F.lit(name)) for name, df, pattern in sources]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def discovered(*ids: DataFrame) -> DataFrame:
    """The distinct non-null ids (their first columns) of all sources."""
    parts = [df.select(F.col(df.columns[0]).alias("id")) for df in ids]
    return reduce(DataFrame.unionByName, parts).where("id is not null").distinct()


def first_candidate(ids: DataFrame, listing: DataFrame, key: str, path: str) -> DataFrame:
    """ids with the first path, in order, that the listing has for each; null without any."""
    return ids.join(listing.groupBy(key).agg(F.min(path).alias("resolved")), key, "left")


def png_size(content: Column) -> tuple[Column, Column]:
    """(width, height) of a PNG from its header; null for other content."""
    head = F.hex(F.substring(content, 1, 24))
    number = lambda at: F.conv(F.substring(head, at, 8), 16, 10).cast("int")
    png = F.substring(head, 1, 16) == "89504E470D0A1A0A"
    return F.when(png, number(33)), F.when(png, number(41))


def source_identity(path: Column, rules: list[tuple[str, str]], default: str) -> tuple[Column, Column]:
    """(catalog by the first fitting suffix, the folder that holds the file)."""
    catalog = reduce(lambda out, r: F.when(path.endswith(r[0]), F.lit(r[1])).otherwise(out), reversed(rules), F.lit(default))
    parts = F.split(path, "/")
    return catalog, F.when(F.size(parts) > 1, F.element_at(parts, -2))
