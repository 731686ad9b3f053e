"""Projections, label maps, roll-ups, registries and policies, driven by tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.ids import stable_id


def overridden(df: DataFrame, changes: dict[str, Column], drop: tuple[str, ...] = ()) -> DataFrame:
    """df with columns replaced or added, all from the old values, and others dropped."""
    return df.withColumns(changes).drop(*drop)


def label_set(rules: dict[str, Column]) -> Column:
    """The names of the conditions that hold, in the order given; a null one does not."""
    return F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in rules.items())))


def policy(found: Column, allowed: list[str], blocked: list[str]) -> Column:
    """(mode, allowed, blocked): which of the found concepts a text may name."""
    ok, no = (F.array_sort(F.array_intersect(found, F.array(*map(F.lit, x)))) for x in (allowed, blocked))
    mode = F.when(F.size(ok) > 0, "allowed_visible").otherwise("descriptive_only")
    return F.struct(mode.alias("mode"), ok.alias("allowed"), no.alias("blocked"))


def class_policy(df: DataFrame, label: str, split: str, test: int = 20, total: int = 50) -> DataFrame:
    """(label, n_test, n, report_ap): whether a class is frequent enough to be scored."""
    counts = df.groupBy(label).agg(F.count_if(F.col(split) == "test").alias("n_test"), F.count(F.lit(1)).alias("n"))
    return counts.withColumn("report_ap", (F.col("n_test") >= test) & (F.col("n") >= total))


MAPPING = "pattern string, path string, value string, scope string"


def mapped_labels(df: DataFrame, keys: list[str], label: Column, mapping: DataFrame) -> DataFrame:
    """(keys, scope, path, value): one row for each assignment that a label's text makes.

    mapping has the columns MAPPING: one pattern, the label's lower-cased text, may set
    several paths, and none with a null path (a label that is known and ignored). It is
    a lookup table that a person writes, so it is broadcast."""
    rows = df.select(*keys, F.lower(F.trim(label)).alias("__l"))
    return rows.join(F.broadcast(mapping), F.col("__l") == F.col("pattern")).where("path is not null").select(*keys, "scope", "path", "value")


def unmapped_labels(df: DataFrame, label: Column, mapping: DataFrame) -> DataFrame:
    """(label, n) of labels that the mapping does not know."""
    rows = df.select(F.lower(F.trim(label)).alias("label"))
    known = F.broadcast(mapping.select(F.col("pattern").alias("label")).distinct())
    return rows.join(known, "label", "left_anti").groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def registry(df: DataFrame, label: str, order: str, *first: str) -> DataFrame:
    """(label, n, first...): occurrences of each label and its first-seen columns."""
    seen = F.min_by(F.struct(*first), order).alias("__first")
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"), seen).select(label, "n", "__first.*")


def collisions(df: DataFrame, raw: str, canonical: str) -> DataFrame:
    """Raw ids that more than one canonical thing has: (raw, n, canonical ids in order)."""
    sets = df.groupBy(raw).agg(F.array_sort(F.collect_set(canonical)).alias("ids"))
    return sets.where(F.size("ids") > 1).select(raw, F.size("ids").cast("long").alias("n"), "ids")


def spread(df: DataFrame, group: str, aggregates: list[Column]) -> DataFrame:
    """df with what is aggregated over each row's group; a null group is a group. The
    aggregate comes first, so a large group is not gathered as a window would."""
    names = df.groupBy(F.col(group).alias("__g")).agg(*aggregates)
    return df.join(names, F.col(group).eqNullSafe(F.col("__g")), "left").drop("__g")


def rolled_up(df: DataFrame, key: str, explicit: Column, positive: Column, name: str = "normal") -> DataFrame:
    """(key, name, conflicting_<name>): the explicit values of a key, and false if anything
    positive is in it, merged as three-valued: two different ones make null and a flag."""
    values = F.array_compact(F.array_union(F.collect_set(explicit), F.when(F.bool_or(F.coalesce(positive, F.lit(False))), F.array(F.lit(False))).otherwise(F.array().cast("array<boolean>"))))
    one = df.groupBy(key).agg(values.alias("v"))
    return one.select(key, F.when(F.size("v") == 1, F.element_at("v", 1)).alias(name), (F.size("v") > 1).alias(f"conflicting_{name}"))


def by_geometry(df: DataFrame, image: str, geometry: Column, annotation: Column, label: str, position: str) -> DataFrame:
    """One region for each image and geometry, with the sorted annotations and labels.

    An annotation without an id gets one from its image, geometry and place, and the
    region's number counts the image's geometries in order of their hash."""
    synthetic = F.concat(F.lit("synthetic:"), stable_id("a", F.col(image), geometry, F.col(position)))
    rows = df.select(image, F.sha2(geometry, 256).alias("geometry_hash"), F.coalesce(annotation, synthetic).alias("a"), annotation.isNull().alias("made"), F.col(label).alias("l"))
    regions = rows.groupBy(image, "geometry_hash").agg(F.array_sort(F.collect_set("a")).alias("annotation_ids"), F.array_sort(F.collect_set("l")).alias("label_ids"), F.bool_or("made").alias("has_synthetic_id"))
    hashes = regions.groupBy(image).agg(F.array_sort(F.collect_list("geometry_hash")).alias("__all"))  # an image's regions are few
    number = F.array_position("__all", F.col("geometry_hash"))
    return regions.join(hashes, image).select(image, F.concat(F.lit("region_"), F.lpad(number.cast("string"), 4, "0")).alias("region_id"), "annotation_ids", "label_ids", "has_synthetic_id")


def same_geometry_events(df: DataFrame, keys: list[str], signature: str, annotation: str) -> DataFrame:
    """(keys, signature, kept, removed, type): of the annotations of one geometry and one
    meaning the least stays (A); where a geometry has several meanings, B."""
    groups = df.groupBy(*keys, signature).agg(F.min(annotation).alias("kept"), F.array_sort(F.collect_list(annotation)).alias("all"))
    meanings = groups.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(F.count(F.lit(1)).alias("__n"))
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    kind = F.when(F.col("__n") > 1, "B").otherwise("A")
    out = groups.join(meanings, on).withColumn("removed", F.slice("all", 2, F.greatest(F.size("all"), F.lit(1)))).withColumn("type", kind)
    return out.where("type = 'B' or size(removed) > 0").select(*keys, signature, "kept", "removed", "type")


def votes(df: DataFrame, key: str, surface: str) -> DataFrame:
    """(key, surface, n): the most frequent surface of each key, ties to the least."""
    counts = df.groupBy(key, surface).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("m"), F.col(surface))).alias("__t")).select(key, f"__t.{surface}", (-F.col("__t.m")).alias("n"))


def ordered_set(c: Column) -> Column:
    """A sorted array without repeats; null is empty."""
    return F.coalesce(F.array_sort(F.array_distinct(c)), F.array().cast(T.ArrayType(T.StringType())))
