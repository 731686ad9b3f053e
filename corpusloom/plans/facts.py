"""Wide labels to fact rows, facts to plans: table-driven, sealed and grouped."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.ids import seal, stable_id


def unpivot_facts(df: DataFrame, key: str, specs: list[tuple[str, Column]]) -> DataFrame:
    """One row for each non-null label: key, concept, value, polarity, fact_id."""
    cells = F.array(*(F.struct(F.lit(n).alias("concept"), c.cast("string").alias("value")) for n, c in specs))
    rows = df.select(key, F.inline(cells)).where("value is not null")
    absent = F.col("value").isin("false", "0")
    return rows.withColumn("polarity", F.when(absent, "absent").otherwise("present")).withColumn("fact_id", stable_id("fact", F.col(key), F.col("concept"), F.col("value")))


def merge_values(facts: DataFrame, keys: list[str], value: str, sources: str) -> DataFrame:
    """Facts of one key become one row with its sorted distinct values and sources."""
    return facts.groupBy(*keys).agg(F.array_sort(F.collect_set(value)).alias("values"), F.array_sort(F.collect_set(sources)).alias("sources"))


def unambiguous(facts: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys with exactly one distinct value, and that value."""
    return facts.groupBy(*keys).agg(F.min(value).alias("value"), F.max(value).alias("__m")).where(F.col("value") == F.col("__m")).drop("__m")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    return child.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def sealed(df: DataFrame, fields: list[str], name: str = "protected_sha256") -> DataFrame:
    return df.withColumn(name, seal(**{f: F.col(f) for f in fields}))


def tampered(df: DataFrame, fields: list[str], name: str = "protected_sha256") -> DataFrame:
    """Rows whose fields no longer match their seal."""
    return df.where(~F.col(name).eqNullSafe(seal(**{f: F.col(f) for f in fields})))


@dataclass(frozen=True)
class Spec:
    """One kind of fact that a region may give: value is JSON text, null for no fact;
    parent is the place in the list of the spec whose fact this one details."""

    kind: str
    concept: Column
    family: Column
    value: Column
    surface: Column
    polarity: Column
    parent: int | None = None
    eligible: bool = True


FACT = ("kind", "concept", "family", "value", "surface", "polarity")


def fact_id(image: Column, region: Column, kind: Column, concept: Column, value: Column, polarity: Column) -> Column:
    return stable_id("fact", image, F.coalesce(region, F.lit("image")), kind, concept, value, polarity)


def build_facts(regions: DataFrame, image: str, region: str, specs: list[Spec], places: Column, accepted: Column) -> DataFrame:
    """One row for each fact of each region: the specs with a value, and its places, which
    are never asked about. A parent's id is computed from the same row, so nothing is
    joined or shuffled."""
    own = F.col(region)
    up = ("kind", "concept", "value", "polarity")
    no_parent = F.lit(None).cast("struct<kind:string,concept:string,value:string,polarity:string>")

    def row(s: Spec, parent: Column) -> Column:
        cells = (F.lit(s.kind), s.concept, s.family, s.value, s.surface, s.polarity, parent, accepted & F.lit(s.eligible))
        return F.struct(*(c.alias(n) for c, n in zip(cells, (*FACT, "parent", "eligible"))))

    def above(s: Spec) -> Column:
        if s.parent is None:
            return no_parent
        p = specs[s.parent]
        return F.when(p.value.isNotNull(), F.struct(*(c.alias(n) for n, c in zip(up, (F.lit(p.kind), p.concept, p.value, p.polarity)))))

    def place(p: Column) -> Column:
        return row(Spec("anatomy", p, F.lit("anatomy"), F.concat(F.lit('"'), p, F.lit('"')), p, F.lit("present"), eligible=False), no_parent)

    facts = F.array(*(row(s, above(s)) for s in specs))
    sorted_places = F.array_sort(F.array_distinct(places))
    every = F.concat(F.filter(facts, lambda f: f["value"].isNotNull()), F.transform(sorted_places, place))
    rows = regions.select(F.col(image).alias("image_id"), own.alias("region_id"), sorted_places.alias("places"), F.array(own).alias("evidence"), every.alias("__facts"))
    rows = rows.select("image_id", "region_id", "places", "evidence", F.inline("__facts"))
    # ids are worked out once for each fact, from its own row
    id_ = lambda at: fact_id(F.col("image_id"), F.col("region_id"), *(F.col(f"{at}{c}") for c in up))
    rows = rows.withColumns({"fact_id": id_(""), "parent_fact_id": F.when(F.col("parent").isNotNull(), id_("parent."))})
    return rows.select("image_id", "region_id", "places", "evidence", *FACT, "fact_id", "parent_fact_id", "eligible")


def image_state_facts(images: DataFrame, image: str, state: Column, concept: str, surface: str, evidence: Column, accepted: Column) -> DataFrame:
    """The fact of an image's own three-valued state; none where that is null."""
    value, polarity, none = state.cast("string"), F.when(state, "present").otherwise("absent"), F.lit(None).cast("string")
    cells = {"image_id": F.col(image), "region_id": none, "places": F.array().cast("array<string>"), "evidence": F.array_sort(evidence), "kind": F.lit("image_state"), "concept": F.lit(concept), "family": F.lit("image_state"), "value": value, "surface": F.lit(surface), "polarity": polarity}
    id_ = fact_id(F.col(image), none, F.lit("image_state"), F.lit(concept), value, polarity)
    return images.where(state.isNotNull()).select(*(c.alias(n) for n, c in cells.items()), id_.alias("fact_id"), none.alias("parent_fact_id"), accepted.alias("eligible"))


def unsupported_attributes(facts: DataFrame) -> DataFrame:
    """(fact_id, failure): attributes whose parent is missing or not present."""
    parents = facts.select(F.col("fact_id").alias("parent_fact_id"), F.col("polarity").alias("__p")).distinct()
    kids = facts.where("kind = 'attribute'").select("fact_id", "parent_fact_id").distinct().join(parents, "parent_fact_id", "left")
    failure = F.when(F.col("__p").isNull(), "parent_missing").when(F.col("__p") != "present", "parent_not_present")
    return kids.withColumn("failure", failure).where("failure is not null").select("fact_id", "failure")
