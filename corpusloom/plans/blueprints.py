"""From facts to question plans: grouping rules, merges, seals and contract migrations.

A plan is a row of PLAN columns. Its structured answer is canonical JSON text, so that it
can be compared, hashed and sealed as it is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.functions.ids import seal, stable_id

PLAN = ("image_id", "intent", "format", "template", "question", "structured", "answer", "reason", "options", "fact_ids", "evidence", "terms")
#: What the seal of a plan covers.
PROTECTED = ("answer", "evidence", "fact_ids", "format", "intent", "qa_id", "structured")


def json_string(c: Column) -> Column:
    """A plain string (without quotes or control signs) as JSON."""
    return F.concat(F.lit('"'), c, F.lit('"'))


def json_list(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def observations(pairs: Column) -> Column:
    """The structured answer of an array of (concept, polarity), sorted."""
    each = F.transform(F.array_sort(F.array_distinct(pairs)), lambda p: F.concat(F.lit('{"concept":"'), p["concept"], F.lit('","polarity":"'), p["polarity"], F.lit('"}')))
    return F.concat(F.lit('{"observations":'), json_list(each), F.lit("}"))


def at_places(places: Column) -> Column:
    return F.when(F.size(places) > 0, F.concat(F.lit(" at "), text.joined(places))).otherwise("")


def grouped(facts: DataFrame, *keys: str) -> DataFrame:
    """Facts of one image and key together: their ids, evidence, terms and places as
    sorted sets, and the pairs of concept and polarity."""
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c))))
    own = lambda c: F.array_sort(F.collect_set(c))
    return facts.groupBy("image_id", *keys).agg(own("fact_id").alias("fact_ids"), union("evidence").alias("evidence"), own("surface").alias("terms"), union("places").alias("places"), own(F.struct("concept", "polarity")).alias("pairs"), F.min("family").alias("family"), F.min("surface").alias("surface"), own("parent_fact_id").alias("parents"))


def plan(groups: DataFrame, **cells: Column) -> DataFrame:
    """Groups as plans; cells for what a group does not have itself."""
    return groups.select(*((cells[c] if c in cells else F.col(c) if c in groups.columns else F.create_map().cast("map<string,string>")).alias(c) for c in PLAN))


def qa_id() -> Column:
    return stable_id("qa", F.col("image_id"), F.col("intent"), F.col("format"), F.col("template"), F.concat_ws("\u0000", "fact_ids"))


def build_plans(facts: DataFrame, graded: dict[str, tuple[str, str]] | None = None, graded_concept: str = "") -> DataFrame:
    """The plans of all images, by five rules, without repeats of one intent, set of facts
    and answer (the first rule's stays).

    graded: for the values of graded_concept, the option's letter and text."""
    can = facts.where("eligible")
    of = lambda kind, polarity: can.where((F.col("kind") == kind) & (F.col("polarity") == polarity))
    lit, cat, said = F.lit, F.concat, text.joined(F.col("terms"))
    rules = [plan(
        grouped(of("observation", "present")), intent=lit("abnormality"), format=lit("open-ended"), template=lit("abnormality_open_01"), question=lit("Which findings are recorded?"),
        structured=observations(F.col("pairs")), answer=text.sentence(said), reason=cat(lit("The evidence shows "), said, lit(".")))]
    rules.append(plan(
        grouped(of("observation", "absent"), "concept"), intent=F.col("family"), format=lit("closed-ended"), template=lit("explicit_negative_closed_01"), question=cat(lit("Is "), F.col("surface"), lit(" recorded?")),
        structured=cat(lit('{"concept":'), json_string(F.col("concept")), lit(',"presence":false}')), answer=lit("No."), reason=cat(lit("The evidence does not show "), F.col("surface"), lit("."))))
    details = grouped(of("attribute", "present"), "concept", "value")
    several = details.groupBy("image_id", "concept").agg(F.count(lit(1)).alias("n_values"))
    details = details.join(several, ["image_id", "concept"]).where((F.col("n_values") == 1) | (F.size("places") > 0))
    where = at_places(F.col("places"))
    answer = cat(lit('{"concept":'), json_string(F.col("concept")), lit(',"value":'), F.col("value"), lit("}"))
    if graded:
        options = F.create_map(*(lit(x) for letter, name in sorted(graded.values()) for x in (letter, name)))
        letters = F.create_map(*(lit(x) for v, (letter, _) in graded.items() for x in (f'"{v}"', letter)))
        letter = letters[F.col("value")]
        rules.append(plan(
            details.where(F.col("concept") == graded_concept), intent=lit("degree"), format=lit("single-choice"), template=lit("grade_single_01"), question=cat(lit("Which grade is confirmed"), where, lit("?")), options=options,
            structured=cat(lit('{"concept":'), json_string(F.col("concept")), lit(',"option":'), json_string(letter), lit(',"value":'), F.col("value"), lit("}")), answer=cat(letter, lit(". "), options[letter], lit(".")), reason=cat(lit("The evidence"), where, lit(" shows "), F.col("surface"), lit("."))))
    parents = can.select(F.col("fact_id").alias("__id"), F.col("surface").alias("__s"))
    plain = details.where(F.col("concept") != graded_concept)
    of_parent = plain.select("image_id", "concept", "value", F.explode("parents").alias("__id")).join(parents, "__id").groupBy("image_id", "concept", "value").agg(F.min("__s").alias("parent"))
    rules.append(plan(
        plain.join(of_parent, ["image_id", "concept", "value"], "left"), intent=F.col("family"), format=lit("open-ended"), template=lit("attribute_open_01"), question=cat(lit("What is confirmed of "), F.coalesce("parent", lit("the finding")), where, lit("?")),
        structured=answer, answer=text.sentence(F.col("surface")), reason=cat(lit("The evidence"), where, lit(" shows "), F.col("surface"), lit("."))))
    yes = F.col("value") == "true"
    rules.append(plan(
        grouped(can.where("kind = 'image_state'"), "value").withColumn("terms", F.array().cast("array<string>")), intent=lit("image_normality"), format=lit("closed-ended"), template=lit("normal_closed_01"), question=lit("Is this image confirmed as normal?"),
        structured=cat(lit('{"normal":'), F.col("value"), lit("}")), answer=F.when(yes, "Yes.").otherwise("No."), reason=F.when(yes, "The image is confirmed as normal.").otherwise("The image is confirmed as not normal.")))
    every = reduce(DataFrame.unionByName, (r.withColumn("__rule", lit(i)) for i, r in enumerate(rules)))
    first = every.groupBy("image_id", "intent", "fact_ids", "structured").agg(F.min_by(F.struct(*(c for c in (*PLAN, "__rule") if c not in ("image_id", "intent", "fact_ids", "structured"))), F.struct("__rule", "template")).alias("__p"))
    return first.select("image_id", "intent", "fact_ids", "structured", "__p.*").drop("__rule").withColumn("qa_id", qa_id())


def sealed(plans: DataFrame) -> DataFrame:
    return plans.withColumn("protected_sha256", seal(**{f: F.col(f) for f in PROTECTED}))


def merge_attributes(plans: DataFrame, facts: DataFrame, version: str) -> DataFrame:
    """Plans, those of attribute_open_01 merged for each image, concept and set of places,
    with all their values and the plans that they come from; a group of several values
    gets an id of its own. Sealed."""
    one = F.col("template") == "attribute_open_01"
    ordinary = plans.where(~one).withColumn("source_qa_ids", F.array("qa_id"))
    own = facts.select("fact_id", "concept", "value", "surface", "places", F.col("evidence").alias("__e")).distinct()
    each = plans.where(one).select("image_id", "qa_id", F.explode("fact_ids").alias("fact_id")).join(own, "fact_id")
    keyed = each.groupBy("image_id", "qa_id", "concept").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("places")))).alias("places"))
    rows = each.drop("places").join(keyed, ["image_id", "qa_id", "concept"])
    sets = lambda c: F.array_sort(F.collect_set(c))
    g = rows.groupBy("image_id", "concept", "places").agg(sets("qa_id").alias("source_qa_ids"), sets("value").alias("v"), sets("surface").alias("terms"), sets("fact_id").alias("fact_ids"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("__e")))).alias("evidence"))
    several = F.size("v") > 1
    where, said = at_places(F.col("places")), text.joined(F.col("terms"))
    new_id = stable_id("qa", F.lit(version), F.col("image_id"), F.col("concept"), json_list(F.col("v")), json_list(F.transform("places", json_string)))
    value = F.when(several, F.concat(F.lit(',"values":'), json_list(F.col("v")))).otherwise(F.concat(F.lit(',"value":'), F.element_at("v", 1)))
    merged = plan(
        g.withColumn("qa", F.when(several, new_id).otherwise(F.element_at("source_qa_ids", 1))), intent=F.col("concept"), format=F.lit("open-ended"), template=F.concat("concept", F.lit("_open_01")),
        question=F.concat(F.lit("What is the "), F.replace(F.col("concept"), F.lit("_"), F.lit(" ")), where, F.lit("?")), structured=F.concat(F.lit('{"concept":'), json_string(F.col("concept")), value, F.lit("}")),
        answer=text.sentence(said), reason=F.concat(F.lit("The evidence"), where, F.lit(" shows "), said, F.lit(".")))
    extra = g.select("image_id", "fact_ids", F.col("concept").alias("intent"), F.when(several, new_id).otherwise(F.element_at("source_qa_ids", 1)).alias("qa_id"), "source_qa_ids")
    merged = merged.join(extra, ["image_id", "fact_ids", "intent"])
    return sealed(ordinary.unionByName(merged))


def collisions(plans: DataFrame, question: str = "question") -> DataFrame:
    """(image_id, key, n_answers, qa_ids): questions of one image with several answers."""
    key = text.normalize(F.col(question)).alias("key")
    groups = plans.groupBy("image_id", key).agg(F.countDistinct("structured").alias("n_answers"), F.array_sort(F.collect_set("qa_id")).alias("qa_ids"))
    return groups.where("n_answers > 1")


def normal_facts(facts: DataFrame, concepts: list[str]) -> Column:
    """Whether a fact says that something is as it should be."""
    return F.col("concept").isin(*concepts) & (F.col("value") == "true") & (F.col("polarity") == "present")


CARRIED, REMOVED, CONVERTED = "carried_forward_unchanged_contract", "repaired_remove_normal_facts_from_abnormality", "repaired_convert_abnormality_to_normal_finding"


def migrate(plans: DataFrame, facts: DataFrame, normal: list[str], version: str) -> DataFrame:
    """Plans whose abnormalities are no normal findings: facts that are normal leave, and a
    plan of nothing else becomes a question about normal findings. Changed plans get new
    ids. Adds migration_status and source_qa_id; sealed anew."""
    affected = F.col("intent").isin("abnormality", "abnormality_presence")
    own = facts.select("fact_id", "surface", "concept", "polarity", F.col("evidence").alias("__e"), normal_facts(facts, normal).alias("__n")).distinct()
    each = plans.where(affected).select("qa_id", F.explode("fact_ids").alias("fact_id")).join(own, "fact_id")
    pick = lambda c, n: F.array_sort(F.collect_set(F.when(F.col("__n") == n, c)))
    parts = each.groupBy("qa_id").agg(*(e.alias(f"{name}{int(n)}") for n in (False, True) for name, e in (("__f", pick(F.col("fact_id"), n)), ("__t", pick(F.col("surface"), n)), ("__p", pick(F.struct("concept", "polarity"), n)), ("__e", F.array_sort(F.array_distinct(F.flatten(pick(F.col("__e"), n))))))))
    j = plans.join(parts, "qa_id", "left")
    action = F.when(F.size("__f1") > 0, F.when(F.size("__f0") > 0, REMOVED).otherwise(CONVERTED)).otherwise(CARRIED)
    j = j.withColumn("migration_status", F.coalesce(action, F.lit(CARRIED))).withColumn("source_qa_id", F.col("qa_id"))
    changed, to_normal, is_open = F.col("migration_status") != CARRIED, F.col("migration_status") == CONVERTED, F.col("intent") == "abnormality"
    side = lambda name: F.when(to_normal, F.col(f"{name}1")).otherwise(F.col(f"{name}0"))
    said = text.joined(side("__t"))
    rewrites = changed & (to_normal | is_open)
    new = {
        "fact_ids": F.when(changed, side("__f")).otherwise(F.col("fact_ids")), "evidence": F.when(changed, side("__e")).otherwise(F.col("evidence")), "terms": F.when(changed, side("__t")).otherwise(F.col("terms")),
        "reason": F.when(changed, F.concat(F.lit("The evidence shows "), said, F.lit("."))).otherwise(F.col("reason")),
        "structured": F.when(rewrites, observations(side("__p"))).otherwise(F.col("structured")),
        "answer": F.when(to_normal & ~is_open, F.lit("Yes.")).when(rewrites, text.sentence(said)).otherwise(F.col("answer")),
        "question": F.when(to_normal, F.when(is_open, "Which normal findings are recorded?").otherwise("Are normal findings recorded?")).otherwise(F.col("question")),
        "template": F.when(to_normal, F.when(is_open, "normal_findings_open_01").otherwise("normal_findings_closed_01")).otherwise(F.col("template")),
        "intent": F.when(to_normal, F.lit("normal_findings")).otherwise(F.col("intent")),
    }
    out = j.withColumns(new).drop(*(c for c in j.columns if c.startswith("__")))
    new_id = stable_id("qa", F.lit(version), F.col("source_qa_id"), F.col("migration_status"), F.concat_ws("\u0000", "fact_ids"), F.col("structured"))
    return sealed(out.withColumn("qa_id", F.when(changed, new_id).otherwise(F.col("qa_id"))))
