"""Rule sets over plans, what is written for them, and the records made of both.

A rule set gives each row an array of the codes of what is wrong with it; audits lay
those out as (kind, id) rows, which operators.stats.counted_examples sums up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.functions.ids import seal

#: Reasons with which a reviewer's answer may be asked for.
REVIEW_REASONS = ("evidence_unclear", "evidence_contradicts_fact", "image_unusable", "generation_failure_after_retries")


def codes(*rules: tuple[Column, str | Column]) -> Column:
    """The sorted distinct codes of the conditions that hold; a null one does not."""
    each = [F.when(c, F.lit(name) if isinstance(name, str) else name) for c, name in rules]
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*each))))


def coded(prefix: str, items: Column) -> Column:
    return F.transform(items, lambda t: F.concat(F.lit(prefix), t))


def missing(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def has(haystack: Column, needle: Column) -> Column:
    return text.normalize(haystack).contains(text.normalize(needle))


def selected_facts(plans: DataFrame, facts: DataFrame, key: str = "qa_id") -> DataFrame:
    """(key, found, union, concepts, values, polarities, pairs, images, kinds, terms): what
    the facts of each plan say; found counts those that exist."""
    own = facts.select("fact_id", "concept", "value", "polarity", "kind", "surface", F.col("evidence").alias("e"), F.col("image_id").alias("i"), F.lit(1).alias("one")).distinct()
    each = plans.select(key, F.explode("fact_ids").alias("fact_id")).distinct().join(own, "fact_id", "left")
    sets = lambda c: F.array_sort(F.collect_set(c))
    return each.groupBy(key).agg(
        F.count("one").alias("found"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("e")))).alias("union"), sets("concept").alias("concepts"), sets("value").alias("values"), sets("polarity").alias("polarities"),
        sets(F.when(F.col("one") == 1, F.struct("concept", "polarity"))).alias("pairs"), sets("i").alias("images"), sets("kind").alias("kinds"), sets("surface").alias("surfaces"))


def structured(c: Column) -> Column:
    """The fields of a structured answer; values stay JSON text, so that "1" is not 1."""
    kind = "concept string, presence boolean, option string, normal boolean, abnormality_present boolean, observations array<struct<concept:string,polarity:string>>, values array<string>"
    return F.from_json(c, kind)


def answer_value(c: Column) -> Column:
    """The JSON text of a scalar "value" that ends a structured answer; null without."""
    found = F.regexp_extract(c, r'"value":("[^"]*"|true|false|-?[0-9.]+)\}$', 1)
    return F.when(found != "", found)


def semantic_failures(plans: DataFrame, facts: DataFrame) -> DataFrame:
    """(qa_id, failures): what a plan's answer says that its facts do not."""
    j = plans.join(selected_facts(plans, facts), "qa_id", "left").withColumn("s", structured(F.col("structured")))
    s = lambda f: F.col(f"s.{f}")
    whole = F.coalesce(F.col("found") == F.size("fact_ids"), F.size("fact_ids") == 0)
    value, quoted = answer_value(F.col("structured")), F.transform(s("values"), lambda v: F.concat(F.lit('"'), v, F.lit('"')))
    expected = F.array(F.when(s("presence"), "present").otherwise("absent"))
    pairs = lambda c: F.transform(c, lambda p: F.concat(p["concept"], F.lit("="), p["polarity"]))
    option = F.concat(s("option"), F.lit(". "), F.col("options")[s("option")], F.lit("."))
    rules = [
        (~F.array_sort("evidence").eqNullSafe(F.col("union")), "evidence_region_ids_not_fact_union"),
        (s("concept").isNotNull() & (F.col("concepts") != F.array(s("concept"))), "answer_concept_contradicts_fact"),
        (value.isNotNull() & ~F.array_contains("values", value), "answer_value_contradicts_fact"),
        (s("values").isNotNull() & (F.array_sort(quoted) != F.col("values")), "answer_values_contradict_facts"),
        ((value.isNotNull() | s("values").isNotNull()) & F.exists("surfaces", lambda t: ~has(F.col("answer"), t)), "answer_text_contradicts_fact_surface"),
        (s("presence").isNotNull() & (F.col("polarities") != expected), "answer_presence_contradicts_fact_polarity"),
        (s("option").isNotNull() & ~F.col("answer").eqNullSafe(option), "answer_option_inconsistent"),
        (s("normal").isNotNull() & ((F.col("concepts") != F.array(F.lit("image_normal"))) | (F.col("values") != F.array(s("normal").cast("string")))), "answer_normality_contradicts_fact"),
        (s("observations").isNotNull() & (F.array_sort(F.array_distinct(pairs(s("observations")))) != F.array_sort(pairs(F.col("pairs")))), "answer_observations_contradict_facts"),
    ]
    return j.select("qa_id", F.when(~whole, F.array(F.lit("source_fact_missing"))).otherwise(codes(*rules)).alias("failures"))


def candidate_rules(forbidden: list[str], anchors: Column, sealed_by: Column, exempt: tuple[str, ...] = ("Yes", "No")) -> Column:
    """Failures of what was written for a plan: columns question, reason (the plan's),
    candidate_question, candidate_reason, candidate_sha256, protected_sha256, answer, terms.

    anchors: for each plan an array of groups, of which a question keeps one term each;
    sealed_by: the seal that the plan's fields have now."""
    q, r = F.col("candidate_question"), F.col("candidate_reason")
    both = F.concat_ws(" ", q, r)
    lost = F.filter(anchors, lambda g: ~F.exists(g, lambda t: F.coalesce(has(q, t), F.lit(False))))
    answer = F.regexp_replace("answer", r"\.+$", "")
    simple = codes(
        (~F.col("candidate_sha256").eqNullSafe(F.col("protected_sha256")) | (F.col("protected_sha256") != sealed_by), "protected_field_seal_mismatch"),
        (missing(q), "missing_question"), (missing(r), "missing_reasoning_text"),
        (text.normalize(q) == text.normalize(F.col("question")), "question_not_paraphrased"),
        (text.normalize(r) == text.normalize(F.col("reason")), "reason_not_paraphrased"),
        (~answer.isin(*exempt) & text.leaks_answer(q, answer), "answer_leakage_in_question"))
    more = F.concat(
        text.found_terms(both, forbidden),
        coded("question_lost_attribute_anchor:", F.transform(lost, lambda g: F.array_join(g, "|"))),
        coded("reason_missing_fact:", F.filter("terms", lambda t: ~F.coalesce(has(r, t), F.lit(False)))))
    return F.array_sort(F.array_distinct(F.concat(simple, F.when(q.isNotNull() & r.isNotNull(), more).otherwise(F.array().cast("array<string>")))))


def unmatched(plans: DataFrame, candidates: DataFrame) -> DataFrame:
    """(qa_id, failure): candidates without a plan, and plans without a candidate."""
    p, c = plans.select("qa_id").distinct(), candidates.select("qa_id").distinct()
    of = lambda df, name: df.withColumn("failure", F.lit(name))
    return of(c.join(p, "qa_id", "left_anti"), "blueprint_missing").unionByName(of(p.join(c, "qa_id", "left_anti"), "missing_llm_candidate"))


def response_failures(requests: DataFrame, items: DataFrame) -> DataFrame:
    """(image_id, failures) of the items answered for the plans asked of each image.

    requests: image_id, plan_id, qa_id. items: image_id, plan_id, qa_id, status, reasons,
    question, reason, visual. A missing or unknown plan, a repeated one, a wrong id or
    status, a reviewer's reason that is not allowed, or text in an item for review, or
    none in an accepted one, fails."""
    j = items.join(requests.select("image_id", "plan_id", F.col("qa_id").alias("want")), ["image_id", "plan_id"], "left")
    review, known = F.col("status") == "review_required", F.col("want").isNotNull()
    bad_reasons = F.coalesce(F.size("reasons") < 1, F.lit(True)) | F.exists("reasons", lambda r: ~r.isin(*REVIEW_REASONS))
    own = codes(
        (known & ~F.col("qa_id").eqNullSafe(F.col("want")), "qa_id_mismatch"),
        (known & ~F.col("status").isin("accepted", "review_required"), "invalid_status"),
        (known & review & bad_reasons, "invalid_review_reasons"),
        (known & review & F.coalesce("question", "reason", "visual").isNotNull(), "review_text_must_be_null"),
        (known & (F.col("status") == "accepted") & missing(F.col("visual")), "missing_visual_evidence_summary"),
        (known & (F.col("status") == "accepted") & missing(F.col("question")), "missing_question"),
        (known & (F.col("status") == "accepted") & missing(F.col("reason")), "missing_reasoning_text"))
    rows = j.withColumn("own", F.when(known, F.transform(own, lambda c: F.concat("want", F.lit(":"), c))).otherwise(F.array(F.lit("unknown_qa_plan_id"))))
    got = rows.groupBy("image_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("own")))).alias("own"), F.count(F.lit(1)).alias("n"), F.countDistinct("plan_id").alias("d"), F.collect_set("plan_id").alias("seen"))
    asked = requests.groupBy("image_id").agg(F.collect_set("plan_id").alias("asked"))
    both = asked.join(got, "image_id", "left")
    n, lost = F.coalesce("n", F.lit(0)), F.array_sort(F.array_except("asked", F.coalesce("seen", F.array().cast("array<string>"))))
    group = codes((n != F.size("asked"), "item_count_mismatch"), (F.col("d") != F.col("n"), "duplicate_qa_plan_id"), (F.size(lost) > 0, F.concat(F.lit("missing_qa_plans:"), F.array_join(lost, ","))))
    return both.select("image_id", F.array_sort(F.array_distinct(F.concat(group, F.coalesce("own", F.array().cast("array<string>"))))).alias("failures"))


def template_failures(plans: DataFrame, facts: DataFrame) -> DataFrame:
    """(qa_id, failures): by each plan's template, what its facts must be like."""
    j = plans.join(selected_facts(plans, facts), "qa_id", "left").withColumn("s", structured(F.col("structured")))
    t, only = F.col("template"), lambda c, v: F.coalesce(F.col(c) == F.array(F.lit(v)), F.lit(False))
    told = F.array_sort(F.transform("s.observations", lambda p: p["concept"]))
    present = only("kinds", "observation") & only("polarities", "present")
    same = F.coalesce(F.col("concepts") == F.array(F.col("s.concept")), F.lit(False))
    value = F.coalesce(F.col("values") == F.array(answer_value(F.col("structured"))), F.lit(False))
    bad = {
        "abnormality_open_01": (present & F.coalesce(F.col("concepts") == told, F.lit(False)), "invalid_abnormality_answer"),
        "explicit_negative_closed_01": (only("kinds", "observation") & only("polarities", "absent") & same & (F.col("answer") == "No."), "invalid_explicit_negative"),
        "attribute_open_01": (only("kinds", "attribute") & only("polarities", "present") & same & value, "invalid_attribute_answer"),
        "grade_single_01": (same & value & F.col("options")[F.col("s.option")].isNotNull() & F.startswith(F.col("answer"), F.concat("s.option", F.lit(". "))), "invalid_choice"),
        "normal_closed_01": ((F.size("fact_ids") == 1) & only("concepts", "image_normal") & (F.col("answer") == F.when(F.col("s.normal"), "Yes.").otherwise("No.")), "invalid_normality_answer"),
        "abnormality_presence_closed_01": (present & F.coalesce(F.col("s.abnormality_present"), F.lit(False)) & (F.col("answer") == "Yes."), "invalid_rebalanced_abnormality"),
    }
    rules = [((t == name) & ~ok, code) for name, (ok, code) in bad.items()]
    rules.append((~t.isin(*bad), "unknown_template"))
    rules.append((F.exists("terms", lambda x: ~has(F.col("reason"), x)), "reason_missing_required_term"))
    return j.select("qa_id", codes(*rules).alias("failures"))


def label_failures(facts: DataFrame, labels: DataFrame) -> DataFrame:
    """(fact_id) of facts that no label of their region says.

    labels: image_id, region_id, concept, value, kind. Re-derived from the source, not from
    what made the facts; null regions (images) match null ones."""
    on = [facts["image_id"] == labels["image_id"], facts["region_id"].eqNullSafe(labels["region_id"]), facts["kind"] == labels["kind"], facts["concept"] == labels["concept"], facts["value"] == labels["value"]]
    return facts.join(labels, on, "left_anti").select("fact_id").distinct()


def plan_audit(plans: DataFrame, sources: DataFrame, facts: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    """(kind, id) of everything wrong with a layer of plans: seals, ids, facts, coverage of
    the plans it comes from (by source_qa_ids), and questions with several answers."""
    of = lambda df, name: df.select(F.lit(name).alias("kind"), F.col(df.columns[0]).cast("string").alias("id"))
    now = seal(**{f: F.col(f) for f in ("answer", "evidence", "fact_ids", "format", "intent", "qa_id", "structured")})
    said = plans.select(F.explode("source_qa_ids").alias("id"))
    want = sources.select(F.col("qa_id").alias("id"))
    picked = selected_facts(plans, facts).join(plans.select("qa_id", "image_id", "fact_ids"), "qa_id")
    parts = [
        of(plans.groupBy("qa_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "duplicate_qa_id"),
        of(want.join(said, "id", "left_anti"), "missing_source_qa_coverage"),
        of(said.join(want, "id", "left_anti"), "unexpected_source_qa_id"),
        of(said.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "source_qa_mapped_more_than_once"),
        of(plans.where(~F.col("protected_sha256").eqNullSafe(now)).select("qa_id"), "protected_field_seal_mismatch"),
        of(picked.where(F.col("found") < F.size(F.array_distinct("fact_ids"))).select("qa_id"), "source_fact_missing"),
        of(picked.where(F.exists("images", lambda i: i != F.col("image_id"))).select("qa_id"), "source_fact_wrong_image"),
        of(plans.where("template = 'attribute_open_01'").select("qa_id"), "generic_attribute_template_remaining"),
        of(collided(plans).select(F.explode("qa_ids")), "image_normalized_question_collision")]
    failing = semantic_failures(plans, facts).select(F.explode("failures").alias("kind"), F.col("qa_id").alias("id"))
    out = failing
    for p in parts:
        out = out.unionByName(p)
    if splits is not None:
        wrong = plans.join(splits.select("image_id", F.col("split").alias("__s")), "image_id", "left").where(~F.col("split").eqNullSafe(F.col("__s")))
        out = out.unionByName(of(wrong.select("qa_id"), "split_differs"))
    return out


def collided(plans: DataFrame, question: str = "question") -> DataFrame:
    """(image_id, qa_ids): plans of one image that ask the same, whatever the answers."""
    groups = plans.groupBy("image_id", text.normalize(F.col(question)).alias("key")).agg(F.array_sort(F.collect_list("qa_id")).alias("qa_ids"))
    return groups.where(F.size("qa_ids") > 1).select("image_id", "qa_ids")


def carried_failures(old: str = "old", new: str = "new", fields: tuple[str, ...] = ("answer", "evidence", "fact_ids", "format", "intent", "structured")) -> Column:
    """Failures of a row (structs old and new) that is to be carried forward as it is: a
    changed contract, a wrong seal, missing text, text as in the draft, or lost terms."""
    o, n = (lambda f, s=s: F.col(f"{s}.{f}") for s in (old, new))
    now = seal(**{f: n(f) for f in ("answer", "evidence", "fact_ids", "format", "intent", "qa_id", "structured")})
    rules = [(~o(f).eqNullSafe(n(f)), f"carried_contract_changed:{f}") for f in fields]
    rules += [(~n("protected_sha256").eqNullSafe(now), "protected_seal_mismatch"), (missing(o("candidate_question")), "missing_carried_question"), (missing(o("candidate_reason")), "missing_carried_reasoning_text"),
              (text.normalize(o("candidate_question")) == text.normalize(n("question")), "carried_question_not_paraphrased"), (text.normalize(o("candidate_reason")) == text.normalize(n("reason")), "carried_reason_not_paraphrased")]
    lost = F.filter(n("terms"), lambda t: ~F.coalesce(has(o("candidate_reason"), t), F.lit(False)))
    return F.array_sort(F.concat(codes(*rules), coded("carried_reason_missing_fact:", lost)))


def explicit_normal_conflicts(intent: Column, all_normal: Column, any_normal: Column, abnormality_present: Column) -> Column:
    """Conflicts between a plan's intent and facts that say that all is normal."""
    return codes((any_normal & (intent == "abnormality"), "abnormality_answer_includes_explicit_normal_fact"), (all_normal & (intent == "abnormality_presence") & F.coalesce(abnormality_present, F.lit(False)), "abnormality_true_contradicts_explicit_normal_facts"))


def schema_failures(fields: dict[str, str], patterns: dict[str, str], allowed: dict[str, list[str]], record: str = "record") -> Column:
    """Failures of JSON text that is to be an object of exactly these fields.

    fields: the type of each value (string, number, boolean, array, object; a "?" after it
    allows null); patterns and allowed: what strings must look like or be."""
    c = F.col(record)
    keys = F.json_object_keys(c)
    raw = F.from_json(c, "map<string,string>")
    kind = {"string": "STRING", "number": "(BIGINT|DOUBLE|DECIMAL)", "boolean": "BOOLEAN", "array": "ARRAY", "object": "(STRUCT|OBJECT)"}
    rules: list[tuple[Column, str | Column]] = [(keys.isNull(), "not_an_object")]
    extra = F.array_sort(F.array_except(keys, F.array(*map(F.lit, fields))))
    rules.append((F.size(extra) > 0, F.concat(F.lit("additional_fields:"), F.array_join(extra, ","))))
    for name, type_ in fields.items():
        has_ = F.array_contains(keys, name)
        said = F.schema_of_variant(F.try_variant_get(F.try_parse_json(c), f"$.{name}", "variant"))
        null = F.coalesce(raw[name].isNull() | (said == "VOID"), F.lit(True))
        rules.append((keys.isNotNull() & ~has_, f"missing_field:{name}"))
        wrong = ~said.rlike("^" + kind[type_.rstrip("?")])
        rules.append((has_ & F.when(null, F.lit(not type_.endswith("?"))).otherwise(wrong), f"wrong_type:{name}"))
        if name in patterns:
            rules.append((has_ & ~null & ~raw[name].rlike(patterns[name]), f"pattern:{name}"))
        if name in allowed:
            rules.append((has_ & ~null & ~raw[name].isin(*allowed[name]), f"not_allowed:{name}"))
    return codes(*rules)


def realization_failures(fields: tuple[str, ...], plan: str = "plan", response: str = "response", terms: str = "terms") -> Column:
    """Failures of a response (struct) to a plan (struct): not accepted, text that lacks, a
    changed protected field (an echo of the same is ignored), an answer told by the
    question, and terms that the reason lacks."""
    p, r = (lambda f, s=s: F.col(f"{s}.{f}") for s in (plan, response))
    rules = [(~p("protected_sha256").eqNullSafe(seal(**{f: p(f) for f in fields})), "invalid_blueprint_seal"), (~r("qa_id").eqNullSafe(p("qa_id")), "qa_id_mismatch"), (~r("status").eqNullSafe(F.lit("accepted")), "not_accepted")]
    rules += [(missing(r(f)), f"missing_{f}") for f in ("question", "reason")]
    rules += [(r(f).isNotNull() & (r(f) != p(f)), f"protected_field_mutation:{f}") for f in fields if f != "qa_id"]
    rules.append((text.leaks_answer(r("question"), p("answer")), "answer_leakage_in_question"))
    lost = F.filter(F.col(f"{plan}.{terms}"), lambda t: ~F.coalesce(has(r("reason"), t), F.lit(False)))
    return F.array_sort(F.concat(codes(*rules), coded("missing_reason_fact_term:", lost)))


def carry_split(plans: DataFrame, failures: Column) -> tuple[DataFrame, DataFrame]:
    """(carried, repair): rows of structs old and new whose contract is unchanged and whose
    carry-forward has no failure, and the others with what they come from."""
    marked = plans.withColumn("failures", failures)
    same = (F.col("new.migration_status") == "carried_forward_unchanged_contract") & (F.size("failures") == 0)
    return marked.where(same), marked.where(~F.coalesce(same, F.lit(False)))
