"""Requests for plans, and the records that are exported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.plans.audit import codes, missing

#: The fields of an exported record, in order, and the names of formats.
CLEAN = ("qa_id", "image", "conversations", "question_type", "q_type", "evidence_boxes_xyxy", "answer_structured")
Q_TYPES = {"open-ended": "open", "closed-ended": "closed", "single-choice": "single", "multi-choice": "multi"}


def boxes_text(boxes: Column) -> Column:
    """Boxes as JSON with a blank after each comma."""
    one = F.transform(boxes, lambda b: F.concat(F.lit("["), F.array_join(F.transform(b, lambda v: v.cast("string")), ", "), F.lit("]")))
    return F.concat(F.lit("["), F.array_join(one, ", "), F.lit("]"))


def told_answer(format_: Column, structured: Column, answer: Column) -> Column:
    """What the answer turn says: an option's letter, joined options, or the answer."""
    option, several = F.get_json_object(structured, "$.option"), F.from_json(F.get_json_object(structured, "$.options"), "array<string>")
    return F.when((format_ == "single-choice") & option.isNotNull(), option).when((format_ == "multi-choice") & several.isNotNull(), F.array_join(several, ", ")).otherwise(answer)


def conversations(question: Column, options: Column, answer: Column, reason: Column, visual: Column, boxes: Column) -> Column:
    """The two turns of a record."""
    asked = F.concat(F.lit("<image>\n"), question, F.when(F.size(options) > 0, text.choices(options, True)).otherwise(""))
    told = F.concat(F.lit("<answer> "), answer, F.lit(" <reason> "), reason, F.lit(" <visual_evidence> "), visual, F.lit(" <location> "), boxes_text(boxes))
    turn = lambda who, value: F.struct(F.lit(who).alias("from"), value.alias("value"))
    return F.array(turn("human", asked), turn("gpt", told))


def evidence_boxes(plans: DataFrame, regions: DataFrame) -> DataFrame:
    """(qa_id, boxes) in the order of each plan's evidence; regions without a box are left
    out, and plans without any have none."""
    each = plans.select("qa_id", F.posexplode("evidence").alias("pos", "region_id")).join(regions.select("region_id", "box"), "region_id")
    return each.groupBy("qa_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "box"))), lambda r: r["box"]).alias("boxes"))


def clean_failures() -> Column:
    """Failures of a row of CLEAN columns."""
    c, b = F.col("conversations"), F.col("evidence_boxes_xyxy")
    human, gpt = F.try_element_at(c, F.lit(1)), F.try_element_at(c, F.lit(2))
    marks = F.lit(True)
    for m in ("<answer>", "<reason>", "<visual_evidence>", "<location>"):
        marks = marks & gpt["value"].contains(m)
    two = F.coalesce(F.size(c) == 2, F.lit(False))
    return codes(
        (missing(F.col("qa_id")), "invalid_qa_id"), (missing(F.col("image")), "invalid_image"), (~two, "invalid_conversations"),
        (two & ~F.coalesce((human["from"] == "human") & human["value"].startswith("<image>\n"), F.lit(False)), "invalid_human_turn"),
        (two & ~F.coalesce((gpt["from"] == "gpt") & marks, F.lit(False)), "invalid_gpt_turn"),
        (~F.coalesce(F.col("q_type").isin(*Q_TYPES.values()), F.lit(False)), "invalid_q_type"),
        (b.isNull(), "invalid_evidence_boxes"), (F.exists(b, lambda x: x.isNull() | (F.size(x) != 4) | F.exists(x, lambda v: v.isNull())), "invalid_bbox"),
        (F.col("answer_structured").isNull() | ~F.col("answer_structured").startswith("{"), "invalid_answer_structured"))


def checked(clean: DataFrame) -> DataFrame:
    """clean, if its columns are CLEAN in order and no row fails; else an error."""
    if tuple(clean.columns) != CLEAN:
        raise ValueError(f"columns {clean.columns}, not {CLEAN}")
    bad = [r[0] for r in clean.withColumn("f", clean_failures()).where(F.size("f") > 0).select("qa_id").limit(5).collect()]
    if bad:
        raise ValueError(f"records that fail: {bad}")
    return clean


def join_errors(master: DataFrame, clean: DataFrame, fields: tuple[str, ...] = CLEAN[1:]) -> DataFrame:
    """(kind, id): ids twice in either, clean ids that the master lacks or does not export,
    exportable ones that are not in clean, and fields that differ."""
    of = lambda df, name: df.select(F.lit(name).alias("kind"), F.col("qa_id").cast("string").alias("id"))
    twice = lambda df: df.groupBy("qa_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    go = master.where("master_record_status = 'ACCEPTED_EXPORTED'").select("qa_id")
    out = of(twice(master), "duplicate_master_id").unionByName(of(twice(clean), "duplicate_clean_id"))
    out = out.unionByName(of(clean.join(master, "qa_id", "left_anti"), "absent_from_master")).unionByName(of(go.join(clean, "qa_id", "left_anti"), "master_only"))
    both = clean.alias("c").join(master.alias("m"), "qa_id")
    out = out.unionByName(of(both.where(F.col("m.master_record_status") != "ACCEPTED_EXPORTED").select("qa_id"), "non_exportable_status"))
    for f in fields:
        out = out.unionByName(of(both.where(~F.col(f"c.{f}").eqNullSafe(F.col(f"m.{f}"))).select("qa_id"), f"mismatch:{f}"))
    return out


def requests(regions: DataFrame, facts: DataFrame, plans: DataFrame) -> DataFrame:
    """One package for each image with plans: its regions, numbered, its facts and plans,
    each in order. An image's are few."""
    nest = lambda df, *c: df.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct(*c))).alias("x"))
    r = nest(regions, "region_id", "box").select("image_id", F.transform("x", lambda v, i: F.struct((i + 1).alias("region_index"), v["region_id"].alias("region_id"), v["box"].alias("box"))).alias("regions"))
    f = nest(facts, "fact_id", "concept", "polarity").withColumnRenamed("x", "facts")
    p = nest(plans, "qa_id", "question", "protected_sha256").withColumnRenamed("x", "plans")
    return p.join(r, "image_id", "left").join(f, "image_id", "left").select("image_id", "regions", "facts", "plans")
