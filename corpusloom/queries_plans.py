"""Queries from labels to facts, plans, audits, requests and records.

Events stand for labelled regions: the user is the image, the event a region, its type the
concept observed, and k (of props) gives each label. Derived labels are written below
once for Spark and once, in the same words, for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import ids, text
from corpusloom.operators import stats
from corpusloom.plans import audit, blueprints, facts, records
from corpusloom.registry import query
from corpusloom.session import table, written

GRADES = {"grade_0": ("A", "Up to a third"), "grade_1": ("B", "Up to two thirds"), "grade_2": ("C", "Above two thirds")}
NORMAL = ["view"]


def _regions(spark, d) -> DataFrame:
    k = F.col("k")
    e = table(spark, d, "events").select(F.col("user_id").alias("image_id"), F.concat(F.lit("r"), F.col("event_id")).alias("region_id"), F.col("event_type").alias("concept"), F.get_json_object("props", "$.k").cast("int").alias("k"))
    return e.select(
        "*", (k < 90).alias("accepted"), F.when(k % 5 > 0, k % 5 < 4).alias("presence"), F.when(k % 5 < 2, F.concat(F.lit("tone_"), k % 3)).alias("tone"),
        F.when((F.col("concept") == "error") & (k % 5 == 2), F.concat(F.lit("grade_"), k % 3)).alias("grade"),
        F.when(k % 7 < 3, F.array(F.lit("left"))).when(k % 7 < 5, F.array(F.lit("right"), F.lit("left"))).otherwise(F.array().cast("array<string>")).alias("places"),
        F.array(k, k + 1, k + 10, k + 21).alias("box"))


def _facts(spark, d) -> DataFrame:
    r = _regions(spark, d)
    c, quoted = F.col("concept"), lambda v: F.concat(F.lit('"'), F.col(v), F.lit('"'))
    specs = [
        facts.Spec("observation", c, c, F.col("presence").cast("string"), F.concat(F.lit("event "), c), F.when(F.col("presence"), "present").otherwise("absent")),
        facts.Spec("attribute", F.concat(c, F.lit("_tone")), F.lit("tone"), quoted("tone"), F.replace(F.col("tone"), F.lit("_"), F.lit(" ")), F.lit("present"), 0),
        facts.Spec("attribute", F.lit("error_grade"), F.lit("grade"), quoted("grade"), F.replace(F.col("grade"), F.lit("_"), F.lit(" ")), F.lit("present"), 0)]
    own = facts.build_facts(r, "image_id", "region_id", specs, F.col("places"), F.col("accepted"))
    images = r.groupBy("image_id").agg(F.collect_set(F.when(F.col("presence"), F.col("region_id"))).alias("e"))
    state = F.when(F.col("image_id") % 3 < 2, F.col("image_id") % 3 == 0)
    return own.unionByName(facts.image_state_facts(images, "image_id", state, "image_normal", "normal image", F.col("e"), F.lit(True)))


def _plans(spark, d) -> DataFrame:
    return blueprints.build_plans(written(_facts(spark, d), "facts"), GRADES, "error_grade")


def norm(e: str) -> str:
    return rf"trim(regexp_replace(lower({e}), '[^\p{{L}}\p{{N}}_%]+', ' ', 'g'))"


def joined(e: str) -> str:
    return f"CASE WHEN len({e}) < 2 THEN array_to_string({e}, ', ') ELSE array_to_string({e}[1:len({e}) - 1], ', ') || ' and ' || {e}[len({e})] END"


def sentence(e: str) -> str:
    return f"upper(substr({e}, 1, 1)) || substr({e}, 2) || '.'"


def fid(kind: str, concept: str, value: str, polarity: str) -> str:
    return f"'fact_' || substr(sha256(concat_ws(chr(0), CAST(image_id AS VARCHAR), region_id, {kind}, {concept}, {value}, {polarity})), 1, 20)"


REG = """r AS (SELECT user_id AS image_id, 'r' || event_id AS region_id, event_type AS concept, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events),
    g AS (SELECT *, k < 90 AS accepted, CASE WHEN k % 5 > 0 THEN k % 5 < 4 END AS presence, CASE WHEN k % 5 < 2 THEN 'tone_' || (k % 3) END AS tone, CASE WHEN concept = 'error' AND k % 5 = 2 THEN 'grade_' || (k % 3) END AS grade,
        CASE WHEN k % 7 < 3 THEN ['left'] WHEN k % 7 < 5 THEN ['left', 'right'] ELSE CAST([] AS VARCHAR[]) END AS places, [k, k + 1, k + 10, k + 21] AS box FROM r)"""
POL, VAL = "CASE WHEN presence THEN 'present' ELSE 'absent' END", "CAST(presence AS VARCHAR)"
PARENT = f"CASE WHEN presence IS NOT NULL THEN {fid(chr(39) + 'observation' + chr(39), 'concept', VAL, POL)} END"
QT, QG, QP = "'\"' || tone || '\"'", "'\"' || grade || '\"'", "'\"' || place || '\"'"
FACTS = f"""{REG},
    s AS (SELECT image_id, list_sort(coalesce(list(region_id) FILTER (WHERE presence), [])) AS e, image_id % 3 = 0 AS normal, NULL AS region_id FROM g GROUP BY image_id HAVING image_id % 3 < 2),
    f AS (SELECT image_id, region_id, 'observation' AS kind, concept, concept AS family, {VAL} AS value, 'event ' || concept AS surface, {POL} AS polarity, places, [region_id] AS evidence, {fid("'observation'", 'concept', VAL, POL)} AS fact_id, NULL AS parent_fact_id, accepted AS eligible FROM g WHERE presence IS NOT NULL
        UNION ALL SELECT image_id, region_id, 'attribute', concept || '_tone', 'tone', {QT}, replace(tone, '_', ' '), 'present', places, [region_id], {fid("'attribute'", "concept || '_tone'", QT, "'present'")}, {PARENT}, accepted FROM g WHERE tone IS NOT NULL
        UNION ALL SELECT image_id, region_id, 'attribute', 'error_grade', 'grade', {QG}, replace(grade, '_', ' '), 'present', places, [region_id], {fid("'attribute'", "'error_grade'", QG, "'present'")}, {PARENT}, accepted FROM g WHERE grade IS NOT NULL
        UNION ALL SELECT image_id, region_id, 'anatomy', place, 'anatomy', {QP}, place, 'present', places, [region_id], {fid("'anatomy'", 'place', QP, "'present'")}, NULL, FALSE FROM (SELECT *, unnest(places) AS place FROM g)
        UNION ALL SELECT image_id, NULL, 'image_state', 'image_normal', 'image_state', CAST(normal AS VARCHAR), 'normal image', CASE WHEN normal THEN 'present' ELSE 'absent' END, CAST([] AS VARCHAR[]), e,
            'fact_' || substr(sha256(concat_ws(chr(0), CAST(image_id AS VARCHAR), 'image', 'image_state', 'image_normal', CAST(normal AS VARCHAR), CASE WHEN normal THEN 'present' ELSE 'absent' END)), 1, 20), NULL, TRUE FROM s)"""
SETS = "list_sort(list(DISTINCT fact_id)) AS fact_ids, list_sort(list_distinct(flatten(list(evidence)))) AS evidence, list_sort(list(DISTINCT surface)) AS terms, list_sort(list_distinct(flatten(list(places)))) AS places"
AT = f"CASE WHEN len(places) > 0 THEN ' at ' || ({joined('places')}) ELSE '' END"
LETTER = "CASE value WHEN '\"grade_0\"' THEN 'A' WHEN '\"grade_1\"' THEN 'B' ELSE 'C' END"
GRADE_TEXT = "CASE value WHEN '\"grade_0\"' THEN 'A. Up to a third.' WHEN '\"grade_1\"' THEN 'B. Up to two thirds.' ELSE 'C. Above two thirds.' END"
PLANS = f"""{FACTS},
    a1 AS (SELECT image_id, {SETS}, '{{"observations":[' || string_agg(DISTINCT '{{"concept":"' || concept || '","polarity":"present"}}', ',' ORDER BY '{{"concept":"' || concept || '","polarity":"present"}}') || ']}}' AS structured FROM f WHERE eligible AND kind = 'observation' AND polarity = 'present' GROUP BY 1),
    a2 AS (SELECT image_id, concept, min(surface) AS x, {SETS} FROM f WHERE eligible AND kind = 'observation' AND polarity = 'absent' GROUP BY 1, 2),
    a3 AS (SELECT image_id, concept, value, min(family) AS family, min(surface) AS x, {SETS}, list(DISTINCT parent_fact_id) AS parents FROM f WHERE eligible AND kind = 'attribute' GROUP BY 1, 2, 3),
    a4 AS (SELECT *, {AT} AS place FROM (SELECT *, count(*) OVER (PARTITION BY image_id, concept) AS n FROM a3) WHERE n = 1 OR len(places) > 0),
    up AS (SELECT image_id, concept, value, min(surface) AS parent FROM (SELECT image_id, concept, value, unnest(parents) AS id FROM a4) JOIN (SELECT fact_id AS id, surface FROM f WHERE eligible) USING (id) GROUP BY 1, 2, 3),
    a5 AS (SELECT image_id, value, {SETS} FROM f WHERE kind = 'image_state' GROUP BY 1, 2),
    p0 AS (SELECT image_id, 'abnormality' AS intent, 'open-ended' AS format, 'abnormality_open_01' AS template, 'Which findings are recorded?' AS question, structured, {sentence('(' + joined('terms') + ')')} AS answer, 'The evidence shows ' || ({joined('terms')}) || '.' AS reason, fact_ids, evidence, terms FROM a1
        UNION ALL SELECT image_id, concept, 'closed-ended', 'explicit_negative_closed_01', 'Is ' || x || ' recorded?', '{{"concept":"' || concept || '","presence":false}}', 'No.', 'The evidence does not show ' || x || '.', fact_ids, evidence, terms FROM a2
        UNION ALL SELECT image_id, 'degree', 'single-choice', 'grade_single_01', 'Which grade is confirmed' || place || '?', '{{"concept":"error_grade","option":"' || {LETTER} || '","value":' || value || '}}', {GRADE_TEXT}, 'The evidence' || place || ' shows ' || x || '.', fact_ids, evidence, terms FROM a4 WHERE concept = 'error_grade'
        UNION ALL SELECT image_id, family, 'open-ended', 'attribute_open_01', 'What is confirmed of ' || coalesce(parent, 'the finding') || place || '?', '{{"concept":"' || concept || '","value":' || value || '}}', {sentence('x')}, 'The evidence' || place || ' shows ' || x || '.', fact_ids, evidence, terms FROM a4 LEFT JOIN up USING (image_id, concept, value) WHERE concept <> 'error_grade'
        UNION ALL SELECT image_id, 'image_normality', 'closed-ended', 'normal_closed_01', 'Is this image confirmed as normal?', '{{"normal":' || value || '}}', CASE WHEN value = 'true' THEN 'Yes.' ELSE 'No.' END, CASE WHEN value = 'true' THEN 'The image is confirmed as normal.' ELSE 'The image is confirmed as not normal.' END, fact_ids, evidence, CAST([] AS VARCHAR[]) FROM a5),
    p AS (SELECT *, 'qa_' || substr(sha256(concat_ws(chr(0), CAST(image_id AS VARCHAR), intent, format, template, array_to_string(fact_ids, chr(0)))), 1, 20) AS qa_id FROM p0)"""
SEAL = """sha256('{"answer":' || CAST(to_json(answer) AS VARCHAR) || ',"evidence":' || CAST(to_json(evidence) AS VARCHAR) || ',"fact_ids":' || CAST(to_json(fact_ids) AS VARCHAR) || ',"format":"' || format || '","intent":"' || intent || '","qa_id":"' || qa_id || '","structured":' || CAST(to_json(structured) AS VARCHAR) || '}')"""
MERGED = f"""{PLANS},
    m1 AS (SELECT image_id, qa_id, concept, f.value, f.surface, f.places, f.evidence AS e, fact_id FROM (SELECT image_id, qa_id, unnest(fact_ids) AS fact_id FROM p WHERE template = 'attribute_open_01') JOIN f USING (image_id, fact_id)),
    m2 AS (SELECT image_id, qa_id, concept, list_sort(list_distinct(flatten(list(places)))) AS key FROM m1 GROUP BY 1, 2, 3),
    m3 AS (SELECT image_id, concept, key AS places, list_sort(list(DISTINCT qa_id)) AS src, list_sort(list(DISTINCT value)) AS v, list_sort(list(DISTINCT surface)) AS terms, list_sort(list(DISTINCT fact_id)) AS fact_ids, list_sort(list_distinct(flatten(list(e)))) AS evidence FROM m1 JOIN m2 USING (image_id, qa_id, concept) GROUP BY 1, 2, 3),
    m4 AS (SELECT *, {AT} AS place, {joined('terms')} AS said, '[' || array_to_string(v, ',') || ']' AS vs, '[' || array_to_string(list_transform(places, lambda x: '"' || x || '"'), ',') || ']' AS ps FROM m3),
    q0 AS (SELECT image_id, intent, format, template, question, structured, answer, reason, fact_ids, evidence, terms, qa_id, [qa_id] AS source_qa_ids FROM p WHERE template <> 'attribute_open_01'
        UNION ALL SELECT image_id, concept, 'open-ended', concept || '_open_01', 'What is the ' || replace(concept, '_', ' ') || place || '?', '{{"concept":"' || concept || '",' || CASE WHEN len(v) > 1 THEN '"values":' || vs ELSE '"value":' || v[1] END || '}}', {sentence('said')}, 'The evidence' || place || ' shows ' || said || '.', fact_ids, evidence, terms,
            CASE WHEN len(v) > 1 THEN 'qa_' || substr(sha256(concat_ws(chr(0), 'v4.2', CAST(image_id AS VARCHAR), concept, vs, ps)), 1, 20) ELSE src[1] END, src FROM m4),
    q AS (SELECT *, {SEAL} AS protected_sha256 FROM q0)"""


@query(f"WITH {REG} SELECT image_id, region_id, presence, tone, grade, accepted FROM g")
def labelled_regions(spark, d):
    return _regions(spark, d).select("image_id", "region_id", "presence", "tone", "grade", "accepted")


@query(f"WITH {FACTS} SELECT image_id, region_id, kind, concept, family, value, surface, polarity, places, evidence, fact_id, parent_fact_id, eligible FROM f")
def fact_table(spark, d):
    return _facts(spark, d)


@query(f"WITH {FACTS} SELECT DISTINCT c.fact_id, CASE WHEN o.fact_id IS NULL THEN 'parent_missing' ELSE 'parent_not_present' END AS failure FROM f c LEFT JOIN f o ON o.fact_id = c.parent_fact_id WHERE c.kind = 'attribute' AND (o.fact_id IS NULL OR o.polarity <> 'present')")
def unsupported_attributes(spark, d):
    return facts.unsupported_attributes(_facts(spark, d))


@query(f"WITH {PLANS} SELECT image_id, intent, format, template, question, structured, answer, reason, fact_ids, evidence, terms, qa_id FROM p")
def question_plans(spark, d):
    return _plans(spark, d).drop("options")


def _merged(spark, d) -> DataFrame:
    f = written(_facts(spark, d), "facts")
    return blueprints.merge_attributes(blueprints.build_plans(f, GRADES, "error_grade"), f, "v4.2")


@query(f"WITH {MERGED} SELECT image_id, intent, format, template, question, structured, answer, reason, fact_ids, evidence, terms, qa_id, source_qa_ids, protected_sha256 FROM q")
def merged_plans(spark, d):
    return _merged(spark, d).drop("options")


@query(f"WITH {PLANS} SELECT image_id, {norm('question')} AS key, count(DISTINCT structured) AS n_answers, list_sort(list(DISTINCT qa_id)) AS qa_ids FROM p GROUP BY 1, 2 HAVING count(DISTINCT structured) > 1")
def plan_collisions(spark, d):
    return blueprints.collisions(_plans(spark, d))


@query(f"""WITH {PLANS}, x AS (SELECT qa_id, unnest(fact_ids) AS fact_id FROM p WHERE intent = 'abnormality'), y AS (SELECT qa_id, concept = 'view' AS n, fact_id, surface, concept, evidence FROM x JOIN f USING (fact_id)),
    z AS (SELECT qa_id, bool_or(n) AS any_n, bool_or(NOT n) AS any_p, list_sort(list(DISTINCT fact_id) FILTER (WHERE n)) AS fn, list_sort(list(DISTINCT fact_id) FILTER (WHERE NOT n)) AS fp, list_sort(list(DISTINCT concept) FILTER (WHERE n)) AS cn, list_sort(list(DISTINCT concept) FILTER (WHERE NOT n)) AS cp FROM y GROUP BY 1),
    w AS (SELECT p.*, CASE WHEN any_n AND any_p THEN 'repaired_remove_normal_facts_from_abnormality' WHEN any_n THEN 'repaired_convert_abnormality_to_normal_finding' ELSE 'carried_forward_unchanged_contract' END AS s, CASE WHEN any_p THEN fp ELSE fn END AS nf, CASE WHEN any_p THEN cp ELSE cn END AS nc FROM p LEFT JOIN z USING (qa_id)),
    v AS (SELECT qa_id AS source_qa_id, s AS migration_status, CASE WHEN s LIKE '%convert%' THEN 'normal_findings' ELSE intent END AS intent, CASE WHEN s LIKE 'c%' THEN fact_ids ELSE nf END AS fact_ids,
        CASE WHEN s LIKE 'c%' THEN structured ELSE '{{"observations":[' || array_to_string(list_transform(nc, lambda c: '{{"concept":"' || c || '","polarity":"present"}}'), ',') || ']}}' END AS structured FROM w)
    SELECT *, CASE WHEN migration_status LIKE 'c%' THEN source_qa_id ELSE 'qa_' || substr(sha256(concat_ws(chr(0), 'v4.3', source_qa_id, migration_status, array_to_string(fact_ids, chr(0)), structured)), 1, 20) END AS qa_id FROM v""")
def migrated_plans(spark, d):
    f = written(_facts(spark, d), "facts")
    out = blueprints.migrate(blueprints.build_plans(f, GRADES, "error_grade"), f, NORMAL, "v4.3")
    return out.select("source_qa_id", "migration_status", "intent", "fact_ids", "structured", "qa_id")


# What is written for the plans: a template stands for the writer, and some rows go wrong
# by the plan's bucket, so that every rule has rows that it fails.
B = "CAST('0x' || substr(sha256(qa_id), 1, 8) AS BIGINT) % 12"
SAID = f"({joined('terms')})"
CANDIDATES = f"""{MERGED},
    b AS (SELECT *, {B} AS b FROM q),
    c AS (SELECT *, CASE b WHEN 0 THEN question WHEN 1 THEN NULL WHEN 2 THEN 'Please say ' || answer ELSE 'Please say: ' || question END AS cq, CASE b WHEN 3 THEN reason WHEN 4 THEN 'Nothing can be said.' WHEN 5 THEN '' WHEN 6 THEN 'Seen: ' || {SAID} || ' as a diagnosis.' ELSE 'Seen: ' || {SAID} || '.' END AS cr, CASE b WHEN 7 THEN 'x' ELSE protected_sha256 END AS cs FROM b WHERE b <> 8)"""


def _candidates(plans: DataFrame) -> DataFrame:
    b, said = ids.hash_bucket(F.col("qa_id"), 12), F.concat(F.lit("Seen: "), text.joined(F.col("terms")))
    q = F.when(b == 0, F.col("question")).when(b == 1, F.lit(None)).when(b == 2, F.concat(F.lit("Please say "), F.col("answer"))).otherwise(F.concat(F.lit("Please say: "), F.col("question")))
    r = F.when(b == 3, F.col("reason")).when(b == 4, "Nothing can be said.").when(b == 5, "").when(b == 6, F.concat(said, F.lit(" as a diagnosis."))).otherwise(F.concat(said, F.lit(".")))
    return plans.where(b != 8).select("qa_id", q.alias("candidate_question"), r.alias("candidate_reason"), F.when(b == 7, "x").otherwise(F.col("protected_sha256")).alias("candidate_sha256"))


def _anchors():
    t = F.col("template")
    one = lambda *terms: F.array(F.array(*map(F.lit, terms)))
    return F.when(t.startswith("abnormality"), one("findings")).when(t.startswith("normal"), one("normal")).when(t == "grade_single_01", F.array(F.array(F.lit("grade"), F.lit("degree")), F.array(F.lit("confirmed")))).when(t.startswith("explicit"), F.array(F.col("terms"))).otherwise(F.array().cast("array<array<string>>"))


CODES = f"""[CASE WHEN cs <> protected_sha256 THEN 'protected_field_seal_mismatch' END, CASE WHEN cq IS NULL THEN 'missing_question' END, CASE WHEN cr = '' THEN 'missing_reasoning_text' END, CASE WHEN {norm('cq')} = {norm('question')} THEN 'question_not_paraphrased' END, CASE WHEN {norm('cr')} = {norm('reason')} THEN 'reason_not_paraphrased' END,
    CASE WHEN rtrim(answer, '.') NOT IN ('Yes', 'No') AND contains({norm('cq')}, {norm("rtrim(answer, '.')")}) THEN 'answer_leakage_in_question' END, CASE WHEN cq IS NOT NULL AND contains(lower(cq || ' ' || cr), 'diagnosis') THEN 'forbidden_term:diagnosis' END,
    CASE WHEN template LIKE 'abnormality%' AND NOT contains(lower(cq), 'findings') THEN 'question_lost_attribute_anchor:findings' END, CASE WHEN template LIKE 'normal%' AND NOT contains(lower(cq), 'normal') THEN 'question_lost_attribute_anchor:normal' END,
    CASE WHEN template = 'grade_single_01' AND NOT contains(lower(cq), 'grade') AND NOT contains(lower(cq), 'degree') THEN 'question_lost_attribute_anchor:grade|degree' END, CASE WHEN template = 'grade_single_01' AND NOT contains(lower(cq), 'confirmed') THEN 'question_lost_attribute_anchor:confirmed' END,
    CASE WHEN template LIKE 'explicit%' AND len(list_filter(terms, lambda t: contains({norm('cq')}, {norm('t')}))) = 0 AND cq IS NOT NULL THEN 'question_lost_attribute_anchor:' || array_to_string(terms, '|') END]"""
FAILED = f"""{CANDIDATES}, e AS (SELECT *, list_sort(list_distinct(list_filter(list_concat({CODES}, CASE WHEN cq IS NULL THEN CAST([] AS VARCHAR[]) ELSE list_transform(list_filter(terms, lambda t: NOT contains({norm('cr')}, {norm('t')})), lambda t: 'reason_missing_fact:' || t) END), lambda x: x IS NOT NULL))) AS failures FROM c)"""


def _failed(plans: DataFrame) -> DataFrame:
    j = plans.join(_candidates(plans), "qa_id")
    return j.withColumn("failures", audit.candidate_rules(["diagnosis", "prognosis"], _anchors(), ids.seal(**{f: F.col(f) for f in blueprints.PROTECTED})))


@query(f"WITH {FAILED} SELECT qa_id, failures FROM e")
def candidate_failures(spark, d):
    return _failed(written(_merged(spark, d), "plans")).select("qa_id", "failures")


@query(f"WITH {CANDIDATES} SELECT qa_id, 'missing_llm_candidate' AS failure FROM q WHERE qa_id NOT IN (SELECT qa_id FROM c) UNION ALL SELECT 'stray_' || event_type, 'blueprint_missing' FROM events GROUP BY 1")
def unmatched_candidates(spark, d):
    plans = written(_merged(spark, d), "plans")
    stray = table(spark, d, "events").select(F.concat(F.lit("stray_"), F.col("event_type")).alias("qa_id"))
    return audit.unmatched(plans, _candidates(plans).select("qa_id").unionByName(stray))


@query(f"WITH {FAILED}, u AS (SELECT unnest(failures) AS kind, qa_id AS id FROM e), n AS (SELECT kind, id, row_number() OVER (PARTITION BY kind ORDER BY id) AS r FROM u) SELECT kind, count(*) AS n, list(id ORDER BY id) FILTER (WHERE r <= 10) AS examples FROM n GROUP BY 1")
def audit_examples(spark, d):
    long = _failed(written(_merged(spark, d), "plans")).select(F.explode("failures").alias("kind"), F.col("qa_id").alias("id"))
    return stats.counted_examples(long, "kind", "id")


def _tampered(plans: DataFrame) -> DataFrame:
    """Plans of some buckets made wrong: lost evidence, another concept, other polarity, a
    fact that is not there, another text, a changed grade."""
    b = ids.hash_bucket(F.col("qa_id"), 12)
    s = F.col("structured")
    return plans.withColumns({
        "evidence": F.when(b == 0, F.array_append("evidence", F.lit("r"))).otherwise(F.col("evidence")),
        "structured": F.when(b == 1, F.replace(s, F.lit('"concept":"'), F.lit('"concept":"x'))).when(b == 2, F.replace(F.replace(s, F.lit('"presence":false'), F.lit('"presence":true')), F.lit('"normal":'), F.lit('"normal":not '))).otherwise(s),
        "fact_ids": F.when(b == 3, F.array_append("fact_ids", F.lit("fact_none"))).otherwise(F.col("fact_ids")),
        "answer": F.when(b == 4, F.concat(F.lit("Q"), F.substring("answer", 2, 2))).otherwise(F.col("answer"))})


SEMANTICS = f"""{MERGED}, b AS (SELECT *, {B} AS b FROM q), t AS (SELECT * REPLACE (CASE b WHEN 0 THEN list_append(evidence, 'r') ELSE evidence END AS evidence, CASE b WHEN 1 THEN replace(structured, '"concept":"', '"concept":"x') WHEN 2 THEN replace(replace(structured, '"presence":false', '"presence":true'), '"normal":', '"normal":not ') ELSE structured END AS structured,
        CASE b WHEN 3 THEN list_append(fact_ids, 'fact_none') ELSE fact_ids END AS fact_ids, CASE b WHEN 4 THEN 'Q' || substr(answer, 2, 2) ELSE answer END AS answer) FROM b),
    k AS (SELECT *, template LIKE 'explicit%' AS neg, template = 'normal_closed_01' AS nor, template = 'abnormality_open_01' AS obs, template = 'grade_single_01' AS gra FROM t),
    w AS (SELECT qa_id, CASE WHEN b = 3 THEN ['source_fact_missing'] ELSE list_sort(list_filter([CASE WHEN b = 0 THEN 'evidence_region_ids_not_fact_union' END, CASE WHEN b = 1 AND NOT obs AND NOT nor THEN 'answer_concept_contradicts_fact' END, CASE WHEN b = 1 AND obs THEN 'answer_observations_contradict_facts' END,
        CASE WHEN b = 2 AND neg THEN 'answer_presence_contradicts_fact_polarity' END, CASE WHEN gra AND b = 4 THEN 'answer_option_inconsistent' END,
        CASE WHEN NOT obs AND NOT nor AND NOT neg AND len(list_filter(terms, lambda x: NOT contains({norm('answer')}, {norm('x')}))) > 0 THEN 'answer_text_contradicts_fact_surface' END], lambda x: x IS NOT NULL)) END AS failures FROM k)"""


@query(f"WITH {SEMANTICS} SELECT * FROM w")
def fact_semantics(spark, d):
    f = written(_facts(spark, d), "facts")
    plans = blueprints.merge_attributes(blueprints.build_plans(f, GRADES, "error_grade"), f, "v4.2")
    return audit.semantic_failures(_tampered(plans), f)


@query(f"""WITH {PLANS}, t AS (SELECT *, {B} AS b FROM p) SELECT qa_id, CASE WHEN b = 1 AND template <> 'normal_closed_01' THEN [CASE template WHEN 'abnormality_open_01' THEN 'invalid_abnormality_answer' WHEN 'explicit_negative_closed_01' THEN 'invalid_explicit_negative' WHEN 'attribute_open_01' THEN 'invalid_attribute_answer' ELSE 'invalid_choice' END]
    WHEN b = 5 THEN ['unknown_template'] WHEN b = 4 AND template = 'normal_closed_01' THEN ['invalid_normality_answer'] WHEN b = 4 AND template = 'explicit_negative_closed_01' THEN ['invalid_explicit_negative'] WHEN b = 4 AND template = 'grade_single_01' THEN ['invalid_choice'] ELSE CAST([] AS VARCHAR[]) END AS failures FROM t""")
def template_audit(spark, d):
    f = written(_facts(spark, d), "facts")
    b = ids.hash_bucket(F.col("qa_id"), 12)
    plans = blueprints.build_plans(f, GRADES, "error_grade")
    wrong = _tampered(plans).select(*(c for c in plans.columns if c not in ("structured", "answer")), "structured", "answer")
    wrong = plans.drop("structured", "answer").join(wrong.select("qa_id", F.when(b == 1, F.col("structured")).alias("s1"), F.when(b == 4, F.col("answer")).alias("a4")), "qa_id").join(plans.select("qa_id", "structured", "answer"), "qa_id")
    wrong = wrong.withColumns({"structured": F.coalesce("s1", "structured"), "answer": F.coalesce("a4", "answer"), "template": F.when(b == 5, "other_01").otherwise(F.col("template"))})
    return audit.template_failures(wrong, f)


@query(f"WITH {FACTS} SELECT DISTINCT fact_id FROM f WHERE region_id IS NOT NULL AND substr(fact_id, 6, 1) = '0'")
def label_match_audit(spark, d):
    f = _facts(spark, d)
    own = f.select("image_id", "region_id", "kind", "concept", "value").distinct()
    wrong = f.withColumn("value", F.when(F.col("region_id").isNotNull() & (F.substring("fact_id", 6, 1) == "0"), F.concat("value", F.lit("!"))).otherwise(F.col("value")))
    return audit.label_failures(wrong, own)


@query(f"""WITH {SEMANTICS}, y AS (SELECT unnest(failures) AS kind, qa_id AS id FROM w), n AS (SELECT * FROM y UNION ALL SELECT 'protected_field_seal_mismatch', qa_id FROM t WHERE b IN (0, 3, 4) OR (b = 1 AND contains(structured, '"concept":"x')) OR (b = 2 AND template IN ('explicit_negative_closed_01', 'normal_closed_01'))
    UNION ALL SELECT 'image_normalized_question_collision', unnest(l) FROM (SELECT list(qa_id) AS l FROM t GROUP BY image_id, {norm('question')} HAVING count(*) > 1)), u AS (SELECT DISTINCT kind, id FROM n WHERE kind <> 'source_fact_missing' UNION ALL SELECT 'source_fact_missing', qa_id FROM t WHERE b = 3 UNION ALL SELECT 'source_fact_missing', qa_id FROM t WHERE b = 3)
    SELECT kind, count(*) AS n FROM u GROUP BY 1""")
def plan_audit(spark, d):
    f = written(_facts(spark, d), "facts")
    made = written(blueprints.build_plans(f, GRADES, "error_grade"), "plans")
    plans = written(_tampered(blueprints.merge_attributes(made, f, "v4.2")), "merged")
    return audit.plan_audit(plans, made, f).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def _box_regions(spark, d) -> DataFrame:
    return _regions(spark, d).select("image_id", "region_id", "box")


@query(f"""WITH {MERGED}, x AS (SELECT image_id, list({{'region_id': region_id, 'box': box}} ORDER BY region_id) AS r FROM g GROUP BY 1), y AS (SELECT image_id, count(DISTINCT fact_id) AS n FROM f GROUP BY 1)
    SELECT image_id, count(*) AS n_plans, min(y.n) AS n_facts, min(len(r)) AS n_regions, min(qa_id) AS first_plan, min(r[1].region_id) AS first_region, min(r[len(r)].box[4]) AS last_edge FROM q JOIN x USING (image_id) JOIN y USING (image_id) GROUP BY 1""")
def request_packages(spark, d):
    f = written(_facts(spark, d), "facts")
    plans = blueprints.merge_attributes(blueprints.build_plans(f, GRADES, "error_grade"), f, "v4.2")
    r = records.requests(_box_regions(spark, d), f.dropDuplicates(["fact_id"]), plans)
    last = F.element_at("regions", -1)
    return r.select("image_id", F.size("plans").cast("long").alias("n_plans"), F.size("facts").cast("long").alias("n_facts"), F.size("regions").cast("long").alias("n_regions"), F.col("plans")[0]["qa_id"].alias("first_plan"), F.col("regions")[0]["region_id"].alias("first_region"), last["box"][3].alias("last_edge"))


RESPONSES = f"""{PLANS}, b AS (SELECT *, {B} AS b FROM p)"""


@query(f"""WITH {RESPONSES}, x AS (SELECT image_id, qa_id, b, CASE b WHEN 1 THEN qa_id || ':invalid_review_reasons' WHEN 2 THEN qa_id || ':review_text_must_be_null' WHEN 3 THEN qa_id || ':invalid_status' WHEN 4 THEN qa_id || ':qa_id_mismatch' WHEN 5 THEN qa_id || ':missing_visual_evidence_summary' END AS own FROM b),
    y AS (SELECT image_id, list(own) FILTER (WHERE own IS NOT NULL) AS own, count(*) FILTER (WHERE b = 0) AS lost, count(*) FILTER (WHERE b = 6) AS twice, list_sort(list(qa_id || '/p') FILTER (WHERE b = 0)) AS l FROM x GROUP BY 1)
    SELECT image_id, list_sort(list_filter(list_concat(coalesce(own, []), [CASE WHEN lost > 0 THEN 'missing_qa_plans:' || array_to_string(l, ',') END, CASE WHEN lost <> twice THEN 'item_count_mismatch' END, CASE WHEN twice > 0 THEN 'duplicate_qa_plan_id' END]), lambda v: v IS NOT NULL)) AS failures FROM y""")
def response_contract(spark, d):
    plans = written(_plans(spark, d), "plans")
    b = ids.hash_bucket(F.col("qa_id"), 12)
    asked = plans.select("image_id", F.concat("qa_id", F.lit("/p")).alias("plan_id"), "qa_id")
    items = asked.withColumn("b", b).where("b <> 0").withColumn("copy", F.explode(F.when(F.col("b") == 6, F.sequence(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    said = lambda c, ok=None: F.when(~F.col("b").isin(1, 2, 7) if ok is None else ok, F.lit(c))
    items = items.select(
        "image_id", "plan_id", F.when(F.col("b") == 4, "other").otherwise(F.col("qa_id")).alias("qa_id"), F.when(F.col("b").isin(1, 2, 7), "review_required").when(F.col("b") == 3, "maybe").otherwise("accepted").alias("status"),
        F.when(F.col("b").isin(2, 7), F.array(F.lit("evidence_unclear"))).when(F.col("b") == 1, F.array(F.lit("bored"))).alias("reasons"), F.coalesce(said("q"), F.when(F.col("b") == 2, "text")).alias("question"), said("r").alias("reason"), F.when(F.col("b") == 5, " ").otherwise(said("v")).alias("visual"))
    return audit.response_failures(asked, items)


RECORDS = f"""{FAILED},
    k AS (SELECT e.*, list_sort(list_filter([CASE WHEN intent = 'abnormality' AND 'event view' IN terms THEN 'abnormality_answer_includes_explicit_normal_fact' END], lambda x: x IS NOT NULL)) AS conflicts FROM e WHERE len(failures) = 0),
    x AS (SELECT qa_id, list('[' || array_to_string(box, ', ') || ']' ORDER BY pos) AS boxes, list(box ORDER BY pos) AS raw FROM (SELECT qa_id, unnest(evidence) AS region_id, unnest(range(1, len(evidence) + 1)) AS pos FROM k) JOIN g USING (region_id) GROUP BY 1),
    o AS (SELECT qa_id, 'image/' || image_id || '.png' AS image, '<image>' || chr(10) || cq || CASE WHEN format = 'single-choice' THEN ' <choices>: [A: Up to a third, B: Up to two thirds, C: Above two thirds]' ELSE '' END AS human,
        '<answer> ' || CASE WHEN format = 'single-choice' THEN json_extract_string(structured, '$.option') ELSE answer END || ' <reason> ' || cr || ' <visual_evidence> ' || {SAID} || ' seen <location> [' || coalesce(array_to_string(boxes, ', '), '') || ']' AS gpt,
        intent AS question_type, CASE format WHEN 'open-ended' THEN 'open' WHEN 'closed-ended' THEN 'closed' ELSE 'single' END AS q_type, coalesce(raw, []) AS evidence_boxes_xyxy, structured AS answer_structured, CASE WHEN len(conflicts) > 0 THEN 'PROTECTED_BLUEPRINT_CONFLICT_NOT_EXPORTED' ELSE 'ACCEPTED_EXPORTED' END AS master_record_status FROM k LEFT JOIN x USING (qa_id))"""


def _master(spark, d) -> DataFrame:
    """Plans with a candidate that passes, as records with all their fields."""
    plans = written(_merged(spark, d), "plans")
    good = _failed(plans).where(F.size("failures") == 0)
    boxes = records.evidence_boxes(good, _box_regions(spark, d))
    j = good.join(boxes, "qa_id", "left")
    none = F.array().cast("array<array<int>>")
    visual = F.concat(text.joined(F.col("terms")), F.lit(" seen"))
    told = records.told_answer(F.col("format"), F.col("structured"), F.col("answer"))
    turns = records.conversations(F.col("candidate_question"), F.col("options"), told, F.col("candidate_reason"), visual, F.coalesce("boxes", none))
    normal = F.array_contains("terms", F.lit("event view"))
    conflicts = audit.explicit_normal_conflicts(F.col("intent"), normal & (F.size("terms") == 1), normal, F.lit(False))
    q_types = F.create_map(*(F.lit(x) for kv in records.Q_TYPES.items() for x in kv))
    return j.select(
        "qa_id", F.concat(F.lit("image/"), F.col("image_id"), F.lit(".png")).alias("image"), turns.alias("conversations"), F.col("intent").alias("question_type"), q_types[F.col("format")].alias("q_type"), F.coalesce("boxes", none).alias("evidence_boxes_xyxy"), F.col("structured").alias("answer_structured"),
        F.when(F.size(conflicts) > 0, "PROTECTED_BLUEPRINT_CONFLICT_NOT_EXPORTED").otherwise("ACCEPTED_EXPORTED").alias("master_record_status"), conflicts.alias("export_review_reasons"), "image_id")


def _turns(df: DataFrame) -> DataFrame:
    return df.withColumn("human", F.col("conversations")[0]["value"]).withColumn("gpt", F.col("conversations")[1]["value"]).drop("conversations")


@query(f"WITH {RECORDS} SELECT * FROM o")
def master_records(spark, d):
    return _turns(_master(spark, d)).drop("export_review_reasons", "image_id")


@query(f"WITH {RECORDS} SELECT * EXCLUDE (master_record_status) FROM o WHERE master_record_status = 'ACCEPTED_EXPORTED'")
def clean_records(spark, d):
    clean = _master(spark, d).where("master_record_status = 'ACCEPTED_EXPORTED'").select(*records.CLEAN)
    return _turns(records.checked(written(clean, "clean")))


@query(f"""WITH {RECORDS}, x9 AS (SELECT *, {B} AS b FROM o WHERE master_record_status = 'ACCEPTED_EXPORTED')
    SELECT kind, count(*) AS n FROM (SELECT 'master_only' AS kind FROM x9 WHERE b = 9 UNION ALL SELECT 'mismatch:image' FROM x9 WHERE b = 10 UNION ALL SELECT 'mismatch:q_type' FROM x9 WHERE b = 11) GROUP BY 1""")
def master_clean_join(spark, d):
    master = written(_master(spark, d), "master")
    b = ids.hash_bucket(F.col("qa_id"), 12)
    clean = master.where("master_record_status = 'ACCEPTED_EXPORTED'").where(b != 9).select(*records.CLEAN)
    clean = clean.withColumns({"image": F.when(b == 10, "x").otherwise(F.col("image")), "q_type": F.when(b == 11, "x").otherwise(F.col("q_type"))})
    return records.join_errors(master, clean).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {FAILED}, x AS (SELECT *, CAST('0x' || substr(sha256(qa_id || 'n'), 1, 8) AS BIGINT) % 12 AS nb FROM e)
    SELECT qa_id, list_sort(list_concat(list_filter([CASE WHEN nb = 0 THEN 'carried_contract_changed:answer' END, CASE WHEN nb IN (0, 1) THEN 'protected_seal_mismatch' END, CASE WHEN cq IS NULL THEN 'missing_carried_question' END, CASE WHEN cr = '' THEN 'missing_carried_reasoning_text' END, CASE WHEN {norm('cq')} = {norm('question')} THEN 'carried_question_not_paraphrased' END, CASE WHEN {norm('cr')} = {norm('reason')} THEN 'carried_reason_not_paraphrased' END], lambda v: v IS NOT NULL),
        list_transform(list_filter(terms, lambda t: NOT contains({norm('cr')}, {norm('t')})), lambda t: 'carried_reason_missing_fact:' || t))) AS failures FROM x""")
def carried_candidates(spark, d):
    plans = written(_merged(spark, d), "plans")
    old = plans.join(_candidates(plans), "qa_id").select("qa_id", F.struct("*").alias("old"))
    b = ids.hash_bucket(F.concat("qa_id", F.lit("n")), 12)
    new = plans.withColumns({"answer": F.when(b == 0, F.lit("else")).otherwise(F.col("answer")), "protected_sha256": F.when(b == 1, F.lit("x")).otherwise(F.col("protected_sha256"))}).select("qa_id", F.struct("*").alias("new"))
    return old.join(new, "qa_id").select("qa_id", audit.carried_failures().alias("failures"))



@query("""SELECT event_id, list_sort(list_filter([CASE WHEN event_id % 7 = 0 THEN 'additional_fields:x' END, CASE WHEN event_id % 5 = 0 THEN 'missing_field:kind' END, CASE WHEN event_id % 3 = 0 THEN 'wrong_type:k' END,
    CASE WHEN event_id % 5 > 0 AND event_type = 'error' THEN 'not_allowed:kind' END, CASE WHEN user_id >= 100 THEN 'pattern:id' END], lambda x: x IS NOT NULL)) AS failures FROM events""")
def schema_failures(spark, d):
    k, i = F.get_json_object("props", "$.k"), F.col("event_id")
    kind = F.when(i % 5 > 0, F.concat(F.lit(', "kind": "'), F.col("event_type"), F.lit('"'))).otherwise("")
    record = F.concat(F.lit('{"id": "image_'), F.col("user_id"), F.lit('", "k": '), F.when(i % 3 == 0, F.concat(F.lit('"'), k, F.lit('"'))).otherwise(k), kind, F.lit(', "none": null'), F.when(i % 7 == 0, F.lit(', "x": [1]')).otherwise(""), F.lit("}"))
    rules = audit.schema_failures({"id": "string", "k": "number", "kind": "string", "none": "object?"}, {"id": r"^image_[0-9]{1,2}$"}, {"kind": ["view", "click", "signup", "purchase"]})
    return table(spark, d, "events").select("event_id", record.alias("record")).select("event_id", rules.alias("failures"))


@query(f"""WITH {CANDIDATES} SELECT qa_id, list_sort(list_concat(list_filter([CASE WHEN b = 7 THEN 'qa_id_mismatch' END, CASE WHEN b = 9 THEN 'not_accepted' END, CASE WHEN cq IS NULL THEN 'missing_question' END, CASE WHEN cr = '' THEN 'missing_reason' END, CASE WHEN b = 10 THEN 'protected_field_mutation:answer' END,
    CASE WHEN contains({norm('cq')}, {norm('answer')}) AND {norm('answer')} <> '' THEN 'answer_leakage_in_question' END], lambda v: v IS NOT NULL), list_transform(list_filter(terms, lambda t: NOT contains({norm('cr')}, {norm('t')})), lambda t: 'missing_reason_fact_term:' || t))) AS failures FROM c""")
def realization_contract(spark, d):
    plans = written(_merged(spark, d), "plans")
    said = plans.join(_candidates(plans), "qa_id")
    b = ids.hash_bucket(F.col("qa_id"), 12)
    echo = {f: F.lit(None).cast(plans.schema[f].dataType) for f in blueprints.PROTECTED}
    echo |= {"qa_id": F.when(b == 7, "x").otherwise(F.col("qa_id")), "answer": F.when(b == 10, F.lit("other")).when(b == 11, F.col("answer")), "structured": F.col("structured")}
    response = F.struct(*(c.alias(n) for n, c in echo.items()), F.when(b == 9, "review_required").otherwise("accepted").alias("status"), F.col("candidate_question").alias("question"), F.col("candidate_reason").alias("reason"))
    rows = said.select("qa_id", F.struct(*plans.columns).alias("plan"), response.alias("response"))
    return rows.select("qa_id", audit.realization_failures(blueprints.PROTECTED).alias("failures"))


@query(f"""WITH {FAILED}, z AS (SELECT qa_id, bool_or(concept = 'view') AS n FROM (SELECT qa_id, unnest(fact_ids) AS fact_id FROM q WHERE intent = 'abnormality') JOIN f USING (fact_id) GROUP BY 1)
    SELECT e.qa_id, CASE WHEN NOT coalesce(z.n, FALSE) AND NOT (cq IS NULL OR cr = '' OR {norm('coalesce(cq, chr(1))')} = {norm('question')} OR {norm('cr')} = {norm('reason')} OR len(list_filter(terms, lambda t: NOT contains({norm('cr')}, {norm('t')}))) > 0) THEN 'carried' ELSE 'repair' END AS route FROM e LEFT JOIN z USING (qa_id)""")
def carried_or_repaired(spark, d):
    f = written(_facts(spark, d), "facts")
    plans = written(blueprints.merge_attributes(blueprints.build_plans(f, GRADES, "error_grade"), f, "v4.2"), "plans")
    old = plans.join(_candidates(plans), "qa_id").select("qa_id", F.struct("*").alias("old"))
    new = blueprints.migrate(plans, f, NORMAL, "v4.3").select(F.col("source_qa_id").alias("qa_id"), F.struct("*").alias("new"))
    carried, repair = audit.carry_split(old.join(new, "qa_id"), audit.carried_failures())
    of = lambda df, n: df.select("qa_id", F.lit(n).alias("route"))
    return of(carried, "carried").unionByName(of(repair, "repair"))
