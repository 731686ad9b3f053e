"""Queries of projections, joins, aggregates, windows, text, geometry and selection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from corpusloom.functions import geometry as G
from corpusloom.functions import ids, raster, text
from corpusloom.operators import relate, sampling, shape, similar
from corpusloom.registry import query
from corpusloom.session import table

NORM = r"trim(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}_%]+', ' ', 'g'))"
BUCKET = "CAST('0x' || substr(sha256(CAST({} AS VARCHAR)), 1, 8) AS BIGINT) % 100"
SPLIT = f"CASE WHEN {BUCKET} < 70 THEN 'train' WHEN {BUCKET} < 85 THEN 'val' ELSE 'test' END"


@query("SELECT p_partkey, p_size + 1 AS p_size, p_brand || '/' || p_size AS tag FROM part")
def row_override(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_size", "p_brand", "p_name")
    return shape.overridden(p, {"p_size": F.col("p_size") + 1, "tag": F.concat_ws("/", "p_brand", "p_size")}, ("p_name", "p_brand"))


@query("""SELECT doc_id, source, CASE WHEN toxic = 1 THEN 'none' ELSE lang END AS lang, coalesce(toxic = 1, FALSE) AS overridden FROM documents LEFT JOIN labels USING (doc_id)""")
def delta_resolved(spark, d):
    delta = table(spark, d, "labels").where("toxic = 1").select("doc_id", F.lit("none").alias("lang"))
    return relate.resolved_delta(table(spark, d, "documents").select("doc_id", "source", "lang"), delta, "doc_id", ["lang"])


@query("""SELECT o_orderkey, list_filter([CASE WHEN o_orderstatus = 'F' THEN 'filled' END, CASE WHEN o_totalprice > 2e5 THEN 'large' END, CASE WHEN o_orderpriority LIKE '1%' THEN 'urgent' END], lambda x: x IS NOT NULL) AS labels FROM orders""")
def major_labels(spark, d):
    rules = {"filled": F.col("o_orderstatus") == "F", "large": F.col("o_totalprice") > 2e5, "urgent": F.col("o_orderpriority").startswith("1")}
    return table(spark, d, "orders").select("o_orderkey", shape.label_set(rules).alias("labels"))


@query(f"""SELECT event_type, count(*) FILTER (WHERE s = 'test') AS n_test, count(*) AS n, count(*) FILTER (WHERE s = 'test') >= 20 AND count(*) >= 50 AS report_ap FROM (SELECT event_type, {SPLIT.format('user_id', 'user_id')} AS s FROM events) GROUP BY 1""")
def class_policy(spark, d):
    e = table(spark, d, "events").select("event_type", ids.bucket_split(F.col("user_id")).alias("s"))
    return shape.class_policy(e, "event_type", "s")


@query("""WITH f AS (SELECT l_orderkey, list_sort(list(DISTINCT l_returnflag)) AS f FROM lineitem GROUP BY 1),
    p AS (SELECT l_orderkey, list_filter(f, lambda x: x IN ('A', 'R')) AS allowed, list_filter(f, lambda x: x = 'N') AS blocked FROM f)
    SELECT l_orderkey, CASE WHEN len(allowed) > 0 THEN 'allowed_visible' ELSE 'descriptive_only' END AS mode, allowed, blocked FROM p""")
def disease_policy(spark, d):
    sets = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("f"))
    return sets.select("l_orderkey", shape.policy(F.col("f"), ["A", "R"], ["N"]).alias("p")).select("l_orderkey", "p.*")


@query(r"""WITH r AS (SELECT l_orderkey, count(*) FILTER (WHERE l_quantity < 45) AS accepted, bool_or(l_quantity >= 50) AS review FROM lineitem GROUP BY 1)
    SELECT o_orderkey, o_orderstatus <> 'P' AS eligible, NOT coalesce(review, FALSE) AND o_totalprice IS NOT NULL AND (coalesce(accepted, 0) > 0 OR o_orderstatus = 'O') AS included,
    CASE WHEN coalesce(accepted, 0) > 2 THEN 2 ELSE 1 END AS category FROM orders LEFT JOIN r ON l_orderkey = o_orderkey""")
def export_inclusion(spark, d):
    """Eligibility, and inclusion in an annotation export: nothing in review, a size that is
    known, and accepted regions or an explicit negative."""
    r = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count_if(F.col("l_quantity") < 45).alias("accepted"), F.bool_or(F.col("l_quantity") >= 50).alias("review"))
    j = table(spark, d, "orders").join(r, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    n = F.coalesce("accepted", F.lit(0))
    included = ~F.coalesce("review", F.lit(False)) & F.col("o_totalprice").isNotNull() & ((n > 0) | (F.col("o_orderstatus") == "O"))
    return j.select("o_orderkey", (F.col("o_orderstatus") != "P").alias("eligible"), included.alias("included"), F.when(n > 2, 2).otherwise(1).alias("category"))


@query("""SELECT doc_id, CASE WHEN regexp_matches(text, '[0-9]{3}') THEN 'with' ELSE 'without' END AS part FROM documents""")
def presence_partition(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    has = F.coalesce(F.col("text").rlike("[0-9]{3}"), F.lit(False))
    parts = {"with": docs.where(has), "without": docs.where(~has)}
    if relate.conserved(docs, parts, "doc_id").head(1):
        raise ValueError("the parts do not make up the whole")
    return parts["with"].select("doc_id", F.lit("with").alias("part")).unionByName(parts["without"].select("doc_id", F.lit("without").alias("part")))


@query("""SELECT l.doc_id, lang, quality FROM labels l JOIN documents USING (doc_id)""")
def integrity_join(spark, d):
    return relate.required_join(table(spark, d, "labels"), table(spark, d, "documents"), "doc_id").select("doc_id", "lang", "quality")


@query("""WITH p AS (SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority FROM orders)
    SELECT o_custkey, list(o_orderstatus ORDER BY o_orderkey) AS statuses, list(o_orderpriority ORDER BY o_orderkey) AS priorities FROM p GROUP BY 1""")
def regions_renested(spark, d):
    o = table(spark, d, "orders")
    c = o.groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("keys"))
    rows = relate.renested(c, "o_custkey", "keys", o, "o_orderkey", ["o_orderstatus", "o_orderpriority"])
    return rows.select("o_custkey", F.transform("rows", lambda r: r["o_orderstatus"]).alias("statuses"), F.transform("rows", lambda r: r["o_orderpriority"]).alias("priorities"))


@query("SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') GROUP BY 1")
def semi_restricted(spark, d):
    chosen = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, d, "lineitem").join(chosen, "l_orderkey", "left_semi").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH b AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x0, CAST(embedding[2] AS DOUBLE) AS y0, CAST(embedding[1] + abs(embedding[3]) AS DOUBLE) AS x1, CAST(embedding[2] + abs(embedding[4]) AS DOUBLE) AS y1 FROM embeddings),
    p AS (SELECT a.label, a.vec_id AS a, b.vec_id AS b, greatest(least(a.x1, b.x1) - greatest(a.x0, b.x0), 0) * greatest(least(a.y1, b.y1) - greatest(a.y0, b.y0), 0) AS i, (a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) AS s FROM b a JOIN b ON a.label = b.label AND a.vec_id < b.vec_id)
    SELECT label, a, b, round(i / (s - i), 6) AS iou FROM p WHERE s - i > 0 AND i / (s - i) >= 0.3""")
def box_iou_pairs(spark, d):
    e = F.col("embedding")
    boxes = table(spark, d, "embeddings").select("label", "vec_id", F.array(e[0], e[1], e[0] + F.abs(e[2]), e[1] + F.abs(e[3])).alias("box"))
    return similar.box_pairs(boxes, "label", "vec_id", "box", 0.5, 0.3).withColumn("iou", F.round("iou", 6))


@query("""SELECT event_id, CASE WHEN user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) THEN 'image' ELSE 'procedure' END AS scope FROM events""")
def impression_scope(spark, d):
    known = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"), F.lit(True).alias("k"))
    return table(spark, d, "events").join(known, "user_id", "left").select("event_id", F.when(F.col("k"), "image").otherwise("procedure").alias("scope"))


@query("""WITH l AS (SELECT l_orderkey, count(*) AS n_lines, min(l_linenumber) AS first_line FROM lineitem GROUP BY 1)
    SELECT o_orderkey, c_name, n_name, r_name, n_lines, first_line FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey LEFT JOIN l ON l_orderkey = o_orderkey""")
def provenance_chain(spark, d):
    """From each record through every stage it came from; what a stage lacks is null."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"), F.min("l_linenumber").alias("first_line"))
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey"), "left")
    o = o.join(table(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"), "left").join(table(spark, d, "region"), F.col("r_regionkey") == F.col("n_regionkey"), "left")
    return o.join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left").select("o_orderkey", "c_name", "n_name", "r_name", "n_lines", "first_line")


@query("""SELECT CASE WHEN l_returnflag IS NULL AND l_linestatus IS NULL THEN 'all' WHEN l_linestatus IS NULL THEN 'flag:' || l_returnflag WHEN l_returnflag IS NULL THEN 'status:' || l_linestatus ELSE 'flag:' || l_returnflag || ',status:' || l_linestatus END AS key, count(*) AS n
    FROM lineitem GROUP BY GROUPING SETS ((), (l_returnflag), (l_linestatus), (l_returnflag, l_linestatus))""")
def composite_counts(spark, d):
    f, s = F.concat(F.lit("flag:"), F.col("l_returnflag")), F.concat(F.lit("status:"), F.col("l_linestatus"))
    cube = table(spark, d, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    key = F.concat_ws(",", f, s)
    return cube.select(F.when(key == "", "all").otherwise(key).alias("key"), "n")


@query("SELECT count(DISTINCT l_orderkey) AS orders, count(DISTINCT (l_orderkey, l_linenumber)) AS lines, count(DISTINCT (l_partkey, l_suppkey, l_returnflag)) AS tuples FROM lineitem")
def distinct_tuples(spark, d):
    return table(spark, d, "lineitem").agg(F.countDistinct("l_orderkey").alias("orders"), F.countDistinct("l_orderkey", "l_linenumber").alias("lines"), F.countDistinct("l_partkey", "l_suppkey", "l_returnflag").alias("tuples"))


@query(rf"""WITH a AS (SELECT doc_id, ' ' || replace({NORM.format('text')}, ' ', '  ') || ' ' AS t0 FROM documents),
    b AS (SELECT *, replace(t0, ' of  the ', ' | ') AS t1 FROM a), c AS (SELECT *, replace(t1, ' the ', ' | ') AS t2 FROM b)
    SELECT doc_id, CAST((length(t0) - length(replace(t0, ' of  the ', ''))) // 9 AS BIGINT) AS n_of_the, CAST((length(t1) - length(replace(t1, ' the ', ''))) // 5 AS BIGINT) AS n_the,
    CAST(len(list_filter(string_split_regex(trim(t2), ' +'), lambda w: w <> '|' AND w <> '')) AS INT) AS n_rest FROM c""")
def phrase_counts(spark, d):
    counts, words = text.phrase_counts(F.col("text"), ["of the", "the"])
    return table(spark, d, "documents").select("doc_id", counts[0].alias("n_of_the"), counts[1].alias("n_the"), F.size(words).alias("n_rest"))


@query("""WITH l AS (SELECT l_orderkey, sha256(CAST(l_partkey AS VARCHAR)) AS h, CAST(l_partkey AS VARCHAR) AS g, CASE WHEN l_linenumber > 2 THEN 'ann' || l_suppkey END AS ann, l_linenumber, l_returnflag FROM lineitem),
    r AS (SELECT l_orderkey, h, list_sort(list(DISTINCT coalesce(ann, 'synthetic:a_' || substr(sha256(l_orderkey || chr(0) || g || chr(0) || l_linenumber), 1, 20)))) AS annotation_ids, list_sort(list(DISTINCT l_returnflag)) AS label_ids, bool_or(ann IS NULL) AS has_synthetic_id FROM l GROUP BY 1, 2)
    SELECT l_orderkey, 'region_' || lpad(CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY h) AS VARCHAR), 4, '0') AS region_id, annotation_ids, label_ids, has_synthetic_id FROM r""")
def geometry_groups(spark, d):
    li = table(spark, d, "lineitem")
    return shape.by_geometry(li, "l_orderkey", F.col("l_partkey").cast("string"), F.when(F.col("l_linenumber") > 2, F.concat(F.lit("ann"), F.col("l_suppkey"))), "l_returnflag", "l_linenumber")


@query("""WITH g AS (SELECT l_orderkey, l_suppkey, l_returnflag, min(l_partkey) AS kept, list_sort(list(l_partkey)) AS a FROM lineitem GROUP BY 1, 2, 3),
    n AS (SELECT l_orderkey, l_suppkey, count(*) AS n FROM g GROUP BY 1, 2)
    SELECT l_orderkey, l_suppkey, l_returnflag, kept, a[2:] AS removed, CASE WHEN n > 1 THEN 'B' ELSE 'A' END AS type FROM g JOIN n USING (l_orderkey, l_suppkey) WHERE n > 1 OR len(a) > 1""")
def same_geometry_events(spark, d):
    return shape.same_geometry_events(table(spark, d, "lineitem"), ["l_orderkey", "l_suppkey"], "l_returnflag", "l_partkey")


@query(f"""SELECT s AS split, event_type, count(*) AS n FROM (SELECT DISTINCT user_id, event_type, {SPLIT.format('user_id', 'user_id')} AS s FROM events) GROUP BY 1, 2""")
def class_instances(spark, d):
    paths = table(spark, d, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("paths"))
    each = paths.select(ids.bucket_split(F.col("user_id")).alias("split"), F.explode(F.array_distinct("paths")).alias("event_type"))
    return each.groupBy("split", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH j AS (SELECT d.source, d.lang, l.quality, {BUCKET.format('d.doc_id')} AS b FROM documents d JOIN labels l USING (doc_id)),
    g AS (SELECT quality FROM j WHERE b < 70 GROUP BY 1 ORDER BY count(*) DESC, quality LIMIT 1),
    m AS (SELECT source, quality AS predicted FROM (SELECT source, quality, row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, quality) AS r FROM j WHERE b < 70 GROUP BY 1, 2) WHERE r = 1)
    SELECT lang, count(*) AS n, avg(CAST(coalesce(m.predicted, g.quality) = j.quality AS DOUBLE)) AS accuracy, avg(CAST(m.predicted IS NOT NULL AS DOUBLE)) AS coverage FROM j LEFT JOIN m USING (source), g WHERE b >= 70 GROUP BY lang""")
def majority_breakdown(spark, d):
    from corpusloom.operators import stats

    j = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").select("source", "lang", "quality", ids.hash_bucket(F.col("doc_id")).alias("b"))
    return stats.majority_baseline(j.where("b < 70"), j.where("b >= 70"), "source", "quality", by=["lang"])


@query("""WITH l AS (SELECT l_orderkey, bool_or(l_returnflag = 'R') AS c FROM lineitem GROUP BY 1)
    SELECT CASE WHEN c THEN 'canonical' WHEN c IS NOT NULL THEN 'fallback' ELSE 'unspecified' END AS route, count(*) AS n FROM orders LEFT JOIN l ON l_orderkey = o_orderkey GROUP BY 1""")
def grounding_routes(spark, d):
    flags = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("c"))
    j = table(spark, d, "orders").join(flags, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    route = relate.routes([("canonical", F.col("c")), ("fallback", F.col("c").isNotNull())], "unspecified")
    return j.groupBy(route.alias("route")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT 'event_' || lpad(CAST(row_number() OVER (ORDER BY ts, event_id) AS VARCHAR), 8, '0') AS id, event_id FROM events""")
def ordinal_ids(spark, d):
    rows = ids.ordinals(table(spark, d, "events").select("ts", "event_id"), ["ts", "event_id"])
    return rows.select(F.concat(F.lit("event_"), F.lpad(F.col("ordinal").cast("string"), 8, "0")).alias("id"), "event_id")


@query("""SELECT l_suppkey AS s, l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_linenumber) AS place FROM lineitem""")
def edge_order(spark, d):
    from pyspark.sql.window import Window

    w = Window.partitionBy("l_suppkey").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_partkey", "l_linenumber")
    return table(spark, d, "lineitem").select(F.col("l_suppkey").alias("s"), "l_orderkey", "l_partkey", F.row_number().over(w).cast("long").alias("place"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def limited_sorted(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey = 42")
def point_find(spark, d):
    return table(spark, d, "customer").where("c_custkey = 42").select("c_custkey", "c_name").limit(1)


@query("SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, NULL AS size FROM customer UNION ALL SELECT p_partkey, p_name, NULL, p_size FROM part")
def union_with_missing(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("size"))
    return c.unionByName(p, allowMissingColumns=True)


@query("""WITH a AS (SELECT DISTINCT user_id AS id FROM events), b AS (SELECT DISTINCT c_custkey AS id FROM customer)
    SELECT 'both' AS op, id FROM (SELECT id FROM a INTERSECT SELECT id FROM b) UNION ALL SELECT 'left', id FROM (SELECT id FROM a EXCEPT SELECT id FROM b) UNION ALL SELECT 'any', id FROM (SELECT id FROM a UNION SELECT id FROM b)""")
def set_operations(spark, d):
    a, b = table(spark, d, "events").select(F.col("user_id").alias("id")), table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    named = lambda df, n: df.select(F.lit(n).alias("op"), "id")
    return named(a.intersect(b), "both").unionByName(named(a.subtract(b), "left")).unionByName(named(a.union(b).distinct(), "any"))


@query("""WITH e AS (SELECT l_orderkey, list_sort(list(DISTINCT l_returnflag)) AS f, list_sort(list(DISTINCT l_returnflag) FILTER (WHERE l_linenumber <= 4)) AS s FROM lineitem GROUP BY 1) SELECT l_orderkey, f IS NOT DISTINCT FROM coalesce(s, []) AS equal FROM e""")
def evidence_equality(spark, d):
    whole = F.collect_list(F.array("l_returnflag"))
    part = F.collect_list(F.when(F.col("l_linenumber") <= 4, F.array("l_returnflag")))
    e = table(spark, d, "lineitem").groupBy("l_orderkey").agg(whole.alias("w"), part.alias("p"))
    return e.select("l_orderkey", (shape.ordered_set(F.flatten("w")) == shape.ordered_set(F.flatten("p"))).alias("equal"))


@query(r"""SELECT doc_id, sha256(trim(regexp_replace(replace(lower(text), 'ß', 'ss'), '\s+', ' ', 'g'))) AS folded FROM documents""")
def casefolded_text(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(text.casefolded("text"), 256).alias("folded"))


@query("SELECT c_custkey, regexp_replace(c_name, '^(Customer|Supplier)#0*', '') AS tail FROM customer")
def label_tails(spark, d):
    return table(spark, d, "customer").select("c_custkey", text.tail(F.col("c_name"), "(?:Customer|Supplier)#0*").alias("tail"))


@query(rf"""WITH q AS (SELECT p_partkey, 'Is ' || p_name || CASE WHEN p_size > 30 THEN ' of ' || p_brand ELSE '' END AS q, p_brand AS a FROM part)
    SELECT p_partkey, contains({NORM.format('q')}, {NORM.format('a')}) AND a <> 'Brand#11' AS leaks FROM q""")
def answer_leakage(spark, d):
    q = F.concat(F.lit("Is "), F.col("p_name"), F.when(F.col("p_size") > 30, F.concat(F.lit(" of "), F.col("p_brand"))).otherwise(""))
    return table(spark, d, "part").select("p_partkey", text.leaks_answer(q, F.col("p_brand"), ("Brand#11",)).alias("leaks"))


@query("SELECT p_partkey, p_name AS question FROM part")
def clean_questions(spark, d):
    said = F.concat(F.lit("<image>\n"), F.col("p_name"), F.lit(" <choices>: [A: x, B: y]"))
    return table(spark, d, "part").select("p_partkey", text.clean_question(said).alias("question"))


@query("""SELECT conv_id, min_by(text, turn) FILTER (WHERE role = 'user') AS question, min_by(text, turn) FILTER (WHERE role = 'assistant') AS answer FROM (SELECT conv_id, role, turn * 1000000 + row_number() OVER (PARTITION BY conv_id, turn ORDER BY text) AS turn, text FROM conversations)
    GROUP BY 1 HAVING count(*) FILTER (WHERE role = 'user') > 0 AND count(*) FILTER (WHERE role = 'assistant') > 0""")
def first_turn_pairs(spark, d):
    first = lambda role: F.min(F.when(F.col("role") == role, F.struct("turn", "text")))["text"]
    return table(spark, d, "conversations").groupBy("conv_id").agg(first("user").alias("question"), first("assistant").alias("answer")).where("question is not null and answer is not null")


@query("SELECT p_partkey, 'yes ' || p_brand AS answer, [[p_size, 1, p_size + 9, 7], [0, 0, 2, 2]] AS boxes FROM part")
def located_boxes(spark, d):
    said = F.concat(F.lit("<answer> yes "), F.col("p_brand"), F.lit(" <location> [["), F.col("p_size"), F.lit(", 1, "), F.col("p_size") + 9, F.lit(", 7], [0, 0, 2, 2]]"))
    return table(spark, d, "part").select("p_partkey", text.part(said, "answer").alias("answer"), text.boxes(said).alias("boxes"))


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Order ' || o_orderkey || ' is filled.' WHEN 'O' THEN 'Order ' || o_orderkey || ' is open, with priority ' || o_orderpriority || '.' ELSE 'Part of order ' || o_orderkey || ' is open.' END AS line FROM orders""")
def english_templates(spark, d):
    templates = {"F": "Order {key} is filled.", "O": "Order {key} is open, with priority {priority}.", "P": "Part of order {key} is open."}
    return table(spark, d, "orders").select("o_orderkey", text.templated(F.col("o_orderstatus"), templates, {"key": F.col("o_orderkey"), "priority": F.col("o_orderpriority")}).alias("line"))


@query("""WITH s AS (SELECT p_partkey, p_size + 10.0 AS w, 60.0 - p_size AS h FROM part), g AS (SELECT p_partkey, w / h AS a, (w + 1) / h AS b FROM s)
    SELECT p_partkey, abs(a - b) / greatest(a, b) <= 0.02 AS alike FROM g""")
def aspect_filter(spark, d):
    w, h = F.col("p_size") + 10.0, 60.0 - F.col("p_size")
    return table(spark, d, "part").select("p_partkey", (G.aspect_difference(w, h, w + 1, h) <= 0.02).alias("alike"))


@query("""WITH u AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m FROM embeddings, (SELECT unnest(range(1, 9)) AS i) GROUP BY 1, 2), n AS (SELECT label, sqrt(sum(m * m)) AS n FROM u GROUP BY 1)
    SELECT label, list(round(m / n, 6) ORDER BY i) AS mean FROM u JOIN n USING (label) GROUP BY 1""")
def mean_pooled(spark, d):
    v = table(spark, d, "embeddings").groupBy("label").agg(F.collect_list(F.slice("embedding", 1, 8)).alias("v"))
    return v.select("label", F.transform(G.mean_pooled(F.col("v"), 8), lambda x: F.round(x, 6)).alias("mean"))


@query("""WITH b AS (SELECT p_partkey, p_size % 20 AS x, p_size AS w FROM part), i AS (SELECT *, greatest(0, least(x + w, 30) - greatest(x, 10)) * least(w, 20) AS i FROM b)
    SELECT p_partkey, round(i / CAST(w * w + 20 * 20 - i AS DOUBLE), 9) AS iou FROM i""")
def mask_overlaps(spark, d):
    """Two squares as masks: pixels' centres inside make their areas exactly."""

    @F.pandas_udf("double")
    def overlap(size: pd.Series) -> pd.Series:
        square = lambda x, n: [(x, 0), (x + n, 0), (x + n, n), (x, n)]
        return size.map(lambda s: raster.mask_iou(square(s % 20, s), square(10, 20), 200, 200))

    return table(spark, d, "part").select("p_partkey", F.round(overlap("p_size"), 9).alias("iou"))


@query("""SELECT p_partkey, CASE WHEN p_size > 40 THEN 'review_required' ELSE 'accepted' END AS status, CASE WHEN p_size > 40 THEN ['polygon_out_of_bounds', 'removed_duplicate_closing_vertex'] ELSE ['removed_duplicate_closing_vertex'] END AS flags FROM part""")
def training_polygons(spark, d):
    @F.pandas_udf("status string, flags array<string>")
    def checked(size: pd.Series) -> pd.DataFrame:
        found = [raster.training_polygon([(0, 0), (s, 0), (s, s), (0, s), (0, 0)], 40, 40) for s in size]
        return pd.DataFrame({"status": [f[1] for f in found], "flags": [f[2] for f in found]})

    return table(spark, d, "part").select("p_partkey", checked("p_size").alias("c")).select("p_partkey", "c.status", F.array_sort("c.flags").alias("flags"))


@query()
def perceptual_hashes(spark, d):
    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [raster.perceptual_hashes(np.array(list(v)).reshape(8, 8)) for v in b["embedding"]]
            yield pd.DataFrame({"vec_id": b["vec_id"], "phash": [f"{p:016x}" for p, _ in found], "dhash": [f"{q:016x}" for _, q in found]})

    return table(spark, d, "embeddings").select("vec_id", "embedding").mapInPandas(hashed, "vec_id long, phash string, dhash string")


@query("""SELECT o_orderpriority AS split, CAST(least(CASE o_orderpriority WHEN '1-URGENT' THEN 70 WHEN '2-HIGH' THEN 15 WHEN '3-MEDIUM' THEN 15 ELSE 0 END, count(*)) AS BIGINT) AS quota FROM orders GROUP BY 1""")
def capped_quotas(spark, d):
    counts = {r[0]: r[1] for r in table(spark, d, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1))).collect()}  # a few groups
    shares = {g: {"1-URGENT": 0.7, "2-HIGH": 0.15, "3-MEDIUM": 0.15}.get(g, 0.0) for g in counts}
    return spark.createDataFrame(sorted(sampling.capped_quotas(shares, counts, 100).items()), "split string, quota long")


@query(f"""WITH e AS (SELECT event_id, event_type, {SPLIT.format('user_id', 'user_id')} AS split FROM events), n AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY sha256('v4.1' || chr(0) || split || chr(0) || CAST(event_id AS VARCHAR)), event_id) AS r, count(*) OVER (PARTITION BY split) AS c FROM e WHERE event_type = 'error')
    SELECT e.event_id, CASE WHEN r <= c // 2 THEN 'abnormality_presence' WHEN e.event_type = 'error' THEN 'image_normality' ELSE e.event_type END AS intent, coalesce(r <= c // 2, FALSE) AS converted FROM e LEFT JOIN n USING (event_id)""")
def polarity_rebalance(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", ids.bucket_split(F.col("user_id")).alias("split"))
    chosen = sampling.hash_ranked(e.where("event_type = 'error'"), "split", "event_id", "v4.1", F.lit(0.5)).select("event_id", F.lit(True).alias("c"))
    c = F.coalesce("c", F.lit(False))
    intent = F.when(c, "abnormality_presence").when(F.col("event_type") == "error", "image_normality").otherwise(F.col("event_type"))
    return e.join(chosen, "event_id", "left").select("event_id", intent.alias("intent"), c.alias("converted"))


MAPPING_ROWS = [("click", "finding.click", "true", "region"), ("click", "group", "action", "region"), ("view", "finding.view", "true", "region"), ("purchase", "sale.severity", "high", "image"), ("purchase", "sale.presence", "true", "image"), ("signup", None, None, "region")]
MAPPING_SQL = "m AS (SELECT * FROM (VALUES " + ", ".join("(" + ", ".join("NULL" if x is None else f"'{x}'" for x in r) + ")" for r in MAPPING_ROWS) + ") AS t(pattern, path, value, scope))"


@query(f"WITH {MAPPING_SQL} SELECT event_id, scope, path, m.value AS value FROM events JOIN m ON lower(event_type) = pattern WHERE path IS NOT NULL")
def mapped_labels(spark, d):
    return shape.mapped_labels(table(spark, d, "events"), ["event_id"], F.upper("event_type"), spark.createDataFrame(MAPPING_ROWS, shape.MAPPING))


@query("SELECT event_type AS label, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1")
def unmapped_labels(spark, d):
    return shape.unmapped_labels(table(spark, d, "events"), F.col("event_type"), spark.createDataFrame(MAPPING_ROWS, shape.MAPPING))


@query("SELECT event_type, count(*) AS n, arg_min(user_id, event_id) AS user_id, arg_min(props, event_id) AS props FROM events GROUP BY 1")
def label_registry(spark, d):
    return shape.registry(table(spark, d, "events"), "event_type", "event_id", "user_id", "props")


@query("SELECT l_partkey, count(DISTINCT l_suppkey) AS n, list_sort(list(DISTINCT l_suppkey)) AS ids FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1")
def raw_id_collisions(spark, d):
    return shape.collisions(table(spark, d, "lineitem"), "l_partkey", "l_suppkey")


@query("""SELECT o_orderkey, n_orders, priorities FROM orders JOIN (SELECT o_custkey AS c, count(*) AS n_orders, list_sort(list(DISTINCT o_orderpriority)) AS priorities FROM orders GROUP BY 1) ON c = o_custkey""")
def procedure_labels(spark, d):
    aggregates = [F.count(F.lit(1)).alias("n_orders"), F.array_sort(F.collect_set("o_orderpriority")).alias("priorities")]
    return shape.spread(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), "o_custkey", aggregates).select("o_orderkey", "n_orders", "priorities")


@query("""WITH v AS (SELECT user_id, CASE user_id % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS e, bool_or(event_type = 'error' AND value > 100) AS p FROM events GROUP BY 1)
    SELECT user_id, CASE WHEN e AND p THEN NULL WHEN p THEN FALSE ELSE e END AS normal, coalesce(e AND p, FALSE) AS conflicting_normal FROM v""")
def normality_rollup(spark, d):
    explicit = F.when(F.col("user_id") % 3 == 0, True).when(F.col("user_id") % 3 == 1, False)
    return shape.rolled_up(table(spark, d, "events"), "user_id", explicit, (F.col("event_type") == "error") & (F.col("value") > 100))


@query("""SELECT o_orderkey, 'image' AS grain, 'Is order ' || o_orderkey || ' open?' AS question, CASE WHEN o_orderstatus = 'O' THEN 'Yes.' ELSE 'No.' END AS answer FROM orders
    UNION ALL SELECT l_orderkey, 'region', 'What is the flag of line ' || l_linenumber || '?', l_returnflag || '.' FROM lineitem""")
def template_questions(spark, d):
    image = table(spark, d, "orders").select("o_orderkey", F.lit("image").alias("grain"), F.concat(F.lit("Is order "), F.col("o_orderkey"), F.lit(" open?")).alias("question"), F.when(F.col("o_orderstatus") == "O", "Yes.").otherwise("No.").alias("answer"))
    region = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.lit("region").alias("grain"), F.concat(F.lit("What is the flag of line "), F.col("l_linenumber"), F.lit("?")).alias("question"), F.concat("l_returnflag", F.lit(".")).alias("answer"))
    return image.unionByName(region)


@query("""SELECT user_id, list_sort(list(DISTINCT s)) AS strata FROM (SELECT user_id, 'family:' || event_type AS s FROM events UNION ALL SELECT user_id, 'size:' || CASE WHEN value < 10 THEN 'small' WHEN value < 100 THEN 'medium' ELSE 'large' END FROM events) GROUP BY 1""")
def golden_profiles(spark, d):
    size = F.when(F.col("value") < 10, "small").when(F.col("value") < 100, "medium").otherwise("large")
    strata = F.array(F.concat(F.lit("family:"), F.col("event_type")), F.concat(F.lit("size:"), size))
    return table(spark, d, "events").groupBy("user_id").agg(shape.ordered_set(F.flatten(F.collect_set(strata))).alias("strata"))


@query("""WITH g AS (SELECT o_custkey, list(o_orderkey ORDER BY o_orderkey) AS old, list(CASE WHEN o_orderstatus = 'P' THEN o_orderkey + 1000000000 ELSE o_orderkey END ORDER BY o_orderkey) AS "new" FROM orders GROUP BY 1) SELECT * FROM g""")
def golden_remap(spark, d):
    """Ids in arrays replaced by those of a map; ids that it lacks stay."""
    o = table(spark, d, "orders")
    new = o.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") + 1000000000).alias("to"))
    golden = o.groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("old"))
    each = golden.select("o_custkey", F.posexplode("old").alias("pos", "id")).join(new, "id", "left")
    moved = each.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("to", "id").alias("id")))).alias("n"))
    return golden.join(moved, "o_custkey").select("o_custkey", "old", F.transform("n", lambda r: r["id"]).alias("new"))


@query("""SELECT c_custkey, count(o_orderkey) AS n_orders, coalesce(bool_or(o_orderpriority = '1-URGENT'), FALSE) AS golden, c_mktsegment FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_mktsegment""")
def image_index(spark, d):
    o = table(spark, d, "orders")
    n = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    golden = o.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"), F.lit(True).alias("g")).distinct()
    j = table(spark, d, "customer").join(n, "c_custkey", "left").join(golden, "c_custkey", "left")
    return j.select("c_custkey", F.coalesce("n", F.lit(0)).alias("n_orders"), F.coalesce("g", F.lit(False)).alias("golden"), "c_mktsegment")


@query("""SELECT user_id, event_type, n FROM (SELECT user_id, event_type, count(*) AS n, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS r FROM events GROUP BY 1, 2) WHERE r = 1""")
def label_votes(spark, d):
    return shape.votes(table(spark, d, "events"), "user_id", "event_type")


@query()
def cohort_selection(spark, d):
    """Twenty users of each split, rarest event types first, ties by hash."""
    users = table(spark, d, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("f"))
    users = users.withColumn("split", ids.bucket_split(F.col("user_id"))).withColumn("k", F.concat_ws("/", F.sha2(F.col("user_id").cast("string"), 256), F.col("user_id")))
    out = [(s, i, int(k.rpartition("/")[2])) for s in ("train", "val", "test") for i, k in enumerate(sampling.diverse_keys(users.where(F.col("split") == s), "k", "f", 20), 1)]
    return spark.createDataFrame(out, "split string, rank long, user_id long")
