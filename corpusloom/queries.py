"""Queries over the provided tables, one or more for each operator, with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import geometry as G
from corpusloom.functions import ids, text
from corpusloom.operators import dedup, relate, sampling, similar, stats
from corpusloom.operators.graph import connected_components
from corpusloom.plans import export, facts
from corpusloom.registry import ORACLE_SQL, QUERIES, query  # noqa: F401
from corpusloom.session import scratch, table
from corpusloom.streaming.resume import resumed

NORM = r"trim(regexp_replace(lower(text), '[^\p{L}\p{N}_%]+', ' ', 'g'))"
BUCKET = "CAST('0x' || substr(sha256(CAST({} AS VARCHAR)), 1, 8) AS BIGINT) % 100"


@query(rf"""WITH n AS (SELECT *, {NORM} AS norm FROM documents),
    k AS (SELECT *, row_number() OVER (PARTITION BY lang, norm ORDER BY doc_id) AS r FROM n)
    SELECT k.lang, l.quality, count(*) AS n, min('doc_' || substr(sha256(CAST(k.doc_id AS VARCHAR) || chr(0) || k.lang), 1, 20)) AS first_id
    FROM k JOIN labels l USING (doc_id) WHERE r = 1 GROUP BY k.lang, l.quality""")
def deduplicated_by_language(spark, d):
    docs = table(spark, d, "documents").withColumn("norm", text.normalize(F.col("text")))
    kept = dedup.keep_first(docs, ["lang", "norm"], ["doc_id"]).withColumn("id", ids.stable_id("doc", F.col("doc_id"), F.col("lang")))
    return kept.join(table(spark, d, "labels"), "doc_id").groupBy("lang", "quality").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))


@query("SELECT doc_id, 'doc_' || substr(sha256(CAST(doc_id AS VARCHAR) || chr(0) || source || chr(0) || text), 1, 24) AS id FROM documents")
def stable_id_docs(spark, d):
    return table(spark, d, "documents").select("doc_id", ids.stable_id("doc", F.col("doc_id"), F.col("source"), F.col("text"), length=24).alias("id"))


@query(f"""WITH b AS (SELECT {BUCKET.format('c_custkey')} AS b FROM customer)
    SELECT CASE WHEN b < 70 THEN 'train' WHEN b < 85 THEN 'val' ELSE 'test' END AS split, count(*) AS n FROM b GROUP BY 1""")
def hash_bucket_split(spark, d):
    return table(spark, d, "customer").select(ids.bucket_split(F.col("c_custkey")).alias("split")).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT lang, doc_id FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY sha256('v1' || chr(0) || lang || chr(0) || CAST(doc_id AS VARCHAR)), doc_id) AS r,
    count(*) OVER (PARTITION BY lang) AS n FROM documents) WHERE r <= n // 2""")
def hash_ranked_half(spark, d):
    return sampling.hash_ranked(table(spark, d, "documents").select("lang", "doc_id"), "lang", "doc_id", "v1", F.lit(0.5))


@query(rf"""SELECT doc_id, sha256({NORM}) AS words, sha256(trim(regexp_replace(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}\s]', '', 'g'), '\s+', ' ', 'g'))) AS alnum,
    sha256(trim(regexp_replace(regexp_replace(replace(replace(lower(text), '–', '-'), '—', '-'), '[^\p{{L}}\p{{N}}\s]', '', 'g'), '\s+', ' ', 'g'))) AS alnum_dash, sha256(trim(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}_]+', ' ', 'g'))) AS signs,
    sha256({NORM}) AS words_dash, sha256(trim(regexp_replace(lower(text), '\s+', ' ', 'g'))) AS spaces FROM documents""")
def normalize_variants(spark, d):
    return table(spark, d, "documents").select("doc_id", *(F.sha2(text.normalize(F.col("text"), v), 256).alias(v) for v in ("words", "alnum", "alnum_dash", "signs", "words_dash", "spaces")))


@query(f"""WITH n AS (SELECT doc_id, lang, {NORM} AS norm FROM documents), m AS (SELECT *, min(doc_id) OVER (PARTITION BY lang, norm) AS kept FROM n)
    SELECT doc_id, kept FROM m WHERE doc_id <> kept""")
def dedup_log(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", text.normalize(F.col("text")).alias("norm"))
    return dedup.dropped(docs, ["lang", "norm"], "doc_id").select("doc_id", "kept")


@query(f"""WITH e AS (SELECT *, {BUCKET.format('user_id')} AS b FROM events), r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS r FROM e)
    SELECT event_id, user_id FROM r WHERE r <= CASE WHEN b < 70 THEN 2 ELSE 1 END""")
def cap_per_group(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "event_type")
    limit = F.when(ids.bucket_split(F.col("user_id")) == "train", 2).otherwise(1)
    return dedup.cap(e, ["user_id", "event_type"], ["event_id"], limit).select("event_id", "user_id")


@query("""SELECT l_orderkey, l_returnflag, count(DISTINCT l_linestatus) AS n_values, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT l_linestatus) > 1""")
def contradiction_groups(spark, d):
    return dedup.contradictions(table(spark, d, "lineitem"), ["l_orderkey", "l_returnflag"], "l_linestatus")


@query("""SELECT conv_id, turn, role, previous FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, text) AS previous FROM conversations) WHERE previous <> role""")
def lag_contradictions(spark, d):
    return dedup.changes(table(spark, d, "conversations"), ["conv_id"], ["turn", "text"], "role").select("conv_id", "turn", "role", "previous")


@query("""SELECT l_orderkey, list_sort(list(DISTINCT l_returnflag)) AS "values", list_sort(list(DISTINCT l_linenumber)) AS sources FROM lineitem GROUP BY 1""")
def multi_value_merge(spark, d):
    return facts.merge_values(table(spark, d, "lineitem"), ["l_orderkey"], "l_returnflag", "l_linenumber")


@query("""SELECT l_orderkey, min(l_returnflag) AS value FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 1""")
def ambiguity_skip(spark, d):
    return facts.unambiguous(table(spark, d, "lineitem"), ["l_orderkey"], "l_returnflag")


@query("""WITH f AS (SELECT doc_id, 'quality' AS concept, CAST(quality AS VARCHAR) AS value FROM labels UNION ALL SELECT doc_id, 'toxic', CAST(toxic AS VARCHAR) FROM labels)
    SELECT doc_id, concept, value, CASE WHEN value = '0' THEN 'absent' ELSE 'present' END AS polarity,
    'fact_' || substr(sha256(CAST(doc_id AS VARCHAR) || chr(0) || concept || chr(0) || value), 1, 20) AS fact_id FROM f WHERE value IS NOT NULL""")
def facts_unpivot(spark, d):
    return facts.unpivot_facts(table(spark, d, "labels"), "doc_id", [("quality", F.col("quality")), ("toxic", F.col("toxic"))])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def parent_orphans(spark, d):
    return facts.orphans(table(spark, d, "orders").select("o_orderkey", "o_custkey"), table(spark, d, "lineitem"), "o_orderkey", "l_orderkey")


@query("""WITH c AS (SELECT o_custkey, list_sort(list(DISTINCT o_orderkey)) AS keys FROM orders GROUP BY 1),
    p AS (SELECT o_custkey, unnest(keys) AS k FROM c)
    SELECT c.o_custkey, coalesce(v."values", []) AS "values" FROM c LEFT JOIN (SELECT p.o_custkey, list(o.o_orderpriority ORDER BY p.k) AS "values" FROM p JOIN orders o ON o.o_orderkey = p.k WHERE o.o_orderstatus = 'F' GROUP BY 1) v USING (o_custkey)""")
def array_membership_join(spark, d):
    o = table(spark, d, "orders")
    c = o.groupBy("o_custkey").agg(F.array_sort(F.collect_set("o_orderkey")).alias("keys"))
    return relate.array_join_ordered(c, "o_custkey", "keys", o.where("o_orderstatus = 'F'"), "o_orderkey", "o_orderpriority")


@query("""SELECT doc_id, 'left' AS only_in FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)
    UNION ALL SELECT doc_id, 'right' FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)""")
def coverage_diff(spark, d):
    return relate.coverage(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id")


@query("""SELECT count(*) FILTER (WHERE l.o_orderstatus IS DISTINCT FROM r.o_orderstatus) AS o_orderstatus, count(*) FILTER (WHERE l.o_orderpriority IS DISTINCT FROM r.o_orderpriority) AS o_orderpriority
    FROM orders l JOIN (SELECT o_orderkey, CASE WHEN o_totalprice > 1e5 THEN 'F' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority FROM orders) r USING (o_orderkey)""")
def fieldwise_compare(spark, d):
    o = table(spark, d, "orders")
    changed = o.withColumn("o_orderstatus", F.when(F.col("o_totalprice") > 1e5, "F").otherwise(F.col("o_orderstatus")))
    return relate.differing(o, changed, "o_orderkey", ["o_orderstatus", "o_orderpriority"])


@query("""SELECT d.doc_id, coalesce(CASE WHEN l.toxic = 1 THEN 'toxic' END, CASE WHEN l.quality = 1 THEN 'good' END, d.lang) AS label,
    CASE WHEN l.toxic = 1 THEN 'toxic' WHEN l.quality = 1 THEN 'quality' ELSE 'lang' END AS source FROM documents d LEFT JOIN labels l USING (doc_id)""")
def fallback_resolve(spark, d):
    j = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    label, source = relate.resolved([("toxic", F.when(F.col("toxic") == 1, "toxic")), ("quality", F.when(F.col("quality") == 1, "good")), ("lang", F.col("lang"))])
    return j.select("doc_id", label.alias("label"), source.alias("source"))


@query("""SELECT source, lang, CASE WHEN count(DISTINCT quality) = 1 THEN min(quality) END AS quality, count(DISTINCT quality) > 1 AS conflicting_quality,
    CASE WHEN count(DISTINCT toxic) = 1 THEN min(toxic) END AS toxic, count(DISTINCT toxic) > 1 AS conflicting_toxic FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1, 2""")
def tristate_merge(spark, d):
    j = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return dedup.merge_tristate(j, ["source", "lang"], ["quality", "toxic"])


@query("""SELECT user_id, count(DISTINCT event_type) AS n_splits FROM events GROUP BY 1 HAVING count(DISTINCT event_type) > 1""")
def split_leakage(spark, d):
    return relate.leaking(table(spark, d, "events"), "user_id", "event_type")


@query("""WITH s AS (SELECT DISTINCT user_id, event_type FROM events) SELECT a.event_type AS "left", b.event_type AS "right", count(*) AS n FROM s a JOIN s b USING (user_id) WHERE a.event_type < b.event_type GROUP BY 1, 2""")
def split_overlap_matrix(spark, d):
    return relate.overlaps(table(spark, d, "events"), "user_id", "event_type")


@query(f"""WITH j AS (SELECT d.source, l.quality, {BUCKET.format('d.doc_id')} AS b FROM documents d JOIN labels l USING (doc_id)),
    g AS (SELECT quality FROM j WHERE b < 70 GROUP BY 1 ORDER BY count(*) DESC, quality LIMIT 1),
    m AS (SELECT source, quality AS predicted FROM (SELECT source, quality, row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, quality) AS r FROM j WHERE b < 70 GROUP BY 1, 2) WHERE r = 1)
    SELECT count(*) AS n, avg(CAST(coalesce(m.predicted, g.quality) = j.quality AS DOUBLE)) AS accuracy, avg(CAST(m.predicted IS NOT NULL AS DOUBLE)) AS coverage FROM j LEFT JOIN m USING (source), g WHERE b >= 70""")
def majority_baseline(spark, d):
    j = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").select("source", "quality", ids.hash_bucket(F.col("doc_id")).alias("b"))
    return stats.majority_baseline(j.where("b < 70"), j.where("b >= 70"), "source", "quality")


@query(r"""WITH t AS (SELECT lang, len(regexp_extract_all(text, '[\p{L}\p{N}]+(?:[-–][\p{L}\p{N}]+)*')) AS n FROM documents)
    SELECT lang, count(n) AS n, round(avg(n), 3) AS mean, round(coalesce(stddev_samp(n), 0), 3) AS sd, CAST(min(n) AS INT) AS min, round(quantile_cont(n, 0.25), 3) AS p25, round(quantile_cont(n, 0.5), 3) AS median,
    round(quantile_cont(n, 0.75), 3) AS p75, round(quantile_cont(n, 0.95), 3) AS p95, CAST(max(n) AS INT) AS max FROM t GROUP BY 1""")
def describe_token_lengths(spark, d):
    docs = table(spark, d, "documents").select("lang", F.size(text.tokens(F.col("text"))).alias("len"))
    return stats.describe(docs, "lang", "len")


@query("""SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS F, count(*) FILTER (WHERE o_orderstatus = 'O') AS O, count(*) FILTER (WHERE o_orderstatus = 'P') AS P,
    count(*) FILTER (WHERE o_orderstatus IN ('F', 'O', 'P')) AS total, round(1e2 * count(*) FILTER (WHERE o_orderstatus IN ('F', 'O', 'P')) / (SELECT count(*) FROM orders), 4) AS pct FROM orders GROUP BY 1""")
def value_pct_by_split(spark, d):
    return stats.value_shares(table(spark, d, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query(r"""SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+(?:[-–][\p{L}\p{N}]+)*')) AS token FROM documents) GROUP BY 1 ORDER BY n DESC, token LIMIT 100""")
def top_terms(spark, d):
    t = table(spark, d, "documents").select(F.explode(text.tokens(F.lower("text"))).alias("token"))
    return stats.most_common(t, "token", 100)


@query("""SELECT conv_id, count(*) AS n_turns, string_agg(role || ': ' || text, chr(10) ORDER BY turn, role || ': ' || text) AS transcript FROM conversations GROUP BY 1""")
def export_conversation(spark, d):
    return export.conversation(table(spark, d, "conversations"), "conv_id", "turn", "role", "text")


@query(r"""SELECT page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title FROM pages""")
def tag_extract(spark, d):
    return table(spark, d, "pages").select("page_id", text.tag(F.col("html"), "title").alias("title"))


@query("""SELECT doc_id, list_filter(['token', 'password', 'license'], lambda t: contains(lower(text), t)) AS terms,
    (contains(lower(text), 'the') OR contains(lower(text), 'la')) AND contains(lower(text), 'en') AS anchored FROM documents""")
def anchor_and_forbidden(spark, d):
    terms = text.found_terms(F.col("text"), ["token", "password", "license"], "")
    return table(spark, d, "documents").select("doc_id", terms.alias("terms"), text.has_anchors(F.col("text"), [["the", "la"], ["en"]]).alias("anchored"))


@query("""SELECT p_partkey, sha256('{"p_brand":"' || p_brand || '","p_partkey":' || p_partkey || ',"p_size":' || p_size || '}') AS protected_sha256, p_partkey % 10 = 0 AS tampered FROM part""")
def seal_and_verify(spark, d):
    names = ["p_partkey", "p_brand", "p_size"]
    s = facts.sealed(table(spark, d, "part").select(*names), names)
    changed = s.withColumn("p_size", F.when(F.col("p_partkey") % 10 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")))
    bad = facts.tampered(changed, names).select("p_partkey", F.lit(True).alias("bad"))
    return s.join(bad, "p_partkey", "left").select("p_partkey", "protected_sha256", F.coalesce("bad", F.lit(False)).alias("tampered"))


def _polygons(spark, d):
    point = lambda i: F.struct(F.element_at("embedding", 2 * i + 1).cast("double").alias("x"), F.element_at("embedding", 2 * i + 2).cast("double").alias("y"))
    return table(spark, d, "embeddings").select("vec_id", "label", F.transform(F.sequence(F.lit(0), F.lit(31)), point).alias("polygon"))


@query("""WITH p AS (SELECT vec_id, list_transform(range(0, 32), lambda i: CAST(embedding[2*i+1] AS DOUBLE)) AS x, list_transform(range(0, 32), lambda i: CAST(embedding[2*i+2] AS DOUBLE)) AS y FROM embeddings)
    SELECT vec_id, round(abs(list_sum(list_transform(range(0, 32), lambda i: x[i+1] * y[(i+1)%32+1] - x[(i+1)%32+1] * y[i+1]))) / 2, 6) AS area,
    round(list_min(x), 6) AS x0, round(list_min(y), 6) AS y0, round(list_max(x), 6) AS x1, round(list_max(y), 6) AS y1 FROM p""")
def polygon_measures(spark, d):
    p = _polygons(spark, d).withColumn("b", G.bbox(F.col("polygon")))
    return p.select("vec_id", F.round(G.area(F.col("polygon")), 6).alias("area"), *(F.round(F.col("b")[i], 6).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))))


@query("""WITH p AS (SELECT vec_id, list_transform(range(0, 32), lambda i: {'x': CAST(round(CAST(embedding[2*i+1] AS DOUBLE), 6) * 1000000 AS DOUBLE), 'y': CAST(round(CAST(embedding[2*i+2] AS DOUBLE), 6) * 1000000 AS DOUBLE)}) AS ring FROM embeddings),
    t AS (SELECT vec_id, list_transform(ring, lambda q: {'x': CAST(round(q.x) AS BIGINT), 'y': CAST(round(q.y) AS BIGINT)}) AS ring FROM p),
    e AS (SELECT vec_id, ring AS r FROM t UNION ALL SELECT vec_id, list_reverse(ring) FROM t),
    o AS (SELECT vec_id, min(list_concat(r[k + 1:], r[1:k])) AS r FROM e, (SELECT unnest(range(0, 32)) AS k) GROUP BY 1)
    SELECT vec_id, sha256(array_to_string(list_transform(r, lambda q: q.x || ',' || q.y), ';')) AS geometry_hash FROM o""")
def ring_normal_form(spark, d):
    """Each ring starts anywhere, runs either way and may be closed or repeat a point."""
    k = (F.col("vec_id") % 32).cast("int")
    p = F.col("polygon")
    turned = F.concat(F.slice(p, k + 1, 32 - k), F.slice(p, F.lit(1), k))
    turned = F.when(F.col("vec_id") % 2 == 0, F.reverse(turned)).otherwise(turned)
    turned = F.when(F.col("vec_id") % 3 == 0, F.concat(turned, F.slice(turned, 1, 1))).otherwise(F.concat(F.slice(turned, 1, 1), turned))
    return _polygons(spark, d).select("vec_id", G.ring_hash(turned).alias("geometry_hash"))


@query("""WITH b AS (SELECT vec_id, label, embedding[1] AS x0, embedding[2] AS y0, embedding[1] + abs(embedding[3]) AS x1, embedding[2] + abs(embedding[4]) AS y1 FROM embeddings)
    SELECT a.label, a.vec_id AS a, b.vec_id AS b FROM b a JOIN b ON a.label = b.label AND a.vec_id < b.vec_id AND a.x0 <= b.x1 AND b.x0 <= a.x1 AND a.y0 <= b.y1 AND b.y0 <= a.y1""")
def bbox_overlap_pairs(spark, d):
    v = table(spark, d, "embeddings")
    e = F.col("embedding")
    b = v.select("label", "vec_id", F.array(e[0], e[1], e[0] + F.abs(e[2]), e[1] + F.abs(e[3])).alias("box"))
    return similar.box_pairs(b, "label", "vec_id", "box", 0.5).select("label", "a", "b")


@query("""WITH h AS (SELECT vec_id, list_aggregate(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), 'string_agg', '') AS h FROM embeddings)
    SELECT a.vec_id AS a, b.vec_id AS b, CAST(hamming(a.h, b.h) AS INT) AS distance FROM h a JOIN h b ON a.vec_id < b.vec_id AND hamming(a.h, b.h) <= 18""")
def hamming_pairs(spark, d):
    codes = table(spark, d, "embeddings").select("vec_id", G.sign_hash(F.col("embedding")).alias("code"))
    return similar.hamming_pairs(codes, "vec_id", "code", 18)


COSINE = """WITH p AS (SELECT a.label, a.vec_id AS a, b.vec_id AS b, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS c FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id)"""


@query(COSINE + " SELECT label, a, b, round(c, 6) AS cosine FROM p WHERE c >= 0.3")
def cosine_pairs(spark, d):
    p = similar.cosine_pairs(table(spark, d, "embeddings"), "label", "vec_id", "embedding", 0.3)
    return p.withColumn("cosine", F.round("cosine", 6))


@query()
def greedy_semantic_dedup(spark, d):
    e = table(spark, d, "embeddings")
    return similar.greedy_keep(e.select("vec_id", "label"), similar.cosine_pairs(e, "label", "vec_id", "embedding", 0.3), "vec_id", "label")


@query(COSINE.replace("WITH p", "WITH RECURSIVE p") + """, e AS (SELECT a, b FROM p WHERE c >= 0.3 UNION SELECT b, a FROM p WHERE c >= 0.3),
    r AS (SELECT a AS node, a AS reached FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.reached = e.a) SELECT node, min(reached) AS component FROM r GROUP BY 1""")
def components(spark, d):
    return connected_components(similar.cosine_pairs(table(spark, d, "embeddings"), "label", "vec_id", "embedding", 0.3))


@query("""WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY 1), p AS (SELECT source, 100 * n // (SELECT count(*) FROM documents) AS base, 100 * n % (SELECT count(*) FROM documents) AS rest FROM c)
    SELECT source, CAST(base + CASE WHEN row_number() OVER (ORDER BY rest DESC, source) <= 100 - (SELECT sum(base) FROM p) THEN 1 ELSE 0 END AS BIGINT) AS quota FROM p""")
def quota_allocation(spark, d):
    c = table(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return sampling.quotas(c, "source", "n", 100)


SPLITS = {"train": 0.7, "validation": 0.15, "test": 0.15}
SPLIT_BOUNDS = {"train": (0.70, 0.80), "validation": (0.10, 0.15), "test": (0.10, 0.15)}


def _split(spark, rows, key, kind, labels):
    """Whole groups of rows to splits; the groups' counts, not their rows, reach the driver."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *(F.count_if(c).alias(x) for x, c in labels.items())).collect()
    sizes = {r[key]: r["n"] for r in counts}
    out = sampling.assign_groups(sizes, SPLITS, labels={r[key]: {x: r[x] for x in labels} for r in counts}, bounds=SPLIT_BOUNDS)
    return spark.createDataFrame(sorted((g, sizes[g], s) for g, s in out.items()), f"{key} {kind}, n long, split string")


@query()
def group_stratified_split(spark, d):
    """All users of the events, stratified by event type."""
    e = table(spark, d, "events").where("user_id is not null")
    kinds = sorted(r[0] for r in e.select("event_type").distinct().collect() if r[0] is not None)
    return _split(spark, e, "user_id", "long", {f"is_{k}": F.col("event_type") == k for k in kinds})


@query()
def group_stratified_split_sources(spark, d):
    """All sources of the documents, stratified by the values of their labels."""
    docs = table(spark, d, "documents").where("source is not null").join(table(spark, d, "labels"), "doc_id", "left")
    return _split(spark, docs, "source", "string", {f"{c}_{v}": F.col(c) == v for c in ("quality", "toxic") for v in (0, 1)})


@query()
def diverse_selection(spark, d):
    users = table(spark, d, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("f"))
    chosen = sampling.diverse_keys(users, "user_id", "f", 20)
    return spark.createDataFrame(list(enumerate(chosen, 1)), "rank long, user_id long")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49) THEN 'review' ELSE 'accepted' END AS route FROM lineitem""")
def quarantine_route(spark, d):
    li = table(spark, d, "lineitem")
    return relate.quarantine(li, li.where("l_quantity > 49"), "l_orderkey").select("l_orderkey", "l_linenumber", "l_partkey", "route")


@query("""SELECT event_id, list_filter([CASE WHEN value IS NULL OR value < 0 THEN 'negative' END, CASE WHEN CAST(json_extract(props, '$.k') AS INT) >= 50 THEN 'k_out_of_range' END], lambda x: x IS NOT NULL) AS failures FROM events""")
def rule_failures(spark, d):
    rules = {"negative": F.col("value") >= 0, "k_out_of_range": F.get_json_object("props", "$.k").cast("int") < 50}
    return table(spark, d, "events").select("event_id", relate.failures(rules).alias("failures"))


@query("""SELECT sha256(string_agg(l, chr(10) ORDER BY l)) AS sha256, count(*) AS n FROM (SELECT n_nationkey || chr(0) || n_name AS l FROM nation)""")
def manifest_hash(spark, d):
    return export.manifest_hash(table(spark, d, "nation"), "n_nationkey", "n_name")


@query("""WITH p AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS s FROM embeddings),
    b AS (SELECT vec_id, s, list_transform(range(0, 32), lambda i: s[2*i+1]) AS x, list_transform(range(0, 32), lambda i: s[2*i+2]) AS y FROM p)
    SELECT vec_id, s AS segmentation, [list_min(x), list_min(y), list_max(x) - list_min(x), list_max(y) - list_min(y)] AS bbox FROM b""")
def label_matrix_coco(spark, d):
    p = _polygons(spark, d)
    return export.coco_rows(p, "vec_id", F.col("polygon"), G.bbox(F.col("polygon")))


@query("""SELECT event_id, user_id, 'event_' || substr(sha256(CAST(event_id AS VARCHAR)), 1, 20) AS id FROM events WHERE value > 0""")
def incremental_resume(spark, d):
    e = table(spark, d, "events")
    realise = lambda s: s.where("value > 0").select("event_id", "user_id", ids.stable_id("event", F.col("event_id")).alias("id"))
    source = scratch(spark, "arrivals")
    e.repartition(4).write.parquet(source)
    return resumed(spark, source, e.schema, realise)


@query("SELECT user_id, count(*) AS n FROM events GROUP BY 1 HAVING count(*) < 65")
def rare_values(spark, d):
    return stats.rare(table(spark, d, "events"), "user_id", 65)


@query("""SELECT CAST(sum(u) AS BIGINT) AS user_id, CAST(sum(p) AS BIGINT) AS props FROM (SELECT event_type, count(DISTINCT user_id) AS u, count(DISTINCT props) AS p FROM events GROUP BY 1)""")
def summed_distinct(spark, d):
    return stats.summed_distinct(table(spark, d, "events"), "event_type", ["user_id", "props"])


@query("""SELECT p_type, n, first, row_number() OVER (ORDER BY n DESC, first, p_type) AS rank FROM (SELECT p_type, count(*) AS n, min(p_partkey) AS first FROM part GROUP BY 1) ORDER BY n DESC, first, p_type LIMIT 20""")
def frequency_ranks(spark, d):
    return stats.first_seen_order(table(spark, d, "part"), "p_type", "p_partkey", 20)


@query("""SELECT key, CAST(sum(value) AS BIGINT) AS total FROM (SELECT 'chars' AS key, length(text) AS value FROM conversations UNION ALL SELECT role, 1 FROM conversations) GROUP BY 1""")
def counter_sums(spark, d):
    counters = F.create_map(F.lit("chars"), F.length("text"), F.col("role"), F.lit(1))
    return stats.map_sums(table(spark, d, "conversations").select(counters.alias("usage")), "usage")


@query("""WITH r AS (SELECT l_returnflag || l_linestatus AS code, l_orderkey, row_number() OVER (PARTITION BY l_returnflag || l_linestatus ORDER BY l_orderkey) AS r FROM lineitem)
    SELECT code, count(*) AS n, list(l_orderkey ORDER BY l_orderkey) FILTER (WHERE r <= 10) AS examples FROM r GROUP BY 1""")
def failure_examples(spark, d):
    li = table(spark, d, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("code"), "l_orderkey")
    return stats.counted_examples(li, "code", "l_orderkey")


@query("""WITH b AS (SELECT label, CASE WHEN vec_id % 3 > 0 THEN 1 ELSE 0 END AS boxes, CASE WHEN vec_id % 3 > 0 AND NOT (embedding[3] > embedding[1] AND embedding[4] > embedding[2]) THEN 1 ELSE 0 END AS bad FROM embeddings)
    SELECT label, count(*) AS n, CAST(sum(boxes) AS BIGINT) AS boxes, CAST(sum(boxes) AS BIGINT) AS with_box, CAST(sum(bad) AS BIGINT) AS invalid FROM b GROUP BY 1""")
def box_statistics(spark, d):
    boxes = F.when(F.col("vec_id") % 3 > 0, F.array(F.slice("embedding", 1, 4)))
    return stats.box_counts(table(spark, d, "embeddings").select("label", boxes.alias("boxes")), "label", F.col("boxes"))


@query("""SELECT l_orderkey, l_returnflag, count(*) FILTER (WHERE l_linestatus = 'O') AS n_one, count(*) FILTER (WHERE l_linestatus = 'F') AS n_other FROM lineitem GROUP BY 1, 2
    HAVING count(*) FILTER (WHERE l_linestatus = 'O') > 0 AND count(*) FILTER (WHERE l_linestatus = 'F') > 0""")
def polarity_contradictions(spark, d):
    return relate.opposites(table(spark, d, "lineitem"), ["l_orderkey", "l_returnflag"], "l_linestatus", "O", "F")


@query("""SELECT o_orderkey, o_custkey AS "left", CASE WHEN o_orderkey % 50 > 0 THEN o_custkey + CASE WHEN o_orderkey % 70 = 0 THEN 1 ELSE 0 END END AS "right" FROM orders WHERE o_orderkey % 50 = 0 OR o_orderkey % 70 = 0""")
def positional_mismatch(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    moved = o.where("o_orderkey % 50 > 0").withColumn("o_custkey", F.col("o_custkey") + F.when(F.col("o_orderkey") % 70 == 0, 1).otherwise(0))
    return relate.same_order(o, moved, "o_orderkey", "o_custkey")


@query("""SELECT event_id, CAST(CASE WHEN value IS NULL THEN 1 ELSE -1 END AS BIGINT) AS missing FROM events WHERE value IS NULL OR (value > 0 AND event_type = 'click' AND user_id % 10 = 0)""")
def row_conservation(spark, d):
    e = table(spark, d, "events")
    parts = {"accepted": e.where("value > 0"), "rejected": e.where("value <= 0"), "review": e.where("value > 0 and event_type = 'click' and user_id % 10 = 0")}
    return relate.conserved(e, parts, "event_id")


@query(r"""SELECT doc_id, list_filter(['the', 'license', 'token', 'la'], lambda t: regexp_matches(lower(text), '(?:^|[^\p{L}\p{N}_])' || t || '(?:$|[^\p{L}\p{N}_])')) AS terms FROM documents""")
def mentioned_terms(spark, d):
    return table(spark, d, "documents").select("doc_id", relate.mentions(F.col("text"), ["the", "license", "token", "la"]).alias("terms"))


@query("""SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1""")
def group_representative(spark, d):
    return dedup.representative(table(spark, d, "orders"), ["o_custkey"], ["o_totalprice", "o_orderkey"], ["o_orderkey", "o_totalprice"])


@query("""SELECT user_id, count(*) AS n, bool_and(event_type = 'view') AS all_views FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r <= 9 GROUP BY 1""")
def last_nine(spark, d):
    last = dedup.last_rows(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], 9)
    return last.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("event_type") == "view").alias("all_views"))


@query("""SELECT p_partkey, replace(format('{:,}', p_partkey * 1234), ',', '.') AS marked FROM part""")
def thousands_marks(spark, d):
    return table(spark, d, "part").select("p_partkey", text.thousands(F.col("p_partkey") * 1234).alias("marked"))


@query(r"""SELECT p_partkey, 'A. ' || p_brand || chr(10) || 'B. ' || p_type AS lines, ' <choices>: [A: ' || p_brand || ', B: ' || p_type || ']' AS inline FROM part""")
def choice_rendering(spark, d):
    options = F.create_map(F.lit("B"), F.col("p_type"), F.lit("A"), F.col("p_brand"))
    return table(spark, d, "part").select("p_partkey", text.choices(options).alias("lines"), text.choices(options, True).alias("inline"))


@query("""SELECT doc_id, CAST(len(regexp_extract_all(lower(text), '[éèñüß]')) AS INT) AS marked FROM documents""")
def marked_letters(spark, d):
    return table(spark, d, "documents").select("doc_id", text.count_marked(F.col("text"), "éèñüß").alias("marked"))


@query("""SELECT event_id, replace(props, ' ', '') AS object FROM events""")
def json_from_text(spark, d):
    said = F.concat(F.lit("Answer {so}:\n```json\n"), F.col("props"), F.lit("\n```\nand {} more"))
    return table(spark, d, "events").select("event_id", text.json_object(said).alias("object"))


@query("""SELECT p_partkey, CASE WHEN p_size / 1e3 < 0.01 THEN 'small' WHEN p_size / 1e3 < 0.1 THEN 'medium' ELSE 'large' END AS bin,
    [CAST(round_even(1000.0 * p_size / 640, 0) AS INT), CAST(round_even(1000.0 * p_size / 480, 0) AS INT), CAST(round_even(1000.0 * (p_size + 7) / 640, 0) AS INT), CAST(round_even(1000.0 * (p_size + 7) / 480, 0) AS INT)] AS box FROM part""")
def scaled_boxes(spark, d):
    box = F.array("p_size", "p_size", F.col("p_size") + 7, F.col("p_size") + 7)
    return table(spark, d, "part").select("p_partkey", G.size_bin(F.col("p_size") / 1e3).alias("bin"), G.scaled_box(box, F.lit(640), F.lit(480)).alias("box"))


@query("""SELECT conv_id, CASE WHEN len(l) < 2 THEN l[1] ELSE array_to_string(l[1:len(l) - 1], ', ') || ' and ' || l[len(l)] END AS roles FROM (SELECT conv_id, list_sort(list(DISTINCT role)) AS l FROM conversations GROUP BY 1)""")
def joined_items(spark, d):
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_set("role")).alias("r"))
    return c.select("conv_id", text.joined(F.col("r")).alias("roles"))


@query(r"""SELECT item_id, upper(substr(b, 1, 1)) || substr(b, 2) || '.' AS sentence FROM (SELECT item_id, rtrim(regexp_replace(trim(text), '\.+$', '')) AS b FROM benchmark)""")
def sentences(spark, d):
    return table(spark, d, "benchmark").select("item_id", text.sentence(F.col("text")).alias("sentence"))


from corpusloom import queries_plans, queries_runs, queries_shapes, queries_sources  # noqa: E402, F401  (they register more)
