"""Queries of runs: realizers, checkpoints, gates, quarantine, hashes of inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import ids
from corpusloom.operators import regions, similar
from corpusloom.registry import query
from corpusloom.session import table, written
from corpusloom.streaming import runs


def _flaky(request: dict) -> str:
    """A writer that fails as often as its key says, so that retries show."""
    if request["attempt"] < request["o_orderkey"] % 5:
        raise TimeoutError(f"timed out {request['attempt']}")
    return runs.REALIZERS["template"]({"question": request["o_orderpriority"]})


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 2 THEN 'failed' ELSE 'accepted' END AS status, CAST(least(o_orderkey % 5 + 1, 3) AS INT) AS attempts, CASE WHEN o_orderkey % 5 <= 2 THEN 'Please say: ' || o_orderpriority END AS text, CAST(least(o_orderkey % 5, 3) AS INT) AS n_errors FROM orders""")
def realized_requests(spark, d):
    out = runs.realized(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderkey", _flaky)
    return out.select("o_orderkey", "status", "attempts", "text", F.size("errors").alias("n_errors"))


@query("SELECT o_orderkey, o_orderstatus AS result, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS run FROM orders")
def checkpointed_runs(spark, d):
    """A first run gets through a part of the keys, a second one through what is pending."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    kept = runs.Checkpoints(spark, "o_orderkey")
    result = lambda df, n: df.select("o_orderkey", F.col("o_orderstatus").alias("result"), F.lit(n).alias("run"))
    kept.add(result(o.where("o_orderkey % 3 > 0"), 0))
    kept.add(result(kept.pending(o), 1))
    return kept.results()


@query("""SELECT o_orderpriority AS cohort, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS done, count(*) FILTER (WHERE o_orderstatus <> 'F') AS pending FROM orders GROUP BY 1""")
def cohort_progress(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderpriority").alias("cohort"), "o_orderkey", "o_orderstatus")
    return runs.progress(o, o.where("o_orderstatus = 'F'"), "o_orderkey", "cohort")


@query("SELECT o_orderkey, 'review_required' AS status, ['generation_failure_after_retries'] AS reasons FROM orders WHERE o_orderstatus <> 'F'")
def failure_checkpoints(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return runs.failure_checkpoints(o, o.where("o_orderstatus = 'F'"), "o_orderkey")


@query("""WITH e AS (SELECT user_id, event_type = 'error' AND value > 5 AS i, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) SELECT user_id, bool_and(NOT i) FILTER (WHERE r <= 3) AS infrastructure FROM e GROUP BY 1""")
def infrastructure_errors(spark, d):
    said = F.when((F.col("event_type") == "error") & (F.col("value") > 5), "ValueError: bad json").otherwise("URLError: HTTP Error 503")
    e = table(spark, d, "events").select("user_id", F.struct("event_id", said.alias("e")).alias("x"))
    lists = e.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["e"]).alias("errors"))
    return lists.select("user_id", runs.infrastructure(F.col("errors"), 3).alias("infrastructure"))


@query("SELECT FALSE AS passed, 'hard_review_reason:R' AS reason")
def quality_gate(spark, d):
    li = table(spark, d, "lineitem")
    failures = li.where("l_quantity < 0").agg(F.count(F.lit(1)).alias("n"))
    reviews = li.groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("reasons"))
    return runs.gate(failures, reviews, ["R", "X"])


@query("""SELECT * FROM (VALUES (1, 'INITIALIZED', '{}'), (2, 'RUNNING', '{}'), (3, 'PAUSED_MANUAL_REVIEW', '{"cohort": 1}'), (4, 'READY_TO_RESUME', '{}'), (5, 'RUNNING', '{}'), (6, 'COMPLETE', '{}')) AS t(seq, event, detail)
    UNION ALL SELECT 6 + row_number() OVER (ORDER BY n_name), n_name, 'nation' FROM nation""")
def event_log(spark, d):
    run = runs.Run().to("RUNNING").to("PAUSED_MANUAL_REVIEW", cohort=1).to("READY_TO_RESUME").to("RUNNING").to("COMPLETE")
    new = table(spark, d, "nation").select(F.col("n_name").alias("event"), F.lit("nation").alias("detail"))
    return runs.events_appended(run.log(spark), new)


@query("""SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN 'added' WHEN p_partkey % 13 = 0 THEN 'removed' ELSE 'changed' END AS change FROM part WHERE p_partkey % 11 = 0 OR p_partkey % 13 = 0 OR p_partkey % 17 = 0 AND p_size > 0 EXCEPT SELECT p_partkey, 'added' FROM part WHERE p_partkey % 143 = 0""")
def changed_inputs(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.sha2("p_name", 256).alias("sha"))
    after = p.where("p_partkey % 13 <> 0").withColumn("sha", F.when(F.col("p_partkey") % 17 == 0, "x").otherwise(F.col("sha")))
    return runs.changed_inputs(p.where("p_partkey % 11 <> 0"), after, "p_partkey", "sha")


@query()
def merged_regions(spark, d):
    """Squares of each user's events on a grid of a few places: many cover the same."""
    e = table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    x, y = F.col("k") % 4 * 30, F.floor(F.col("k") / 25).cast("int") * 30
    size = F.lit(20) + (F.col("k") % 3 == 0).cast("int") * 2
    corner = lambda dx, dy: F.array((x + dx).cast("double"), (y + dy).cast("double"))
    polygon = F.array(corner(0, 0), corner(size, 0), corner(size, size), corner(0, size))
    labels = F.to_json(F.struct(F.array("event_type").alias("types"), F.when(F.col("k") % 10 == 0, F.lit("x")).when(F.col("k") % 10 == 1, F.lit("y")).alias("place")))
    rows = e.select(F.col("user_id").alias("image_id"), F.concat(F.lit("r"), F.lpad(F.col("event_id"), 9, "0")).alias("region_id"), polygon.alias("polygon"), labels.alias("labels"), F.lit(200).alias("width"), F.lit(200).alias("height"))
    return regions.merge_regions(rows)


SIM_TOKENS = r"list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'))"


@query(rf"""WITH t AS (SELECT doc_id, unnest({SIM_TOKENS}) AS w FROM documents), h AS (SELECT doc_id, CAST('0x' || substr(sha256(w), 1, 15) AS BIGINT) AS h FROM t),
    b AS (SELECT doc_id, i, sum(CASE WHEN (h >> i) & 1 = 1 THEN 1 ELSE -1 END) AS s FROM h, (SELECT unnest(range(0, 60)) AS i) GROUP BY 1, 2),
    c AS (SELECT doc_id, CAST(sum(CASE WHEN s > 0 THEN CAST(1 AS BIGINT) << i ELSE 0 END) AS BIGINT) AS code FROM b GROUP BY 1)
    SELECT a.doc_id AS a, b.doc_id AS b, CAST(bit_count(xor(a.code, b.code)) AS INT) AS distance FROM c a JOIN c b ON a.doc_id < b.doc_id AND bit_count(xor(a.code, b.code)) <= 3""")
def simhash_near_dups(spark, d):
    """Documents whose 60-bit SimHashes of their distinct words differ in three bits or
    fewer; documents without words have none."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)))
    codes = similar.simhash(table(spark, d, "documents"), "doc_id", words)
    return similar.hamming_pairs(codes, "doc_id", "code", 3)


@query("""WITH d AS (SELECT doc_id, lang, quality, toxic FROM documents JOIN labels USING (doc_id)) SELECT lang, count(*) AS n, sha256(string_agg(doc_id || chr(0) || quality || chr(0) || toxic, chr(10) ORDER BY doc_id)) AS sha256 FROM d GROUP BY 1""")
def split_manifests(spark, d):
    """A hash of each language's labelled documents in order; a split's rows go by key."""
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    line = F.concat_ws(ids.NUL, "doc_id", "quality", "toxic")
    lists = written(rows.select("lang", F.struct("doc_id", line.alias("l")).alias("x")), "lines").groupBy("lang").agg(F.array_sort(F.collect_list("x")).alias("x"))
    return lists.select("lang", F.size("x").cast("long").alias("n"), F.sha2(F.array_join(F.transform("x", lambda r: r["l"]), "\n"), 256).alias("sha256"))


