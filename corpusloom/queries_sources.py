"""Queries of sources, sinks and nested values."""

from __future__ import annotations

import io
import json
import tarfile

from pyspark.sql import functions as F

from corpusloom.functions import nested
from corpusloom.registry import query
from corpusloom.session import scratch, table
from corpusloom.sources import catalogs, jsonl
from corpusloom.sources.files import replacing


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def jsonl_written_and_read(spark, d):
    c, path = table(spark, d, "customer"), scratch(spark, "jsonl")
    jsonl.write_jsonl(c, path, split="c_mktsegment")
    return jsonl.read_jsonl(spark, path, c.schema)


@query("SELECT row_number() OVER (ORDER BY n_nationkey) AS line_no, n_nationkey, n_name FROM nation")
def jsonl_line_numbers(spark, d):
    path = scratch(spark, "lines")
    jsonl.write_jsonl(table(spark, d, "nation").orderBy("n_nationkey").coalesce(1), path)
    row = F.from_json("text", "n_nationkey int, n_name string")
    return jsonl.numbered_lines(spark, path, ".json.gz").withColumn("r", row).select("line_no", "r.n_nationkey", "r.n_name")


@query("SELECT r_regionkey, r_name FROM region")
def json_array_scan(spark, d):
    path = scratch(spark, "array") + "/regions.json"
    r = table(spark, d, "region")
    jsonl.write_pretty(path, [x.asDict() for x in r.collect()])  # five rows
    return jsonl.read_json_array(spark, path, r.schema)


@query("SELECT 'part/' || n_nationkey || '.json' AS member, n_name AS name FROM nation")
def bundle_members(spark, d):
    folder, content = scratch(spark, "bundles"), io.BytesIO()
    with tarfile.open(fileobj=content, mode="w:gz") as tar:
        for r in table(spark, d, "nation").collect():  # 25 rows
            for name, text in ((f"part/{r.n_nationkey}.json", "﻿" + json.dumps({"name": r.n_name})), (f"part/{r.n_nationkey}.txt", "no")):
                info = tarfile.TarInfo(name)
                info.size = len(text.encode())
                tar.addfile(info, io.BytesIO(text.encode()))
    with replacing(f"{folder}/all.tar.gz") as out:
        out.write(content.getvalue())
    return jsonl.read_bundles(spark, folder).select("member", F.get_json_object("text", "$.name").alias("name"))


@query("""SELECT o_orderkey AS id, o_orderpriority AS path, o_orderstatus AS note, 'urgent' AS source_group FROM orders WHERE regexp_matches(o_orderpriority, '^[12]-')
    UNION ALL SELECT c_custkey, c_mktsegment, NULL, 'building' FROM customer WHERE regexp_matches(c_mktsegment, 'BUILD')
    UNION ALL SELECT s_suppkey, s_name, NULL, 'supplier' FROM supplier WHERE regexp_matches(s_name, '[05]$')""")
def annotation_sources(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("path"), F.col("o_orderstatus").alias("note"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("path"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("path"))
    return catalogs.union_sources([("urgent", o, "^[12]-"), ("building", c, "BUILD"), ("supplier", s, "[05]$")], "path")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer WHERE c_custkey <> 0
    UNION ALL SELECT 'n' || n_nationkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def walked_labels(spark, d):
    j = table(spark, d, "customer").join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    inner = F.struct(F.concat(F.lit("n"), F.col("n_nationkey")).alias("id"), F.col("n_name").alias("name"))
    payload = F.to_json(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.array(F.struct(F.lit("").alias("id"), F.array(inner).alias("children"))).alias("items")))
    return j.select(F.explode(nested.labelled_rows(payload)).alias("r")).select("r.id", "r.name")


@query("""SELECT coalesce(nullif(CASE WHEN p_size > 25 THEN p_brand ELSE '' END, ''), p_type) AS key, arg_max(p_name, p_partkey) AS p_name, max(p_partkey) AS p_partkey FROM part GROUP BY 1""")
def label_catalog(spark, d):
    p = table(spark, d, "part")
    code = F.when(F.col("p_size") > 25, F.col("p_brand")).otherwise("")
    return catalogs.last_written(p, F.coalesce(F.nullif(code, F.lit("")), F.col("p_type")), "p_partkey", "p_name", "p_partkey")


@query("""SELECT row_number() OVER (ORDER BY n_nationkey) AS line_no, CASE WHEN n_nationkey % 5 > 0 THEN sha256(n_name) END AS sha256, CASE WHEN n_nationkey % 5 > 0 THEN 'dir/' || n_name END AS path FROM nation""")
def checksum_lines(spark, d):
    n, folder = table(spark, d, "nation"), scratch(spark, "sums")
    line = F.when(F.col("n_nationkey") % 5 > 0, F.concat(F.sha2("n_name", 256), F.lit("  dir/"), F.col("n_name"))).otherwise(F.concat(F.lit("broken "), F.col("n_name")))
    n.orderBy("n_nationkey").select(line.alias("value")).coalesce(1).write.text(folder)
    return jsonl.read_checksums(spark, folder)


@query("SELECT DISTINCT id FROM (SELECT l_partkey AS id FROM lineitem UNION ALL SELECT p_partkey FROM part UNION ALL SELECT s_suppkey FROM supplier)")
def discovered_ids(spark, d):
    return catalogs.discovered(table(spark, d, "lineitem").select("l_partkey"), table(spark, d, "part").select("p_partkey"), table(spark, d, "supplier").select("s_suppkey"))


@query("""SELECT c_custkey, (SELECT min(o_orderpriority || '/' || o_orderkey) FROM orders WHERE o_custkey = c_custkey) AS resolved FROM customer""")
def resolved_paths(spark, d):
    listing = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.concat_ws("/", "o_orderpriority", "o_orderkey").alias("path"))
    return catalogs.first_candidate(table(spark, d, "customer").select("c_custkey"), listing, "c_custkey", "path")


@query("SELECT p_partkey, CASE WHEN p_partkey % 7 > 0 THEN p_size * 100 END AS width, CASE WHEN p_partkey % 7 > 0 THEN p_size + 70000 END AS height FROM part")
def image_sizes(spark, d):
    number = lambda c: F.lpad(F.hex(c.cast("long")), 8, "0")
    head = F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), number(F.col("p_size") * 100), number(F.col("p_size") + 70000))
    width, height = catalogs.png_size(F.when(F.col("p_partkey") % 7 > 0, F.unhex(head)).otherwise(F.unhex(F.lit("FFD8FFE0"))))
    return table(spark, d, "part").select("p_partkey", width.alias("width"), height.alias("height"))


@query(r"""WITH u AS (SELECT page_id, string_split(url, '/') AS p, url FROM pages)
    SELECT page_id, CASE WHEN url LIKE '%.html' THEN 'html' WHEN url LIKE '%0' THEN 'round' ELSE 'other' END AS catalog, CASE WHEN len(p) > 1 THEN p[len(p) - 1] END AS folder FROM u""")
def source_identities(spark, d):
    catalog, folder = catalogs.source_identity(F.col("url"), [(".html", "html"), ("0", "round")], "other")
    return table(spark, d, "pages").select("page_id", catalog.alias("catalog"), folder.alias("folder"))


@query("SELECT s_suppkey, s_name, '[' || s_nationkey || ',' || s_suppkey || ']' AS pair, '' AS reviewer FROM supplier")
def csv_written_and_read(spark, d):
    s, path = table(spark, d, "supplier"), scratch(spark, "csv")
    jsonl.write_csv(s.select("s_suppkey", "s_name", F.array(F.col("s_nationkey").cast("long"), "s_suppkey").alias("pair")), path, ("reviewer",))
    read = spark.read.schema("s_suppkey long, s_name string, pair string, reviewer string").csv(path, header=True, escape='"')
    return read.withColumn("reviewer", F.coalesce("reviewer", F.lit("")))


@query("""WITH c AS (SELECT o_orderpriority AS p, count(*) AS n FROM orders GROUP BY 1)
    SELECT 'markdown' AS kind, '| priority | n |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || p || ' | ' || n || ' |', chr(10) ORDER BY p) AS body FROM c
    UNION ALL SELECT 'latex', '\\begin{tabular}{ll}' || chr(10) || 'priority & n \\' || chr(10) || '\\hline' || chr(10) || string_agg(p || ' & ' || n || ' \\', chr(10) ORDER BY p) || chr(10) || '\\end{tabular}' FROM c""".replace("\\\\b", "\\b").replace("\\\\h", "\\h").replace("\\\\e", "\\e").replace("n \\'", "n \\\\'").replace("' \\'", "' \\\\'"))
def printed_tables(spark, d):
    counts = table(spark, d, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    rows = [tuple(r) for r in counts.orderBy("o_orderpriority").collect()]  # a few groups
    head = ("priority", "n")
    return spark.createDataFrame([("markdown", jsonl.markdown(rows, head)), ("latex", jsonl.latex(rows, head))], "kind string, body string")


@query("SELECT n_nationkey, sha256(n_name || chr(10)) AS sha256 FROM nation")
def hashed_files(spark, d):
    folder = scratch(spark, "hashed")
    table(spark, d, "nation").withColumn("key", F.col("n_nationkey")).select("key", "n_name").repartition("key").write.partitionBy("key").text(folder)
    found = jsonl.file_hashes(spark, folder).where(F.col("path").endswith(".txt"))
    return found.select(F.regexp_extract("path", r"key=(\d+)", 1).cast("int").alias("n_nationkey"), "sha256")


@query("""SELECT event_id, '{"a":{"k":' || json_extract_string(props, '$.k') || ',"z":null},"b":[' || user_id || ',"' || event_type || '"]}' AS body FROM events""")
def nested_canonical_json(spark, d):
    text = F.concat(F.lit('{"b": ['), F.col("user_id"), F.lit(', "'), F.col("event_type"), F.lit('"], "a": {"z": null, "k": '), F.get_json_object("props", "$.k"), F.lit("}}"))
    return table(spark, d, "events").select("event_id", nested.canonical_text(text).alias("body"))


@query("""SELECT event_id, CASE WHEN user_id = CAST(json_extract(props, '$.k') AS INT) THEN ['$.k', '$.u[0].id'] ELSE ['$.k'] END AS paths FROM events""")
def image_json_paths(spark, d):
    k = F.get_json_object("props", "$.k")
    text = F.concat(F.lit('{"k": '), k, F.lit(', "u": [{"id": '), F.col("user_id"), F.lit("}]}"))
    return table(spark, d, "events").select("event_id", nested.value_paths(text, k).alias("paths"))


@query("""SELECT doc_id, list_sort(list_filter([CASE WHEN quality = 1 THEN 'flags.quality' END, CASE WHEN toxic = 1 THEN 'flags.toxic' END, 'lang:' || lang, 'tags:' || source], lambda x: x IS NOT NULL)) AS paths
    FROM documents JOIN labels USING (doc_id)""")
def positive_label_paths(spark, d):
    j = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    flags = F.struct((F.col("quality") == 1).alias("quality"), (F.col("toxic") == 1).alias("toxic"))
    return j.select("doc_id", nested.positive_paths(F.to_json(F.struct(flags.alias("flags"), F.col("lang").alias("lang"), F.array("source").alias("tags")))).alias("paths"))


@query("""WITH r AS (SELECT l_orderkey, min(l_linenumber * 1000000 + l_partkey) AS f, list_sort(list(DISTINCT l_returnflag)) AS tags, count(DISTINCT l_linestatus) > 1 AS conflict, arg_min(l_linestatus, l_linenumber * 100000000000 + l_partkey * 100000 + l_suppkey) AS status FROM lineitem GROUP BY 1)
    SELECT l_orderkey, '{"s":{"status":"' || status || '"},"tags":["' || array_to_string(tags, '","') || '"]}' AS value, CASE WHEN conflict THEN ['s.status'] ELSE [] END AS conflicts FROM r""")
def merged_structs(spark, d):
    row = F.struct(F.struct(F.col("l_linestatus").alias("status")).alias("s"), F.array("l_returnflag").alias("tags"))
    li = table(spark, d, "lineitem").select("l_orderkey", F.struct((F.col("l_linenumber") * 100000000000 + F.col("l_partkey") * 100000 + F.col("l_suppkey")).alias("o"), F.to_json(row).alias("j")).alias("e"))
    texts = li.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list("e")), lambda e: e["j"]).alias("t"))
    return texts.select("l_orderkey", nested.merged_texts("t").alias("m")).select("l_orderkey", "m.value", "m.conflicts")
