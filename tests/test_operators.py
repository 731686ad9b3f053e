"""Small fixtures with known results."""
from pyspark.sql import functions as F

from corpusloom.functions import geometry, text
from corpusloom.operators import dedup, relate, sampling, similar, stats
from corpusloom.operators.graph import connected_components
from corpusloom.plans import facts


def test_tristate(spark):
    rows = [("a", None), ("b", True), ("b", None), ("c", True), ("c", False), ("c", True)]
    out = {r.k: (r.v, r.conflicting_v) for r in dedup.merge_tristate(spark.createDataFrame(rows, "k string, v boolean"), ["k"], ["v"]).collect()}
    assert out == {"a": (None, False), "b": (True, False), "c": (None, True)}


def test_components(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("d", "e"), ("f", "f"), (None, "x")], "a string, b string")
    assert {r.node: r.component for r in connected_components(e).collect()} == dict(a="a", b="a", c="a", d="d", e="d", f="f")


def test_components_of_a_path_and_of_nothing(spark):
    path = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.component for r in connected_components(path).collect()} == {0}
    assert connected_components(path.limit(0)).count() == 0


def test_ring(spark):
    square = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    rings = [square[i:] + square[:i] for i in range(4)] + [square[::-1], square + square[:1]]
    df = spark.createDataFrame([([dict(x=x, y=y) for x, y in r],) for r in rings], "p array<struct<x:double,y:double>>")
    assert df.select(geometry.ring(F.col("p")).alias("r")).distinct().count() == 1
    assert {r.a for r in df.limit(4).select(geometry.area(F.col("p")).alias("a")).collect()} == {1.0}


def test_hamming_against_all_pairs(spark):
    codes = [0, 1, 3, 7, 15, 31, -1, -2, 1 << 40, (1 << 63) - 1]
    df = spark.createDataFrame(list(enumerate(codes)), "k long, c long")
    got = {(r.a, r.b): r.distance for r in similar.hamming_pairs(df, "k", "c", 4).collect()}
    far = {(i, j): bin((a ^ b) & (2**64 - 1)).count("1") for i, a in enumerate(codes) for j, b in enumerate(codes) if i < j}
    assert got == {k: v for k, v in far.items() if v <= 4}


def test_greedy_is_not_transitive(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 0)], "k long, g long")
    pairs = spark.createDataFrame([(0, 1, 2), (0, 2, 3)], "g long, a long, b long")
    assert {r.k for r in similar.greedy_keep(df, pairs, "k", "g").where("kept").collect()} == {1, 3}


def test_keep_first_with_null_keys(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 3), ("a", 4)], "k string, i long")
    assert {r.i for r in dedup.keep_first(df, ["k"], ["i"]).collect()} == {1, 3}


def test_changes_a_b_a(spark):
    df = spark.createDataFrame([("k", 1, "A"), ("k", 2, "B"), ("k", 3, "A")], "k string, i long, v string")
    assert dedup.changes(df, ["k"], ["i"], "v").count() == 2
    assert dedup.contradictions(df, ["k"], "v").count() == 1


def test_seal(spark):
    df = facts.sealed(spark.createDataFrame([(1, 'x"y'), (2, None)], "i long, t string"), ["i", "t"])
    assert facts.tampered(df, ["i", "t"]).count() == 0
    assert facts.tampered(df.withColumn("t", F.lit("z")), ["i", "t"]).count() == 2


def test_text(spark):
    df = spark.createDataFrame([("ﬁn  A", ["a", "b", "a", "c"])], "t string, l array<string>")
    r = df.select(text.normalize(text.nfkc(F.col("t")), "spaces").alias("n"), text.joined(F.col("l")).alias("j"), text.sentence(F.lit("wHo..")).alias("s")).first()
    assert tuple(r) == ("fin a", "a, b and c", "WHo.")


def test_group_assignment():
    out = sampling.assign_groups({"a": 70, "b": 15, "c": 15}, {"train": 0.7, "val": 0.15, "test": 0.15})
    assert out["a"] == "train" and {out["b"], out["c"]} == {"val", "test"}


def test_json_object(spark):
    said = ['so {x} {"b": 1, "a": [2]} then', 'first {"n": 0}\n```json\n{"n": 1}\n```', "none {", "", None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(said)], "i int, s string")
    out = {r.i: r.o for r in df.select("i", text.json_object("s").alias("o")).collect()}
    assert out == {0: '{"a":[2],"b":1}', 1: '{"n":1}', 2: None, 3: None, 4: None}


def test_mentions_are_whole_words(spark):
    df = spark.createDataFrame([("Lao la, élan",), ("élla",), (None,)], "t string")
    assert [r.m for r in df.select(relate.mentions(F.col("t"), ["la", "lan"]).alias("m")).collect()] == [["la"], [], []]


def test_conserved(spark):
    ids = lambda *xs: spark.createDataFrame([(x,) for x in xs], "k int")
    out = relate.conserved(ids(1, 2, 3, None), {"a": ids(1, 2), "b": ids(2, 4)}, "k")
    assert {r.k: r.missing for r in out.collect()} == {2: -1, 3: 1, 4: -1, None: 1}


def test_counted_examples(spark):
    df = spark.range(500).select(F.lit("x").alias("code"), "id").unionByName(spark.range(1).select(F.lit("y").alias("code"), "id"))
    out = {r.code: (r.n, r.examples) for r in stats.counted_examples(df, "code", "id", 3).collect()}
    assert out == {"x": (500, [0, 1, 2]), "y": (1, [0])}


def test_ranks_tie_by_first_position(spark):
    df = spark.createDataFrame([("b", 0), ("a", 1), ("a", 2), ("b", 3), ("c", 4)], "v string, p int")
    assert [r.v for r in stats.first_seen_order(df, "v", "p", 2).orderBy("rank").collect()] == ["b", "a"]


def test_size_bin(spark):
    df = spark.createDataFrame([(0.0099,), (0.01,), (0.1,), (None,)], "f double")
    assert [r.b for r in df.select(geometry.size_bin(F.col("f")).alias("b")).collect()] == ["small", "medium", "large", None]
