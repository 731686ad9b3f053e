"""Small fixtures of regions, polygons, plans, runs and selections with known results."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import geometry, nested, raster, text
from corpusloom.operators import dedup, regions, relate, sampling, shape, similar
from corpusloom.plans import audit, blueprints, export, facts, records
from corpusloom.sources import jsonl
from corpusloom.streaming import runs

SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]


@pytest.mark.parametrize("points,size,status,flag", [
    ([(0, 0), (math.nan, 1), (1, 1)], (9, 9), "review_required", "non_finite_or_malformed_point"),
    ([(0, 0), (1, 1), (0, 0)], (9, 9), "review_required", "fewer_than_three_unique_vertices"),
    ([(0, 0), (1, 1), (2, 2)], (9, 9), "review_required", "zero_area_polygon"),
    ([(0, 0), (4, 4), (4, 0), (0, 3)], (9, 9), "review_required", "self_intersection_or_invalid_topology"),
    (SQUARE, (None, 9), "review_required", "missing_image_dimensions"),
    ([(x + 5.6, y) for x, y in SQUARE], (9, 9), "review_required", "polygon_out_of_bounds"),
    ([(x * 100 + 0.3, y * 100) for x, y in SQUARE], (400, 400), "accepted", "clipped_subpixel_boundary_overflow"),
    ([(x + 5.4, y) for x, y in SQUARE], (9, 9), "review_required", "boundary_clip_area_change_too_large"),
    ([*SQUARE, SQUARE[0]], (9, 9), "accepted", "removed_duplicate_closing_vertex"),
    ([SQUARE[0], *SQUARE], (9, 9), "accepted", "removed_consecutive_duplicate_vertex"),
])
def test_training_polygon(points, size, status, flag):
    got = raster.training_polygon(points, *size)
    assert got[1] == status and flag in got[2] and (got[0] is None) == (status != "accepted")


def test_masks_and_hashes():
    assert raster.mask_iou(SQUARE, [(x + 2, y) for x, y in SQUARE], 50, 50) == pytest.approx(8 / 24)
    assert raster.mask_iou(SQUARE, [(x + 20, y) for x, y in SQUARE], 50, 50) == 0
    ramp = np.tile(np.arange(64.0), (64, 1))
    assert raster.perceptual_hashes(ramp)[1] == 0 and raster.perceptual_hashes(ramp[:, ::-1])[1] == 2**64 - 1
    rng = np.random.default_rng(1)
    grey = rng.random((64, 64))
    a, b = raster.perceptual_hashes(grey), raster.perceptual_hashes(grey * 2 + 1)
    assert bin(a[0] ^ b[0]).count("1") <= 1 and a[1] == b[1]
    x = raster._resized(grey, 32, 32)
    assert np.allclose(x, grey.reshape(32, 2, 32, 2).mean((1, 3)))


def test_ring_hash(spark):
    rows = []
    for i in range(4):
        turned = SQUARE[i:] + SQUARE[:i]
        rows += [(turned,), (turned[::-1],), ([*turned, turned[0]],), ([turned[0], *turned],), ([(x + 1e-8, y - 1e-9) for x, y in turned],)]
    df = spark.createDataFrame(rows, "polygon array<struct<x:double,y:double>>")
    assert df.select(geometry.ring_hash(F.col("polygon")).alias("h")).distinct().count() == 1


def test_region_merge(spark):
    def square(side, at=0.0):
        return [[at, 0.0], [at + side, 0.0], [at + side, 100.0], [at, 100.0]]

    rows = [(1, "a", square(100.0), '{"t":["x"],"s":null}'), (1, "b", square(99.0), '{"t":["y"],"s":"k"}'), (2, "a", square(100.0), '{"s":"k"}'), (2, "b", square(99.0), '{"s":"l"}'), (3, "a", square(100.0), "{}"), (3, "b", square(85.0), "{}"), (4, "a", square(100.0), "{}")]
    df = spark.createDataFrame([(*r, 200, 200) for r in rows], "image_id long, region_id string, polygon array<array<double>>, labels string, width int, height int")
    got = {(r.image_id, r.region_id): (r.root, r.labels, r.review) for r in regions.merge_regions(df).collect()}
    assert got[1, "a"] == got[1, "b"] == ("a", '{"s":"k","t":["x","y"]}', [])
    assert got[2, "b"] == ("b", '{"s":"l"}', ["label_conflict_prevents_auto_merge"]) and got[2, "a"][0] == "a"
    assert got[3, "b"] == ("b", "{}", ["C_partial_overlap_0.80_to_0.98"]) and got[4, "a"] == ("a", "{}", [])


def test_struct_merge():
    assert nested.merged({"a": None, "l": ["x"]}, {"a": True, "l": ["y", "x"], "n": {"k": 1}}) == ({"a": True, "l": ["x", "y"], "n": {"k": 1}}, [])
    assert nested.merged({"n": {"k": 1}}, {"n": {"k": 2}}) == ({"n": {"k": 1}}, ["n.k"])
    assert nested.merged({"k": True}, {"k": 1})[1] == ["k"]  # one is not true
    assert list(nested._positive({"a": True, "b": False, "c": None, "d": "x", "e": {"f": ["g"]}})) == ["a", "d:x", "e.f:g"]


def test_quotas():
    shares = {"train": 0.7, "validation": 0.15, "test": 0.15}
    got = sampling.capped_quotas(shares, {"train": 100, "validation": 1, "test": 100}, 10)
    assert sum(got.values()) == 10 and got["validation"] == 1
    assert sampling.capped_quotas(shares, {"train": 2}, 10) == {"train": 2, "validation": 0, "test": 0}
    assert sum(sampling.capped_quotas(shares, dict.fromkeys(shares, 99), 100).values()) == 100


def test_hash_ranked_null_group(spark):
    df = spark.createDataFrame([(None if i % 2 else "a", i) for i in range(40)], "g string, k long")
    got = sampling.hash_ranked(df, "g", "k", "s", F.lit(0.5)).collect()
    assert sum(r.g is None for r in got) == sum(r.g == "a" for r in got) == 10
    want = sorted((i for i in range(0, 40, 2)), key=lambda i: __import__("hashlib").sha256(f"s\0a\0{i}".encode()).hexdigest())[:10]
    assert {r.k for r in got if r.g == "a"} == set(want)


def test_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 4)], "k string, id long")
    assert sorted(r.id for r in dedup.dropped(df, ["k"], "id").collect()) == [2, 4]
    assert relate.coverage(df, df.where("id < 3"), "k").collect()[0].only_in == "left"
    assert relate.coverage(df, df, "k").count() == 0


def test_required_join(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k long"), spark.createDataFrame([(1, "x")], "k long, v string")
    assert relate.required_join(a.where("k = 1"), b, "k").count() == 1
    with pytest.raises(ValueError, match="2"):
        relate.required_join(a, b, "k")


def test_text(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(text.casefolded(F.lit(" Straße  A"))) == "strasse a"
    assert one(text.clean_question(F.lit("<image>\n Is it? <choices>: [A: x]"))) == "Is it?"
    assert one(text.boxes(F.lit("<answer> x <location> [[1, 2, 3, 4]]"))) == [[1, 2, 3, 4]] and one(text.boxes(F.lit("<answer> x"))) is None
    assert one(text.leaks_answer(F.lit("Is it RED, then?"), F.lit("red."))) and not one(text.leaks_answer(F.lit("Is it?"), F.lit(".")))
    with pytest.raises(Exception, match="no template"):
        one(text.templated(F.lit("x"), {"a": "b"}, {}))
    assert jsonl.latex([("a_b", 1)], ("k", "n")).splitlines()[3] == r"a\_b & 1 \\"


def test_simhash(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["c", "b", "a"]), (3, ["z"]), (4, [])], "k long, w array<string>")
    got = {r.k: r.code for r in similar.simhash(df, "k", F.col("w")).collect()}
    assert set(got) == {1, 2, 3}
    import hashlib

    hashes = [int(hashlib.sha256(w.encode()).hexdigest()[:15], 16) for w in "abc"]
    assert got[1] == got[2] == sum(1 << i for i in range(60) if sum(2 * (h >> i & 1) - 1 for h in hashes) > 0)


def test_end_to_end(spark):
    """One image whose region has a finding with two details."""
    region = spark.createDataFrame([("i", "r1", True, "blood", "clotted", [1, 2, 30, 40])], "image_id string, region_id string, secretion boolean, kind string, consistency string, box array<int>")
    quoted = lambda c: F.concat(F.lit('"'), F.col(c), F.lit('"'))
    lit, present = F.lit, F.lit("present")
    specs = [facts.Spec("observation", lit("secretion"), lit("secretion"), F.col("secretion").cast("string"), lit("secretion"), present), facts.Spec("attribute", lit("secretion_type"), lit("type"), quoted("kind"), F.col("kind"), present, 0), facts.Spec("attribute", lit("secretion_consistency"), lit("consistency"), quoted("consistency"), F.col("consistency"), present, 0)]
    f = facts.build_facts(region, "image_id", "region_id", specs, F.array().cast("array<string>"), F.lit(True))
    assert f.count() == 3 and facts.unsupported_attributes(f).count() == 0
    plans = blueprints.merge_attributes(blueprints.build_plans(f), f, "v")
    kinds = sorted(r.template for r in plans.collect())
    assert kinds == ["abnormality_open_01", "secretion_consistency_open_01", "secretion_type_open_01"]
    assert blueprints.collisions(plans).count() == 0 and audit.semantic_failures(plans, f).where("size(failures) > 0").count() == 0
    boxes = records.evidence_boxes(plans, region)
    told = records.conversations(F.concat(F.lit("Say: "), "question"), F.col("options"), F.col("answer"), F.col("reason"), F.lit("seen"), F.col("boxes"))
    clean = plans.join(boxes, "qa_id").select("qa_id", F.lit("i.png").alias("image"), told.alias("conversations"), F.col("intent").alias("question_type"), F.lit("open").alias("q_type"), F.col("boxes").alias("evidence_boxes_xyxy"), F.col("structured").alias("answer_structured"))
    out = records.checked(clean).collect()
    assert len(out) == 3 and all(r.conversations[1].value.endswith("<location> [[1, 2, 30, 40]]") for r in out)
    with pytest.raises(ValueError, match="columns"):
        records.checked(clean.drop("image"))
    with pytest.raises(ValueError, match="fail"):
        records.checked(clean.withColumn("q_type", F.lit("odd")))
    broken = plans.withColumn("answer", F.lit("Something else."))
    kinds = {r.kind for r in audit.plan_audit(broken, blueprints.build_plans(f), f).collect()}
    assert "protected_field_seal_mismatch" in kinds and "answer_text_contradicts_fact_surface" in kinds


def test_runs(spark):
    run = runs.Run().to("RUNNING").to("WAITING_FOR_API", tries=2)
    with pytest.raises(ValueError):
        run.to("COMPLETE")
    assert [r.seq for r in run.log(spark).orderBy("seq").collect()] == [1, 2, 3]
    df = spark.createDataFrame([(["HTTP Error 503", "timed out"],), (["HTTP Error 503", "bad json"],), ([],), (["bad json", *["timed out"] * 9],)], "e array<string>")
    assert [r[0] for r in df.select(runs.infrastructure(F.col("e"))).collect()] == [True, False, False, True]
    kept = runs.Checkpoints(spark, "k")
    asked = spark.createDataFrame([(1,), (2,)], "k long")
    assert kept.results() is None and kept.pending(asked).count() == 2
    kept.add(spark.createDataFrame([(1, "a")], "k long, v string"))
    kept.add(spark.createDataFrame([(1, "b")], "k long, v string"))
    assert [r.v for r in kept.results().collect()] == ["b"] and [r.k for r in kept.pending(asked).collect()] == [2]


def test_roll_up(spark):
    rows = [(1, True, True), (2, None, True), (3, True, False), (4, None, None), (5, False, True)]
    df = spark.createDataFrame(rows, "k long, e boolean, p boolean")
    got = {r.k: (r.normal, r.conflicting_normal) for r in shape.rolled_up(df, "k", F.col("e"), F.col("p")).collect()}
    assert got == {1: (None, True), 2: (False, False), 3: (True, False), 4: (None, False), 5: (False, False)}


def test_coco():
    doc = export.coco_document([{"id": 1}], [{"image_id": 1, "category": "b", "segmentation": [0, 0, 1, 0, 1, 1], "bbox": [0, 0, 1, 1], "area": 0.5}], ["a", "b"])
    assert doc["annotations"][0]["category_id"] == 2 and [c["id"] for c in doc["categories"]] == [1, 2]
