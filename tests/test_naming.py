"""Names in questions, relations from either side, peeling order, coverage; depth arrays and manifests."""

import json

import numpy as np
import pytest

from scenetable.operators import contracts, graph, naming
from scenetable.sources import arrays, manifest


def test_names_are_whole_words(spark):
    terms = [("bed01", "bed01", "id"), ("bed01", "Bed", "name"), ("bed01", "床", "name"), ("plant01", "plant", "alias"), ("plant02", "plant", "alias"), ("table01", "coffee table", "name"), ("table01", "furniture", "category"), ("bed01", "Furniture", "category"), ("x", "?!", "name")]
    asked = [
        (1, "Where is the BED?", None), (2, "the bedroom", None), (3, "我的床在哪", None), (4, "that plant", "bed01"), (5, "coffee-table!", None), (6, "coffee on a table", None), (7, "furniture", None), (8, "where is it", "table01"), (9, "where is it", None),
        (10, "where is it", "gone"), (11, "the pillow on the bed", None), (12, "枕头呢", None), (13, " ?! ", None), (14, "bed01 plant", None), (15, None, "bed01"),
    ]
    out = naming.resolve_named(spark.createDataFrame(asked, "question_id int, text string, selected_id string"), spark.createDataFrame(terms, "object_id string, term string, kind string"), spark.createDataFrame([("Pillow",), ("枕头",)], "term string"))
    got = {r.question_id: (r.status, r.object_id or r.term or ",".join(r.candidates)) for r in out.collect()}
    none = ("not-found", "")
    assert got == {
        1: ("resolved", "bed01"), 2: none, 3: ("resolved", "bed01"), 4: ("ambiguous", "plant01,plant02"), 5: ("resolved", "table01"), 6: none, 7: ("ambiguous", "bed01,table01"), 8: ("resolved", "table01"), 9: none,
        10: none, 11: ("missing-instance", "pillow"), 12: ("missing-instance", "枕头"), 13: ("empty", ""), 14: ("resolved", "bed01"), 15: ("empty", ""),
    }


def test_relations_are_told_from_both_sides(spark):
    objects = spark.createDataFrame([("a", "Lamp"), ("b", "Desk"), ("c", "Bin")], "object_id string, name string")
    rows = [(0, "a", "OnTopOf", "b", None, None, 0.4, True), (1, "a", "OnTopOf", "b", None, "the desk", None, True), (2, "b", "Near", "c", None, None, 0.9, False), (3, "c", "FacesTo", "zz", None, None, 0.5, True)]
    out = naming.told_relations(objects, spark.createDataFrame(rows, "ord int, subject string, predicate string, object string, target_zh string, target_en string, confidence double, verified boolean"))
    assert {r.object_id: (r.zh, r.en) for r in out.collect()} == {"a": ("位于其上方 the desk", "on top of the desk"), "b": ("位于其下方 Lamp", "under Lamp"), "c": ("FacesTo zz", "FacesTo zz")}


def test_peeling_order(spark):
    nodes = spark.createDataFrame([("a", 1), ("b", 9), ("c", 5), ("d", 9)], "node string, priority int")
    edge = "front string, back string, confidence double, verified boolean"
    strong = [("a", "c", 0.9, True), ("b", "c", 0.8, True), ("c", "d", 0.5, True), ("d", "a", 0.4, False), ("zz", "a", 0.9, False)]
    got = {r.node: (r.layer, r.place) for r in graph.peel_layers(nodes, spark.createDataFrame(strong, edge)).collect()}
    assert got == {"b": (0, 1), "a": (0, 2), "c": (1, 1), "d": (2, 1)}
    with pytest.raises(ValueError, match="b->d"):
        graph.peel_layers(nodes, spark.createDataFrame([*strong, ("b", "d", 0.9, False)], edge))
    with pytest.raises(ValueError, match="cycle"):
        graph.peel_layers(nodes, spark.createDataFrame([*strong, ("d", "a", 0.9, True)], edge))


def test_coverage_by_the_rule(spark):
    observed = spark.createDataFrame([("bed", 1), ("chair", 3), ("lamp", 2), ("rug", 2), ("desk", 1)], "category string, n int")
    assets = [("chair", "c1", "group", 2, "completed"), ("lamp", "l1", "group", 2, "completed"), ("rug", "r1", "individual", 1, "completed"), ("rug", "r2", "individual", 1, "segmented"), ("desk", "d1", "individual", 1, "verified"), ("desk", "d2", "group", 1, "candidate"), ("sofa", "s1", "individual", 1, "candidate")]
    out = contracts.asset_coverage(observed, spark.createDataFrame(assets, "category string, asset_id string, scope string, represented int, state string"))
    assert {r.category: (r.status, r.next_action) for r in out.collect()} == {"bed": ("missing", "segment"), "chair": ("undercovered", "segment"), "lamp": ("undercovered", "instance_split"), "rug": ("covered", "complete"), "desk": ("covered", "none"), "sofa": ("unassessed", "none")}


def test_depth_arrays_by_ranges_and_frames(spark, tmp_path):
    rng = np.random.default_rng(0)
    held = {"000001": rng.random((7, 5)).astype(np.float32), "000002": rng.random((3, 4)), "000003": np.array([[1.0, 0.0], [np.nan, -2.0]])}
    np.save(tmp_path / "000001.npy", held["000001"])
    np.savez(tmp_path / "000002.npz", depth=held["000002"])
    np.save(tmp_path / "000003.npy", held["000003"])
    spark.dataSource.register(arrays.DepthArrays)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    read = spark.read.format("depth_arrays").option("path", str(tmp_path)).option("rows_per_partition", "2").load()
    got = {(r.frame_id, r.y, r.x): r.depth for r in read.collect()}
    want = {(f, y, x): (float(v) if np.isfinite(v) and v > 0 else None) for f, a in held.items() for (y, x), v in np.ndenumerate(a)}
    assert got == want and read.rdd.getNumPartitions() == 7
    some = read.where("frame_id IN ('000001', '000003') AND y = 1")
    assert {(r.frame_id, r.x) for r in some.collect()} == {("000001", x) for x in range(5)} | {("000003", 0), ("000003", 1)} and some.rdd.getNumPartitions() == 5
    np.savez(tmp_path / "000004.npz", depth=held["000002"], mask=held["000002"])
    assert read.where("frame_id = '000001'").count() == 35  # other files are not opened
    with pytest.raises(Exception, match="exactly one array"):
        spark.read.format("depth_arrays").option("path", str(tmp_path)).load().count()


def test_manifests(spark, tmp_path):
    world = {
        "world_id": "room_4", "unknown": 1,
        "objects": [
            {"id": "bed01", "name": {"zh": "床", "en": "Bed"}, "category": "bed", "bbox_scene": {"frame_id": "scene", "min": [0, 0, 0], "max": [1, 2, 3]}, "quality_gates": [{"gate": "mesh", "status": "passed", "report_sha256": "0" * 64, "metrics": {"faces": "10"}}]},
            {"id": "plant02", "name": {"en": "Plant"}, "aliases": ["plant"], "relations": [{"predicate": "OnTopOf", "target_object_id": "bed01", "confidence": 0.9, "verified": True}, {"predicate": "next-to it", "target_object_id": "nobody"}]},
        ],
    }
    (tmp_path / "a.json").write_text(json.dumps(world))
    t = manifest.read_manifests(spark, str(tmp_path))
    assert [(r.object_id, r.scoped_id, r.aliases, r.bbox_max) for r in t["objects"].orderBy("ord").collect()] == [("bed01", "room_4:bed01", [], [1.0, 2.0, 3.0]), ("plant02", "room_4:plant02", ["plant"], None)]
    assert [(r.subject, r.predicate, r.confidence, r.verified) for r in t["relations"].orderBy("ord").collect()] == [("plant02", "on_top_of", 0.9, True), ("plant02", "next_to_it", None, False)]
    assert t["gates"].first().metrics == {"faces": "10"} and [(r.object_id, r.issue) for r in t["issues"].collect()] == [("plant02", "relation leads nowhere")]
