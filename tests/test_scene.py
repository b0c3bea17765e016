"""Scene operators on small planted cases."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from scenetable.operators import composite, contracts, fit, fuse, graph, match, neighbors, pixels, questions, visibility
from scenetable.sources import documents as docs
from scenetable.sources import ply
from scenetable.streaming import commands

CAM = "frame_id int, fx double, fy double, cx double, cy double, w int, h int, r array<double>, t array<double>"
EYE = [1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0]


def test_projection_and_its_inverse(spark):
    c, s = math.cos(0.3), math.sin(0.3)
    cams = spark.createDataFrame([(0, 80.0, 80.0, 48.0, 36.0, 96, 72, [c, 0.0, -s, 0.0, 1.0, 0.0, s, 0.0, c], [0.1, -0.2, 0.3])], CAM)
    pts = spark.createDataFrame([(i, random.Random(i).uniform(-1, 1), 0.1 * i - 0.5, 5.0) for i in range(9)], "point_id long, x double, y double, z double")
    seen = visibility.project_points(pts, cams)
    assert seen.count() == 9
    back = visibility.unproject_pixels(seen.select("frame_id", F.col("py").alias("y"), F.col("px").alias("x"), "depth", "point_id"), cams).join(pts.select("point_id", F.col("x").alias("a"), F.col("y").alias("b"), F.col("z").alias("c")), "point_id")
    assert all(abs(r.wx - r.a) < 0.05 and abs(r.wy - r.b) < 0.05 and abs(r.wz - r.c) < 0.05 for r in back.collect())


def test_visibility_votes_and_fuse(spark):
    rows = spark.createDataFrame([(0, "a", 1, 1, 2.0), (0, "b", 1, 1, 2.005), (0, "c", 1, 1, 2.5)], "frame_id int, obj string, px int, py int, depth double")
    assert {r.obj: r.visible for r in visibility.visible_pixels(rows).collect()} == {"a": True, "b": True, "c": False}
    donors = spark.createDataFrame([(1, 2.00, 240.0), (1, 2.01, 220.0), (1, 5.00, 255.0), (2, 1.0, 3.0)], "pixel long, depth double, v double")
    out = fuse.robust_fuse(donors, ["pixel"], ["v"], 0.05, 0.01).collect()
    assert [(r.pixel, r.support, round(r.depth, 6), r.v) for r in out] == [(1, 2, 2.005, 230.0)]


def test_grid_join_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    a, b = rng.uniform(-1, 1, (80, 3)), rng.uniform(-1, 1, (40, 3))
    pts = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(a)], "point_id long, x double, y double, z double")
    anchors = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(b)], "anchor_id long, x double, y double, z double")
    got = {r.point_id: r.anchor_id for r in neighbors.nearest_within(pts, anchors, 0.4).collect()}
    d = ((a[:, None] - b[None]) ** 2).sum(2)
    assert got == {i: int(d[i].argmin()) for i in range(80) if d[i].min() <= 0.16}


def test_morphology_and_components(spark):
    mask = {(y, x) for y in range(5) for x in range(7)} - {(2, 3)} | {(9, 9), (9, 10), (12, 9)}
    df = spark.createDataFrame([(0, y, x) for y, x in mask], "frame_id int, y int, x int")
    grown = {(y + a, x + b) for y, x in mask for a in (-1, 0, 1) for b in (-1, 0, 1)}
    assert {(r.y, r.x) for r in pixels.dilate(df, 1).collect()} == grown
    assert {(r.y, r.x) for r in pixels.erode(df, 1).collect()} == {p for p in mask if all((p[0] + a, p[1] + b) in mask for a in (-1, 0, 1) for b in (-1, 0, 1))}
    sizes = sorted(r["count"] for r in pixels.connected_components(df).groupBy("label").count().collect())
    assert sizes == [1, 2, 34]


def test_assignment_is_optimal(spark):
    rng = np.random.default_rng(5)
    edges, want = [], {}
    for f in range(12):
        w = rng.random((3, 4)).round(3)
        want[f] = match.brute_assign(w)
        edges += [(f, i, j, float(w[i, j])) for i in range(3) for j in range(4)]
    edges += [(99, 0, 0, 0.90), (99, 0, 1, 0.80), (99, 1, 0, 0.85), (99, 1, 1, 0.10)]
    got = match.assign(spark.createDataFrame(edges, "frame_id int, object_id int, detection_id int, weight double"))
    total = {r.frame_id: r.w for r in got.groupBy("frame_id").agg(F.sum("weight").alias("w")).collect()}
    assert all(abs(total[f] - w) < 1e-9 for f, w in want.items())
    assert {(r.object_id, r.detection_id) for r in got.where("frame_id = 99").collect()} == {(0, 1), (1, 0)}


def test_fits_recover_what_was_planted(spark):
    rng = np.random.default_rng(0)
    p = rng.normal(size=(30, 3))
    rows = [(0, *map(float, q), *map(float, 2.5 * np.array([[0, -1, 0], [1, 0, 0], [0, 0, 1]]) @ q + [3, -2, 1])) for q in p]
    r = fit.similarity_fit(spark.createDataFrame(rows, "k int, sx double, sy double, sz double, tx double, ty double, tz double"), ["k"]).first()
    assert abs(r.scale - 2.5) < 1e-7 and np.allclose(r.rotation, [0, -1, 0, 1, 0, 0, 0, 0, 1], atol=1e-7) and np.allclose(r.translation, [3, -2, 1], atol=1e-7)
    line = [(0, float(x), 1.3 * x + 7 + (90 if x % 10 == 0 else 0)) for x in range(60)]
    r = fit.huber_line(spark.createDataFrame(line, "k int, x double, y double"), ["k"]).first()
    assert abs(r.gain - 1.3) < 0.05 and abs(r.offset - 7) < 2
    plane = [(float(x), float(y), 2.0) for x in range(20) for y in range(20)] + [(float(i), 3.0, float(i) + 5) for i in range(60)]
    r = fit.plane_consensus(spark.createDataFrame(plane, "x double, y double, z double"), 0.01).first()
    assert r.inliers >= 400 and abs(abs(r.nz) - 1) < 1e-6


def test_descendants_of_long_chains(spark):
    chain = spark.range(1000).selectExpr("id AS parent", "id + 1 AS node")
    got = graph.descendants(chain)
    assert got.agg(F.count("*"), F.max("depth"), F.count_if(F.col("depth") != F.col("node") - F.col("ancestor"))).first() == (1000 * 1001 // 2, 1000, 0)
    ring = spark.range(500).selectExpr("id AS parent", "(id + 1) % 500 AS node")
    with pytest.raises(ValueError, match="cycle"):
        graph.descendants(ring)


def test_graphs_raise_on_cycles(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("d", "c")], "front string, back string")
    assert {r.node: r.layer for r in graph.topological_layers(e).collect()} == {"a": 0, "d": 0, "b": 1, "c": 2}
    loop = e.union(spark.createDataFrame([("c", "a")], e.schema))
    with pytest.raises(ValueError):
        graph.topological_layers(loop)
    with pytest.raises(ValueError):
        graph.descendants(loop.select(F.col("front").alias("parent"), F.col("back").alias("node")))
    found = graph.stale_closure(e.select(F.col("back").alias("node"), F.col("front").alias("needs")), spark.createDataFrame([("b",)], "node string"))
    assert {r.node for r in found.collect()} == {"b", "c"}


def test_composite_partitions_all_pixels(spark):
    src = spark.createDataFrame([(0, 0, x, 1.0) for x in range(5)], "frame_id int, y int, x int, v double")
    layers = spark.createDataFrame([(0, 0, 1, "near", 1.0, 8.0), (0, 0, 1, "far", 2.0, 9.0), (0, 0, 4, "far", 2.0, 9.0)], "frame_id int, y int, x int, layer string, depth double, v double")
    out = {r.x: (r.v, r.label) for r in composite.layer_composite(src, src.where("x < 3"), layers, src.where("x = 2")).collect()}
    assert out == {0: (None, "unresolved"), 1: (8.0, "layer:near"), 2: (1.0, "background"), 3: (1.0, "source"), 4: (1.0, "source")}


def test_questions(spark):
    objs = spark.createDataFrame([(f"plant0{i}", f"w:plant0{i}", [f"Plant {i}", "植物"], ["fern"], "plant", None, "green" if i == 1 else None, None, None) for i in (1, 2)] + [("bed01", "w:bed01", ["Bed"], None, "bed", "by the wall", None, None, None)], "object_id string, scoped_id string, names array<string>, aliases array<string>, category string, location string, appearance string, box_min array<double>, box_max array<double>")
    rel = spark.createDataFrame([("plant02", "near", "bed", 0.9, True), ("plant01", "near", "bed", 0.9, False)], "subject string, predicate string, target string, confidence double, verified boolean")
    asked = ["Where is the bed?", "Where is the fern?", "where is the second fern", "What does the bed look like?", "Where is the sofa?", "where is the first fern", "第二植物在哪里", "植物 02 在哪", "where is the fernfirst", "bed"]
    got = {r.question_id: (r.status, r.answer) for r in questions.answer(spark.createDataFrame(list(enumerate(asked)), "question_id long, text string"), objs, rel).collect()}
    assert got == {0: ("resolved", "by the wall"), 1: ("ambiguous", None), 2: ("resolved", "near bed"), 3: ("unavailable", None), 4: ("not_found", None), 5: ("unavailable", None), 6: ("resolved", "在bed附近"), 7: ("resolved", "在bed附近"), 8: ("ambiguous", None), 9: ("unsupported", None)}
    text = spark.createDataFrame([("Ｐｌａｎｔ １",), ("Bed-01",), ("植物?",)], "t string").select(questions.normalize_text(F.col("t")).alias("n"), questions.language(F.col("t")).alias("l")).collect()
    assert [(r.n, r.l) for r in text] == [("plant1", "en"), ("bed01", "en"), ("植物", "zh")]


def test_contracts(spark):
    r = spark.createDataFrame([(1, 1, "x", "a"), (1, 2, "a", "b"), (1, 3, "z", "c"), (1, 5, "c", "d")], "k int, round int, input_sha256 string, output_sha256 string")
    assert {(x["round"], x.issue) for x in contracts.lineage_breaks(r, ["k"], "round").collect()} == {(3, "digest_break"), (5, "gap")}
    ev = spark.createDataFrame([(1, "object", None, True, 5, 0.9)], "object_id long, target_kind string, same_instance_multi_frame_verified boolean, appearance_contract_verified boolean, calibrated_view_count int, view_baseline_score double")
    ev = ev.select("*", F.lit("Throw_Pillow").alias("category"), F.lit(0.4).alias("estimated_visible_surface_fraction"), *(F.lit(None).cast(t).alias(c) for c, t in (("source_front_rgba_available", "boolean"), ("deformable_prior_available", "boolean"), ("cad_retrieval_confidence", "double"), ("support_geometry_available", "boolean"), ("multi_depth_negative_space_verified", "boolean"))))
    assert [(x.backend, x.score) for x in contracts.route(ev).collect()] == [("hold_for_more_evidence", 100)]
    known = ev.withColumn("same_instance_multi_frame_verified", F.lit(True))
    alone = known.withColumns({"calibrated_view_count": F.lit(2), "source_front_rgba_available": F.lit(True)})
    assert [(x.backend, x.score) for x in contracts.route(alone).collect()] == [("deformable_category_prior", 88)]
    assert [(x.backend, x.score) for x in contracts.route(known.withColumn("calibrated_view_count", F.lit(2))).collect()] == [("hold_for_more_evidence", 1)]
    assert contracts.route(ev.withColumn("same_instance_multi_frame_verified", F.lit(True))).first().backend == "multi_view_reconstruction"


def test_ply_and_rle(spark, tmp_path):
    spark.dataSource.register(ply.PlyDataSource)
    head = "ply\nformat {}\nelement vertex 3\nproperty float x\nproperty uchar red\nend_header\n"
    (tmp_path / "a.ply").write_text(head.format("ascii 1.0") + "0.5 1\n1.5 2\n-2 255\n")
    (tmp_path / "b.ply").write_bytes(head.format("binary_little_endian 1.0").encode() + b"".join(struct.pack("<fB", x, r) for x, r in ((0.5, 1), (1.5, 2), (-2.0, 255))))
    for name in "ab":
        got = spark.read.format("ply").option("path", str(tmp_path / f"{name}.ply")).option("rows_per_partition", "2").load()
        assert sorted(map(tuple, got.collect())) == [(0, 0.5, 1), (1, 1.5, 2), (2, -2.0, 255)]
    masks = spark.createDataFrame([(0, 1, 4, [5, 3, 2, 1])], "frame_id int, mask_id int, h int, runs array<int>")
    assert {(r.y, r.x) for r in docs.expand_rle(masks).collect()} == {(1, 1), (2, 1), (3, 1), (2, 2)}


def test_streams_equal_batches(spark, tmp_path):
    rows = [(i, "u", "delete it" if i % 2 else "where is it", "t1", "s", f"2024-01-01 00:0{i}:00") for i in range(6)] + [(9, "u", "rename it", "t1", "old", "2024-01-01 00:07:00")]
    batch = spark.createDataFrame(rows, "request_id long, requester string, text string, target string, expected_sha string, at string").withColumn("submitted_at", F.to_timestamp("at"))
    batch.coalesce(1).write.parquet(str(tmp_path / "in"))
    manifest = spark.createDataFrame([("t1", "s")], "target string, manifest_sha string")
    done = commands.enqueue_once(commands.plan_commands(spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in")), manifest).where("status = 'queued'"))
    q = done.writeStream.format("memory").queryName("queued").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert [r.kind for r in spark.table("queued").collect()] == ["delete"]
    planned = commands.plan_commands(batch, manifest)
    assert [r.request_id for r in commands.enqueue_once(planned.where("status = 'queued'")).collect()] == [1]
    assert {r.status for r in planned.where("request_id = 9").collect()} == {"blocked_stale_manifest"}
    boxes = spark.createDataFrame([(1, s, b, 10.0 * s + 50 * b, 0.0, 20.0, 20.0) for s in range(3) for b in range(2)] + [(1, 3, 0, 900.0, 0.0, 20.0, 20.0)], "track long, seq long, box_id long, bx double, by double, bw double, bh double")
    assert [(r.seq, r.box_id, r.status) for r in commands.track_boxes(boxes).orderBy("seq").collect()] == [(0, 0, "tracked"), (1, 0, "tracked"), (2, 0, "tracked"), (3, None, "lost")]


def test_times_and_paths(spark):
    from scenetable.functions.text import rebase_path, zoned_timestamp

    rows = [("2024-01-02T03:04:05Z", "/a/b/c"), ("2024-01-02T05:04:05+02:00", "/a/b"), ("2024-01-02T03:04:05", "/a/bc"), ("2024-01-02", None), ("soon Z", ""), (None, "/x/a/b")]
    got = spark.createDataFrame(rows, "t string, p string").select(F.unix_seconds(zoned_timestamp(F.col("t"))).alias("t"), rebase_path(F.col("p"), "/a/b/", "/n").alias("p")).collect()
    assert [r.t for r in got] == [1704164645, 1704164645, None, None, None, None]
    assert [r.p for r in got] == ["/n/c", "/n", "/a/bc", None, "", "/x/a/b"]


def test_weighted_median_meets_the_half_exactly(spark, tmp_path):
    """0.01 + 0.06 is half of 0.14; as doubles it falls short."""
    from scenetable.plans import views

    rows = [(1, k, "N", 1, 1, float(q), 1.0, w) for k, (q, w) in enumerate([(1, 0.01), (2, 0.06), (3, 0.07)])]
    kinds = "l_orderkey long, l_linenumber int, l_returnflag string, l_suppkey long, l_partkey long, l_quantity double, l_extendedprice double, l_discount double"
    spark.createDataFrame(rows, kinds).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    assert [tuple(r) for r in views.weighted_median_price(spark, str(tmp_path)).collect()] == [(1, 2.0)]
