"""Meshes: PLY faces, audits, carving, compaction and rasters against plain loops."""

import struct

import numpy as np
import pytest

from scenetable.functions.register import register
from scenetable.operators import mesh
from scenetable.sources import ply

VERTEX = "mesh_id int, vid long, x double, y double, z double"
FACE = "mesh_id int, fid long, v0 long, v1 long, v2 long"


def write_ply(path, kind, points, faces, count="uchar", index="uint"):
    head = f"ply\nformat {kind} 1.0\nelement vertex {len(points)}\nproperty float x\nproperty float y\nproperty double z\nelement face {len(faces)}\nproperty list {count} {index} vertex_indices\nend_header\n".encode()
    if kind == "ascii":
        body = "".join(f"{' '.join(map(str, p))}\n" for p in points) + "".join(f"{len(f)} {' '.join(map(str, f))}\n" for f in faces)
        path.write_bytes(head + body.encode())
        return
    order = "<" if "little" in kind else ">"
    body = b"".join(struct.pack(f"{order}ffd", *p) for p in points) + b"".join(struct.pack(f"{order}{ply.SCALARS[count][0]}{len(f)}{ply.SCALARS[index][0]}", len(f), *f) for f in faces)
    path.write_bytes(head + body)


@pytest.mark.parametrize("kind", ["ascii", "binary_little_endian", "binary_big_endian"])
def test_faces_of_a_file_are_carved_and_numbered_anew(spark, tmp_path, kind):
    points = [(float(i % 5), float(i // 5), 0.5) for i in range(25)]
    faces = [(i, i + 1, i + 5) for i in range(19) if i % 5 < 4]
    write_ply(tmp_path / "m.ply", kind, points, faces)
    spark.dataSource.register(ply.PlyDataSource)
    path = str(tmp_path / "m.ply")
    found = spark.read.format("ply").option("path", path).option("element", "face").option("rows_per_partition", "3").load()
    assert [tuple(r)[1:] for r in found.orderBy("fid").collect()] == faces
    vertices = spark.read.format("ply").option("path", path).load().selectExpr("1 AS mesh_id", "point_id AS vid", "x", "y", "z")
    box = spark.createDataFrame([("bed", 0, -1.0, 1.5, -1.0, 1.5, 0.0, 1.0)], "object_id string, ord int, x0 double, x1 double, y0 double, y1 double, z0 double, z1 double")
    carved = mesh.carve_faces(vertices, found.selectExpr("1 AS mesh_id", "*"), box, cell=0.7)
    gone = {k for k, f in enumerate(faces) if min(points[v][0] for v in f) <= 1.5 and min(points[v][1] for v in f) <= 1.5}
    assert {r.fid for r in carved.where("object_id = 'bed'").collect()} == gone
    new, kept = mesh.compact_mesh(vertices, carved.where("object_id IS NULL"))
    old = {r.vid: r.old_vid for r in new.collect()}
    assert sorted(old) == list(range(len(old))) and [old[k] for k in range(len(old))] == sorted({v for k, f in enumerate(faces) if k not in gone for v in f})
    assert {r.fid: (old[r.v0], old[r.v1], old[r.v2]) for r in kept.collect()} == {k: f for k, f in enumerate(faces) if k not in gone}


def test_bad_files_are_refused(spark, tmp_path):
    spark.dataSource.register(ply.PlyDataSource)
    write_ply(tmp_path / "q.ply", "binary_little_endian", [(0.0, 0.0, 0.0)], [(0, 0, 0, 0)])
    load = lambda name: spark.read.format("ply").option("path", str(tmp_path / name)).option("element", "face").load().collect()
    with pytest.raises(Exception, match="last triangle"):
        load("q.ply")
    write_ply(tmp_path / "a.ply", "ascii", [(0.0, 0.0, 0.0)], [(0, 0)])
    with pytest.raises(Exception, match="no triangle"):
        load("a.ply")


def test_audit(spark):
    vertices = spark.createDataFrame([(1, 0, 0.0, 0.0, 0.0), (1, 1, 1.0, 0.0, 0.0), (1, 2, 0.0, 1.0, 0.0), (1, 3, 5.0, 5.0, 5.0), (2, 0, float("nan"), 0.0, 0.0), (3, 0, 1.0, 1.0, 1.0)], VERTEX)
    faces = spark.createDataFrame([(1, 0, 0, 1, 2), (1, 1, 0, 1, 2), (1, 2, 1, 0, 2), (1, 3, 0, 0, 1), (2, 0, 0, 0, 9)], FACE)
    got = {r.mesh_id: tuple(r)[1:] for r in mesh.mesh_audit(vertices, faces).collect()}
    assert got[1] == (4, 4, True, True, 1, 1, 3, 1)
    assert got[2] == (1, 1, False, False, 0, 1, 0, 0) and got[3] == (1, 0, True, False, 0, 0, 0, 1)
    with pytest.raises(ValueError):
        mesh.carve_faces(vertices, faces, spark.createDataFrame([], "object_id string, ord int, x0 double, x1 double, y0 double, y1 double, z0 double, z1 double"))


def loop(corners, w, h):
    x0, y0, x1, y1, x2, y2 = corners
    turn = lambda ax, ay, bx, by, x, y: (bx - ax) * (y - ay) - (by - ay) * (x - ax)
    out = set()
    for y in range(h):
        for x in range(w):
            e = [turn(x0, y0, x1, y1, x, y), turn(x1, y1, x2, y2, x, y), turn(x2, y2, x0, y0, x, y)]
            boxed = min(x0, x1, x2) <= x <= max(x0, x1, x2) and min(y0, y1, y2) <= y <= max(y0, y1, y2)
            if boxed and (all(v >= 0 for v in e) or all(v <= 0 for v in e)):
                out.add((y, x))
    return out


def test_raster_equals_a_plain_loop(spark):
    rng = np.random.default_rng(3)
    rows = [(k % 3, 40, 30, *map(float, np.round(rng.uniform(-30, 60, 6) * 4) / 4)) for k in range(30)]
    rows += [(0, 40, 30, 3.0, 3.0, 9.0, 9.0, 5.0, 5.0), (1, 40, 30, 2.0, 2.0, 2.0, 2.0, 2.0, 2.0), (2, 40, 30, float("nan"), 0.0, 1.0, 1.0, 2.0, 0.0), (2, 40, 30, 1e12, 0.0, 1.0, 1.0, 2.0, 0.0)]
    df = spark.createDataFrame(rows, "frame_id int, w int, h int, x0 double, y0 double, x1 double, y1 double, x2 double, y2 double")
    want = {(f, *p) for f, w, h, *c in rows[:-2] for p in loop(c, w, h)}
    for tile in (4, 16):
        assert {tuple(r) for r in mesh.raster_triangles(df, tile).collect()} == want
    register(spark)
    df.limit(32).createOrReplaceTempView("tris")
    lateral = spark.sql("SELECT DISTINCT frame_id, y, x FROM tris, LATERAL scene_raster_triangle(x0, y0, x1, y1, x2, y2, w, h)")
    assert {tuple(r) for r in lateral.collect()} == want


def test_registered_functions(spark):
    register(spark)
    r = spark.sql("SELECT scene_bbox_iou(0, 0, 2, 2, 1, 1, 3, 3) AS iou, scene_bbox_iou(0, 0, 0, 0, 0, 0, 0, 0) AS none, scene_luma(1, 1, 1) AS l, scene_linear_to_srgb(scene_srgb_to_linear(0.5)) AS s, scene_project_u(1, 0, 2, 10, 3, array(1D, 0D, 0D, 0D, 1D, 0D, 0D, 0D, 1D), array(0D, 0D, 0D)) AS u").first()
    assert (r.iou, r.none, round(r.l, 9), round(r.s, 9), r.u) == (1 / 7, 0.0, 1.0, 0.5, 8.0)
    assert [tuple(x) for x in spark.sql("SELECT * FROM scene_expand_runs(array(1, 2, 1, 1), 2)").collect()] == [(1, 0), (0, 1), (0, 2)]


def test_silhouette_leaves_out_faces_behind(spark):
    vertices = spark.createDataFrame([(0, 0, -1.0, -1.0, 2.0), (0, 1, 1.0, -1.0, 2.0), (0, 2, 0.0, 1.0, 2.0), (0, 3, 0.0, 0.0, -1.0)], VERTEX)
    cams = spark.createDataFrame([(0, 7, 10.0, 10.0, 10.0, 10.0, 20, 20, np.eye(3).ravel().tolist(), [0.0, 0.0, 0.0])], "mesh_id int, frame_id int, fx double, fy double, cx double, cy double, w int, h int, r array<double>, t array<double>")
    got = {tuple(r)[1:] for r in mesh.mesh_silhouette(vertices, spark.createDataFrame([(0, 0, 0, 1, 2), (0, 1, 0, 1, 3)], FACE), cams).collect()}
    assert got == loop([5.0, 5.0, 15.0, 5.0, 10.0, 15.0], 20, 20)
