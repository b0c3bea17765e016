"""Planes and rays: the planted frame, the floor before the bed, the nearest wall, all pairs."""

import numpy as np
import pytest

from scenetable.operators import planes

CAM = "scene int, frame_id int, fx double, fy double, cx double, cy double, w int, h int, r array<double>, t array<double>"
PLANE = "scene int, plane_id int, n array<double>, offset double, u array<double>, v array<double>, u0 double, u1 double, v0 double, v1 double"


def faces_frame(spark, centres, normals, areas):
    rows = [(i, *map(float, c), *map(float, n), float(a)) for i, (c, n, a) in enumerate(zip(centres, normals, areas, strict=True))]
    return spark.createDataFrame(rows, "fid long, cx double, cy double, cz double, nx double, ny double, nz double, area double")


def test_face_geometry(spark):
    vertices = spark.createDataFrame([(1, 0, 0.0, 0.0, 0.0), (1, 1, 2.0, 0.0, 0.0), (1, 2, 0.0, 2.0, 0.0), (1, 3, float("nan"), 0.0, 0.0)], "mesh_id int, vid int, x double, y double, z double")
    faces = spark.createDataFrame([(1, 0, 0, 1, 2), (1, 1, 0, 2, 1), (1, 2, 0, 0, 1), (1, 3, 0, 1, 3), (1, 4, 0, 1, 9)], "mesh_id int, fid int, v0 int, v1 int, v2 int")
    got = {r.fid: r for r in planes.face_geometry(vertices, faces).collect()}
    assert set(got) == {0, 1} and got[0].area == 2.0 and (got[0].nz, got[1].nz) == (1.0, -1.0) and abs(got[0].cx - 2 / 3) < 1e-12


def test_axes_of_noisy_flipped_normals(spark):
    a = np.deg2rad(27.0)
    expected = np.array([[np.cos(a), 0, np.sin(a)], [0, 1, 0], [-np.sin(a), 0, np.cos(a)]])
    rng = np.random.default_rng(7)
    normals, areas = [], []
    for k, count in enumerate((700, 500, 600)):
        noisy = expected[k] + rng.normal(0.0, 0.015, (count, 3))
        noisy /= np.linalg.norm(noisy, axis=1)[:, None]
        noisy[::2] *= -1
        normals.append(noisy)
        areas.append(np.full(count, 1.0 + 0.1 * k))
    found, support = planes.dominant_axes(faces_frame(spark, np.zeros((1800, 3)), np.vstack(normals), np.concatenate(areas)))
    assert (np.abs(found @ expected.T).max(axis=1) > 0.999).all() and np.abs(found @ found.T - np.eye(3)).max() < 1e-10
    assert sorted(np.round(support, 6)) == [550.0, 700.0, 720.0]
    with pytest.raises(ValueError):
        planes.dominant_axes(faces_frame(spark, np.zeros((5, 3)), np.tile([0.0, 0, 1], (5, 1)), np.ones(5)))


def test_peaks_keep_their_distance(spark):
    at = np.concatenate([np.full(50, 1.0), np.full(20, 1.2), np.full(30, 2.0), np.full(5, 9.0)])
    centres = np.stack([np.linspace(0, 1, len(at)), at, np.linspace(2, 4, len(at))], axis=1)
    got = planes.axis_planes(faces_frame(spark, centres, np.tile([0.0, -1, 0], (len(at), 1)), np.ones(len(at))), np.eye(3)).collect()
    assert [(r.axis, round(r.offset, 9), r.inlier_faces) for r in got] == [(1, 1.0, 50), (1, 2.0, 30), (1, 9.0, 5)]
    assert planes.axis_planes(faces_frame(spark, centres, np.tile([0.6, 0.8, 0], (len(at), 1)), np.ones(len(at))), np.eye(3)).count() == 0


def test_the_floor_is_chosen_before_a_larger_bed(spark):
    rows = [(1, -4.0, 30.0), (1, 1.0, 150.0), (1, 4.0, 25.0)]
    candidates = spark.createDataFrame([(k, o, a, 10, 0.01, -3.0, 3.0, 2.0, 9.0) for k, o, a in rows], "axis int, offset double, support_area double, inlier_faces long, rms double, u0 double, u1 double, v0 double, v1 double")
    points = [("floor", x, 4.02, z) for x, z in zip(np.linspace(-3, 3, 200), np.linspace(2, 9, 200), strict=True)]
    points += [("ceiling", x, -4.01, z) for _, x, _, z in points]
    anchors = spark.createDataFrame([(r, float(x), y, float(z)) for r, x, y, z in points], "role string, x double, y double, z double")
    found = planes.anchored(candidates, np.eye(3), anchors, 0.15)
    support = {r.offset: r.support for r in found.collect()}
    assert support[4.0][0].inliers == 200 and support[1.0] is None
    centres = spark.createDataFrame([(0.0, 0.0, 0.0)], "x double, y double, z double")
    got = {r.role: r for r in planes.envelope_planes(found, np.eye(3), centres, anchors, clearance=0.25, margin=0.2, min_fraction=0.05, tolerance=0.15).collect()}
    assert {k: r.offset for k, r in got.items()} == {"floor": 4.02, "ceiling": -4.01} and got["floor"].u0 < -3.19 and got["floor"].n == [0.0, 1.0, 0.0]
    bare = planes.envelope_planes(found.withColumns({"score": found.score * 0}).drop("support").selectExpr("*", "CAST(NULL AS array<struct<role:string,inliers:bigint,fraction:double,median_residual:double>>) AS support"), np.eye(3), centres, anchors, clearance=0.25)
    assert {(r.side, r.role, r.offset) for r in bare.collect()} == {("negative", "structural_boundary", -4.0), ("positive", "structural_boundary", 1.0)}


def test_the_nearest_wall_is_hit(spark):
    eye = np.eye(3).ravel().tolist()
    cams = spark.createDataFrame([(0, 0, 100.0, 100.0, 0.0, 0.0, 100, 100, eye, [0.0, 0.0, 0.0])], CAM)
    rows = [(0, 1, [0.0, 1.0, 0.0], 4.0, [1.0, 0.0, 0.0], [0.0, 0.0, 1.0], *(-20.0, 20.0) * 2), (0, 2, [0.0, 0.0, 1.0], 10.0, [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], *(-20.0, 20.0) * 2)]
    pixels = spark.createDataFrame([(0, 50, 0), (0, 10, 0)], "frame_id int, y int, x int")
    got = sorted((r.y, r.plane_id, r.depth, r.wx, r.wy, r.wz) for r in planes.ray_plane_hits(pixels, cams, spark.createDataFrame(rows, PLANE), ["scene"]).collect())
    assert got == [(10, 2, 10.0, 0.0, 1.0, 10.0), (50, 1, 8.0, 0.0, 4.0, 8.0)]


def test_hits_and_support_equal_all_pairs(spark):
    rng = np.random.default_rng(11)
    turn = lambda: np.linalg.qr(rng.normal(size=(3, 3)))[0]
    cams = []
    for f in range(4):
        q = turn()
        cams.append((f % 2, f, 20.0, 22.0, 16.0, 12.0, 32, 24, (q * np.sign(np.linalg.det(q))).ravel().tolist(), rng.normal(size=3).tolist()))
    rows = []
    for k in range(24):
        q = turn()
        a, b = rng.uniform(-4, 1, 2)
        rows.append((k % 2, k, q[0].tolist(), float(rng.uniform(-4, 4)), q[1].tolist(), q[2].tolist(), float(a), float(a + 4), float(b), float(b + 3)))
    pixels = [(f, y, x, float(np.round(rng.uniform(0.5, 5), 3))) for f in range(4) for y in range(24) for x in range(32)]
    df = spark.createDataFrame(pixels, "frame_id int, y int, x int, depth double")
    hit, on = {}, set()
    for f, y, x, d in pixels:
        scene, _, fx, fy, cx, cy, _, _, r, t = cams[f]
        r, t = np.array(r).reshape(3, 3), np.array(t)
        o, ray = -r.T @ t, r.T @ np.array([(x - cx) / fx, (y - cy) / fy, 1.0])
        for s, k, n, off, u, v, u0, u1, v0, v1 in rows:
            if s != scene:
                continue
            inside = lambda p: u0 <= p @ u <= u1 and v0 <= p @ v <= v1  # noqa: E731, B023
            p = o + ray * d
            if abs(p @ n - off) <= 0.15 and inside(p):
                on.add((f, y, x, k))
            z = (off - o @ n) / (ray @ n)
            if z > 1e-5 and inside(o + ray * z):
                hit[f, y, x] = min(hit.get((f, y, x), (9e9, 0)), (z, k))
    cameras, table = spark.createDataFrame(cams, CAM), spark.createDataFrame(rows, PLANE)
    for tile in (5, 16):
        got = {(r.frame_id, r.y, r.x): r.plane_id for r in planes.ray_plane_hits(df, cameras, table, ["scene"], tile).collect()}
        assert got == {k: v[1] for k, v in hit.items()} and len(got) > 300
        assert {tuple(r) for r in planes.plane_support(df, cameras, table, ["scene"], 0.15, tile).collect()} == on and len(on) > 50
    text = planes.ray_plane_hits(df, cameras, table, ["scene"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
