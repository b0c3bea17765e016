"""Donor prefill against plain arrays, with the planted outlier, occluder and guard cases."""

import numpy as np
import pytest

from scenetable.operators import prefill

PIXELS = "frame_id long, y int, x int, r int, g int, b int, depth double"
CAMERAS = "frame_id long, fx double, fy double, cx double, cy double, w int, h int, r array<double>, t array<double>"


def turned(angle):
    c, s = np.cos(angle), np.sin(angle)
    return np.array([[c, 0, s], [0, 1, 0], [-s, 0, c]])


def scene(rng, n=4, h=14, w=18):
    cams = [(i, 20.0, 20.0, 9.0, 7.0, w, h, turned(0.05 * i).ravel().tolist(), [-0.1 * i, 0.02 * i, 0.0]) for i in range(n)]
    rows = [(i, y, x, *map(int, rng.integers(0, 255, 3)), float(np.round(rng.choice([2.0, 2.05, 3.0, float("nan")]), 2))) for i in range(n) for y in range(h) for x in range(w)]
    return cams, rows


def plainly(cams, rows, stride, splat):
    """Every donor pixel in every other frame, by loops."""
    best = {}
    at = {c[0]: c for c in cams}
    for f, y, x, r, g, b, d in rows:
        if y % stride or x % stride or not d > 0:
            continue
        _, fx, fy, cx, cy, *_, rot, t = at[f]
        world = np.array(rot).reshape(3, 3).T @ (np.array([(x - cx) / fx * d, (y - cy) / fy * d, d]) - t)
        for to, c in at.items():
            if to == f:
                continue
            p = np.array(c[7]).reshape(3, 3) @ world + c[8]
            if p[2] <= 1e-6:
                continue
            u, v = np.rint(c[1] * p[0] / p[2] + c[3]), np.rint(c[2] * p[1] / p[2] + c[4])
            for oy in range(-splat, splat + 1):
                for ox in range(-splat, splat + 1):
                    if 0 <= u + ox < c[5] and 0 <= v + oy < c[6]:
                        key, item = (to, f, int(v + oy), int(u + ox)), (round(float(p[2]), 9), oy, ox, y, x, r, g, b)
                        best[key] = min(best.get(key, item), item)
    return {(*k, v[0], *v[5:]) for k, v in best.items()}


@pytest.mark.parametrize(("stride", "splat"), [(1, 0), (2, 1)])
def test_reprojection_with_turned_cameras(spark, stride, splat):
    cams, rows = scene(np.random.default_rng(5))
    views = spark.createDataFrame([(a[0], b[0]) for a in cams for b in cams if a is not b], "donor_id long, frame_id long")
    got = prefill.reproject_pixels(spark.createDataFrame(rows, PIXELS), spark.createDataFrame(cams, CAMERAS), views, stride, splat)
    assert {(r.frame_id, r.donor_id, r.y, r.x, round(r.depth, 9), r.r, r.g, r.b) for r in got.collect()} == plainly(cams, rows, stride, splat)


def test_identity_cameras_copy_the_donor_and_leave_the_rest(spark):
    eye = np.eye(3).ravel().tolist()
    cams = spark.createDataFrame([(i, 20.0, 20.0, 4.0, 3.0, 8, 6, eye, [0.0, 0.0, 0.0]) for i in range(3)], CAMERAS)
    rows = [(i, y, x, 10 * x, 20 * y, 40 if i else 99, 2.0) for i in range(3) for y in range(6) for x in range(8)]
    pixels = spark.createDataFrame(rows, PIXELS)
    removal = pixels.where("frame_id = 0 AND y IN (2, 3) AND x BETWEEN 3 AND 5").select("frame_id", "y", "x")
    views = spark.createDataFrame([(a, 0) for a in range(3)], "donor_id long, frame_id long")
    out, frames = prefill.donor_prefill(pixels, cams, removal, removal.limit(0), views, stride=1, splat=0, guard=None)
    for r in out.collect():
        inside = r.y in (2, 3) and 3 <= r.x <= 5
        assert (r.frame_id, r.r, r.g, r.b, r.label, r.support) == (0, 10 * r.x, 20 * r.y, 40 if inside else 99, "measured" if inside else "source", 2 if inside else 0)
    report = frames.collect()[0]
    assert (report.stable_pixels, report.retention, report.passed, report.coverage) == (6, 1.0, True, 1.0)


def test_fuse_rejects_the_outlier(spark):
    rows = [(0, 0, 0, 240, 240, 240, 2.0), (0, 0, 0, 220, 220, 220, 2.01), (0, 0, 0, 255, 0, 0, 5.0), (0, 0, 1, 9, 9, 9, 2.0)]
    got = prefill.fused(spark.createDataFrame(rows, PIXELS), 0.05, 0.01, 2).collect()
    assert [(r.y, r.x, r.support, r.r, r.g, r.b, round(r.depth, 9)) for r in got] == [(0, 0, 2, 230.0, 230.0, 230.0, 2.005)]


def test_guard_keeps_what_both_exclusions_support(spark):
    eye = np.eye(3).ravel().tolist()
    cams = spark.createDataFrame([(i, 20.0, 20.0, 20.0, 20.0, 40, 40, eye, [0.0, 0.0, 0.0]) for i in range(4)], CAMERAS)
    pixels = spark.createDataFrame([(i, y, x, 50 + i, 60, 70, 2.0) for i in range(4) for y in range(40) for x in range(40)], PIXELS)
    removal = pixels.where("frame_id IN (0, 1) AND y = 20").select("frame_id", "y", "x")
    exclusion = pixels.where("frame_id > 1 AND y = 20 AND x < 10").select("frame_id", "y", "x")
    views = spark.createDataFrame([(d, 0) for d in range(4)] + [(0, 1)], "donor_id long, frame_id long")
    views = views.where("donor_id > 1 OR frame_id = 1")
    out, frames = prefill.donor_prefill(pixels, cams, removal, exclusion, views, stride=1, splat=0)
    got = {r.frame_id: r for r in frames.collect()}
    assert (got[0].configured_pixels, got[0].guard_pixels, got[0].stable_pixels, got[0].passed) == (26, 22, 22, True) and got[0].retention == 22 / 26
    assert (got[1].configured_pixels, got[1].retention, got[1].passed, got[1].failure_reason) == (0, None, False, "no_configured_support")
    labels = {(r.frame_id, r.x): r.label for r in out.where("y = 20 AND frame_id < 2").collect()}
    assert all(labels[0, x] == ("measured" if x >= 18 else "residual") and labels[1, x] == "residual" for x in range(40))
    few = prefill.donor_prefill(pixels, cams, removal, exclusion, views, stride=1, splat=0, min_retention=0.9)[1].where("frame_id = 0").first()
    assert (few.passed, few.failure_reason) == (False, "boundary_guard_retention_below_minimum")


@pytest.mark.parametrize("splat", [0, 1, 2])
def test_targets_and_tiles(spark, splat):
    """Frames wider and higher than a tile, and only the asked pixels: the same rows as all pixels give."""
    cams, rows = scene(np.random.default_rng(5), 3, 70, 72)
    px, cameras = spark.createDataFrame(rows, PIXELS), spark.createDataFrame(cams, CAMERAS)
    views = spark.createDataFrame([(a, b) for a in range(3) for b in range(3) if a != b], "donor_id long, frame_id long")
    every = {tuple(r) for r in prefill.reproject_pixels(px, cameras, views, 2, splat).collect()}
    best = plainly(cams, rows, 2, splat)
    assert {(*r[:4], round(r[4], 9), *r[5:]) for r in every} == best and any(r[2] >= 64 for r in every) and any(r[3] >= 64 for r in every)
    asked = {(f, y, x) for f in range(3) for y in range(60, 68) for x in range(50, 70)}
    some = prefill.reproject_pixels(px, cameras, views, 2, splat, spark.createDataFrame(sorted(asked), "frame_id long, y int, x int")).collect()
    assert some and {tuple(r) for r in some} == {r for r in every if (r[0], r[2], r[3]) in asked}
