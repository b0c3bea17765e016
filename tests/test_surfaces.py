"""Carving, depth agreement, colour support and surfaces against plain arrays."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from scenetable.operators import carve, surface

POINT = "point_id long, x double, y double, z double, footprint double"


def cloud(spark, a):
    return spark.createDataFrame([tuple(map(float, p)) for p in a], "x double, y double, z double")


def test_carving_equals_all_pairs_at_every_reach(spark):
    rng = np.random.default_rng(6)
    p, front, rear = rng.uniform(-1, 1, (400, 3)), rng.uniform(-1, 1, (60, 3)), rng.uniform(-1, 1, (60, 3))
    foot = rng.uniform(0, 0.5, 400)
    got = {r.point_id: r for r in carve.semantic_carve(spark.createDataFrame([(i, *map(float, q), float(f)) for i, (q, f) in enumerate(zip(p, foot, strict=True))], POINT), cloud(spark, front), cloud(spark, rear)).collect()}
    dist = lambda a: np.sqrt(((p[:, None] - a[None]) ** 2).sum(-1)).min(1)
    f, r, reach = dist(front), dist(rear), np.minimum(0.4, 0.08 + foot)
    assert set(got) == set(np.flatnonzero(f <= reach)) and reach.min() < 0.1 and (reach == 0.4).any()
    for i, row in got.items():
        near = r[i] <= f[i] + 0.02
        assert row.removed == (not near) and row.front_distance == pytest.approx(f[i]) and (row.rear_distance is None or row.rear_distance == pytest.approx(r[i])) and (not near or row.rear_distance is not None)
    assert {row.removed for row in got.values()} == {True, False}


def test_extents_of_a_turned_gaussian(spark):
    rng = np.random.default_rng(2)
    q, s = rng.normal(size=4), rng.normal(size=3)
    columns = ", ".join(f"{c} double" for c in ("x", "y", "z", *(f"scale_{i}" for i in range(3)), *(f"rot_{i}" for i in range(4))))
    row = carve.gaussian_extents(spark.createDataFrame([(0.0, 0.0, 0.0, *map(float, s), *map(float, 3 * q))], columns)).first()
    w, x, y, z = q / np.linalg.norm(q)
    r = np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)], [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)], [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]])
    want = np.sqrt(np.diag(r @ np.diag(np.exp(2 * s)) @ r.T))
    assert [row.sx, row.sy, row.sz] == pytest.approx(want.tolist()) and row.footprint == pytest.approx(want.max() * np.sqrt(8))


def test_depth_edges_and_agreement(spark):
    depth = np.full((5, 6), 2.0)
    depth[:, 3:] = 2.2
    df = spark.createDataFrame([(0, y, x, float(depth[y, x])) for y in range(5) for x in range(6) if (y, x) != (2, 2)], "frame_id int, y int, x int, depth double")
    edges = {(r.y, r.x) for r in carve.depth_edges(df).where("edge").collect()}
    assert edges == {(y, x) for y in range(5) for x in (2, 3) if (y, x) != (2, 2)}
    rows = [(1, 2.0, 2.05), (2, 2.2, 2.0), (3, 1.8, 2.0), (4, 2.0, None), (5, 2.0, float("nan")), (6, None, 2.0)]
    out = spark.createDataFrame(rows, "k int, a double, s double").select("k", carve.depth_agreement(F.col("a"), F.col("s"), 0.08, 0.01).alias("c"))
    assert {r.k: r.c for r in out.collect()} == {1: "visible", 2: "occluded_behind_scene", 3: "front_depth_mismatch", 4: "missing_scene_depth", 5: "missing_scene_depth", 6: None}


def test_splat_and_bounded_closing(spark):
    pixel = "frame_id int, y int, x int, depth double"
    scene = spark.createDataFrame([(0, y, x, 2.0 if x < 6 else 4.0) for y in range(9) for x in range(9)], pixel)
    anchors = spark.createDataFrame([(0, 4, 1, 2.0), (0, 4, 5, 2.0)], pixel)
    first = {(r.y, r.x) for r in carve.depth_aware_splat(anchors, scene, 1).collect()}
    assert first == {(y, x) for y in (3, 4, 5) for x in (0, 1, 2, 4, 5)}  # what lies at the other depth is left out
    closed = {(r.y, r.x) for r in carve.depth_bounded_close(carve.depth_aware_splat(anchors, scene, 1), anchors, scene, 1, 1).collect()}
    assert closed == first | {(y, 3) for y in (3, 4, 5)}


def grid(rows, cols):
    return [(y, x) for y in range(rows) for x in range(cols)]


def test_the_bright_colour_gives_the_support(spark):
    rng = np.random.default_rng(4)
    wall = rng.integers(180, 200, (200, 3))
    stain = rng.integers(20, 60, (60, 3))
    rows = [(0, 0, i, True, *map(int, c)) for i, c in enumerate(np.vstack([wall, stain]))] + [(0, 1, 0, False, 190, 190, 190)]
    df = spark.createDataFrame(rows, "plane_id int, row int, col int, observed boolean, r int, g int, b int")
    got = {(r.row, r.col): r.support for r in surface.dominant_colour_support(df, ["plane_id"]).collect()}
    assert all(got[0, i] == (i < 200) for i in range(260)) and got[1, 0] is False
    thin = surface.dominant_colour_support(df, ["plane_id"], radius=0.5, min_share=0.5).where("observed")
    assert thin.where("support").count() == 260


@pytest.mark.parametrize("degree", [1, 3])
def test_planted_light_among_outliers(spark, degree):
    rng = np.random.default_rng(degree)
    h, w = 20, 24
    y, x = np.mgrid[0:h, 0:w]
    u, v = (x + 0.5) / w * 2 - 1, (y + 0.5) / h * 2 - 1
    light = 120 + 30 * u - 20 * v + (12 * u * v - 9 * v**3 if degree == 3 else 0)
    colour = np.stack([light, light - 10, light + 5], -1)
    dirty = colour.copy()
    dirty[rng.random((h, w)) < 0.2] += 70
    seen = rng.random((h, w)) < 0.6
    rows = [(0, int(a), int(b), bool(seen[a, b]), bool(seen[a, b]), *map(float, dirty[a, b])) for a, b in grid(h, w)]
    texels = spark.createDataFrame(rows, "plane_id int, row int, col int, observed boolean, support boolean, r double, g double, b double")
    sizes = spark.createDataFrame([(0, h, w)], "plane_id int, height int, width int")
    out, fit = surface.illumination_surface(texels, ["plane_id"], sizes, degree=degree)
    for r in out.collect():
        want = dirty[r.row, r.col] if r.observed else colour[r.row, r.col]
        assert abs(np.array([r.r, r.g, r.b]) - want).max() <= (0 if r.observed else 1.6)
    assert fit.first().n == seen.sum() and len(fit.first().coefficients) == 3 * (3 if degree == 1 else 10)
    with pytest.raises(ValueError):
        surface.illumination_surface(texels.where("col < 1 AND row < 9"), ["plane_id"], sizes)


def test_grid_of_planes_is_not_broadcast(spark):
    from scenetable.plans import surfaces

    out = surfaces._colours(spark, "/root/testdata/sf0.001").where("observed")
    assert out.count() and "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_stencils_shuffle_pixels_once(spark):
    """By tiles, over their borders and left of 0: the plain results, and one exchange for both passes."""
    from scenetable.operators import pixels

    rng = np.random.default_rng(4)
    places = sorted({(int(f), int(y), int(x)) for f, y, x in zip(rng.integers(0, 2, 900), rng.integers(-6, 140, 900), rng.integers(50, 80, 900), strict=True)})
    depth = {p: float(v) for p, v in zip(places, rng.random(len(places)) + 1, strict=True)}
    rows = spark.createDataFrame([(*p, d) for p, d in depth.items()], "frame_id long, y int, x int, depth double")
    around = lambda p, r: [(p[0], p[1] + j, p[2] + i) for j in range(-r, r + 1) for i in range(-r, r + 1)]
    wide, least = pixels.dilate(rows, 3), carve._spread_least(rows, 3)
    assert {tuple(r) for r in wide.collect()} == {q for p in places for q in around(p, 3)}
    assert {tuple(r) for r in least.collect()} == {(*q, min(depth[p] for p in around(q, 3) if p in depth)) for q in {q for p in places for q in around(p, 3)}}
    full = {p for q in places for p in around(q, 2)}
    assert {tuple(r) for r in pixels.erode(pixels.dilate(rows, 2), 1).collect()} == {p for p in full if all(q in full for q in around(p, 1))}
    got = {(r.frame_id, r.y, r.x): r.jump for r in carve.depth_edges(rows, 0.1).collect()}
    assert got.keys() == depth.keys()
    for p, jump in got.items():
        near = [depth[q] for q in around(p, 1) if q in depth]
        assert abs(jump - (max(near) - min(near)) / depth[p]) < 1e-12
    for out in (wide, least):
        assert out._jdf.queryExecution().sparkPlan().toString().count("REPARTITION") == 1
        assert out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("Exchange") == 1
