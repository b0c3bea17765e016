"""Grid distances, holes and fills against brute force."""

import numpy as np
import pytest

from scenetable.operators import distance, pixels

XY = "frame_id int, y int, x int"


def table(spark, arrays):
    return spark.createDataFrame([(f, int(y), int(x)) for f, a in arrays.items() for y, x in zip(*np.nonzero(a), strict=True)], XY)


@pytest.mark.parametrize("radius", [3, 64])
def test_distance_equals_brute_force(spark, radius):
    rng = np.random.default_rng(radius)
    masks = {f: rng.random((70, 150)) < p for f, p in ((1, 0.002), (2, 0.2))}
    got = {(r.frame_id, r.y, r.x): r.d2 for r in distance.bounded_distance(table(spark, masks), radius).where("y BETWEEN 0 AND 69 AND x BETWEEN 0 AND 149").collect()}
    for f, m in masks.items():
        at = np.argwhere(m)
        yy, xx = np.mgrid[0:70, 0:150]
        d2 = ((yy[..., None] - at[:, 0]) ** 2 + (xx[..., None] - at[:, 1]) ** 2).min(-1)
        assert {(y, x): int(d2[y, x]) for y, x in zip(*np.nonzero(d2 <= radius * radius), strict=True)} == {k[1:]: v for k, v in got.items() if k[0] == f}
    assert distance.bounded_distance(table(spark, masks).limit(0), radius).count() == 0


def test_soft_bands(spark):
    core = np.zeros((20, 20), bool)
    core[8:12, 8:12] = True
    keep = np.zeros_like(core)
    keep[:, 14:] = True
    everything = table(spark, {0: np.ones_like(core)})
    got = {(r.y, r.x): (r.band, r.weight) for r in distance.soft_bands(table(spark, {0: core}), table(spark, {0: keep}), everything, 3).collect()}
    assert got[9, 9] == ("core", 1.0) and got[9, 14] == ("protected_collar", 0.0) and (4, 9) not in got and (9, 15) not in got
    s = (4 - np.sqrt(5)) / 4
    assert got[6, 7] == ("collar", pytest.approx(s * s * (3 - 2 * s)))
    grey = everything.selectExpr("frame_id", "y", "x", "10 AS v")
    out = {(r.y, r.x): r.v for r in distance.blend(grey, everything.selectExpr("frame_id", "y", "x", "110 AS v"), distance.soft_bands(table(spark, {0: core}), table(spark, {0: keep}), everything, 3), ["v"]).collect()}
    assert (out[9, 9], out[0, 0], out[9, 14]) == (110.0, 10.0, 10.0) and out[6, 7] == np.rint(10 + 100 * s * s * (3 - 2 * s))


def test_boundary_distances_at_any_size(spark):
    a, b = np.zeros((40, 300), bool), np.zeros((40, 300), bool)
    a[5:15, 5:15] = True
    b[20:30, 200:290] = True
    r = distance.mask_alignment(table(spark, {0: a, 1: a}), table(spark, {0: b}), 2).collect()
    edge = lambda m: np.argwhere(m & ~np.array([[all(m[max(y - 1, 0) : y + 2, max(x - 1, 0) : x + 2].ravel()) for x in range(300)] for y in range(40)]))
    ea, eb = edge(a), edge(b)
    d = np.sqrt(((ea[:, None] - eb[None]) ** 2).sum(-1))
    both = np.concatenate([d.min(1), d.min(0)])
    assert [(x.frame_id, x.boundary_samples, x.intersection, x.removal_pixels) for x in r] == [(0, len(both), 0, 100)]
    assert (r[0].median_px, r[0].p95_px, r[0].max_px) == pytest.approx((np.quantile(both, 0.5), np.quantile(both, 0.95), both.max()))


def test_holes_fill_and_notches_stay_open(spark):
    rows = """
    ############....######
    #..........#....#....#
    #..####..#.#....#....#
    #..#..#....#....#.....
    #..####....#....######
    ############.#.#......
    ..............#.......
    """.split()
    mask = np.array([[c == "#" for c in r] for r in rows])
    frames = spark.createDataFrame([(0, 22, 7)], "frame_id int, w int, h int")
    fill = lambda **k: {(r.y, r.x) for r in distance.enclosed_holes(table(spark, {0: mask}), frames, **k).collect()}
    inner = {(3, 4), (3, 5)}
    outer = {(y, x) for y in range(1, 5) for x in range(1, 11) if not mask[y, x]} - inner
    assert fill() == inner | outer and fill(min_pixels=3) == outer and fill(min_share=0.5) == set()
    diagonal = np.array([[0, 1, 0], [1, 0, 1], [0, 1, 0]], bool)
    sizes = spark.createDataFrame([(0, 3, 3)], "frame_id int, w int, h int")
    assert {(r.y, r.x) for r in distance.enclosed_holes(table(spark, {0: diagonal}), sizes).collect()} == {(1, 1)}
    assert distance.enclosed_holes(table(spark, {0: diagonal}), sizes, eight=True).count() == 0


def test_a_bridge_closes_the_notch_for_topology_only(spark):
    mask = np.zeros((15, 15), bool)
    mask[2:13, 2:13] = True
    mask[5:10, 5:10] = False
    mask[7, 10:13] = False  # a slit of one pixel
    frames = spark.createDataFrame([(0, 15, 15)], "frame_id int, w int, h int")
    assert distance.enclosed_holes(table(spark, {0: mask}), frames).count() == 0
    got = {(r.y, r.x) for r in distance.enclosed_holes(table(spark, {0: mask}), frames, bridge=1).collect()}
    assert got and all(5 <= y < 10 and 5 <= x < 10 and not mask[y, x] for y, x in got)


def test_spiral_components_need_many_rounds(spark):
    mask = np.zeros((41, 41), bool)
    for k in range(0, 20, 4):
        mask[k, k : 41 - k] = mask[k : 41 - k, 40 - k] = mask[40 - k, k : 41 - k] = True
        mask[k + 2 if k else 2 : 41 - k, k] = True
        mask[k + 2, max(k - 3, 0) : k + 1] |= k > 0
    labels = {(r.y, r.x): r.label for r in pixels.connected_components(table(spark, {0: mask})).collect()}
    for (y, x), label in labels.items():
        assert all(labels[n] == label for n in ((y + 1, x), (y, x + 1)) if n in labels)
    corner = np.eye(6, dtype=bool)
    assert pixels.connected_components(table(spark, {0: corner})).select("label").distinct().count() == 6
    assert pixels.connected_components(table(spark, {0: corner}), eight=True).select("label").distinct().count() == 1


def grid(spark, values, seen):
    return spark.createDataFrame([(0, y, x, bool(seen[y, x]), float(values[y, x])) for y in range(values.shape[0]) for x in range(values.shape[1])], "plane_id int, row int, col int, observed boolean, v double")


def test_directional_fill(spark):
    rng = np.random.default_rng(1)
    values = np.repeat(rng.random((1, 9)) * 100, 7, axis=0) + rng.random((7, 9))  # changes less down the columns
    seen = rng.random((7, 9)) < 0.4
    seen[:, 4] = False
    seen[2:5, 0] = True
    out = {(r.row, r.col): r for r in distance.directional_fill(grid(spark, values, seen), ["plane_id"], ["v"]).collect()}
    for y in range(7):
        for x in range(9):
            known = np.flatnonzero(seen[:, x])
            near = min(known, key=lambda k: (abs(k - y), k)) if len(known) else None
            assert out[y, x].direction == "down" and out[y, x].source == (None if near is None else near) and out[y, x].v == (None if near is None else values[near, x])


def test_blur_and_normalised_fill(spark):
    rng = np.random.default_rng(2)
    values, seen = rng.random((6, 8)), rng.random((6, 8)) < 0.5
    k = np.array(distance.gaussian_kernel(1.2))
    r = len(k) // 2

    def blur(a):
        p = np.pad(a, ((0, 0), (r, r)), mode="edge")
        a = sum(w * p[:, i : i + a.shape[1]] for i, w in enumerate(k))
        p = np.pad(a, ((r, r), (0, 0)), mode="edge")
        return sum(w * p[i : i + a.shape[0]] for i, w in enumerate(k))

    soft = {(x.row, x.col): x.v for x in distance.separable_blur(grid(spark, values, seen), ["plane_id"], ["v"], 1.2).collect()}
    assert all(abs(soft[y, x] - blur(values)[y, x]) < 1e-12 for y in range(6) for x in range(8))
    want = np.where(seen, values, blur(values * seen) / blur(seen.astype(float)))
    full = {(x.row, x.col): x.v for x in distance.normalized_fill(grid(spark, values, seen), ["plane_id"], ["v"], 1.2).collect()}
    assert all(abs(full[y, x] - want[y, x]) < 1e-12 for y in range(6) for x in range(8))


def test_exploded_masks_are_not_broadcast(spark):
    """A mask made by exploding few rows looks as small as those to Spark."""
    from pyspark.sql import functions as F

    from scenetable.operators import pixels

    steps = F.explode(F.sequence(F.lit(0), F.lit(5)))
    mask = spark.range(3).select(F.col("id").alias("frame_id"), steps.alias("y")).select("*", steps.alias("x"))
    for out in (pixels.inner_boundary(mask), pixels.ring(mask, 0, 1), distance.soft_bands(mask, mask, mask, 2), distance.bounded_distance(mask, 2).join(mask, pixels.PIXEL)):
        assert out.count() and "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
