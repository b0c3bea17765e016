"""Scene checks on planted cases."""

import math

import numpy as np
import pytest

from scenetable.operators import checks


def bins(spark, front, rear):
    rows = [(0, o, 8 * x, 8 * y, d) for o, a in (("f", front), ("r", rear)) for y, line in enumerate(a) for x, d in enumerate(line) if d is not None]
    seen = spark.createDataFrame(rows, "frame_id int, obj string, px int, py int, depth double")
    return spark.createDataFrame([(0, "f", "r")], "frame_id int, front string, rear string"), seen, seen.drop("depth")


def test_depth_order_and_its_inversion(spark):
    front, rear = [[None, 2.0], [2.2, 2.1]], [[None, 2.5], [2.7, 2.6]]
    good = checks.depth_order(*bins(spark, front, rear)).first()
    assert (good.shared, round(good.least, 9), good.wrong, good.passed, good.disjoint) == (3, 0.5, 0.0, True, False)
    rear[1][1] = 1.9
    bad = checks.depth_order(*bins(spark, front, rear)).first()
    assert (bad.passed, bad.shared) == (False, 3) and bad.wrong == pytest.approx(1 / 3)
    apart = checks.depth_order(*bins(spark, [[2.0, None]], [[None, 3.0]])).first()
    assert (apart.passed, apart.disjoint, apart.shared, apart.wrong) == (False, True, 0, 1.0)


def test_contact(spark):
    rows = [(1, 1.04, 0.4, 1.0), (2, 1.09, 0.4, 1.0), (3, 0.95, 0.4, 1.0), (4, 1.04, 0.1, 1.0), (5, None, 0.1, 1.0)]
    got = {r.id: (round(r.excess or 0, 9), r.passed) for r in checks.contact(spark.createDataFrame(rows, "id int, bottom double, thickness double, top double")).collect()}
    assert got == {1: (0.0, True), 2: (0.04, False), 3: (0.0, False), 4: (0.015, False), 5: (0.0, False)}


def test_affine_audit(spark):
    c, s = math.cos(0.3), math.sin(0.3)
    turned = np.diag([2.0, 2, 2, 1]) @ np.array([[c, -s, 0, 1], [s, c, 0, 2], [0, 0, 1, 3], [0, 0, 0, 1]])
    turned[3] = [0, 0, 0, 1]
    sheared, mirrored, projective = turned.copy(), turned.copy(), turned.copy()
    sheared[0, 1] += 0.5
    mirrored[:, 0] *= -1
    projective[3, 0] = 0.1
    rows = [(k, np.ravel(m).tolist()) for k, m in enumerate((turned, sheared, mirrored, projective))] + [(4, [1.0] * 15), (5, [float("nan")] * 16), (6, np.diag([2.0, 4, 2, 1]).ravel().tolist()), (7, None)]
    got = {r.id: r for r in checks.affine_audit(spark.createDataFrame(rows, "id int, matrix array<double>")).collect()}
    assert (round(got[0].determinant, 9), round(got[0].scale, 9), got[0].orthonormal, got[0].uniform, got[0].right_handed) == (8.0, 2.0, True, True, True)
    assert (got[1].orthonormal, got[1].issue) == (False, None) and (got[6].uniform, got[6].anisotropy, got[6].orthonormal) == (False, 2.0, True)
    assert [got[k].issue for k in (2, 3, 4, 5, 7)] == ["turns orientation", "not affine", "not finite", "not finite", "not finite"] and got[2].determinant is None


def test_views_quality_and_cameras(spark):
    crop = "object_id int, frame_id int, area int, x0 int, y0 int, x1 int, y1 int, w int, h int, support_ratio double, coverage double, fill double, sharpness double, support_points int"
    rows = [(1, 1, 90, 0, 5, 50, 40, 96, 72, 1.0, 1.0, 0.62, 1.0, 10), (1, 2, 50, 5, 5, 50, 40, 96, 72, 1.0, 1.0, 0.62, 1.0, 10), (1, 3, 50, 6, 6, 50, 40, 96, 72, 1.0, 1.0, 0.62, 1.0, 10), (2, 4, 9, 0, 0, 96, 72, 96, 72, 0.5, 0.25, 0.0, 2.0, 0)]
    df = spark.createDataFrame(rows, crop)
    assert {(r.object_id, r.frame_id, r.area, r.refused) for r in checks.largest_eligible_view(df).collect()} == {(1, 2, 50, False), (2, None, None, True)}
    q = {r.frame_id: r for r in checks.selection_quality(df).collect()}
    assert q[2].quality == pytest.approx(1.0) and q[1].sides == 1 and q[1].quality == pytest.approx(0.82) and q[4].sides == 4
    assert q[4].quality == pytest.approx((0.42 * 0.5 + 0.32 * 0.5 + 0.16) * 0.28)
    assert q[2].rank_score == pytest.approx(math.sqrt(35) * (1 + math.log1p(10) / 18))
    cams = spark.createDataFrame([(0, 100.0, 110.0, 50.0, 40.0, 100, 80), (0, 104.0, 110.0, 50.0, 40.0, 100, 80), (1, 100.0, 100.0, 50.0, 40.0, 100, 80), (1, 150.0, 100.0, 50.0, 40.0, 100, 80)], "scene int, fx double, fy double, cx double, cy double, w int, h int")
    from pyspark.sql import functions as F

    got = {r.scene: r for r in checks.common_intrinsics(checks.resize_intrinsics(cams, F.lit(50), F.lit(80)), ["scene"]).collect()}
    assert (got[0].fx, got[0].fy, got[0].cx, got[0].common) == (51.0, 110.0, 25.0, True) and got[1].common is False and got[0].spread == pytest.approx(1 / 51)


def test_trim_and_unchanged(spark):
    pts = spark.createDataFrame([("a", i, float(i % 3), 0.0, 0.0) for i in range(50)] + [("a", 99, 90.0, 0.0, 0.0)], "label string, point_id int, x double, y double, z double")
    assert {r.point_id for r in checks.robust_trim(pts, ["label"]).collect()} == set(range(50))
    rows = [(f, y, x, 10, 20, 30) for f in (0, 1) for y in range(20) for x in range(20)]
    px = spark.createDataFrame(rows, "frame_id int, y int, x int, r int, g int, b int")
    mask = px.where("y = 10 AND x = 10")
    out = px.selectExpr("frame_id", "y", "x", "CASE WHEN y BETWEEN 8 AND 12 AND x BETWEEN 8 AND 12 THEN r + 9 WHEN frame_id = 1 THEN r + 3 ELSE r END AS r", "g", "b")
    got = {r.frame_id: (r.inside, r.outside, r.passed) for r in checks.outside_unchanged(px, out, mask).collect()}
    assert got == {0: (3.0, 0.0, True), 1: (3.0, 1.0, False)}
    s = checks.colour_stats(px, ["frame_id"]).first()
    assert (s.n, s.mean_g, s.std_b, s.p90_r) == (400, 20.0, 0.0, 10.0)


def test_masks_are_not_broadcast(spark):
    """A dilated mask looks as small to Spark as the mask's own pixels, which few bytes hold."""
    from pyspark.sql import functions as F

    px = spark.range(40 * 40 * 3).select((F.col("id") % 3).alias("frame_id"), (F.col("id") / 3 % 40).cast("int").alias("y"), (F.col("id") / 120).cast("int").alias("x"), *(F.lit(7).alias(c) for c in "rgb"))
    out = checks.outside_unchanged(px, px.withColumn("r", F.col("r") + F.when(F.col("x") < 20, 6).otherwise(0)), px.where("x BETWEEN 5 AND 19 AND y BETWEEN 5 AND 30"))
    got = {r.frame_id: (r.n_inside, r.n_outside, r.inside, r.passed) for r in out.collect()}
    assert got == {f: (15 * 26, 1600 - 23 * 34, 2.0, True) for f in range(3)}
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
