"""Association by geometry, evidence from separated views, votes with anchors."""

import numpy as np
import pytest

from scenetable.operators import associate, match, visibility

CAM = "frame_id string, fx double, fy double, cx double, cy double, w int, h int, r array<double>, t array<double>"
EYE = np.eye(3).ravel().tolist()


def planted(spark, shifts=(-0.6, 0.0, 0.6), residue=True):
    """Two 31 x 27 grids of points; the masks' names suggest the wrong object."""
    cams = [(f"{k:06d}", 80.0, 80.0, 48.0, 36.0, 96, 72, EYE, [-s, 0.0, 0.0]) for k, s in enumerate(shifts)]
    points = [(name, x0 + 0.02 * (i - 15), 0.02 * (j - 13), 5.0) for name, x0 in (("a", -0.75), ("b", 0.75)) for i in range(31) for j in range(27)]
    pts = spark.createDataFrame(points, "obj string, x double, y double, z double")
    cameras = spark.createDataFrame(cams, CAM)
    seen = visibility.project_points(pts, cameras)
    masks, found = [], []
    for k, s in enumerate(shifts):
        for name, x0, detection, score in (("a", -0.75, "b_1", 0.96), ("b", 0.75, "a_1", 0.95)):
            if name == "b" and not residue:
                continue
            xs = np.rint(80 * (x0 + 0.02 * (np.arange(31) - 15) - s) / 5 + 48).astype(int)
            ys = np.rint(80 * (0.02 * (np.arange(27) - 13)) / 5 + 36).astype(int)
            box = [(f"{k:06d}", detection, y, x) for y in range(ys.min() - 1, ys.max() + 2) for x in range(xs.min() - 1, xs.max() + 2) if 0 <= x < 96]
            masks += box
            found.append((f"{k:06d}", detection, score))
    return pts, seen, cameras, spark.createDataFrame(masks, "frame_id string, detection_id string, y int, x int"), spark.createDataFrame(found, "frame_id string, detection_id string, score double")


def test_matches_follow_geometry_not_names(spark):
    nobody = spark.createDataFrame([], "obj string")
    pairs, objects, warnings = associate.associate(*planted(spark), nobody, dilation=1)
    got = {(r.frame_id, r.obj): r.detection_id for r in pairs.where("matched").collect()}
    assert got == {(f"{k:06d}", o): d for k in range(3) for o, d in (("a", "b_1"), ("b", "a_1"))}
    assert all(r.hit_ratio >= 0.95 and r.support_ratio >= 0.95 and r.iou >= 0.5 and r.n_visible >= 20 for r in pairs.where("matched").collect())
    assert {(r.obj, r.disposition, r.n_matches, len(r.evidence)) for r in objects.collect()} == {("a", "accepted_next_layer_target", 3, 2), ("b", "accepted_next_layer_target", 3, 2)} and warnings.count() == 0


def test_peeled_objects_only_warn_and_still_cameras_fail(spark):
    peeled = spark.createDataFrame([("b",)], "obj string")
    pairs, objects, warnings = associate.associate(*planted(spark), peeled, dilation=1)
    assert {r.obj: r.disposition for r in objects.collect()} == {"a": "accepted_next_layer_target", "b": "peeled_residual_warning"} and warnings.count() == 3
    pairs, objects, _ = associate.associate(*planted(spark, (0.0, 0.0, 0.0), residue=False), peeled, dilation=1)
    assert {r.obj: (r.disposition, r.n_matches) for r in objects.collect()} == {"a": ("failed_insufficient_separated_evidence", 3), "b": ("peeled_absent_as_expected", 0)}


@pytest.mark.parametrize(("count", "both"), [(1, True), (2, True), (3, True), (2, False)])
def test_separated_evidence_equals_all_sets(spark, count, both):
    rng = np.random.default_rng(count)
    rows = []
    for o in range(6):
        for f in range(9):
            rows.append((o, f, float(np.round(rng.uniform(0, 1), 1)), *map(float, rng.uniform(0, 0.2, 3)), *map(float, rng.normal(size=3) * 0.1 + [0, 0, 1])))
    df = spark.createDataFrame(rows, "object_id int, frame_id int, score double, px double, py double, pz double, dx double, dy double, dz double")
    got = {}
    for r in match.separated_evidence(df, 0.10, 5.0, count, both).collect():
        got.setdefault(r.object_id, set()).add(r.frame_id)
    for o in range(6):
        own = sorted((r for r in rows if r[0] == o), key=lambda r: (-r[2], r[1]))

        def apart(a, b):
            base = np.linalg.norm(np.array(a[3:6]) - b[3:6]) >= 0.10
            u, v = np.array(a[6:]), np.array(b[6:])
            angle = np.degrees(np.arccos(np.clip(u @ v / np.linalg.norm(u) / np.linalg.norm(v), -1, 1))) >= 5.0
            return base and angle if both else base or angle

        best = None
        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                if count > 1 and apart(a, b):
                    chosen = [a, b]
                    for c in own:
                        if len(chosen) < count and c not in chosen and all(apart(c, d) for d in chosen):
                            chosen.append(c)
                    key = (sum(c[2] for c in chosen), tuple(c[1] for c in chosen))
                    if len(chosen) == count and (best is None or key[0] > best[0] + 1e-12 or abs(key[0] - best[0]) <= 1e-12 and key[1] > best[1]):
                        best = key
        want = {own[0][1]} if count == 1 else set(best[1]) if best else None
        assert got.get(o) == want


def test_votes_need_mask_anchor_and_depth(spark):
    cams = spark.createDataFrame([(f"{k}", 10.0, 10.0, 16.0, 16.0, 32, 32, EYE, [-0.1 * k, 0.0, 0.0]) for k in range(2)], CAM)
    points = spark.createDataFrame([(0, 0.01, 0.0, 5.01), (1, 0.02, 0.0, 5.075), (2, 1.01, 0.0, 5.01), (3, 3.0, 0.0, 5.0)], "point_id long, x double, y double, z double")
    anchors = spark.createDataFrame([(0, 0.0, 0.0, 5.0), (1, 1.0, 0.0, 5.0)], "anchor_id long, x double, y double, z double")
    everywhere = spark.createDataFrame([(f"{k}", x, y) for k in range(2) for x in range(32) for y in range(32)], "frame_id string, px int, py int")
    run = lambda m, **k: {r.point_id: (r.anchor_id, r.matched, r.votes, r.carved) for r in visibility.anchored_votes(points, anchors, cams, m, **k).collect()}
    assert run(everywhere) == {0: (0, 2, 2, True), 1: (0, 2, 2, True), 2: (1, 2, 2, True)}
    assert run(everywhere, depth_tolerance=0.05)[1] == (0, 2, 0, False)
    assert run(everywhere.where("frame_id = '0'"))[0] == (0, 1, 1, False)
    assert run(everywhere.where("px > 17")) == {0: (0, 0, 0, False), 1: (0, 0, 0, False), 2: (1, 2, 2, True)}


def test_culled_projection_is_the_same(spark):
    rng = np.random.default_rng(12)
    cams = []
    for k in range(6):
        q = np.linalg.qr(rng.normal(size=(3, 3)))[0]
        cams.append((str(k), 30.0, 40.0, 10.0, 9.0, 24, 18, (q * np.sign(np.linalg.det(q))).ravel().tolist(), rng.normal(size=3).tolist()))
    cameras = spark.createDataFrame(cams, CAM)
    points = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(rng.uniform(-4, 4, (3000, 3)))], "point_id long, x double, y double, z double")
    whole = {tuple(r) for r in visibility.project_points(points, cameras).collect()}
    for cell in (0.3, 1.0, 20.0):
        assert {tuple(r) for r in visibility.project_points(points, cameras, cell).collect()} == whole
    assert len(whole) > 100
