"""What keeps the work of a query from growing faster than its tables."""

import random

import numpy as np
from pyspark.sql import functions as F

from scenetable.functions.register import RasterTriangle
from scenetable.operators import consensus, distance, graph, neighbors, pixels, planes, visibility
from scenetable.plans import derived, registry

PIXEL = "frame_id long, y int, x int"


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_parts_within_a_band_need_no_rounds(spark, monkeypatch):
    snake = {(y, x) for y in range(40) for x in range(9) if y % 2 == 0 or x == (8 if y % 4 == 1 else 0)}
    written, plain = [], pixels.checkpointed
    monkeypatch.setattr(pixels, "checkpointed", lambda df: written.append(1) or plain(df))
    out = pixels.connected_components(spark.createDataFrame([(1, *p) for p in sorted(snake)], PIXEL))
    assert out.select("label").distinct().count() == 1 and out.count() == len(snake)
    assert len(written) == 3


def test_parts_over_bands_are_joined(spark):
    rng = random.Random(4)
    cells = {(y, x) for y in range(-70, 200) for x in range(12) if rng.random() < 0.62}
    for eight in (False, True):
        steps = [(0, 1), (1, 0), (0, -1), (-1, 0)] + ([(1, 1), (1, -1), (-1, 1), (-1, -1)] if eight else [])
        want, left = set(), set(cells)
        while left:
            part, todo = set(), [left.pop()]
            while todo:
                y, x = todo.pop()
                part.add((y, x))
                near = {(y + a, x + b) for a, b in steps} & left
                left -= near
                todo += near
            want.add(frozenset(part))
        got = {}
        for r in pixels.connected_components(spark.createDataFrame([(1, *p) for p in cells], PIXEL), eight).collect():
            got.setdefault(r.label, set()).add((r.y, r.x))
        assert {frozenset(v) for v in got.values()} == want


def test_distances_shuffle_mask_pixels_not_copies(spark):
    mask = spark.range(64 * 64).selectExpr("1L AS frame_id", "CAST(id div 64 AS INT) AS y", "CAST(id % 64 AS INT) AS x")
    plan = _plan(distance.bounded_distance(mask, 8))
    assert "REPARTITION_BY_NUM" in plan and "HashAggregate" not in plan and "Window" not in plan


def test_boxes_and_triangles_are_dealt_before_they_grow(spark):
    sf = "/root/testdata/sf0.001"
    from scenetable.plans import grids

    assert "REPARTITION_BY_NUM" in _plan(grids._box(spark, sf, "a"))
    assert "REPARTITION_BY_NUM" in _plan(registry.queries()["raster_in_sql"](spark, sf))
    assert derived.parts(spark, 10 * derived.PART_ROWS) == 10


def test_triangle_pixels_in_blocks_of_rows():
    corners = (1.0, 0.0, 900.0, 40.0, 30.0, 500.0)
    raster = RasterTriangle.func if hasattr(RasterTriangle, "func") else RasterTriangle
    got = list(raster().eval(*corners, 1000, 600))
    y, x = np.mgrid[0:600, 0:1000]
    from scenetable.operators.mesh import inside_triangle

    assert got == [tuple(p) for p in np.argwhere(inside_triangle(x, y, list(corners))).tolist()]
    assert list(raster().eval(-9.0, 0.0, -3.0, 0.0, -5.0, 4.0, 10, 10)) == []


def test_equal_normals_are_summed_before_the_rounds(spark, monkeypatch):
    rows = [(*n, 1.0) for n in ((1.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, 0.0, -1.0)) for _ in range(40)]
    faces = spark.createDataFrame(rows, "nx double, ny double, nz double, area double")
    written, plain = [], planes.checkpointed
    monkeypatch.setattr(planes, "checkpointed", lambda df: written.append(plain(df)) or written[-1])
    axes, areas = planes.dominant_axes(faces)
    assert areas == [40.0] * 3 and np.allclose(np.abs(axes).sum(axis=0), 1)
    assert [w.count() for w in written] == [3]


def test_depth_order_projects_a_place_once(spark, monkeypatch):
    from scenetable.operators import visibility

    seen, plain = [], visibility.project_points
    monkeypatch.setattr(visibility, "project_points", lambda points, cameras: seen.append(points) or plain(points, cameras))
    registry.queries()["depth_order"](spark, "/root/testdata/sf0.001")
    assert [p.groupBy(*p.columns).agg(F.count("*").alias("n")).where("n > 1").count() for p in seen] == [0]


def test_nearest_anchors_of_dense_cells_without_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(6)
    near, far = rng.normal(0, 0.01, (500, 3)), rng.normal(0.2, 0.3, (200, 3))
    pts = np.concatenate([near, near[:50], far])
    anc = np.concatenate([rng.normal(0.03, 0.01, (300, 3)), rng.normal(0.2, 0.3, (50, 3)), near[:5], near[:5]])
    monkeypatch.setattr(neighbors, "FEW", 0)
    work, plain = [], neighbors._judged
    monkeypatch.setattr(neighbors, "_judged", lambda pairs, radius: work.append(plain(pairs, radius)) or work[-1])
    frame = lambda rows, name: spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rows)] + [(9000, None, 0.0, 0.0), (9001, float("nan"), 0.0, 0.0)], f"{name} long, x double, y double, z double")
    got = {r.point_id: (r.anchor_id, r.d2) for r in neighbors.nearest_within(frame(pts, "point_id"), frame(anc, "anchor_id"), 0.1).collect()}
    want = {}
    for i, p in enumerate(pts):
        d = (p - anc) ** 2
        d2 = d[:, 0] + d[:, 1] + d[:, 2]
        if d2.min() <= 0.1 * 0.1:
            want[i] = (int(d2.argmin()), float(d2.min()))
    assert got == want
    assert work[-1].agg(F.sum("n")).first()[0] <= neighbors.EACH * len(np.unique(pts, axis=0)) < work[0].agg(F.sum("n")).first()[0]


def test_points_in_many_boxes_are_dealt_once(spark):
    boxes = [(f"m{i:02}", i / 10, 0.0, i / 10 + 1.5, 1.0, 0.5 + i % 2) for i in range(20)] + [("a", 0.0, 0.0, 1.5, 1.0, 0.5)]
    pts = [(i, (i * 7 % 90) / 20 - 0.5, (i * 13 % 30) / 20 - 0.2) for i in range(300)] + [(5, 1.0, 0.5), (400, None, 0.1), (401, float("nan"), 0.1)]
    out = visibility.split_by_boxes(spark.createDataFrame(pts, "point_id long, u double, v double"), spark.createDataFrame(boxes, "mask string, x0 double, y0 double, x1 double, y1 double, score double"))
    assert "REPARTITION_BY_NUM" in _plan(out)
    want = {i: [] for i, *_ in pts}
    for i, u, v in pts:
        for m, x0, y0, x1, y1, score in boxes:
            if u is not None and x0 <= u <= x1 and y0 <= v <= y1:
                du, dv = (u - (x0 + x1) / 2) / max((x1 - x0) / 2, 1.0), (v - (y0 + y1) / 2) / max((y1 - y0) / 2, 1.0)
                want[i].append(((du * du + dv * dv) - score * 1e-9, m))
    assert {r.point_id: (r.label, r.n_boxes) for r in out.collect()} == {i: (min(w)[1] if w else None, len(w)) for i, w in want.items()}


def test_descendants_of_heavy_ancestors(spark, monkeypatch):
    monkeypatch.setattr(graph, "HEAVY", 4)
    met, plain = [], graph._met
    monkeypatch.setattr(graph, "_met", lambda *a, **b: met.append(a[3]) or plain(*a, **b))
    above = {i: (i - 1) // 3 for i in range(1, 120)}
    want = set()
    for i in above:
        at, depth = i, 0
        while at in above:
            at, depth = above[at], depth + 1
            want.add((at, i, depth))
    out = graph.descendants(spark.createDataFrame([(p, i) for i, p in above.items()], "parent long, node long"))
    assert {(r.ancestor, r.node, r.depth) for r in out.collect()} == want and out.count() == len(want)
    assert any(h is not None for h in met)


def test_peeled_layers_are_numbered_in_ranges_and_heavy_fronts_stay(spark, monkeypatch):
    monkeypatch.setattr(graph, "HEAVY", 3)
    nodes = [("hub", 1)] + [(f"n{i:03}", i % 5 if i % 9 else None) for i in range(200)]
    edges = [("gone", f"n{i:03}", 0.9, False) for i in range(200)] + [("hub", f"n{i:03}", 0.9, True) for i in range(200)] + [(f"n{i:03}", "n199", 0.9, True) for i in range(50)]
    out = graph.peel_layers(spark.createDataFrame(nodes, "node string, priority int"), spark.createDataFrame(edges, "front string, back string, confidence double, verified boolean"))
    assert "_range" in _plan(out)
    layer = {n: 0 if n == "hub" else 2 if n == "n199" else 1 for n, _ in nodes}
    want, seen = {}, {}
    for n, _ in sorted(nodes, key=lambda r: (r[1] is None, -(r[1] or 0), r[0])):
        seen[layer[n]] = seen.get(layer[n], 0) + 1
        want[n] = (layer[n], seen[layer[n]])
    assert {r.node: (r.layer, r.place) for r in out.collect()} == want


def test_points_of_a_cloud_are_not_sorted_by_cloud(spark):
    rows = [(c, i + 100 * c, (i * 37 % 50) / 5.0, (i * 11 % 47) / 5.0, 1.0 if i % 4 else 9.0 + i) for c in (0, 1) for i in range(100)]
    kept, report = consensus.consensus_planes(spark.createDataFrame(rows, "cloud int, point_id long, x double, y double, z double"), ["cloud"], trials=64)
    assert "SortMergeJoin [cloud" not in _plan(kept) + _plan(report)
    assert {r.point_id for r in kept.collect()} == {i for _, i, *_, z in rows if z == 1.0}
