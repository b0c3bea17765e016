"""Nearest others and parts under a radius, against all pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from scenetable.operators import carve, spacing


def _parts(rows, radius):
    label = {p: p for p, *_ in rows}
    changed = True
    while changed:
        changed = False
        for p, *a in rows:
            for q, *b in rows:
                if label[p] != label[q] and sum((x - y) ** 2 for x, y in zip(a, b, strict=True)) <= radius * radius:
                    label[p] = label[q] = min(label[p], label[q])
                    changed = True
    return label


def _cloud(seed, n, dims, spread):
    rng = random.Random(seed)
    heavy = [tuple(rng.gauss(0, 0.05) for _ in range(dims)) for _ in range(n // 3)]
    wide = [tuple(rng.uniform(-spread, spread) for _ in range(dims)) for _ in range(n - n // 3)]
    return [(i, *p) for i, p in enumerate([*heavy, *wide, wide[0], wide[1]])]


@pytest.mark.parametrize(("dims", "spread", "radius"), [(2, 4.0, 0.45), (3, 3.0, 0.7)])
def test_parts_equal_all_pairs(spark, dims, spread, radius):
    axes = "uvw"[:dims]
    rows = _cloud(dims, 240, dims, spread)
    df = spark.createDataFrame(rows, "point_id long, " + ", ".join(f"{a} double" for a in axes)).withColumn("g", F.lit("one"))
    # A second group at the same places but half of them: groups never mix.
    half = df.where("point_id % 2 = 0").withColumn("point_id", F.col("point_id") + 1000).withColumn("g", F.lit("two"))
    got = {r.point_id: r.part for r in spacing.radius_parts(df.union(half), ["g"], radius, axes).collect()}
    want = _parts(rows, radius) | _parts([(p + 1000, *c) for p, *c in rows if p % 2 == 0], radius)
    assert len(set(want.values())) > 10
    assert got == want


def test_cells_that_boxes_cannot_tell(spark):
    """Two dense rows of points in facing cells, just within and just out of reach; equality links."""
    for gap, parts in ((1.0, 1), (1.0 + 1e-9, 2)):
        left = [(i, -i * 1e-4, j * 0.01) for i, j in enumerate(range(50))]
        right = [(100 + i, gap + i * 1e-4, 0.3 - j * 0.011) for i, j in enumerate(range(50))]
        rows = [*left, *right, (200, 0.0, 0.9), (201, gap, 0.9)]
        df = spark.createDataFrame(rows, "point_id long, u double, v double")
        got = {r.point_id: r.part for r in spacing.radius_parts(df, [], 1.0).collect()}
        assert got == _parts(rows, 1.0)
        assert len(set(got.values())) == parts


def test_a_long_chain_is_one_part(spark):
    df = spark.range(3000).select(F.col("id").alias("point_id"), (F.col("id") * 0.9).alias("u"), F.lit(0.0).alias("v"))
    assert {r.part for r in spacing.radius_parts(df, [], 1.0).select("part").distinct().collect()} == {0}


def test_nearest_other_equals_all_pairs(spark):
    rng = random.Random(5)
    rows = [("a", i, *(rng.gauss(0, 1) * 10 ** rng.randint(-4, 2) for _ in range(3))) for i in range(300)]
    rows += [("b", 1000 + i, i * 1e-6, 0.0, 0.0) for i in range(100)] + [("b", 2000, 500.0, 0.0, 0.0), ("b", 2001, 500.0, 0.0, 0.0), ("c", 3000, 1.0, 1.0, 1.0)]
    rows.append(rows[0])
    df = spark.createDataFrame([*rows, ("c", 3001, None, 1.0, 1.0), ("c", 3002, float("nan"), 1.0, 1.0)], "g string, point_id long, x double, y double, z double")
    got = {r.point_id: r.d for r in spacing.nearest_other(df, ["g"], crowd=4).collect()}
    unique = sorted(set(rows), key=lambda r: r[1])
    for g, p, *a in unique:
        near = [math.dist(a, b) for h, q, *b in unique if h == g and q != p]
        assert (got[p] == pytest.approx(min(near), rel=1e-12)) if near else got[p] is None
    assert len(got) == len(unique)


def test_largest_part_and_report(spark):
    rows = [(0, 0.0, 0.0, 5.0), (1, 0.5, 0.0, -7.0), (2, 1.0, 0.0, 0.0), (3, 9.0, 0.0, 0.0), (4, 9.5, 0.0, 0.0), (5, 9.5, 0.4, 0.0), (6, 30.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "point_id long, x double, y double, z double")
    kept, report = spacing.largest_planar_part(df.withColumn("g", F.lit(1)), ["g"], [0.0, 0.0, 2.0], 0.6)
    assert sorted(r.point_id for r in kept.collect()) == [0, 1, 2]  # of equal parts the one with the least point
    r = report.first()
    assert (r.n_points, r.n_parts, r.largest, r.second) == (7, 3, 3, 3)
    assert (r.fraction, r.minimum, r.median, r.maximum) == (pytest.approx(3 / 7), pytest.approx(0.4), pytest.approx(0.5), pytest.approx(20.5))
    none, empty = spacing.largest_planar_part(df.limit(0).withColumn("g", F.lit(1)), ["g"], [0.0, 0.0, 1.0], 0.6)
    assert none.count() == empty.count() == 0
    with pytest.raises(ValueError, match="radius"):
        spacing.radius_parts(df, [], 0.0, "xy")
    with pytest.raises(ValueError, match="normal"):
        spacing.in_plane(df, [0.0, 0.0, 0.0])


def test_objects_take_what_is_near_their_own_anchors(spark):
    rng = random.Random(9)
    points = [(i, *(rng.uniform(0, 4) for _ in range(3))) for i in range(1500)]
    anchors = [(o, *(rng.uniform(lo, lo + 2.5) for _ in range(3))) for o, lo, n in (("bed", 0, 60), ("rug", 1, 200)) for _ in range(n)]
    anchors += [("bed", 1 + rng.random() * 0.05, 1.0, 1.0) for _ in range(80)] + [anchors[0]]
    boxes = [("bed", 1, *[0.0, 2.5] * 3), ("rug", 0, *[1.0, 3.5] * 3)]
    box = "object_id string, ord int, x0 double, x1 double, y0 double, y1 double, z0 double, z1 double"
    frame = lambda rows, kind: spark.createDataFrame(rows, kind)
    args = frame(points, "point_id long, x double, y double, z double"), frame(boxes, box), frame(anchors, "object_id string, x double, y double, z double")
    want = {}
    for i, *p in points:
        for o, _, *b in sorted(boxes, key=lambda r: r[1]):
            if all(lo <= c <= hi for c, lo, hi in zip(p, b[::2], b[1::2], strict=True)) and any(math.dist(p, q) <= 0.35 for a, *q in anchors if a == o):
                want[i] = o
                break
    assert {r.point_id: r.object_id for r in carve.carve_objects(*args, 0.35).collect()} == want
    assert min(list(want.values()).count(o) for o in ("bed", "rug")) >= 25
    lone = args[1].union(frame([("lamp", 2, *[0.0, 4.0] * 3)], box))
    with pytest.raises(ValueError, match=r"lamp \(0\)"):
        carve.carve_objects(args[0], lone, args[2], 0.35)
    wide = carve.grown(args[1].where("ord = 1"), 0.1, 0.5).first()
    assert (wide.x0, wide.x1) == (-0.75, 3.25)


def test_points_of_one_place_are_looked_at_once(spark, monkeypatch):
    points = spark.range(3000).selectExpr("id AS point_id", "(id % 10) * 1.0D AS x", "0.0D AS y", "0.0D AS z")
    boxes = spark.createDataFrame([("a", 1, 0.0, 6.0), ("b", 0, 5.0, 9.0)], "object_id string, ord int, x0 double, x1 double").selectExpr("*", "-1.0D AS y0", "1.0D AS y1", "-1.0D AS z0", "1.0D AS z1")
    anchors = spark.createDataFrame([("a", 2.0, 0.3, 0.0), ("a", 5.0, 0.0, 0.2), ("a", 8.0, 0.0, 0.0), ("b", 5.0, 0.5, 0.0), ("b", 7.0, 0.0, -0.51)], "object_id string, x double, y double, z double")
    looked, plain = [], carve.near_objects
    monkeypatch.setattr(carve, "near_objects", lambda places, *rest: looked.append(places.count()) or plain(places, *rest))
    taken = carve.carve_objects(points, boxes, anchors, 0.5).groupBy("object_id").agg(F.count("*").alias("n"), F.min(F.col("point_id") % 10).alias("lo"), F.max(F.col("point_id") % 10).alias("hi")).collect()
    assert sorted(map(tuple, taken)) == [("a", 300, 2, 2), ("b", 300, 5, 5)]
    assert looked == [10]
