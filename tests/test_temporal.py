"""Flow validity, pairs and triplets against plain arrays: a static sequence, flicker, bad flow, a flat ring."""

import numpy as np
import pytest

from scenetable.operators import temporal

H, W = 30, 36
FLOW = "src int, dst int, y int, x int, dx double, dy double"
PLACES = [(y, x) for y in range(H) for x in range(W)]


def region(y, x):
    core = 11 <= y < 19 and 13 <= x < 23
    ring = 4 <= y < 26 and 5 <= x < 31 and not (8 <= y < 22 and 9 <= x < 27)
    return "core" if core else "control" if ring else None


def frames(spark, images, flow):
    regions = spark.createDataFrame([(f, y, x, region(y, x)) for f in images for y, x in PLACES if region(y, x)], "frame_id int, y int, x int, region string")
    sizes = spark.createDataFrame([(f, W, H) for f in images], "frame_id int, w int, h int")
    pixels = spark.createDataFrame([(f, y, x, *map(float, a[y, x])) for f, a in images.items() for y, x in PLACES], "frame_id int, y int, x int, r double, g double, b double")
    steps = spark.createDataFrame([(s, d, y, x, float(v[y, x, 0]), float(v[y, x, 1])) for (s, d), v in flow.items() for y, x in PLACES], FLOW)
    return steps, regions, sizes, pixels


def pattern(shift=0.0, gain=1.0, offset=0.0):
    y, x = np.mgrid[0:H, 0:W].astype(float)
    return np.stack([60 + 3 * (x - shift) + y, 80 + (x - shift) + 2 * y, 90 + 2 * (x - shift) - y], -1) * gain + offset


def moved(dx):
    return np.stack([np.full((H, W), dx), np.zeros((H, W))], -1)


def bilinear(a, x, y):
    x, y = np.clip(x, 0, W - 1), np.clip(y, 0, H - 1)
    x0, y0 = np.floor(x).astype(int), np.floor(y).astype(int)
    x1, y1 = np.minimum(x0 + 1, W - 1), np.minimum(y0 + 1, H - 1)
    u, v = (x - x0)[..., None], (y - y0)[..., None]
    return (a[y0, x0] * (1 - u) + a[y0, x1] * u) * (1 - v) + (a[y1, x0] * (1 - u) + a[y1, x1] * u) * v


def test_validity_equals_the_formula(spark):
    rng = np.random.default_rng(8)
    flow = {(0, 1): rng.normal(0, 2, (H, W, 2)), (1, 0): rng.normal(0, 2, (H, W, 2))}
    flow[1, 0][:, :18] = -1.0
    flow[0, 1][:, :18] = 1.0
    steps, regions, sizes, _ = frames(spark, {0: pattern(), 1: pattern()}, flow)
    got = {(r.src, r.dst, r.y, r.x): r for r in temporal.flow_validity(steps, regions, sizes).collect()}
    for (s, d), v in flow.items():
        y, x = np.mgrid[0:H, 0:W].astype(float)
        tx, ty = x + v[..., 0], y + v[..., 1]
        error = np.linalg.norm(v + bilinear(flow[d, s], tx, ty), axis=2)
        inside = (tx >= 0) & (tx <= W - 1) & (ty >= 0) & (ty <= H - 1)
        consistent = inside & (error <= 1.5 + 0.01 * np.linalg.norm(v, axis=2))
        for a, b in PLACES:
            if region(a, b):
                r = got[s, d, a, b]
                hit = inside[a, b] and region(int(np.clip(np.rint(ty[a, b]), 0, H - 1)), int(np.clip(np.rint(tx[a, b]), 0, W - 1))) == region(a, b)
                assert (r.consistent, r.overlap, r.valid) == (consistent[a, b], hit, hit and consistent[a, b]) and r.fb_error == pytest.approx(error[a, b])
    assert {r.valid for r in got.values()} == {True, False}


def test_gradient(spark):
    rng = np.random.default_rng(1)
    image = rng.uniform(0, 255, (H, W, 3))
    got = {(r.y, r.x): (r.r, r.g, r.b) for r in temporal.colour_gradient(frames(spark, {0: image}, {(0, 0): moved(0)})[3]).collect()}
    p = np.pad(image, ((1, 1), (1, 1), (0, 0)), mode="edge")
    gx = sum(k * (p[i : i + H, 2:] - p[i : i + H, :-2]) for i, k in enumerate((1, 2, 1))) / 8
    gy = sum(k * (p[2:, i : i + W] - p[:-2, i : i + W]) for i, k in enumerate((1, 2, 1))) / 8
    want = np.sqrt(gx**2 + gy**2)
    assert all(np.allclose(got[y, x], want[y, x]) for y, x in PLACES)


def test_pairs_and_triplets(spark):
    images = {0: pattern(0), 1: pattern(1, 1.2, 5), 2: pattern(2), 3: pattern(3), 4: pattern(4)}
    images[3] = images[3] + np.array([[60.0 * (region(y, x) == "core") for x in range(W)] for y in range(H)])[..., None] * np.random.default_rng(3).uniform(0.4, 1, (H, W, 1))
    images[4] = np.full((H, W, 3), 77.0)
    flow = {(a, b): moved(float(b - a)) for a in range(5) for b in (a - 1, a + 1) if 0 <= b < 5}
    steps, regions, sizes, pixels = frames(spark, images, flow)
    limits = {"region_pixels": 40}
    pairs, valid = temporal.temporal_pairs(steps, regions, sizes, pixels, limits)
    got = {(r.src, r.dst): r for r in pairs.collect()}
    assert all(got[k].passed and got[k].evaluable and got[k].core_colour_p95 < 1e-9 for k in ((0, 1), (1, 0), (1, 2), (2, 1)))
    assert not got[2, 3].passed and "core_colour_p95" in got[2, 3].failed_gates and "core_excess_p95" in got[2, 3].failed_gates and got[2, 3].control_colour_p95 < 1e-9
    assert (got[3, 4].evaluable, got[3, 4].passed, got[3, 4].failed_gates) == (False, False, None) and "ill-conditioned" in got[3, 4].reason
    triplets = spark.createDataFrame([(k - 1, k, k + 1) for k in (1, 2, 3)], "previous int, centre int, following int")
    out = {r.centre: r for r in temporal.temporal_triplets(triplets, valid, regions, temporal.flow_validity(steps, regions, sizes), limits).collect()}
    assert out[1].passed and out[1].core_mean < 1e-9
    assert out[2].evaluable and not out[2].passed and "triplet_excess_p95" in out[2].failed_gates
    assert (out[3].evaluable, out[3].passed, out[3].reason) == (False, False, "an exposure fit is missing")
    few = temporal.temporal_pairs(steps, regions, sizes, pixels)[0].first()  # the production limit of region pixels
    assert (few.evaluable, few.passed, few.reason) == (False, False, "too few valid core pixels")


def test_inconsistent_flow_fails_closed(spark):
    images = {0: pattern(0), 1: pattern(1)}
    steps, regions, sizes, pixels = frames(spark, images, {(0, 1): moved(1.0), (1, 0): moved(3.0)})
    out = temporal.temporal_pairs(steps, regions, sizes, pixels, {"region_pixels": 40})[0].collect()
    assert len(out) == 2 and not any(r.evaluable or r.passed for r in out) and {r.core_valid for r in out} == {0}


def test_affine_rejects_the_implausible():
    x = np.linspace(0, 100, 200)
    y = 1.3 * x - 7
    y[::9] += 90
    a, b = temporal.robust_affine(x, y)
    assert abs(a - 1.3) < 0.01 and abs(b + 7) < 0.5
    assert "bounds" in temporal.robust_affine(x, 3 * x) and "ill" in temporal.robust_affine(np.ones(50), y[:50]) and "two" in temporal.robust_affine(x[:1], y[:1])


def test_exploded_images_are_not_broadcast(spark):
    """An image made by exploding few rows looks as small as those to Spark."""
    from pyspark.sql import functions as F

    steps = F.explode(F.sequence(F.lit(0), F.lit(5)))
    image = spark.range(3).select(F.col("id").alias("frame_id"), steps.alias("y")).select("*", steps.alias("x"), F.lit(1.0).alias("v"))
    at = image.selectExpr("frame_id AS src", "frame_id AS dst", "y", "x", "x + 0.5 AS tx", "y + 0.5 AS ty", "6 AS w", "6 AS h")
    out = temporal.gather(at, image, {"dst": "frame_id"}, ["v"])
    assert out.count() == 108 and "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def _dealt_by(df):
    """The columns by which the plan of `df` deals rows."""
    import re

    return {c for keys in re.findall(r"hashpartitioning\(([^)]*)\)", df._jdf.queryExecution().executedPlan().toString()) for c in re.findall(r"([A-Za-z_]\w*)#", keys)}


def test_flows_are_written_and_shuffled_as_packed_images(spark, monkeypatch):
    rng = np.random.default_rng(4)
    flow = {k: rng.normal(0, 2, (H, W, 2)) for k in ((0, 1), (1, 0), (1, 2), (2, 1), (2, 3))}  # nothing leads back from 3, which has no regions
    steps, regions, sizes, _ = frames(spark, {0: pattern(), 1: pattern(), 2: pattern()}, flow)
    written, plain = [], temporal.checkpointed
    monkeypatch.setattr(temporal, "checkpointed", lambda df: written.append(plain(df)) or written[-1])
    out = temporal.flow_validity(steps.coalesce(1), regions, sizes)
    assert [w.count() for w in written] == [len(flow)] and not {"y", "x"} & _dealt_by(out)
    rows = {(r.src, r.dst, r.y, r.x): r for r in out.collect()}
    scattered = temporal.flow_validity(steps.repartition(5, "y", "x"), regions.repartition(3, "x"), sizes)
    assert {(r.src, r.dst, r.y, r.x): r for r in scattered.collect()} == rows
    assert len(rows) == len(flow) * sum(region(*p) is not None for p in PLACES)
    assert all(r.fb_error is None and not (r.consistent or r.overlap or r.valid) for k, r in rows.items() if k[:2] == (2, 3))


def test_packed_pixels_come_back(spark):
    rows = [(f"k{i % 3}", i % 2, i // 7, i % 7, None if i == 5 else i * 0.37, float("nan") if i == 6 else -i) for i in range(50)] + [(None, 0, 1, 1, 1.0, 1.0), ("k0", 0, None, 1, 1.0, 1.0)]
    df = spark.createDataFrame([(*r[:5], float(r[5])) for r in rows], "name string, part int, y int, x int, dx double, dy double")
    got = {}
    for r in temporal.packed(df, ["name", "part"], temporal._FLOW).collect():
        y, x, dx, dy = temporal._unpacked(r.n, bytes(r.blob), temporal._FLOW)
        got |= {(r.name, r.part, *p): (u, v) for *p, u, v in zip(y.tolist(), x.tolist(), dx.tolist(), dy.tolist(), strict=True)}
    assert set(got) == {r[:4] for r in rows[:50]}
    assert all(got[r[:4]] == pytest.approx((np.nan if r[4] is None else r[4], r[5]), nan_ok=True) for r in rows[:50])


def test_pairs_write_and_shuffle_packed_images_only(spark, monkeypatch):
    images = {f: pattern(f) for f in range(3)}
    steps, regions, sizes, pixels = frames(spark, images, {(a, b): moved(float(b - a)) for a in range(3) for b in (a - 1, a + 1) if 0 <= b < 3})
    written, plain = [], temporal.checkpointed
    monkeypatch.setattr(temporal, "checkpointed", lambda df: written.append(plain(df)) or written[-1])
    pairs, valid = temporal.temporal_pairs(steps.coalesce(1), regions, sizes, pixels, {"region_pixels": 40})
    assert [w.count() for w in written] == [4] and not {"y", "x"} & (_dealt_by(pairs) | _dealt_by(valid))
    assert all(r.passed for r in pairs.collect()) and {(r.src, r.dst) for r in valid.select("src", "dst").distinct().collect()} == {(0, 1), (1, 0), (1, 2), (2, 1)}
    assert valid.where("region = 'core'").first().asDict().keys() == {"src", "dst", "y", "x", "region", "r", "g", "b", "fixed_r", "fixed_g", "fixed_b", "colour", "slope"}


def test_triplets_shuffle_packed_pixels_only(spark):
    images = {f: pattern(f) for f in range(4)}
    images[2] = images[2] + 8.0 * (np.arange(W) % 2)[None, :, None]
    steps, regions, sizes, pixels = frames(spark, images, {(a, b): moved(float(b - a)) for a in range(4) for b in (a - 1, a + 1) if 0 <= b < 4})
    limits = {"region_pixels": 40}
    valid = temporal.temporal_pairs(steps, regions, sizes, pixels, limits)[1]
    triplets = spark.createDataFrame([(0, 1, 2), (1, 2, 3), (5, 6, 7)], "previous int, centre int, following int")
    out = temporal.temporal_triplets(triplets, valid, regions, temporal.flow_validity(steps, regions, sizes), limits)
    assert not {"y", "x"} & _dealt_by(out)
    held = {(r.src, r.dst, r.y, r.x): r for r in valid.collect()}
    got = {r.centre: r for r in out.collect()}
    for p, c, n in ((0, 1, 2), (1, 2, 3)):
        off = {k: [] for k in ("core", "control")}
        for (s, d, y, x), r in held.items():
            if (s, d) == (c, p) and (o := held.get((c, n, y, x))):
                off[r.region].append(sum(abs(r[k] - (r[f"fixed_{k}"] + o[f"fixed_{k}"]) / 2) for k in "rgb") / 3)
        assert (got[c].core_valid, got[c].control_valid) == (len(off["core"]), len(off["control"]))
        assert got[c].core_mean == pytest.approx(np.mean(off["core"])) and got[c].control_difference_p95 == pytest.approx(np.quantile(off["control"], 0.95))
    assert (got[6].core_valid, got[6].evaluable, got[6].reason) == (0, False, "too few valid core pixels")
