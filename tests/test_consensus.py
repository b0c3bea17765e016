"""Consensus planes and densest slabs against plain counting."""

import numpy as np
import pytest

from scenetable.operators import consensus

POINT = "cloud string, point_id long, x double, y double, z double"


def _rows(cloud, base, at):
    return [(cloud, base + i, *map(float, p)) for i, p in enumerate(at)]


def test_planes_are_found_fitted_and_refused(spark):
    rng = np.random.default_rng(3)
    n = np.array([1.0, 2.0, 2.0]) / 3
    e1, e2 = np.array([2.0, 1.0, -2.0]) / 3, np.array([2.0, -2.0, 1.0]) / 3
    uv = rng.uniform(-5, 5, (120, 2))
    glass = uv[:, :1] * e1 + uv[:, 1:] * e2 + 4 * n + rng.normal(0, 0.01, (120, 1)) * n
    behind = rng.uniform(-6, 6, (80, 3)) + 14 * n
    # Points in close pairs: the tolerance is small, and no plane holds 15 % of them.
    alone = rng.uniform(-10, 10, (200, 3))
    alone = np.vstack([alone, alone + 0.01])
    rows = _rows("window", 0, [*glass, *behind]) + _rows("noise", 1000, alone) + _rows("two", 2000, [[0, 0, 0], [1, 1, 1]])
    df = spark.createDataFrame([*rows, rows[0], ("window", 900, None, 1.0, 1.0)], POINT)
    kept, report = consensus.consensus_planes(df, ["cloud"], trials=64)
    found = {r.cloud: r for r in report.collect()}
    assert set(found) == {"window"}
    r = found["window"]
    near = np.sqrt(((np.array([p[2:] for p in rows[:200]])[:, None] - np.array([p[2:] for p in rows[:200]])[None]) ** 2).sum(2))
    np.fill_diagonal(near, np.inf)
    assert r.tolerance == pytest.approx(1.4 * np.median(near.min(1)), rel=1e-9)
    assert abs(np.dot([r.nx, r.ny, r.nz], n)) > 0.9999
    off = np.abs(np.array([p[2:] for p in rows[:200]]) @ [r.nx, r.ny, r.nz] - r.offset)
    assert {x.point_id for x in kept.collect()} == set(np.flatnonzero(off <= r.tolerance).tolist())
    assert r.kept == int((off <= r.tolerance).sum()) >= 120 and r.n_points == 200


def _slab(at, fraction=0.15):
    at = np.array(at)
    local = (at - at.mean(0)) @ np.linalg.eigh(np.cov(at.T))[1][:, ::-1]
    q = np.percentile(local, [2, 98], axis=0)
    width = max((q[1] - q[0])[:2].max() * 0.12, 1e-5)
    counts = {s: int(((local[:, 2] - s >= 0) & (local[:, 2] - s <= width)).sum()) for s in local[:, 2]}
    return width, max(counts.values()), (q[1] - q[0])[2] > width


def test_the_densest_slab(spark):
    rng = np.random.default_rng(4)
    sheet = np.c_[rng.uniform(-6, 6, (150, 2)), rng.normal(0.5, 0.1, 150)]
    mixed = np.vstack([sheet, np.c_[rng.uniform(-6, 6, (150, 2)), rng.uniform(-2, 2, 150)]])
    thin = np.c_[rng.uniform(-6, 6, (40, 2)), rng.normal(0, 0.01, 40)]
    few = rng.uniform(-1, 1, (9, 3))
    clouds = {"mixed": mixed, "thin": thin, "few": few}
    df = spark.createDataFrame([r for i, (k, at) in enumerate(clouds.items()) for r in _rows(k, 1000 * i, at)], POINT)
    kept, report = consensus.densest_slab(df, ["cloud"])
    got = {r.cloud: r for r in report.collect()}
    for name, at in clouds.items():
        width, most, thick = _slab(at)
        assert got[name].width == pytest.approx(width)
        want = ("slab", most) if thick and most >= max(8, np.ceil(len(at) * 0.15)) else ("too_few" if thick else "not_needed", len(at))
        assert (got[name].mode, got[name].kept) == want
    assert {r.mode for r in got.values()} == {"slab", "not_needed", "too_few"}
    assert kept.count() == sum(r.kept for r in got.values())
