"""Fits by rounds of aggregates: robust lines, similarity transforms, principal frames."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def huber_line(rows: DataFrame, keys: list[str], rounds: int = 8, k: float = 1.345) -> DataFrame:
    """Robust gain and offset of y over x for each key, by reweighted least squares.

    Each round is one aggregate of weighted sums; a residual over k * 1.4826 MAD weighs less. Gain is
    held to [0.5, 2] and offset to [-128, 128]; a key without spread in x gets gain 1, offset 0.
    """
    rows = rows.select(*keys, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    fit = None
    for _ in range(rounds):
        if fit is None:
            weighed = rows.withColumn("w", F.lit(1.0))
        else:
            left = rows.join(fit, keys).withColumn("e", F.col("y") - F.col("gain") * F.col("x") - F.col("offset"))
            middle = left.groupBy(*keys).agg(F.percentile("e", 0.5).alias("m"))
            spread = left.join(middle, keys).groupBy(*keys).agg((F.percentile(F.abs(F.col("e") - F.col("m")), 0.5) * 1.4826 * k).alias("cut"))
            weighed = left.join(spread, keys).withColumn("w", F.when(F.abs("e") <= F.greatest("cut", F.lit(1e-9)), 1.0).otherwise(F.greatest("cut", F.lit(1e-9)) / F.abs("e")))
        w, x, y = F.col("w"), F.col("x"), F.col("y")
        sums = weighed.groupBy(*keys).agg(F.sum(w).alias("n"), F.sum(w * x).alias("sx"), F.sum(w * y).alias("sy"), F.sum(w * x * x).alias("sxx"), F.sum(w * x * y).alias("sxy"))
        det = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
        gain = F.when(det > 1e-9 * F.col("n") * F.col("sxx"), F.greatest(F.lit(0.5), F.least(F.lit(2.0), (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / det))).otherwise(1.0)
        fit = sums.withColumn("gain", gain).withColumn("offset", F.when(det > 0, F.greatest(F.lit(-128.0), F.least(F.lit(128.0), (F.col("sy") - F.col("gain") * F.col("sx")) / F.col("n")))).otherwise(0.0)).select(*keys, "gain", "offset")
        fit = checkpointed(fit)
    return fit


def similarity_fit(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Scale, rotation (row-major) and translation that take s to t in least squares, for each key, and the RMSE.

    Rows: sx, sy, sz, tx, ty, tz. One aggregate gives all moments; a 3x3 decomposition of each
    key's moments follows.
    """
    s, t = [f"s{a}" for a in "xyz"], [f"t{a}" for a in "xyz"]
    moments = pairs.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.array(*(F.avg(c) for c in s)).alias("ms"),
        F.array(*(F.avg(c) for c in t)).alias("mt"),
        F.array(*(F.covar_pop(a, b) for b in t for a in s)).alias("cov"),
        sum(F.var_pop(c) for c in s).alias("vs"),
        sum(F.var_pop(c) for c in t).alias("vt"),
    )

    def solve(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                u, d, vt = np.linalg.svd(np.array(r.cov).reshape(3, 3))
                sign = np.diag([1, 1, np.sign(np.linalg.det(u @ vt)) or 1])
                rot = u @ sign @ vt
                scale = float((d * np.diag(sign)).sum() / r.vs) if r.vs > 0 else 1.0
                move = np.array(r.mt) - scale * rot @ np.array(r.ms)
                rmse = float(np.sqrt(max(0.0, r.vt - scale * scale * r.vs))) if r.vs > 0 else float(np.sqrt(r.vt))
                out.append((scale, rot.ravel().tolist(), move.tolist(), rmse))
            yield pdf[[*keys, "n"]].assign(scale=[x[0] for x in out], rotation=[x[1] for x in out], translation=[x[2] for x in out], rmse=[x[3] for x in out])

    kinds = ", ".join(f"{k} {dict(moments.dtypes)[k]}" for k in keys)
    return moments.mapInPandas(solve, f"{kinds}, n long, scale double, rotation array<double>, translation array<double>, rmse double")


def principal_frame(points: DataFrame, keys: list[str]) -> DataFrame:
    """Centre, axes (row-major, largest spread first) and variances of each cloud."""
    moments = points.groupBy(*keys).agg(F.count("*").alias("n"), F.array(*(F.avg(a) for a in "xyz")).alias("centre"), F.array(*(F.covar_pop(a, b) for a in "xyz" for b in "xyz")).alias("cov"))

    def solve(batches):
        for pdf in batches:
            found = [np.linalg.eigh(np.array(c).reshape(3, 3)) for c in pdf["cov"]]
            yield pdf[[*keys, "n", "centre"]].assign(axes=[v.T[::-1].ravel().tolist() for _, v in found], variances=[w[::-1].tolist() for w, _ in found])

    kinds = ", ".join(f"{k} {dict(moments.dtypes)[k]}" for k in keys)
    return moments.mapInPandas(solve, f"{kinds}, n long, centre array<double>, axes array<double>, variances array<double>")


def plane_consensus(points: DataFrame, tolerance: float, trials: int = 64, seed: int = 7) -> DataFrame:
    """The plane (nx, ny, nz, offset) with the most points within `tolerance`, ties to the least median distance.

    Hypotheses are planes through triplets of points, chosen by a hash of the seed; all are
    counted in one pass over the points, and broadcast, as they are `trials` rows.
    """
    pick = points.select("x", "y", "z").withColumn("h", F.xxhash64(F.lit(seed), "x", "y", "z")).orderBy("h", "x", "y", "z").limit(3 * trials).select("x", "y", "z").collect()
    planes = []
    for i in range(0, len(pick) - 2, 3):
        a, b, c = (np.array(tuple(p), float) for p in pick[i : i + 3])
        n = np.cross(b - a, c - a)
        if np.linalg.norm(n) > 1e-12:
            n = n / np.linalg.norm(n)
            planes.append((i // 3, *map(float, n), float(n @ a)))
    hyp = points.sparkSession.createDataFrame(planes, "trial int, nx double, ny double, nz double, offset double")
    d = F.abs(F.col("nx") * F.col("x") + F.col("ny") * F.col("y") + F.col("nz") * F.col("z") - F.col("offset"))
    near = points.crossJoin(F.broadcast(hyp)).withColumn("d", d).where(F.col("d") <= tolerance)
    counted = near.groupBy("trial", "nx", "ny", "nz", "offset").agg(F.count("*").alias("inliers"), F.percentile("d", 0.5).alias("median"))
    return counted.orderBy(F.desc("inliers"), "median", "trial").limit(1)
