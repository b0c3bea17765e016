"""Robust statistics over views, clouds and planes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def robust_fuse(samples: DataFrame, keys: list[str], values: list[str], absolute: float = 0.08, relative: float = 0.01, min_support: int = 2) -> DataFrame:
    """Median depth of each key, its inliers' count and the medians of depth and `values` over them.

    An inlier's depth is within max(absolute, relative * median). Keys with fewer inliers than
    `min_support` are left out. Medians interpolate. One shuffle by the keys serves both steps.
    """
    w = Window.partitionBy(*keys)
    rows = samples.withColumn("_m", F.percentile("depth", 0.5).over(w))
    rows = rows.where(F.abs(F.col("depth") - F.col("_m")) <= F.greatest(F.lit(absolute), relative * F.col("_m")))
    out = rows.groupBy(*keys).agg(F.count("*").alias("support"), F.percentile("depth", 0.5).alias("depth"), *(F.percentile(v, 0.5).alias(v) for v in values))
    return out.where(F.col("support") >= min_support)


def robust_bounds(points: DataFrame, keys: list[str], low: float = 0.02, high: float = 0.98, floor: float = 1e-5) -> DataFrame:
    """Quantile box of each cloud: low, high, centre and extent by axis."""
    cuts = points.groupBy(*keys).agg(F.count("*").alias("n"), *(F.percentile(a, F.array(F.lit(low), F.lit(high))).alias(f"q{a}") for a in "xyz"))
    cols = []
    for a in "xyz":
        lo, hi = F.col(f"q{a}")[0], F.col(f"q{a}")[1]
        cols += [lo.alias(f"{a}0"), hi.alias(f"{a}1"), ((lo + hi) / 2).alias(f"{a}c"), F.greatest(hi - lo, F.lit(floor)).alias(f"{a}e")]
    return cuts.select(*keys, "n", *cols)


def weighted_median(rows: DataFrame, keys: list[str], value: str, weight: str) -> DataFrame:
    """The first value, in order, at which the running weight reaches half of the whole.

    Equal values are summed first, so a large group sorts its distinct values only. Sums of doubles depend on the order of rows, which
    tells where the half is met exactly; decimal weights are summed exactly.
    """
    each = rows.groupBy(*keys, value).agg(F.sum(weight).alias("_w"))
    run = F.sum("_w").over(Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    whole = F.sum("_w").over(Window.partitionBy(*keys))
    return each.withColumns({"_r": run, "_h": whole}).where(2 * F.col("_r") >= F.col("_h")).groupBy(*keys).agg(F.min(value).alias("median"))


def plane_peaks(offsets: DataFrame, keys: list[str], width: float = 0.1, most: int = 16, min_share: float = 0.05) -> DataFrame:
    """Local maxima of the smoothed weighted histogram of `offset` (weight `weight`): bin, smoothed weight, rank.

    The kernel is [1 2 3 2 1] / 9 over filled bins; a peak is at least as high as both neighbours and
    at least `min_share` of the highest.
    """
    bins = offsets.groupBy(*keys, F.floor(F.col("offset") / width).alias("bin")).agg(F.sum("weight").alias("w"))
    kernel = F.explode(F.array(*(F.struct(F.lit(d).alias("d"), F.lit(float(k)).alias("k")) for d, k in ((-2, 1), (-1, 2), (0, 3), (1, 2), (2, 1)))))
    smooth = bins.select(*keys, "bin", "w", kernel.alias("e")).groupBy(*keys, (F.col("bin") + F.col("e.d")).alias("bin")).agg((F.sum(F.col("w") * F.col("e.k")) / 9).alias("s"))
    w = Window.partitionBy(*keys).orderBy("bin")
    beside = lambda f, step: F.when(f("bin").over(w) == F.col("bin") + step, f("s").over(w)).otherwise(0.0)
    rows = smooth.withColumns({"_p": beside(F.lag, -1), "_n": beside(F.lead, 1), "_t": F.max("s").over(Window.partitionBy(*keys))})
    rows = rows.where((F.col("s") >= F.col("_p")) & (F.col("s") >= F.col("_n")) & (F.col("s") >= min_share * F.col("_t")))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("s"), "bin"))
    return rows.select(*keys, "bin", "s", rank.alias("rank")).where(F.col("rank") <= most)


def texture_atlas(samples: DataFrame, min_frames: int = 2) -> DataFrame:
    """Mean colour of a texel over frames of the mean within each frame: samples (plane_id, row, col, frame_id, v)."""
    per_frame = samples.groupBy("plane_id", "row", "col", "frame_id").agg(F.avg("v").alias("v"))
    out = per_frame.groupBy("plane_id", "row", "col").agg(F.avg("v").alias("v"), F.count("*").alias("frame_support"))
    return out.withColumn("observed", F.col("frame_support") >= min_frames)


def coverage_summary(pixels: DataFrame) -> DataFrame:
    """Measured pixels by frame and in all (frame_id null): rows frame_id, measured boolean."""
    rows = pixels.rollup("frame_id").agg(F.count("*").alias("n"), F.count_if("measured").alias("measured"))
    share = F.col("measured") / F.col("n")
    return rows.withColumns({"fraction": share, "next_action": F.when(share == 1, "accept").when(share > 0, "fill_residual").otherwise("need_donors")})
