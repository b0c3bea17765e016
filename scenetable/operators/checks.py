"""Checks of scenes: depth order, contact, transforms, intrinsics, view quality, trims, colours, what a mask leaves unchanged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_sort
from .pixels import PIXEL, dilate

COLOURS = ("r", "g", "b")


def depth_order(relations: DataFrame, seen: DataFrame, masks: DataFrame, bin_px: int = 8, min_shared: int = 3, margin: float = 0.1) -> DataFrame:
    """Whether the front object of each relation (frame_id, front, rear) is nearer than the rear one wherever both are seen.

    seen: frame_id, obj, px, py, depth; masks: frame_id, obj, px, py. In bins of `bin_px` pixels that hold depths and mask pixels of
    both, the rear's least depth less the front's counts. Returns shared bins, least, median and largest difference, the share of bins in wrong order,
    overlap (mask pixels of both) and passed: enough bins, no inversion, the least difference at least `margin`. Missing evidence does not pass.
    """
    at = [F.floor(F.col(c) / bin_px).alias(f"b{c[1]}") for c in ("py", "px")]
    least = seen.groupBy("frame_id", "obj", *at).agg(F.min("depth").alias("depth"))
    bins = least.join(masks.select("frame_id", "obj", *at).distinct(), ["frame_id", "obj", "by", "bx"], "left_semi")
    side = lambda name: bins.select("frame_id", F.col("obj").alias(name), "by", "bx", F.col("depth").alias(f"{name}_depth"))
    both = relations.join(side("front"), ["frame_id", "front"]).join(side("rear"), ["frame_id", "rear", "by", "bx"]).withColumn("d", F.col("rear_depth") - F.col("front_depth"))
    keys = ["frame_id", "front", "rear"]
    found = both.groupBy(*keys).agg(F.count("*").alias("shared"), F.min("d").alias("least"), F.percentile("d", 0.5).alias("median"), F.max("d").alias("largest"), F.avg((F.col("d") <= 0).cast("double")).alias("wrong"))
    pixel = lambda name: masks.select("frame_id", F.col("obj").alias(name), "px", "py").distinct()
    overlap = relations.join(pixel("front"), ["frame_id", "front"]).join(pixel("rear"), ["frame_id", "rear", "px", "py"]).groupBy(*keys).agg(F.count("*").alias("overlap"))
    rows = relations.join(found, keys, "left").join(overlap, keys, "left").withColumns({"shared": F.coalesce("shared", F.lit(0)), "overlap": F.coalesce("overlap", F.lit(0)), "wrong": F.coalesce("wrong", F.lit(1.0))})
    return rows.withColumns({"disjoint": F.col("overlap") == 0, "passed": F.coalesce((F.col("shared") >= min_shared) & (F.col("least") >= margin) & (F.col("wrong") == 0), F.lit(False))})


def contact(rows: DataFrame, absolute: float = 0.05, fraction: float = 0.25, most_gap: float = 0.02) -> DataFrame:
    """How an upper object (bottom, thickness; heights grow downward) stands on its support (top): adds penetration, gap, limit, excess, passed.

    A height that is missing leaves them null, and does not pass.
    """
    known = F.col("bottom").isNotNull() & F.col("top").isNotNull() & F.col("thickness").isNotNull()  # greatest and least pass over nulls
    gone, gap = (F.when(known, F.greatest(F.lit(0.0), d)) for d in (F.col("bottom") - F.col("top"), F.col("top") - F.col("bottom")))
    limit = F.when(known, F.least(F.lit(absolute), fraction * F.col("thickness")))
    out = rows.withColumns({"penetration": gone, "gap": gap, "limit": limit}).withColumn("excess", F.when(known, F.greatest(F.lit(0.0), F.col("penetration") - F.col("limit"))))
    return out.withColumn("passed", F.coalesce((F.col("penetration") <= F.col("limit") + 1e-12) & (F.col("gap") <= most_gap + 1e-12), F.lit(False)))


def affine_audit(rows: DataFrame, matrix: str = "matrix") -> DataFrame:
    """What a 4 x 4 matrix (array of 16, by rows) does: adds determinant, scale_x .. z, scale, anisotropy, affine, orthonormal, uniform, right_handed, issue.

    issue names the first of: not finite, not affine, turns orientation, has a zero scale; the others are null then.
    """
    m = F.col(matrix)
    a = [[m[4 * i + j] for j in range(3)] for i in range(3)]
    det = a[0][0] * (a[1][1] * a[2][2] - a[1][2] * a[2][1]) - a[0][1] * (a[1][0] * a[2][2] - a[1][2] * a[2][0]) + a[0][2] * (a[1][0] * a[2][1] - a[1][1] * a[2][0])
    size = [F.sqrt(sum(a[i][j] * a[i][j] for i in range(3))) for j in range(3)]
    close = lambda c, v, rel, low: F.abs(c - v) <= low + rel * F.abs(v)
    affine = F.lit(True)
    for k, v in zip(range(12, 16), (0.0, 0.0, 0.0, 1.0), strict=True):
        affine = affine & close(m[k], F.lit(v), 1e-5, 1e-8)
    finite = F.coalesce((F.size(m) == 16) & F.forall(m, lambda v: ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
    issue = F.when(~finite, "not finite").when(~affine, "not affine").when(det <= 0, "turns orientation").when(F.least(*size) <= 1e-9, "zero scale")
    out = rows.withColumn("issue", issue)
    good = lambda c: F.when(F.col("issue").isNull(), c)
    out = out.withColumns({"determinant": good(det), **{f"scale_{n}": good(s) for n, s in zip("xyz", size, strict=True)}})
    s = [F.col(f"scale_{n}") for n in "xyz"]
    mean = (s[0] + s[1] + s[2]) / 3
    square = F.lit(True)
    for j in range(3):
        for k in range(j + 1, 3):
            square = square & (F.abs(sum(a[i][j] * a[i][k] for i in range(3)) / (s[j] * s[k])) <= 1e-5)
    even = F.lit(True)
    for c in s:
        even = even & close(c, mean, 1e-5, 1e-7)
    return out.withColumns({"scale": good(mean), "anisotropy": good(F.greatest(*s) / F.least(*s)), "orthonormal": good(square), "uniform": good(even), "right_handed": good(close(F.col("determinant") / (s[0] * s[1] * s[2]), F.lit(1.0), 1e-5, 1e-5))})


def resize_intrinsics(cameras: DataFrame, w: Column, h: Column) -> DataFrame:
    """Cameras (fx, fy, cx, cy, w, h, ...) for images of another size; sizes of 0 and less give null."""
    x, y = (F.when((F.col(c) > 0) & (n > 0), n / F.nullif(F.col(c), F.lit(0))) for c, n in (("w", w), ("h", h)))
    return cameras.withColumns({"fx": F.col("fx") * x, "cx": F.col("cx") * x, "fy": F.col("fy") * y, "cy": F.col("cy") * y, "w": w, "h": h})


def common_intrinsics(cameras: DataFrame, keys: list[str], most_spread: float = 0.05) -> DataFrame:
    """One camera for each key: median focal lengths and centres, the largest relative deviation of a focal length, and whether that is small enough."""
    middle = cameras.groupBy(*keys).agg(*(F.percentile(c, 0.5).alias(f"_{c}") for c in ("fx", "fy", "cx", "cy")))
    apart = F.greatest(F.abs(F.col("fx") - F.col("_fx")) / F.col("_fx"), F.abs(F.col("fy") - F.col("_fy")) / F.col("_fy"))
    out = cameras.join(middle.where((F.col("_fx") > 0) & (F.col("_fy") > 0)), keys).groupBy(*keys, *(f"_{c}" for c in ("fx", "fy", "cx", "cy"))).agg(F.max(apart).alias("spread"))
    return out.withColumn("common", F.col("spread") <= most_spread).withColumnsRenamed({f"_{c}": c for c in ("fx", "fy", "cx", "cy")})


def _held(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def border_sides(tolerance: int = 2) -> Column:
    """How many sides of the image (w, h) a box (x0, y0, x1, y1) touches."""
    return (F.col("x0") <= tolerance).cast("int") + (F.col("y0") <= tolerance).cast("int") + (F.col("x1") >= F.col("w") - tolerance).cast("int") + (F.col("y1") >= F.col("h") - tolerance).cast("int")


def selection_quality(crops: DataFrame) -> DataFrame:
    """Adds sides, quality and rank_score to crops (support_ratio, coverage, fill, sharpness, support_points, box x0 .. y1, w, h).

    Fixed weights: 0.42 support, 0.32 root of coverage, 0.16 sharpness, 0.10 nearness of the fill to 0.62; less 0.18 a touched side, 0.72 at most.
    """
    rows = crops.withColumn("sides", border_sides())
    plain = 0.42 * _held(F.col("support_ratio")) + 0.32 * _held(F.sqrt(F.greatest("coverage", F.lit(0.0)))) + 0.16 * _held(F.col("sharpness")) + 0.10 * _held(1 - F.abs(F.col("fill") - 0.62) / 0.62)
    rows = rows.withColumn("quality", _held(plain * (1 - _held(0.18 * F.col("sides"), 0.0, 0.72))))
    wide, high = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    aspect = F.greatest(wide / F.greatest(F.lit(1.0), high), high / F.greatest(F.lit(1.0), wide))
    slim, edge = F.greatest(F.lit(0.45), 1 - F.least(F.greatest(aspect - 2.2, F.lit(0.0)) / 4, F.lit(0.55))), F.greatest(F.lit(0.35), 1 - 0.22 * F.col("sides"))
    bonus = 1 + F.least(F.log1p(F.greatest(F.lit(0.0), "support_points")) / 18, F.lit(0.35))
    return rows.withColumn("rank_score", F.col("quality") * F.sqrt(F.greatest(F.lit(1.0), F.least(wide, high))) * slim * edge * bonus)


def largest_eligible_view(views: DataFrame, min_edge: int = 2) -> DataFrame:
    """For each object the view (object_id, frame_id, area, x0, y0, x1, y1, w, h) of largest area whose mask keeps `min_edge` pixels from the border.

    Ties go to the least frame_id. An object all of whose views touch the border has a null frame_id and is refused.
    """
    free = (F.col("x0") >= min_edge) & (F.col("y0") >= min_edge) & (F.col("x1") <= F.col("w") - min_edge) & (F.col("y1") <= F.col("h") - min_edge)
    best = F.min(F.when(free, F.struct((-F.col("area")).alias("a"), F.col("frame_id")))).alias("b")
    out = views.groupBy("object_id").agg(F.count("*").alias("n_views"), F.count_if(free).alias("n_eligible"), best)
    return out.select("object_id", "n_views", "n_eligible", "b.frame_id", (-F.col("b.a")).alias("area"), F.col("b").isNull().alias("refused"))


def robust_trim(points: DataFrame, keys: list[str], quantile: float = 0.98) -> DataFrame:
    """The points of each cloud (keys, x, y, z) within the `quantile` of distances from its median point: adds distance."""
    middle = points.groupBy(*keys).agg(*(F.percentile(a, 0.5).alias(f"_{a}") for a in "xyz"))
    far = points.join(middle, keys).withColumn("distance", F.sqrt(sum((F.col(a) - F.col(f"_{a}")) * (F.col(a) - F.col(f"_{a}")) for a in "xyz"))).drop("_x", "_y", "_z")
    cut = far.groupBy(*keys).agg(F.percentile("distance", quantile).alias("_cut"))
    return far.join(cut, keys).where(F.col("distance") <= F.col("_cut")).drop("_cut")


def colour_stats(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """Pixels and, by colour, mean, median, standard deviation, and 10th and 90th percentile of each key: n, mean_r, median_r, std_r, p10_r, p90_r, ..."""
    parts = [x for c in COLOURS for x in (F.avg(c).alias(f"mean_{c}"), F.percentile(c, 0.5).alias(f"median_{c}"), F.stddev_pop(c).alias(f"std_{c}"), F.percentile(c, 0.1).alias(f"p10_{c}"), F.percentile(c, 0.9).alias(f"p90_{c}"))]
    return pixels.groupBy(*keys).agg(F.count("*").alias("n"), *parts)


def outside_unchanged(source: DataFrame, output: DataFrame, mask: DataFrame, dilation: int = 4, most_outside: float = 0.5, least_inside: float = 2.0) -> DataFrame:
    """How much each frame's output differs from its source inside a mask and outside the dilated mask, by mean absolute colour difference, and the gates.

    A frame without pixels inside or outside does not pass.
    """
    new = output.select(*PIXEL, *(F.col(c).alias(f"_{c}") for c in COLOURS))
    delta = sum(F.abs(F.col(f"_{c}") - F.col(c)) for c in COLOURS) / 3
    rows = source.join(by_sort(new), PIXEL).withColumn("delta", delta).select(*PIXEL, "delta")
    rows = rows.join(by_sort(mask.select(*PIXEL).distinct().withColumn("in", F.lit(True))), PIXEL, "left").join(by_sort(dilate(mask, dilation).withColumn("near", F.lit(True))), PIXEL, "left")
    inside, outside = F.when(F.col("in"), F.col("delta")), F.when(F.col("near").isNull(), F.col("delta"))
    out = rows.groupBy("frame_id").agg(F.count(inside).alias("n_inside"), F.avg(inside).alias("inside"), F.count(outside).alias("n_outside"), F.avg(outside).alias("outside"), F.max(outside).alias("outside_max"))
    return out.withColumn("passed", F.coalesce((F.col("outside") <= most_outside) & (F.col("inside") >= least_inside), F.lit(False)))
