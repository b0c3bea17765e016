"""Gaussians and depth: extents, carving with protection, depth edges, depth agreement and depth-bounded closing."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_sort, checkpointed, small
from .pixels import PIXEL, TILED, close, own, tiled

AXES = ("x", "y", "z")
#: A renderer draws a Gaussian out to so many standard deviations.
DRAWN = math.sqrt(8.0)


def gaussian_extents(gaussians: DataFrame) -> DataFrame:
    """Adds the axis-aligned standard deviations sx, sy, sz of each Gaussian and its drawn half sizes ex, ey, ez and footprint (the largest).

    Gaussians: scale_0 .. 2 are logarithms, rot_0 .. 3 a quaternion (w first) of any length but 0.
    """
    size = F.greatest(F.sqrt(sum(F.col(f"rot_{i}") * F.col(f"rot_{i}") for i in range(4))), F.lit(1e-12))
    rows = gaussians.withColumns({f"_q{i}": F.col(f"rot_{i}") / size for i in range(4)} | {f"_v{i}": F.exp(2 * F.col(f"scale_{i}")) for i in range(3)})
    w, x, y, z = (F.col(f"_q{i}") for i in range(4))
    turn = [[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)], [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)], [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]]
    rows = rows.withColumns({f"s{a}": F.sqrt(sum(c * c * F.col(f"_v{j}") for j, c in enumerate(line))) for a, line in zip(AXES, turn, strict=True)})
    rows = rows.withColumns({f"e{a}": F.col(f"s{a}") * DRAWN for a in AXES}).drop(*(f"_q{i}" for i in range(4)), *(f"_v{i}" for i in range(3)))
    return rows.withColumn("footprint", F.greatest("ex", "ey", "ez"))


def meets_box(low: list[float], high: list[float], padding: float = 0.40) -> Column:
    """Whether a Gaussian with drawn half sizes overlaps a box and its centre is at most `padding` from it along each axis."""
    out = F.lit(True)
    for a, lo, hi in zip(AXES, low, high, strict=True):
        c, e = F.col(a), F.col(f"e{a}")
        out = out & c.between(lo - padding, hi + padding) & (c + e >= lo) & (c - e <= hi)
    return out


def _least_distances(points: DataFrame, anchors: DataFrame, reach: Column, levels: list[float]) -> DataFrame:
    """The distance of each point (point_id, x, y, z) to its nearest anchor, if that is within `reach`: point_id, d2.

    A point belongs to the first level that its reach fits in and meets anchors in the grid of that level only, so points of short
    reach do not look through the cells of long ones. Distances are combined in each task before they are shuffled.
    """
    level = F.lit(len(levels) - 1)
    for k in range(len(levels) - 2, -1, -1):
        level = F.when(F.col("reach") <= levels[k], k).otherwise(level)
    width = F.array(*map(F.lit, levels))
    mine = points.select("point_id", *AXES, reach.alias("reach")).withColumn("level", level).withColumn("_s", width[F.col("level")])
    mine = mine.withColumns({f"c{a}": F.floor(F.col(a) / F.col("_s")) for a in AXES}).drop("_s")
    spread = anchors.select(*(F.col(a).alias(f"a{a}") for a in AXES)).select("*", F.posexplode(width).alias("level", "_s"))
    for a in AXES:
        spread = spread.select("*", F.explode(F.sequence(F.floor(F.col(f"a{a}") / F.col("_s")) - 1, F.floor(F.col(f"a{a}") / F.col("_s")) + 1)).alias(f"c{a}"))
    d2 = sum((F.col(a) - F.col(f"a{a}")) * (F.col(a) - F.col(f"a{a}")) for a in AXES)
    pairs = mine.join(spread.drop("_s"), ["level", "cx", "cy", "cz"]).withColumn("d2", d2).where(F.col("d2") <= F.col("reach") * F.col("reach"))
    return pairs.groupBy("point_id").agg(F.min("d2").alias("d2"))


def semantic_carve(points: DataFrame, front: DataFrame, rear: DataFrame, base: float = 0.08, most: float = 0.40, margin: float = 0.02) -> DataFrame:
    """Points (point_id, x, y, z, footprint) that belong to a front object and not to what stands behind it.

    A point is near if its nearest front anchor (x, y, z) is within min(most, base + footprint), and protected if its nearest rear
    anchor is no farther than that plus `margin`. Returns the near points: point_id, front_distance, rear_distance (null if none is so
    near), removed.
    """
    levels = [base + (most - base) * k / 3 for k in (1, 2, 3)]
    reach = F.least(F.lit(most), base + F.col("footprint"))
    near = _least_distances(points, front, reach, levels).select("point_id", F.sqrt("d2").alias("front_distance"))
    held = points.select("point_id", *AXES).join(near, "point_id")
    back = _least_distances(held, rear, F.col("front_distance") + margin, [v + margin for v in levels]).select("point_id", F.sqrt("d2").alias("rear_distance"))
    out = held.select("point_id", "front_distance").join(back, "point_id", "left")
    return out.withColumn("removed", F.col("rear_distance").isNull() | (F.col("rear_distance") > F.col("front_distance") + margin))


def depth_edges(depths: DataFrame, limit: float = 0.03) -> DataFrame:
    """Adds jump, the range of depths in the 3 x 3 pixels around over the pixel's own, and edge: whether it is over `limit`.

    Pixels: frame_id, y, x, depth; missing neighbours do not count. Ranges spread along rows and then columns, by tiles: 6 copies a pixel, not 9, and none is shuffled.
    """
    steps = F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))
    wide = tiled(depths.select(*PIXEL, "depth"), 1).select(*TILED, "depth", steps.alias("d"))
    wide = wide.groupBy(*TILED[:4], (F.col("x") + F.col("d")).alias("x")).agg(F.min("depth").alias("_l"), F.max("depth").alias("_h"), F.max(F.col("d") == 0).alias("_o")).where(own("x"))
    wide = wide.select(*TILED, "_l", "_h", "_o", steps.alias("d")).groupBy(*TILED[:3], (F.col("y") + F.col("d")).alias("y"), "x").agg(F.min("_l").alias("_l"), F.max("_h").alias("_h"), F.max(F.col("_o") & (F.col("d") == 0)).alias("_o"))
    rows = depths.join(by_sort(wide.where(own("y") & F.col("_o")).select(*PIXEL, "_l", "_h")), PIXEL).withColumn("jump", (F.col("_h") - F.col("_l")) / F.greatest(F.abs("depth"), F.lit(1e-6)))
    return rows.drop("_l", "_h").withColumn("edge", F.col("jump") > limit)


def depth_agreement(anchor: Column, scene: Column, absolute: float, relative: float) -> Column:
    """How an anchor's depth stands to the scene's: visible, occluded_behind_scene, front_depth_mismatch, missing_scene_depth; null without an anchor."""
    seen = scene.isNotNull() & ~F.isnan(scene) & (scene > 0) & (scene < float("inf"))
    tolerance = F.greatest(F.lit(absolute), F.abs(scene) * relative)
    there = anchor.isNotNull() & ~F.isnan(anchor) & (anchor < float("inf"))
    return F.when(there & ~seen, "missing_scene_depth").when(there & (F.abs(anchor - scene) <= tolerance), "visible").when(there & (anchor - scene > tolerance), "occluded_behind_scene").when(there, "front_depth_mismatch")


def _spread_least(anchors: DataFrame, radius: int) -> DataFrame:
    """The least depth within `radius` (Chebyshev) of each pixel that has one: rows first, then columns, by tiles."""
    steps = F.explode(F.sequence(F.lit(-radius), F.lit(radius)))
    wide = tiled(anchors.select(*PIXEL, "depth"), radius).select(*TILED, "depth", steps.alias("d")).groupBy(*TILED[:4], (F.col("x") + F.col("d")).alias("x")).agg(F.min("depth").alias("depth")).where(own("x"))
    return wide.select(*TILED, "depth", steps.alias("d")).groupBy(*TILED[:3], (F.col("y") + F.col("d")).alias("y"), "x").agg(F.min("depth").alias("depth")).where(own("y")).select(*PIXEL, "depth")


def depth_aware_splat(anchors: DataFrame, scene: DataFrame, radius: int, absolute: float = 0.08, relative: float = 0.01) -> DataFrame:
    """Pixels of the scene (frame_id, y, x, depth) where an anchor's depth, its own or the least one within `radius`, agrees with the scene's."""
    own = anchors.groupBy(*PIXEL).agg(F.min("depth").alias("own"))
    near = _spread_least(own.withColumnRenamed("own", "depth"), radius).withColumnRenamed("depth", "near")
    both = scene.select(*PIXEL, "depth").join(near, PIXEL).join(own, PIXEL, "left")
    agrees = lambda c: F.coalesce(depth_agreement(F.col(c), F.col("depth"), absolute, relative) == "visible", F.lit(False))
    return both.where(agrees("own") | agrees("near")).select(*PIXEL)


def depth_bounded_close(support: DataFrame, anchors: DataFrame, scene: DataFrame, splat: int, closing: int, absolute: float = 0.08, relative: float = 0.01) -> DataFrame:
    """`support` and the pixels that closing it by `closing` adds where anchors splatted by splat + closing agree with the scene."""
    if closing == 0:
        return support.select(*PIXEL).distinct()
    envelope = depth_aware_splat(anchors, scene, splat + closing, absolute, relative)
    return support.select(*PIXEL).union(close(support, closing).join(envelope, PIXEL, "left_semi")).distinct()


#: Fixed value: an object that matches fewer points than this is not taken for found.
FEWEST_MATCHES = 25


def grown(boxes: DataFrame, ratio: float, margin: float) -> DataFrame:
    """`boxes` (x0, x1, y0, y1, z0, z1) widened on each side by `ratio` of their extent and `margin`."""
    wide = {a: (F.col(f"{a}1") - F.col(f"{a}0")) * ratio + margin for a in AXES}
    return boxes.withColumns({f"{a}0": F.col(f"{a}0") - wide[a] for a in AXES} | {f"{a}1": F.col(f"{a}1") + wide[a] for a in AXES})


def near_objects(places: DataFrame, boxes: DataFrame, anchors: DataFrame, reach: float) -> DataFrame:
    """The objects of `boxes` (object_id, ord, x0 .. z1, closed) that have a place (x, y, z) in their box and one of their own anchors
    within `reach` of it: x, y, z, object_id, ord, once each if places and boxes are.

    Places and each object's anchors are first made boxes of cells whose diagonal is the reach. A cell of places that is within the reach of all of
    a cell of anchors needs no look at either, and none out of it; only places of cells that neither tells meet the cells' anchors.
    """
    side = reach / math.sqrt(3) * (1 - 1e-9)
    cell = [f"c{a}" for a in AXES]
    at = {f"c{a}": F.floor(F.col(a) / side) for a in AXES}
    bounds = lambda e: [f(a).alias(f"{e}{n}{a}") for a in AXES for n, f in (("lo", F.min), ("hi", F.max))]
    ends = [f"{a}{i}" for a in AXES for i in (0, 1)]
    owned = boxes.select("object_id", "ord", *ends)
    close = F.lit(True)
    for a in AXES:
        close = close & F.col(a).between(F.col(f"{a}0") - 2 * reach, F.col(f"{a}1") + 2 * reach)
    held = checkpointed(anchors.select("object_id", *AXES).distinct().join(owned, "object_id").where(close).select("object_id", *AXES).distinct().withColumns(at))
    spread = held.groupBy("object_id", *cell).agg(*bounds("a")).withColumns({f"h{a}": F.col(f"c{a}") for a in AXES})
    for c in cell:
        spread = spread.withColumn("_o", F.explode(F.sequence(F.lit(-2), F.lit(2)))).withColumn(c, F.col(c) + F.col("_o")).drop("_o")
    placed = places.select(*AXES).withColumns(at)
    low, high = ({a: F.col(f"{e}{a}") for a in AXES} for e in ("plo", "phi"))
    near = sum(F.pow(F.greatest(F.lit(0.0), F.col(f"alo{a}") - high[a], low[a] - F.col(f"ahi{a}")), 2) for a in AXES)
    far = sum(F.pow(F.greatest(F.abs(F.col(f"ahi{a}") - low[a]), F.abs(high[a] - F.col(f"alo{a}"))), 2) for a in AXES)
    # Distances of boxes are rounded another way than those of points, so a hair's breadth is left to the points.
    tried = spread.join(placed.groupBy(*cell).agg(*bounds("p")), cell).where(near <= reach * reach * (1 + 1e-9)).withColumn("sure", far <= reach * reach * (1 - 1e-9))
    told = tried.groupBy("object_id", *cell).agg(F.max("sure").alias("sure"), F.collect_set(F.when(~F.col("sure"), F.struct(*(f"h{a}" for a in AXES)))).alias("cells"))
    told = checkpointed(told.withColumn("cells", F.when(~F.col("sure"), F.col("cells"))))
    inside = F.lit(True)
    for a in AXES:
        inside = inside & F.col(a).between(F.col(f"{a}0"), F.col(f"{a}1"))
    claims = placed.join(told.join(owned, "object_id"), cell).where(inside).select("object_id", "ord", *AXES, "sure", "cells")
    look = claims.where("not sure").select("object_id", "ord", *(F.col(a).alias(f"p{a}") for a in AXES), F.explode("cells").alias("h")).select("*", *(F.col(f"h.h{a}").alias(f"c{a}") for a in AXES))
    d2 = sum((F.col(a) - F.col(f"p{a}")) * (F.col(a) - F.col(f"p{a}")) for a in AXES)
    found = look.join(held, ["object_id", *cell]).where(d2 <= reach * reach).select(*(F.col(f"p{a}").alias(a) for a in AXES), "object_id", "ord").distinct()
    return claims.where("sure").select(*AXES, "object_id", "ord").union(found)


def carve_objects(points: DataFrame, boxes: DataFrame, anchors: DataFrame, reach: float, fewest: int = FEWEST_MATCHES) -> DataFrame:
    """The points (point_id, x, y, z) that objects take: inside the object's box and within `reach` of one of its own anchors.

    boxes: object_id, ord, x0 .. z1 (closed); anchors: object_id, x, y, z. The first object by `ord`, then object_id, takes a point. An object of
    `boxes` that takes fewer than `fewest` raises, as it is not there to be replaced. Points of one place are looked at once. Returns point_id,
    object_id; jobs run while it is built.
    """
    taken = near_objects(points.select(*AXES).distinct(), boxes, anchors, reach).groupBy(*AXES).agg(F.min(F.struct("ord", "object_id")).alias("first"))
    hits = points.select("point_id", *AXES).join(small(checkpointed(taken), 500_000), [*AXES])
    taken = checkpointed(hits.groupBy("point_id").agg(F.min("first").alias("first")).select("point_id", "first.object_id"))
    counts = boxes.select("object_id").distinct().join(taken.groupBy("object_id").agg(F.count("*").alias("n")), "object_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    short = counts.where(F.col("n") < fewest).orderBy("object_id").limit(5).collect()
    if short:
        raise ValueError("too few points match: " + ", ".join(f"{r.object_id} ({r.n})" for r in short))
    return taken.select("point_id", "object_id")
