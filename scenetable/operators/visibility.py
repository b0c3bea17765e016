"""Points in views: projection, depth buffers, visibility, votes and splits by mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import NEAR, camera_axis, world_axis
from .common import by_sort, checkpointed, dealt, small


def _reach(form: list[Column], constant: Column) -> Column:
    """The largest value of a linear form over a box (l0 .. h2)."""
    return sum((F.greatest(a * F.col(f"_l{i}"), a * F.col(f"_h{i}")) for i, a in enumerate(form)), constant)


def _may_see() -> Column:
    """Whether some point of a box can lie in a camera's image: the box is not wholly outside one side of its frustum."""
    row, t = lambda i: [F.col(f"_r{3 * i + k}") for k in range(3)], [F.col(f"_t{i}") for i in range(3)]
    deep = row(2)
    out = _reach(deep, t[2]) > NEAR
    for i, f, c, size in ((0, "fx", "cx", "w"), (1, "fy", "cy", "h")):
        for sign, edge in ((1.0, F.col(c) + 0.5), (-1.0, F.col(size) - 0.5 - F.col(c))):  # a rounded pixel reaches half a pixel over
            form = [sign * F.col(f) * a + edge * d for a, d in zip(row(i), deep, strict=True)]
            out = out & (_reach(form, sign * F.col(f) * t[i] + edge * t[2]) >= -1e-6)
    return out


def project_points(points: DataFrame, cameras: DataFrame, cell: float | None = None) -> DataFrame:
    """Every point (x, y, z, ...) in every camera (frame_id, fx, fy, cx, cy, w, h, r, t) that sees it.

    Adds frame_id, px, py (half-even rounded) and depth. Cameras are broadcast if they are few (checked). With `cell`, only the boxes
    of filled grid cells meet all cameras, and points meet the cameras whose frustum their cell's box can reach, by the cell's
    numbers; that pays where a camera sees a small part of a large cloud.
    """
    flat = [F.col("r")[i].alias(f"_r{i}") for i in range(9)] + [F.col("t")[i].alias(f"_t{i}") for i in range(3)]  # once a camera, not once a pair
    cams = small(cameras.select("frame_id", "fx", "fy", "cx", "cy", "w", "h", *flat))
    if cell is None:
        pairs = points.crossJoin(cams)
    else:
        keys = [f"_g{a}" for a in "xyz"]
        placed = points.withColumns({k: F.floor(F.col(a) / cell) for k, a in zip(keys, "xyz", strict=True)})
        boxes = placed.groupBy(*keys).agg(*(f(a).alias(f"_{e}{i}") for i, a in enumerate("xyz") for e, f in (("l", F.min), ("h", F.max))))
        near = boxes.crossJoin(cams).where(_may_see()).drop(*(f"_{e}{i}" for i in range(3) for e in "lh"))
        pairs = placed.join(near, keys)
    axis = [F.col(f"_r{3 * i}") * F.col("x") + F.col(f"_r{3 * i + 1}") * F.col("y") + F.col(f"_r{3 * i + 2}") * F.col("z") + F.col(f"_t{i}") for i in range(3)]
    rows = pairs.withColumns({"_cx": axis[0], "_cy": axis[1], "depth": axis[2]}).where(F.col("depth") > NEAR)
    rows = rows.withColumns({"px": F.rint(F.col("fx") * F.col("_cx") / F.col("depth") + F.col("cx")), "py": F.rint(F.col("fy") * F.col("_cy") / F.col("depth") + F.col("cy"))})
    rows = rows.where((F.col("px") >= 0) & (F.col("px") < F.col("w")) & (F.col("py") >= 0) & (F.col("py") < F.col("h")))
    return rows.withColumns({"px": F.col("px").cast("int"), "py": F.col("py").cast("int")}).select(*points.columns, "frame_id", "px", "py", "depth")


def unproject_pixels(pixels: DataFrame, cameras: DataFrame) -> DataFrame:
    """Pixels (frame_id, y, x, depth, ...) with valid depth to world points: adds wx, wy, wz."""
    rows = pixels.where(F.col("depth").isNotNull() & ~F.isnan("depth") & (F.col("depth") > 0) & (F.col("depth") < float("inf")))
    rows = rows.join(small(cameras.select("frame_id", "fx", "fy", "cx", "cy", "r", "t")), "frame_id")
    a, b, d = (F.col("x") - F.col("cx")) / F.col("fx") * F.col("depth"), (F.col("y") - F.col("cy")) / F.col("fy") * F.col("depth"), F.col("depth")
    return rows.select(*pixels.columns, *(world_axis(i, a, b, d).alias(n) for i, n in enumerate(("wx", "wy", "wz"))))


def zbuffer(rows: DataFrame, keys: list[str], payload: list[str] | None = None, tie: str | None = None) -> DataFrame:
    """The least depth for each of `keys`; with a payload, that of the nearest row, ties to the least `tie`.

    Three aggregates over numbers, which hash instead of sorting all rows: least depths, then among the
    rows at that depth the least tie, then its payload. The least depths are written to the shared
    folder and broadcast if they are few (counted). Rows with a null key are left out.
    """
    least = rows.groupBy(*keys).agg(F.min("depth").alias("depth"))
    if not payload:
        return least
    at = [*keys, "depth"]
    least = small(checkpointed(least.dropna(subset=keys)), 1_000_000)
    near = rows.select(*dict.fromkeys([*at, *payload, *([tie] if tie else [])])).join(least, at)
    if not tie:
        return near.groupBy(*at).agg(*(F.first(c).alias(c) for c in payload)).select(*at, *payload)
    near = checkpointed(near)
    first = near.groupBy(*at).agg(F.min(tie).alias(tie))
    rest = [c for c in payload if c != tie]
    picked = near.join(first, [*at, tie], "left_semi").groupBy(*at, tie).agg(*(F.first(c).alias(c) for c in rest)) if rest else first
    return picked.select(*at, *payload)


def visible_pixels(projected: DataFrame, absolute: float = 0.02, relative: float = 0.005) -> DataFrame:
    """Each object's pixels (frame_id, obj, px, py, depth) and whether they are visible.

    Visible: depth <= least depth of any object there + max(absolute, relative * least).
    The window runs over one row an object and pixel, after the partial aggregates.
    """
    own = zbuffer(projected, ["frame_id", "obj", "px", "py"])
    least = F.min("depth").over(Window.partitionBy("frame_id", "px", "py"))
    return own.withColumn("visible", F.col("depth") <= least + F.greatest(F.lit(absolute), relative * least))


def view_votes(projected: DataFrame, masks: DataFrame, min_votes: int = 2) -> DataFrame:
    """How many views accept each point, and whether it is carved.

    A view accepts a point whose pixel is in its mask (frame_id, px, py). Returns point_id, votes, carved.
    """
    hits = projected.join(masks.select("frame_id", "px", "py").distinct().withColumn("hit", F.lit(1)), ["frame_id", "px", "py"], "left")
    votes = hits.groupBy("point_id").agg(F.count("hit").alias("votes"))
    return votes.withColumn("carved", F.col("votes") >= min_votes)


def anchored_votes(points: DataFrame, anchors: DataFrame, cameras: DataFrame, masks: DataFrame, radius: float = 0.08, most_pixels: int = 3, depth_tolerance: float = 0.08, min_votes: int = 2) -> DataFrame:
    """How many views accept each point that has an anchor within `radius`, and whether it is carved: point_id, anchor_id, matched, votes, carved.

    A view accepts a point if it and its nearest anchor (anchor_id, x, y, z) both lie in the image and in the view's mask (frame_id, px, py), at most
    `most_pixels` apart along either axis (matched), with depths at most `depth_tolerance` apart. Points meet anchors in a grid.
    """
    from .neighbors import nearest_within

    near = nearest_within(points, anchors, radius).select("point_id", "anchor_id")
    place = anchors.select("anchor_id", *(F.col(a).alias(f"a{a}") for a in "xyz"))
    rows = project_points(points.select("point_id", "x", "y", "z").join(near, "point_id").join(place, "anchor_id"), cameras)
    cams = small(cameras.select("frame_id", "fx", "fy", "cx", "cy", "w", "h", "r", "t"))
    rows = rows.join(cams, "frame_id").withColumns({f"_{c}": camera_axis(i, F.col("ax"), F.col("ay"), F.col("az")) for i, c in enumerate("xyz")}).where(F.col("_z") > NEAR)
    rows = rows.withColumns({"qx": F.rint(F.col("fx") * F.col("_x") / F.col("_z") + F.col("cx")), "qy": F.rint(F.col("fy") * F.col("_y") / F.col("_z") + F.col("cy"))})
    rows = rows.where((F.col("qx") >= 0) & (F.col("qx") < F.col("w")) & (F.col("qy") >= 0) & (F.col("qy") < F.col("h")) & (F.greatest(F.abs(F.col("px") - F.col("qx")), F.abs(F.col("py") - F.col("qy"))) <= most_pixels))
    rows = rows.select("frame_id", "point_id", "px", "py", F.col("qx").cast("int").alias("qx"), F.col("qy").cast("int").alias("qy"), (F.abs(F.col("depth") - F.col("_z")) <= depth_tolerance).alias("close"))
    mask = masks.select("frame_id", "px", "py").distinct()
    both = rows.join(mask, ["frame_id", "px", "py"], "left_semi").join(mask.withColumnsRenamed({"px": "qx", "py": "qy"}), ["frame_id", "qx", "qy"], "left_semi")
    votes = both.groupBy("point_id").agg(F.count("*").alias("matched"), F.count_if("close").alias("votes"))
    out = near.join(votes, "point_id", "left").select("point_id", "anchor_id", F.coalesce("matched", F.lit(0)).alias("matched"), F.coalesce("votes", F.lit(0)).alias("votes"))
    return out.withColumn("carved", F.col("votes") >= min_votes)


def split_by_boxes(points: DataFrame, boxes: DataFrame, cell: float = 1.0) -> DataFrame:
    """Label points (point_id, u, v) by boxes (mask, x0, y0, x1, y1, score): the nearest centre in half extents (at least 1) wins.

    Score, then name break ties. Of boxes alike in place and score only the first name can win, so they
    are counted and joined once. Points meet the list of boxes of their grid cell of `cell`, so they are dealt by
    point_id once and never multiplied. Returns point_id, label (null outside all boxes) and n_boxes, one row a point.
    """
    each = boxes.groupBy("x0", "y0", "x1", "y1", "score").agg(F.min("mask").alias("mask"), F.count("*").alias("n"))
    at = lambda c: F.floor(c / cell)
    cells = each.withColumn("cx", F.explode(F.sequence(at(F.col("x0")), at(F.col("x1"))))).withColumn("cy", F.explode(F.sequence(at(F.col("y0")), at(F.col("y1")))))
    few = cells.limit(10_001).count() <= 10_000
    lists = cells.groupBy("cx", "cy").agg(F.collect_list(F.struct("x0", "y0", "x1", "y1", "score", "mask", "n")).alias("boxes"))
    half = lambda a, b: F.greatest((b - a) / 2, F.lit(1.0))

    def inside(b: Column) -> Column:
        return F.col("u").between(b["x0"], b["x1"]) & F.col("v").between(b["y0"], b["y1"])

    def order(b: Column) -> Column:
        du, dv = (F.col("u") - (b["x0"] + b["x1"]) / 2) / half(b["x0"], b["x1"]), (F.col("v") - (b["y0"] + b["y1"]) / 2) / half(b["y0"], b["y1"])
        return F.struct(((du * du + dv * dv) - b["score"] * 1e-9).alias("far"), b["mask"].alias("mask"), b["n"].alias("n"))

    held = dealt(points.select("point_id", "u", "v"), "point_id").withColumns({"cx": at(F.col("u")), "cy": at(F.col("v"))})
    held = held.join(F.broadcast(lists) if few else by_sort(lists), ["cx", "cy"], "left").select("point_id", F.transform(F.filter("boxes", inside), order).alias("in"))
    rows = held.select("point_id", F.array_min("in").alias("best"), F.coalesce(F.aggregate("in", F.lit(0).cast("long"), lambda n, b: n + b["n"]), F.lit(0)).alias("n"))
    return rows.groupBy("point_id").agg(F.min_by("best.mask", "best").alias("label"), F.sum("n").alias("n_boxes"))
