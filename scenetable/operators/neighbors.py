"""Neighbours of points by a grid join: cells as equal keys, exact distance after."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, small

#: Pairs of places that may be measured without more ado, and for each place.
FEW, EACH = 5_000_000, 16


def _cells(points: DataFrame, radius: float) -> DataFrame:
    return points.withColumns({f"c{a}": F.floor(F.col(a) / radius) for a in "xyz"})


def within(points: DataFrame, anchors: DataFrame, radius: float) -> DataFrame:
    """Pairs (point_id, anchor_id, d2) of points and anchors (anchor_id, x, y, z) within `radius`.

    Anchors go to the 27 cells around theirs; cells are as wide as the radius, so nothing is missed.
    """
    near = F.explode(F.sequence(F.lit(-1), F.lit(1)))
    spread = _cells(anchors.select("anchor_id", *(F.col(a) for a in "xyz")), radius)
    for a in "xyz":
        spread = spread.withColumn("d", near).withColumn(f"c{a}", F.col(f"c{a}") + F.col("d")).drop("d")
    spread = spread.select("anchor_id", "cx", "cy", "cz", *(F.col(a).alias(f"a{a}") for a in "xyz"))
    rows = _cells(points.select("point_id", "x", "y", "z"), radius).join(spread, ["cx", "cy", "cz"]).withColumn("d2", _squared())
    return rows.where(F.col("d2") <= radius * radius).select("point_id", "anchor_id", "d2")


def _boxed(places: DataFrame, side: str, width: float) -> DataFrame:
    """The filled cells (columns led by `side`): numbers c, numbers g of the cells twice as wide around them, the box of their places, and how many."""
    at = {f"{side}{k}{a}": F.floor(F.col(a) / w) for k, w in (("g", 2 * width), ("c", width)) for a in "xyz"}
    boxes = [f(a).alias(f"{side}{e}{a}") for a in "xyz" for e, f in (("l", F.min), ("h", F.max))]
    return places.withColumns(at).groupBy(*at).agg(*boxes, F.count("*").alias(f"{side}n"))


def _judged(pairs: DataFrame, radius: float) -> DataFrame:
    """The pairs of cells that can hold a place and its nearest anchor within the radius: their boxes are no farther apart than
    the farthest corners of some other pair of the same cell of places."""
    gaps = [F.greatest(F.lit(0.0), F.col(f"pl{a}") - F.col(f"ah{a}"), F.col(f"al{a}") - F.col(f"ph{a}")) for a in "xyz"]
    spans = [F.greatest(F.col(f"ph{a}") - F.col(f"al{a}"), F.col(f"ah{a}") - F.col(f"pl{a}")) for a in "xyz"]
    square = lambda sides: sum(d * d for d in sides)
    rows = pairs.withColumns({"_near": square(gaps), "_far": square(spans)}).where(F.col("_near") <= radius * radius)
    sure = F.min("_far").over(Window.partitionBy("pcx", "pcy", "pcz"))
    rows = rows.withColumn("_sure", sure).where(F.col("_near") <= F.col("_sure") * (1 + 1e-9))
    return checkpointed(rows.select(*(f"{s}c{a}" for s in "pa" for a in "xyz"), (F.col("pn") * F.col("an")).alias("n")))


def _on(side: str, letter: str) -> list[str]:
    return [f"{side}{letter}{a}" for a in "xyz"]


def _nearest(places: DataFrame, anchors: DataFrame, radius: float) -> DataFrame:
    """The nearest anchor within the radius of each of distinct places (x, y, z): x, y, z, anchor_id, d2.

    Cells of places meet cells of anchors, and only pairs that can hold a nearest anchor are halved along each axis, until few
    pairs of places are left to measure; so no pairs of a dense cell are made. Each round is written.
    """
    width, most = radius, max(FEW, EACH * places.count())
    near = F.explode(F.sequence(F.lit(-1), F.lit(1)))
    spread = _boxed(anchors, "a", width).drop(*_on("a", "g"))
    for a in "xyz":
        spread = spread.withColumn("_o", near).withColumn(f"pc{a}", F.col(f"ac{a}") + F.col("_o")).drop("_o")
    pairs = _judged(_boxed(places, "p", width).drop(*_on("p", "g")).join(spread, _on("p", "c")), radius)
    for _ in range(64):
        work, cells = pairs.agg(F.sum("n"), F.count("*")).first()
        if not cells or work <= most or work == cells:
            break
        width /= 2
        for side, rows in (("p", places), ("a", anchors)):
            pairs = pairs.drop("n").withColumnsRenamed({f"{side}c{a}": f"{side}g{a}" for a in "xyz"}).join(_boxed(rows, side, width), _on(side, "g")).drop(*_on(side, "g"))
        pairs = _judged(pairs, radius)
    numbered = lambda rows, side: rows.withColumns({f"{side}c{a}": F.floor(F.col(a) / width) for a in "xyz"})
    met = pairs.drop("n").join(numbered(anchors, "a").withColumnsRenamed({a: f"a{a}" for a in "xyz"}), _on("a", "c")).drop(*_on("a", "c"))
    met = met.join(numbered(places, "p"), _on("p", "c"))
    met = met.withColumn("d2", _squared()).where(F.col("d2") <= radius * radius)
    return met.groupBy(*"xyz").agg(F.min_by("anchor_id", F.struct("d2", "anchor_id")).alias("anchor_id"), F.min("d2").alias("d2"))


def _squared() -> Column:
    return sum((F.col(a) - F.col(f"a{a}")) * (F.col(a) - F.col(f"a{a}")) for a in "xyz")


def nearest_within(points: DataFrame, anchors: DataFrame, radius: float) -> DataFrame:
    """The nearest anchor of each point within the radius: point_id, anchor_id, d2; ties to the least anchor_id.

    Jobs run while the result is built: equal places are looked at once, and pairs of very many are not made (`_nearest`).
    """
    best = [F.min_by("anchor_id", F.struct("d2", "anchor_id")).alias("anchor_id"), F.min("d2").alias("d2")]
    if points.count() * anchors.count() <= FEW:
        return within(points, anchors, radius).groupBy("point_id").agg(*best)
    finite = lambda rows: rows.where(F.forall(F.array(*"xyz"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    places = checkpointed(finite(points).select(*"xyz").distinct())
    held = checkpointed(finite(anchors).groupBy(*"xyz").agg(F.min("anchor_id").alias("anchor_id")))
    found = checkpointed(_nearest(places, held, radius))
    return points.select("point_id", *"xyz").join(found, [*"xyz"]).groupBy("point_id").agg(*best)


def near_any(points: DataFrame, anchors: DataFrame, radius: float) -> DataFrame:
    """Points with some anchor within the radius."""
    return points.join(nearest_within(points, anchors, radius).select("point_id"), "point_id", "left_semi")


def carve_boxes(points: DataFrame, boxes: DataFrame) -> DataFrame:
    """Points (point_id, x, y, z) inside boxes (box_id, ord, x0, x1, y0, y1, z0, z1); the first box by `ord` owns."""
    inside = F.col("x").between(F.col("x0"), F.col("x1")) & F.col("y").between(F.col("y0"), F.col("y1")) & F.col("z").between(F.col("z0"), F.col("z1"))
    return points.join(small(boxes), inside).groupBy("point_id").agg(F.min_by("box_id", "ord").alias("box_id"))


def voxel_means(points: DataFrame, size: float) -> DataFrame:
    """Mean position and count of each grid cell."""
    cells = {f"v{a}": F.floor(F.col(a) / size) for a in "xyz"}
    return points.withColumns(cells).groupBy("vx", "vy", "vz").agg(F.count("*").alias("n"), *(F.avg(a).alias(f"m{a}") for a in "xyz"))
