"""How near the points of a cloud are to each other: nearest others without a given radius, and parts that a radius joins."""

from __future__ import annotations

from itertools import product
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, small


def in_plane(points: DataFrame, normal: list[float]) -> DataFrame:
    """`points` with u and v, their coordinates in the plane across `normal` (any length but zero)."""
    size = sqrt(sum(c * c for c in normal))
    if not size > 0:
        raise ValueError("a plane's normal has a length")
    n = [c / size for c in normal]
    k = min(range(3), key=lambda i: abs(n[i]))
    first = [(i == k) - n[i] * n[k] for i in range(3)]
    long = sqrt(sum(c * c for c in first))
    first = [c / long for c in first]
    second = [n[1] * first[2] - n[2] * first[1], n[2] * first[0] - n[0] * first[2], n[0] * first[1] - n[1] * first[0]]
    along = lambda axis: sum(F.col(c) * a for c, a in zip("xyz", axis, strict=True))
    return points.withColumns({"u": along(first), "v": along(second)})


def _finite(points: DataFrame, axes: str) -> DataFrame:
    for a in axes:
        points = points.where(F.col(a).isNotNull() & ~F.isnan(a) & (F.abs(a) < float("inf")))
    return points


def _at(axes: str, width: float) -> dict[str, Column]:
    return {f"c{a}": F.floor(F.col(a) / width) for a in axes}


def nearest_other(points: DataFrame, keys: list[str], axes: str = "xyz", crowd: int = 64) -> DataFrame:
    """The distance `d` from each point (keys, point_id, axes) to the nearest other of its group; null if it is alone.

    Equal places are 0 apart. Distinct places look into the cells around theirs, first in cells so narrow that none holds
    over `crowd`; those that find none within a cell's width go on in cells twice as wide. Their like are then at least half
    a width apart, so a cell holds few that still look, and each round is linear in the places. A point_id names one point.
    Rows with null or non-finite coordinates are left out. Jobs run while the result is built.
    """
    rows = _finite(points, axes).select(*keys, "point_id", *(F.col(a).cast("double").alias(a) for a in axes)).distinct()
    places = checkpointed(rows.groupBy(*keys, *axes).agg(F.count("*").alias("n")))
    spans = places.groupBy(*keys).agg(F.count("*").alias("m"), F.greatest(*(F.max(a) - F.min(a) for a in axes)).alias("span") if len(axes) > 1 else (F.max(axes) - F.min(axes)).alias("span"))
    most = spans.agg(F.max("m").alias("m"), F.max("span").alias("span")).first()
    alone = [*keys, *axes]
    if not most.m or most.span == 0:
        return rows.join(places, alone).select(*keys, "point_id", F.when(F.col("n") > 1, 0.0).alias("d"))
    width = most.span / max(1, ceil(most.m ** (1 / len(axes))))
    for _ in range(60):
        if places.groupBy(*keys, *_at(axes, width).values()).count().agg(F.max("count")).first()[0] <= crowd:
            break
        width /= 4
    looking, found = checkpointed(places.where("n = 1").drop("n")), places.where("n > 1").select(*alone, F.lit(0.0).alias("d"))
    while width <= 4 * most.span and looking.limit(1).count():
        around = looking.withColumns(_at(axes, width))
        for a in axes:
            around = around.withColumn("_o", F.explode(F.sequence(F.lit(-1), F.lit(1)))).withColumn(f"c{a}", F.col(f"c{a}") + F.col("_o")).drop("_o")
        others = places.select(*keys, *(c.alias(n) for n, c in _at(axes, width).items()), *(F.col(a).alias(f"o{a}") for a in axes))
        d2 = sum((F.col(a) - F.col(f"o{a}")) * (F.col(a) - F.col(f"o{a}")) for a in axes)
        near = around.join(others, [*keys, *(f"c{a}" for a in axes)]).where(~F.forall(F.array(*(F.col(a) == F.col(f"o{a}") for a in axes)), lambda same: same))
        met = checkpointed(near.groupBy(*alone).agg(F.sqrt(F.min(d2)).alias("d")).where(F.col("d") <= width))
        found = found.union(met.select(*alone, "d"))
        looking, width = checkpointed(looking.join(met, alone, "left_anti")), width * 2
    return rows.join(found, alone, "left").select(*keys, "point_id", "d")


def merged(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """The part of each node under links (a, b): node, part (some node of it).

    Each round every node hooks to the least of its neighbours, in an order of hashes that changes by round, hooks are
    followed to their ends by doubling, and links are kept between ends only, until none is left: some
    log(nodes) rounds, chains included.
    """
    parts = checkpointed(nodes.select("node", F.col("node").alias("part")))
    links, turn = checkpointed(links.select("a", "b").where("a <> b").distinct()), 0
    while links.limit(1).count():
        rank = lambda c, t=turn: F.struct(F.xxhash64(F.lit(t), c), F.col(c))
        both = links.union(links.select("b", "a"))
        up = checkpointed(both.groupBy("a").agg(F.min(rank("b")).alias("r")).where(F.col("r") < rank("a")).select("a", F.col("r.b").alias("up")))
        while True:
            on = up.select(F.col("a").alias("up"), F.col("up").alias("far"))
            moved = checkpointed(up.join(on, "up", "left").select("a", F.coalesce("far", "up").alias("up"), "far"))
            up = moved.drop("far")
            if not moved.where(F.col("far").isNotNull()).limit(1).count():
                break
        parts = checkpointed(parts.join(up.withColumnRenamed("a", "part"), "part", "left").select("node", F.coalesce("up", "part").alias("part")))
        ends = links
        for c in "ab":
            ends = ends.join(up.select(F.col("a").alias(c), "up"), c, "left").withColumn(c, F.coalesce("up", c)).drop("up")
        links, turn = checkpointed(ends.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()), turn + 1
    return parts


def _boxes(cells: DataFrame, by: list[str], axes: str) -> DataFrame:
    return cells.groupBy(*by).agg(*(F.min(a).alias(f"lo_{a}") for a in axes), *(F.max(a).alias(f"hi_{a}") for a in axes))


def _sided(boxes: DataFrame, side: str, keep: list[str]) -> DataFrame:
    return boxes.select(*keep, *(F.col(c).alias(f"{side}_{c}") for c in boxes.columns if c not in keep))


def _judged(pairs: DataFrame, axes: str, radius: float) -> DataFrame:
    """`pairs` of boxes that can hold points within the radius, with `sure`: all their points are."""
    near = sum(F.pow(F.greatest(F.lit(0.0), F.col(f"b_lo_{a}") - F.col(f"a_hi_{a}"), F.col(f"a_lo_{a}") - F.col(f"b_hi_{a}")), 2) for a in axes)
    far = sum(F.pow(F.greatest(F.abs(F.col(f"b_hi_{a}") - F.col(f"a_lo_{a}")), F.abs(F.col(f"a_hi_{a}") - F.col(f"b_lo_{a}"))), 2) for a in axes)
    return pairs.where(near <= radius * radius).withColumn("sure", far <= radius * radius)


def radius_parts(points: DataFrame, keys: list[str], radius: float, axes: str = "uv") -> DataFrame:
    """The part of each point (keys, point_id, axes) when points of a group within `radius` are linked: keys, point_id, part, its least point_id.

    A cell whose diagonal is the radius is one part, so cells are linked, not points. Two cells are linked if the boxes of
    their points say so; where they cannot tell, both are halved along each axis, and only the pieces that still cannot
    tell go on, down to single places. No pairs of points of a dense cell are made. A point_id names one point of the table.
    Rows with null or non-finite coordinates are left out. Jobs run while the result is built.
    """
    if not radius > 0:
        raise ValueError("the radius must be positive")
    side, cell = radius / sqrt(len(axes)) * (1 - 1e-9), [f"c{a}" for a in axes]
    rows = _finite(points, axes).select(*keys, "point_id", *(F.col(a).cast("double").alias(a) for a in axes)).withColumns(_at(axes, side))
    nodes = checkpointed(rows.groupBy(*keys, *cell).agg(F.min("point_id").alias("node"), *(F.min(a).alias(f"lo_{a}") for a in axes), *(F.max(a).alias(f"hi_{a}") for a in axes)))
    ahead = [o for o in product(range(-2, 3), repeat=len(axes)) if o > (0,) * len(axes)]
    step = F.explode(F.array(*(F.array(*map(F.lit, o)) for o in ahead))).alias("_o")
    left = _sided(nodes.select("*", step), "a", [*keys, *cell, "_o"]).withColumns({c: F.col(c) + F.col("_o")[i] for i, c in enumerate(cell)}).drop("_o")
    tried = checkpointed(_judged(left.join(_sided(nodes, "b", [*keys, *cell]), [*keys, *cell]), axes, radius).drop(*keys, *cell))
    links = tried.where("sure").select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    parent = [f"p{a}" for a in axes]
    placed = rows.join(nodes.select(*keys, *cell, "node"), [*keys, *cell]).select("node", *axes)
    open_ = checkpointed(tried.where("not sure").select("a_node", "b_node"))
    grain, level = side, 0
    first = placed.withColumns(_at(axes, side))
    open_ = open_.join(_sided(first.select("node", *cell).distinct(), "a", []), "a_node").join(_sided(first.select("node", *cell).distinct(), "b", []), "b_node") if open_.limit(1).count() else None
    while open_ is not None:
        grain, level = grain / 2, level + 1
        # Halving parts any two places in the end; places that division makes equal are told apart by themselves.
        by = ["node", *parent, *cell, *(axes if level > 50 else ())]
        asked = open_.select(F.col("a_node").alias("node")).union(open_.select("b_node")).distinct()
        fine = placed.join(asked, "node", "left_semi").withColumns({p: F.floor(F.col(a) / (grain * 2)) for p, a in zip(parent, axes, strict=True)}).withColumns(_at(axes, grain))
        boxes = checkpointed(_boxes(fine, by, axes).select("node", *parent, *cell, *(f"{e}_{a}" for a in axes for e in ("lo", "hi"))))
        pairs = open_.select("a_node", "b_node", *(F.col(f"{s}_{c}").alias(f"{s}_p{c[1:]}") for s in "ab" for c in cell))
        for s in "ab":
            pairs = pairs.join(_sided(boxes, s, []), [f"{s}_node", *(f"{s}_{p}" for p in parent)])
        tried = checkpointed(_judged(pairs, axes, radius).select("a_node", "b_node", *(f"{s}_{c}" for s in "ab" for c in cell), "sure"))
        sure = tried.where("sure").select("a_node", "b_node").distinct()
        links = links.union(sure)
        left = checkpointed(tried.where("not sure").join(sure, ["a_node", "b_node"], "left_anti").drop("sure"))
        open_ = left if left.limit(1).count() else None
    parts = merged(nodes, links)
    named = checkpointed(parts.join(parts.groupBy("part").agg(F.min("node").alias("least")), "part").select("node", F.col("least").alias("part")))
    return rows.join(nodes.select(*keys, *cell, "node").join(named, "node").drop("node"), [*keys, *cell]).select(*keys, "point_id", "part")


#: The quantiles reported of nearest distances.
QUANTILES = {"minimum": 0.0, "q005": 0.005, "q01": 0.01, "q05": 0.05, "median": 0.5, "q95": 0.95, "q99": 0.99, "q995": 0.995, "maximum": 1.0}


def largest_planar_part(points: DataFrame, keys: list[str], normal: list[float], radius: float) -> tuple[DataFrame, DataFrame]:
    """The largest part of each cloud in the plane across `normal`, when points within `radius` there are linked, and a report.

    The first result holds keys and point_id of the points kept; of equal parts the one with the least point_id. The second
    holds by group: n_points, n_parts, largest, fraction, second (0 without another), and quantiles of the distances in
    the plane to the nearest other point, null for a lone one.
    """
    flat = in_plane(points, normal)
    parts = checkpointed(radius_parts(flat, keys, radius))
    sizes = checkpointed(parts.groupBy(*keys, "part").agg(F.count("*").alias("n")))
    top = small(checkpointed(sizes.groupBy(*keys).agg(F.min_by("part", F.struct(-F.col("n"), F.col("part"))).alias("part"))))  # a sort by part would gather the largest
    kept = parts.join(top, [*keys, "part"], "left_semi").select(*keys, "point_id")
    totals = sizes.groupBy(*keys).agg(F.sum("n").alias("n_points"), F.count("*").alias("n_parts"), F.max("n").alias("largest"), F.max("part").alias("_any"))
    second = sizes.join(top, [*keys, "part"], "left_anti").groupBy(*keys).agg(F.max("n").alias("second"))
    spaced = nearest_other(flat, keys, "uv").groupBy(*keys).agg(F.percentile("d", F.array(*map(F.lit, QUANTILES.values()))).alias("_q"))
    spaced = spaced.select(*keys, *(F.get("_q", F.lit(i)).alias(name) for i, name in enumerate(QUANTILES)))
    out = totals.drop("_any").join(second, keys, "left").join(spaced, keys, "left")
    return kept, out.select(*keys, "n_points", "n_parts", "largest", (F.col("largest") / F.col("n_points")).alias("fraction"), F.coalesce("second", F.lit(0)).alias("second"), *QUANTILES)
