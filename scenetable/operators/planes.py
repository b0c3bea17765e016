"""Structural planes: dominant axes of a mesh, plane candidates, envelopes, and rays that hit bounded planes."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import NEAR, camera_axis, world_axis
from .common import checkpointed, small
from .mesh import with_corners
from .visibility import unproject_pixels, zbuffer

AXES = ("x", "y", "z")


def _dot(a: Column | list[Column], b: Column | list[Column]) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def face_geometry(vertices: DataFrame, faces: DataFrame, least_area: float = 1e-10) -> DataFrame:
    """Centre, unit normal and area of each face (mesh_id, fid, v0, v1, v2) over its vertices (mesh_id, vid, x, y, z).

    Faces whose doubled area is `least_area` or less, or that name a missing or non-finite vertex, are left out.
    Three joins by (mesh_id, vid).
    """
    rows = with_corners(vertices, faces)
    side = lambda k: [F.col(f"{a}{k}") - F.col(f"{a}0") for a in AXES]
    p, q = side(1), side(2)
    cross = [p[1] * q[2] - p[2] * q[1], p[2] * q[0] - p[0] * q[2], p[0] * q[1] - p[1] * q[0]]
    rows = rows.withColumns({f"_{a}": c for a, c in zip(AXES, cross, strict=True)}).withColumn("_d", F.sqrt(F.col("_x") * F.col("_x") + F.col("_y") * F.col("_y") + F.col("_z") * F.col("_z")))
    rows = rows.where((F.col("_d") > least_area) & (F.col("_d") < float("inf")))
    centre = [((F.col(f"{a}0") + F.col(f"{a}1") + F.col(f"{a}2")) / 3).alias(f"c{a}") for a in AXES]
    return rows.select("mesh_id", "fid", *centre, *((F.col(f"_{a}") / F.col("_d")).alias(f"n{a}") for a in AXES), (F.col("_d") / 2).alias("area"))


def _orthonormal(matrix: np.ndarray) -> np.ndarray:
    """The nearest right-handed frame (rows)."""
    u, _, vt = np.linalg.svd(matrix)
    return u @ np.diag([1.0, 1.0, np.sign(np.linalg.det(u @ vt)) or 1.0]) @ vt


def dominant_axes(faces: DataFrame, bucket: float = 0.05, angle: float = 12.0, rounds: int = 5, most: int = 64) -> tuple[np.ndarray, list[float]]:
    """The three orthogonal directions that carry most face area (nx, ny, nz, area), as rows of a right-handed frame, and their areas.

    Normals are turned so that their largest component is positive, and fall into buckets whose areas are summed.
    The heaviest bucket is the first direction and the heaviest that stands nearly square to it the second, of
    the `most` heaviest buckets that are no two nearly parallel. Each of `rounds` rounds sums the outer
    products of the normals within `angle` degrees of an axis, by axis, and takes their main directions. The driver holds
    buckets of directions, whose number `bucket` bounds, and nine sums an axis. Areas of equal normals are summed and written first, so the rounds
    do not read the mesh again.
    """
    faces = checkpointed(faces.groupBy(*(f"n{a}" for a in AXES)).agg(F.sum("area").alias("area")))
    n = [F.col(f"n{a}") for a in AXES]
    size = [F.abs(c) for c in n]
    main = F.when((size[0] >= size[1]) & (size[0] >= size[2]), n[0]).when(size[1] >= size[2], n[1]).otherwise(n[2])
    sign = F.when(main < 0, -1.0).otherwise(1.0)
    cells = faces.groupBy(*(F.rint(sign * c / bucket).cast("int").alias(f"b{a}") for a, c in zip(AXES, n, strict=True))).agg(F.sum("area").alias("w"))
    picked: list[np.ndarray] = []
    for row in cells.orderBy(F.desc("w"), "bx", "by", "bz").collect():
        d = np.array([row.bx, row.by, row.bz], float)
        if not d.any():
            continue
        d /= np.linalg.norm(d)
        if all(abs(d @ e) <= 0.94 for e in picked):
            picked.append(d)
        if len(picked) == most:
            break
    second = next((d for d in picked[1:] if abs(d @ picked[0]) < 0.35), None)
    if second is None:
        raise ValueError("the normals have no two directions that stand square to each other")
    second = second - picked[0] * (second @ picked[0])
    second /= np.linalg.norm(second)
    axes = _orthonormal(np.stack([picked[0], second, np.cross(picked[0], second)]))
    cut = math.cos(math.radians(angle))
    for done in range(rounds + 1):
        along = [F.abs(sum(F.lit(float(v)) * c for v, c in zip(axis, n, strict=True))) for axis in axes]
        best = F.when((along[0] >= along[1]) & (along[0] >= along[2]), 0).when(along[1] >= along[2], 1).otherwise(2)
        near = faces.withColumns({"axis": best, "along": F.greatest(*along)}).where(F.col("along") >= cut)
        sums = near.groupBy("axis").agg(F.sum("area").alias("area"), *(F.sum(F.col("area") * n[i] * n[j]).alias(f"o{i}{j}") for i in range(3) for j in range(3))).collect()
        held = {r.axis: r for r in sums}
        if len(held) < 3:
            raise ValueError("an axis has no face within the angle")
        if done == rounds:
            return axes, [held[k].area for k in range(3)]
        new = []
        for k in range(3):
            _, vectors = np.linalg.eigh(np.array([[held[k][f"o{i}{j}"] for j in range(3)] for i in range(3)]))
            new.append(vectors[:, -1] * (1.0 if vectors[:, -1] @ axes[k] >= 0 else -1.0))
        axes = _orthonormal(np.stack(new))
    raise AssertionError


def _along(axis: np.ndarray, names: list[str]) -> Column:
    return sum((F.lit(float(v)) * F.col(c) for v, c in zip(axis, names, strict=True)), F.lit(0.0))


def axis_planes(
    faces: DataFrame, axes: np.ndarray, angle: float = 12.0, width: float = 0.1, tolerance: float = 0.15, separation: float = 0.4, most: int = 16
) -> DataFrame:
    """Plane candidates square to each axis: axis, offset, support_area, inlier_faces, rms, u0, u1, v0, v1, by axis and offset.

    Offsets of faces within `angle` of the axis fill a histogram weighed by area, [1 2 3 2 1] / 9 smooths it, and local maxima
    of filled bins, highest first, are peaks if no taken one is nearer than `separation`; `most` count. A peak's offset is the
    weighted median of the offsets within two bins (or tolerances); its faces are those within `tolerance` of that;
    u and v run along the other two axes, from the 0.002 to the 0.998 quantile.

    The driver sees histograms only (one row a bin); medians and bounds are window and group aggregates by peak.
    """
    spark = faces.sparkSession
    n, c = [f"n{a}" for a in AXES], [f"c{a}" for a in AXES]
    cut = math.cos(math.radians(angle))
    projected = []
    for k, axis in enumerate(axes):
        others = [axes[j] for j in range(3) if j != k]
        projected.append(faces.where(F.abs(_along(axis, n)) >= cut).select(F.lit(k).alias("axis"), _along(axis, c).alias("at"), _along(others[0], c).alias("u"), _along(others[1], c).alias("v"), "area"))
    rows = checkpointed(projected[0].union(projected[1]).union(projected[2]))
    low = {r.axis: math.floor(r.low / width) * width for r in rows.groupBy("axis").agg(F.min("at").alias("low")).collect()}
    if not low:
        return spark.createDataFrame([], "axis int, offset double, support_area double, inlier_faces long, rms double, u0 double, u1 double, v0 double, v1 double")
    start = F.create_map(*(F.lit(x) for pair in low.items() for x in pair))[F.col("axis")]
    rows = rows.withColumn("bin", F.floor((F.col("at") - start) / width))
    bins = rows.groupBy("axis", "bin").agg(F.sum("area").alias("w")).collect()
    peaks: list[tuple[int, float]] = []
    for k in low:
        held = {r.bin: r.w for r in bins if r.axis == k}
        smooth = lambda b, held=held: sum(held.get(b + d, 0.0) * (3 - abs(d)) for d in range(-2, 3)) / 9.0
        top = [b for b in held if held[b] > 0 and smooth(b) >= smooth(b - 1) and smooth(b) >= smooth(b + 1)]
        taken: list[float] = []
        starts = {b: low[k] + (b + 0.5) * width for b in top}
        near = _medians(rows.where(F.col("axis") == k), starts, max(2 * tolerance, 2 * width), width)
        for b in sorted(top, key=lambda b: (-smooth(b), -b)):
            if len(taken) < most and b in near and all(abs(starts[b] - t) >= separation for t in taken):
                taken.append(near[b])
        peaks += [(k, t) for t in taken]
    table = spark.createDataFrame(peaks, "axis int, offset double")
    inside = rows.join(F.broadcast(table), "axis").where(F.abs(F.col("at") - F.col("offset")) <= tolerance)  # 16 peaks an axis at most
    e = F.col("at") - F.col("offset")
    bounds = [F.percentile(x, q).alias(f"{x}{i}") for x in ("u", "v") for i, q in ((0, 0.002), (1, 0.998))]
    out = inside.groupBy("axis", "offset").agg(F.sum("area").alias("support_area"), F.count("*").alias("inlier_faces"), F.sqrt(F.sum(F.col("area") * e * e) / F.sum("area")).alias("rms"), *bounds)
    return out.orderBy("axis", "offset")


def _medians(rows: DataFrame, starts: dict[int, float], reach: float, width: float) -> dict[int, float]:
    """The weighted median of `at` (weight area) within `reach` of each bin's middle: where the running weight first comes to half.

    Rows meet the bins that they are near by equal bin numbers.
    """
    steps = math.ceil(reach / width) + 1
    table = rows.sparkSession.createDataFrame([(b, s, b + d) for b, s in starts.items() for d in range(-steps, steps + 1)], "peak long, start double, bin long")
    near = rows.join(F.broadcast(table), "bin").where(F.abs(F.col("at") - F.col("start")) <= reach).groupBy(F.col("peak").alias("bin"), "at").agg(F.sum("area").alias("w"))
    whole = Window.partitionBy("bin")
    run = near.withColumns({"run": F.sum("w").over(whole.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)), "half": F.sum("w").over(whole) / 2})
    return {r.bin: r.m for r in run.where(F.col("run") >= F.col("half")).groupBy("bin").agg(F.min("at").alias("m")).collect()}


def anchored(candidates: DataFrame, axes: np.ndarray, anchors: DataFrame, tolerance: float = 0.35) -> DataFrame:
    """How well each plane candidate is borne out by anchor points (role, x, y, z): adds score and support.

    A role whose points span little along one axis (a quarter of the next span at most) speaks for planes square to that
    axis only. support is an array of (role, inliers, fraction, median_residual); score sums the fractions. Candidates are few;
    points are aggregated by role and candidate.
    """
    turned = anchors.select("role", *(_along(axis, list(AXES)).alias(f"p{k}") for k, axis in enumerate(axes)))
    spans = turned.groupBy("role").agg(F.count("*").alias("n"), *((F.percentile(f"p{k}", 0.998) - F.percentile(f"p{k}", 0.002)).alias(f"s{k}") for k in range(3)))
    order = F.array_sort(F.array(*(F.struct(F.col(f"s{k}").alias("s"), F.lit(k).alias("k")) for k in range(3))))
    roles = spans.select("role", "n", F.when(order[0]["s"] <= F.greatest(order[1]["s"] * 0.25, F.lit(1e-6)), order[0]["k"]).alias("only"))
    each = turned.select("role", F.posexplode(F.array("p0", "p1", "p2")).alias("axis", "at")).join(F.broadcast(roles), "role")
    near = each.where(F.col("only").isNull() | (F.col("only") == F.col("axis"))).join(F.broadcast(candidates.select("axis", "offset")), "axis")
    gap = F.abs(F.col("at") - F.col("offset"))
    near = near.withColumn("gap", gap).where(F.col("gap") <= tolerance).groupBy("axis", "offset", "role").agg(F.count("*").alias("inliers"), F.first("n").alias("n"), F.percentile("gap", 0.5).alias("median_residual"))
    one = F.struct("role", "inliers", (F.col("inliers") / F.col("n")).alias("fraction"), "median_residual")
    found = near.groupBy("axis", "offset").agg(F.sum(F.col("inliers") / F.col("n")).alias("score"), F.sort_array(F.collect_list(one)).alias("support"))
    return candidates.join(found, ["axis", "offset"], "left").withColumn("score", F.coalesce("score", F.lit(0.0)))


def envelope_planes(
    candidates: DataFrame, axes: np.ndarray, centres: DataFrame, anchors: DataFrame, min_support: float = 0.05, clearance: float = 0.5, margin: float = 0.6, min_fraction: float = 0.01, tolerance: float = 0.35
) -> DataFrame:
    """The planes that bound the cameras (x, y, z), one on each side of each axis where a candidate is there.

    Of the candidates (as `anchored` gives them) with `min_support` of their axis' largest area that lie beyond all cameras by `clearance`, the
    best anchored, then the largest, is taken; only well anchored ones if there are any (`min_fraction`). The role with the
    largest fraction, if that is enough, moves the plane to the median of its points within `tolerance` and widens its bounds;
    bounds then grow by `margin`. Returns plane_id, axis, side, role, n, u, v (arrays), offset, u0, u1, v0, v1, support_area.
    """
    spark = candidates.sparkSession
    cams = centres.agg(*(f(_along(axis, list(AXES))).alias(f"{e}{k}") for k, axis in enumerate(axes) for e, f in (("low", F.min), ("high", F.max)))).first()
    most = Window.partitionBy("axis")
    low, high = (F.create_map(*(F.lit(x) for k in range(3) for x in (k, float(cams[f"{e}{k}"]))))[F.col("axis")] for e in ("low", "high"))
    strong = candidates.withColumn("top", F.max("support_area").over(most)).where(F.col("support_area") >= F.col("top") * min_support)
    side = F.when(F.col("offset") < low - clearance, "negative").when(F.col("offset") > high + clearance, "positive")
    order = Window.partitionBy("axis", "side").orderBy(F.desc(F.col("score") >= min_fraction), F.desc("score"), F.desc("support_area"), "offset")
    best = strong.withColumn("side", side).where(F.col("side").isNotNull()).withColumn("k", F.row_number().over(order)).where("k = 1")
    top = F.array_max(F.transform(F.coalesce("support", F.array()), lambda s: F.struct(s["fraction"].alias("fraction"), s["role"].alias("role"))))
    best = best.withColumn("role", F.when(top["fraction"] >= min_fraction, top["role"]))
    best = checkpointed(best.select("axis", "side", "offset", "role", "support_area", "u0", "u1", "v0", "v1"))  # six rows at most
    turned = anchors.select("role", *(_along(axis, list(AXES)).alias(f"p{k}") for k, axis in enumerate(axes)))
    place = F.array("p0", "p1", "p2")
    near = turned.join(F.broadcast(best.where("role IS NOT NULL").select("axis", "side", "offset", "role")), "role")
    pick = lambda i: F.when(F.col("axis") <= i, place[i + 1]).otherwise(place[i])  # noqa: E731  the first and second of the other axes
    near = near.select("axis", "side", place[F.col("axis")].alias("at"), "offset", pick(0).alias("u"), pick(1).alias("v")).where(F.abs(F.col("at") - F.col("offset")) <= tolerance)
    moved = near.groupBy("axis", "side").agg(F.percentile("at", 0.5).alias("new"), *(F.percentile(x, q).alias(f"a{x}{i}") for x in ("u", "v") for i, q in ((0, 0.002), (1, 0.998))))
    full = best.join(moved, ["axis", "side"], "left")
    frames = spark.createDataFrame([(k, axes[k].tolist(), *(axes[j].tolist() for j in range(3) if j != k)) for k in range(3)], "axis int, n array<double>, u array<double>, v array<double>")
    bounds = [(F.least(f"{x}0", f"a{x}0") - margin).alias(f"{x}0") for x in ("u", "v")] + [(F.greatest(f"{x}1", f"a{x}1") + margin).alias(f"{x}1") for x in ("u", "v")]
    number = F.row_number().over(Window.orderBy("axis", "side"))
    return full.join(F.broadcast(frames), "axis").select(number.alias("plane_id"), "axis", "side", F.coalesce("role", F.lit("structural_boundary")).alias("role"), "n", "u", "v", F.coalesce("new", "offset").alias("offset"), *bounds, "support_area")


def plane_tiles(planes: DataFrame, cameras: DataFrame, keys: list[str], tile: int = 16, thickness: float = 0.0) -> DataFrame:
    """The image tiles that each bounded plane can touch in each camera of its scene: the plane's columns, frame_id, ty, tx.

    The corners of the rectangle (with a thickness, of the box around it) in front of the camera give the range; a plane
    that reaches behind the camera goes to all tiles. Planes and cameras meet by `keys` (the scene).
    """
    flat = planes.withColumnsRenamed({"u": "pu", "v": "pv"})
    ends = [F.struct(F.col(f"u{i}").alias("a"), F.col(f"v{j}").alias("b"), F.lit(s).alias("s")) for i in (0, 1) for j in (0, 1) for s in {-thickness, thickness}]
    corners = flat.select(*keys, "plane_id", "n", "offset", "pu", "pv", F.explode(F.array(*ends)).alias("e"))
    place = [F.col("n")[k] * (F.col("offset") + F.col("e.s")) + F.col("pu")[k] * F.col("e.a") + F.col("pv")[k] * F.col("e.b") for k in range(3)]
    corners = corners.select(*keys, "plane_id", *(c.alias(f"p{a}") for c, a in zip(place, AXES, strict=True)))
    cams = small(cameras.select(*keys, "frame_id", "fx", "fy", "cx", "cy", "w", "h", "r", "t"))
    seen = corners.join(cams, keys).select(*keys, "plane_id", "frame_id", "fx", "fy", "cx", "cy", "w", "h", *(camera_axis(k, F.col("px"), F.col("py"), F.col("pz")).alias(f"c{a}_") for k, a in enumerate(AXES)))
    front = F.col("cz_") > NEAR
    across = {"x": F.when(front, F.col("fx") * F.col("cx_") / F.col("cz_") + F.col("cx")), "y": F.when(front, F.col("fy") * F.col("cy_") / F.col("cz_") + F.col("cy"))}
    held = seen.groupBy(*keys, "plane_id", "frame_id", "w", "h").agg(F.bool_or(front).alias("front"), F.bool_or(~front).alias("behind"), *(f(across[a]).alias(f"{a}{i}") for a in "xy" for i, f in ((0, F.min), (1, F.max))))
    for a, size in (("x", "w"), ("y", "h")):
        last = F.col(size) - 1.0
        held = held.withColumns({f"{a}0": F.when(F.col("behind"), 0.0).otherwise(F.greatest(F.col(f"{a}0") - 1, F.lit(0.0))), f"{a}1": F.when(F.col("behind"), last).otherwise(F.least(F.col(f"{a}1") + 1, last))})
    held = held.where(F.col("front") & (F.col("x0") <= F.col("x1")) & (F.col("y0") <= F.col("y1")))
    cells = lambda a: F.explode(F.sequence(F.floor(F.col(f"{a}0") / tile).cast("int"), F.floor(F.col(f"{a}1") / tile).cast("int")))
    return held.withColumn("ty", cells("y")).select(*keys, "plane_id", "frame_id", "ty", cells("x").alias("tx")).join(flat, [*keys, "plane_id"]).drop(*keys)


def _tiled(pixels: DataFrame, tile: int) -> DataFrame:
    return pixels.withColumns({"ty": F.floor(F.col("y") / tile).cast("int"), "tx": F.floor(F.col("x") / tile).cast("int")})


def ray_plane_hits(pixels: DataFrame, cameras: DataFrame, planes: DataFrame, keys: list[str], tile: int = 16, least_depth: float = 1e-5) -> DataFrame:
    """The nearest bounded plane on each pixel's ray: frame_id, y, x, plane_id, depth, wx, wy, wz; pixels that meet none are left out.

    Planes (`keys`, plane_id, n, offset, u, v, u0, u1, v0, v1) of a camera's scene go to the tiles they touch and pixels
    (frame_id, y, x) meet them there, so no pixel is compared with a plane elsewhere. Of equal depths the least plane_id is hit.
    """
    cams = small(cameras.select("frame_id", "fx", "fy", "cx", "cy", "r", "t"))
    tiles = plane_tiles(planes, cameras, keys, tile).join(cams.select("frame_id", "r", "t"), "frame_id")
    start, r, d = [world_axis(k, F.lit(0.0), F.lit(0.0), F.lit(0.0)) for k in range(3)], F.col("r"), (F.col("dx"), F.col("dy"), F.lit(1.0))
    turned = {f"{name}{k}": r[3 * k] * F.col(c)[0] + r[3 * k + 1] * F.col(c)[1] + r[3 * k + 2] * F.col(c)[2] for name, c in (("n_", "n"), ("u_", "pu"), ("v_", "pv")) for k in range(3)}
    tiles = tiles.select("frame_id", "ty", "tx", "plane_id", "u0", "u1", "v0", "v1", (F.col("offset") - _dot(start, F.col("n"))).alias("gap"), _dot(start, F.col("pu")).alias("ou"), _dot(start, F.col("pv")).alias("ov"), *(c.alias(n) for n, c in turned.items()))
    ray = pixels.join(cams, "frame_id").select("frame_id", "y", "x", ((F.col("x") - F.col("cx")) / F.col("fx")).alias("dx"), ((F.col("y") - F.col("cy")) / F.col("fy")).alias("dy"))
    rows = _tiled(ray, tile).join(tiles, ["frame_id", "ty", "tx"])
    along = {name: _dot([F.col(f"{name}_{k}") for k in range(3)], d) for name in "nuv"}
    rows = rows.withColumn("depth", F.when(F.abs(along["n"]) > 1e-9, F.col("gap") / F.nullif(along["n"], F.lit(0.0)))).where(F.col("depth") > least_depth)
    inside = (F.col("ou") + F.col("depth") * along["u"]).between(F.col("u0"), F.col("u1")) & (F.col("ov") + F.col("depth") * along["v"]).between(F.col("v0"), F.col("v1"))
    hits = zbuffer(rows.where(inside).select("frame_id", "y", "x", "depth", "plane_id"), ["frame_id", "y", "x"], ["plane_id"], "plane_id")
    return unproject_pixels(hits, cameras)


def plane_support(pixels: DataFrame, cameras: DataFrame, planes: DataFrame, keys: list[str], tolerance: float = 0.15, tile: int = 16) -> DataFrame:
    """Pixels (frame_id, y, x, depth) whose points lie on a bounded plane: frame_id, y, x, plane_id, one row for each plane they support."""
    points = _tiled(unproject_pixels(pixels.select("frame_id", "y", "x", "depth"), cameras), tile)
    rows = points.join(plane_tiles(planes, cameras, keys, tile, tolerance), ["frame_id", "ty", "tx"])
    at = [F.col(f"w{c}") for c in AXES]
    on = (F.abs(_dot(at, F.col("n")) - F.col("offset")) <= tolerance) & _dot(at, F.col("pu")).between(F.col("u0"), F.col("u1")) & _dot(at, F.col("pv")).between(F.col("v0"), F.col("v1"))
    return rows.where(on).select("frame_id", "y", "x", "plane_id")
