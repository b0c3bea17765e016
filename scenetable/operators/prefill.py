"""Donor prefill: pixels of other frames moved into a frame's removed region and fused where they agree."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.geometry import NEAR, camera_axis
from .common import by_sort, checkpointed, small
from .fuse import robust_fuse
from .pixels import PIXEL, dilate
from .visibility import unproject_pixels

COLOURS = ["r", "g", "b"]
#: Rows and columns of a tile of a target frame.
TILE = 64


def _nearest_of_tile(splat: int, rows: pa.Table, region: pa.Table | None, schema: pa.Schema) -> pa.Table:
    """The nearest donor pixel of each target pixel and donor in a tile, each donor pixel covering its square there; in `region` only, if given."""
    if not len(rows) or (region is not None and not len(region)):
        return schema.empty_table()
    px, py, w, h, place, depth = (rows.column(c).to_numpy() for c in ("px", "py", "w", "h", "place", "depth"))
    top, left = rows.column("ty")[0].as_py() * TILE, rows.column("tx")[0].as_py() * TILE
    asked = np.ones((TILE, TILE), bool)
    if region is not None:
        asked[:] = False
        asked[region.column("y").to_numpy() - top, region.column("x").to_numpy() - left] = True
    found = []
    for k, (oy, ox) in enumerate((oy, ox) for oy in range(-splat, splat + 1) for ox in range(-splat, splat + 1)):
        y, x = py + oy, px + ox
        here = np.nonzero((y >= max(top, 0)) & (y < np.minimum(h, top + TILE)) & (x >= max(left, 0)) & (x < np.minimum(w, left + TILE)))[0]
        here = here[asked[y[here] - top, x[here] - left]]
        found.append((here, y[here], x[here], np.full(len(here), k)))
    at, y, x, k = (np.concatenate(c) for c in zip(*found, strict=True))
    donor = rows.column("donor_id").combine_chunks().dictionary_encode().indices.to_numpy()[at]
    order = np.lexsort((place[at], k, depth[at], x, y, donor))
    at, y, x, donor = at[order], y[order], x[order], donor[order]
    first = np.ones(len(at), bool)
    first[1:] = (donor[1:] != donor[:-1]) | (y[1:] != y[:-1]) | (x[1:] != x[:-1])
    picked = rows.take(pa.array(at[first]))
    columns = [picked.column("frame_id"), picked.column("donor_id"), pa.array(y[first].astype(np.int32)), pa.array(x[first].astype(np.int32)), picked.column("depth"), *(picked.column(f"own_{c}") for c in COLOURS)]
    return pa.table([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def reproject_pixels(pixels: DataFrame, cameras: DataFrame, views: DataFrame, stride: int = 2, splat: int = 1, targets: DataFrame | None = None) -> DataFrame:
    """Donor pixels in their targets: the nearest of each target pixel and donor.

    `pixels` (frame_id, y, x, depth, r, g, b) are donors', of which every `stride`th row and column with a valid depth is
    moved into the frames that `views` (donor_id, frame_id) names and covers a square of `splat` pixels around its place
    there. Returns frame_id, donor_id, y, x, depth (in the target's camera), r, g, b. Of equal depths the first by place in
    the square (row, then column), then by place in the donor, counts. With `targets` (frame_id, y, x) only those pixels come out.

    Pixels meet views by donor and cameras by frame, both equal keys. They are shuffled before they cover their squares: a group is a tile
    of a frame, and a pixel goes to the tiles that its square touches.
    """
    every = pixels.where((F.col("y") % stride == 0) & (F.col("x") % stride == 0))
    every = every.select(*PIXEL, "depth", *(F.col(c).alias(f"own_{c}") for c in COLOURS))  # cameras have a column r too
    own = [f"own_{c}" for c in COLOURS]
    world = unproject_pixels(every, cameras).select(F.col("frame_id").alias("donor_id"), (F.col("y") * 65536 + F.col("x")).alias("place"), "wx", "wy", "wz", *own)
    moved = world.join(small(views.select("donor_id", "frame_id")), "donor_id").join(small(cameras.select("frame_id", "fx", "fy", "cx", "cy", "w", "h", "r", "t")), "frame_id")
    axis = {f"_{a}": camera_axis(i, F.col("wx"), F.col("wy"), F.col("wz")) for i, a in enumerate("xyz")}
    moved = moved.withColumns(axis).where((F.col("_z") > NEAR) & (F.col("_z") < float("inf")))
    moved = moved.withColumns({"px": F.rint(F.col("fx") * F.col("_x") / F.col("_z") + F.col("cx")).cast("long"), "py": F.rint(F.col("fy") * F.col("_y") / F.col("_z") + F.col("cy")).cast("long")})
    near = (F.col("px") >= -splat) & (F.col("px") < F.col("w") + splat) & (F.col("py") >= -splat) & (F.col("py") < F.col("h") + splat)
    moved = moved.where(near).select("frame_id", "donor_id", "px", "py", F.col("w").cast("long").alias("w"), F.col("h").cast("long").alias("h"), F.col("_z").alias("depth"), "place", *own)
    tiles = lambda c, size: F.explode(F.sequence(F.floor(F.greatest(F.col(c) - splat, F.lit(0)) / TILE), F.floor(F.least(F.col(c) + splat, F.col(size) - 1) / TILE)))
    tiled = moved.withColumn("ty", tiles("py", "h")).withColumn("tx", tiles("px", "w"))
    kinds = dict(tiled.dtypes)
    out = StructType.fromDDL(f"frame_id {kinds['frame_id']}, donor_id {kinds['donor_id']}, y int, x int, depth double, " + ", ".join(f"{c} {kinds[f'own_{c}']}" for c in COLOURS))
    schema = to_arrow_schema(out)
    groups = tiled.groupBy("frame_id", "ty", "tx")
    if targets is None:
        return by_sort(groups.applyInArrow(lambda rows: _nearest_of_tile(splat, rows, None, schema), out))
    asked = targets.select(*PIXEL).withColumns({"ty": F.floor(F.col("y") / TILE), "tx": F.floor(F.col("x") / TILE)})
    return by_sort(groups.cogroup(asked.groupBy("frame_id", "ty", "tx")).applyInArrow(lambda rows, region: _nearest_of_tile(splat, rows, region, schema), out))


def _colour(c: str) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(255.0), F.rint(c))).alias(c)


def fused(samples: DataFrame, absolute: float = 0.08, relative: float = 0.01, min_support: int = 2) -> DataFrame:
    """Donor samples fused by pixel: support, median depth and whole median colours of the inliers."""
    out = robust_fuse(samples, PIXEL, COLOURS, absolute, relative, min_support)
    return out.select(*PIXEL, "support", "depth", *(_colour(c) for c in COLOURS))


def guard_stable_fuse(configured: DataFrame, guard: DataFrame, removal: DataFrame, min_retention: float = 0.25, **fuse: float) -> tuple[DataFrame, DataFrame]:
    """Fuse samples taken under two exclusion masks and keep the pixels that both support, with the guard's values.

    Samples (frame_id, y, x, depth, r, g, b) count inside `removal` (frame_id, y, x) only. Returns the stable pixels (as
    `fused`) and a row for each frame of the removal: configured_pixels, guard_pixels, stable_pixels, retention (null without
    configured support), passed and failure_reason.
    """
    region = removal.select(*PIXEL).distinct()
    one = checkpointed(fused(configured.join(region, PIXEL, "left_semi"), **fuse))
    two = checkpointed(fused(guard.join(region, PIXEL, "left_semi"), **fuse))
    stable = two.join(one, PIXEL, "left_semi")
    parts = one.select("frame_id", F.lit(1).alias("c"), F.lit(0).alias("g"), F.lit(0).alias("s"))
    parts = parts.union(two.select("frame_id", F.lit(0), F.lit(1), F.lit(0))).union(stable.select("frame_id", F.lit(0), F.lit(0), F.lit(1)))
    parts = parts.union(region.groupBy("frame_id").agg(F.lit(0), F.lit(0), F.lit(0)))
    frames = parts.groupBy("frame_id").agg(F.sum("c").alias("configured_pixels"), F.sum("g").alias("guard_pixels"), F.sum("s").alias("stable_pixels"))
    retention = F.when(F.col("configured_pixels") > 0, F.col("stable_pixels") / F.col("configured_pixels"))
    reason = F.when(F.col("configured_pixels") == 0, "no_configured_support").when(F.col("retention") < min_retention, "boundary_guard_retention_below_minimum")
    frames = frames.withColumn("retention", retention).withColumns({"passed": F.coalesce(F.col("retention") >= min_retention, F.lit(False)), "failure_reason": reason})
    return stable, frames


def donor_prefill(
    pixels: DataFrame,
    cameras: DataFrame,
    removal: DataFrame,
    exclusion: DataFrame,
    views: DataFrame,
    stride: int = 2,
    splat: int = 1,
    dilation: int = 4,
    guard: int | None = 4,
    min_retention: float = 0.25,
    exclude_own: bool = True,
    **fuse: float,
) -> tuple[DataFrame, DataFrame]:
    """Fill each frame's removed pixels from the other frames of the scene that saw what is behind.

    `exclusion` (frame_id, y, x) are objects in donors, widened by `dilation`, and once more by `guard` for the
    guard branch (None: no guard; then the configured support counts). `views` (donor_id, frame_id) says which donors serve a
    frame; a frame is no donor of its own. Returns all pixels of the frames with a removal: frame_id, y, x, r, g, b, depth and
    support of measured ones, and label (source, measured or residual; a residual pixel keeps its colours), and the
    frames' row of `guard_stable_fuse` with removed_pixels and coverage.
    """
    views = views.where(F.col("donor_id") != F.col("frame_id")) if exclude_own else views
    inside, branches = removal.select(*PIXEL).distinct(), []
    for wide in [dilation] + ([] if guard is None else [dilation + guard]):
        free = pixels.join(by_sort(dilate(exclusion, wide)), PIXEL, "left_anti")
        branches.append(reproject_pixels(free, cameras, views, stride, splat, inside))
    stable, frames = guard_stable_fuse(branches[0], branches[-1], removal, min_retention, **fuse)
    region = removal.select(*PIXEL).distinct().withColumn("removed", F.lit(True))
    new = stable.select(*PIXEL, "support", "depth", *(F.col(c).alias(f"new_{c}") for c in COLOURS), F.lit(True).alias("measured"))
    own = pixels.join(small(frames.select("frame_id")), "frame_id", "left_semi").select(*PIXEL, *COLOURS)
    both = own.join(region, PIXEL, "left").join(new, PIXEL, "left")
    label = F.when(F.col("removed").isNull(), "source").when(F.col("measured"), "measured").otherwise("residual")
    out = both.select(*PIXEL, *(F.coalesce(F.when(F.col("removed"), F.col(f"new_{c}")), F.col(c).cast("double")).alias(c) for c in COLOURS), "depth", F.coalesce("support", F.lit(0)).alias("support"), label.alias("label"))
    sizes = region.groupBy("frame_id").agg(F.count("*").alias("removed_pixels"))
    frames = frames.join(sizes, "frame_id").withColumn("coverage", F.col("stable_pixels") / F.col("removed_pixels"))
    return out, frames
