"""Distances and fills on pixel grids: Euclidean distance, soft bands, boundary distances, holes, directional fill, blur."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import smoothstep
from .common import by_sort, checkpointed
from .pixels import PIXEL, close, inner_boundary, run_labels

#: Columns of a tile of the column pass.
TILE = 64


def _row_runs(mask: DataFrame) -> DataFrame:
    """Runs of neighbours in each row: frame_id, y, a, b (both inside)."""
    w = Window.partitionBy("frame_id", "y").orderBy("x")
    cells = mask.select(*PIXEL).distinct().withColumn("g", F.col("x") - F.row_number().over(w))
    return cells.groupBy("frame_id", "y", "g").agg(F.min("x").alias("a"), F.max("x").alias("b")).drop("g")


def _tile_pass(radius: int) -> Callable[[pa.Table], pa.Table]:
    def lowest(rows: pa.Table) -> pa.Table:
        """d2 = least (x - x')^2 + (y - y')^2 of mask pixels up to `radius` along either axis, all pixels of the tile at once."""
        y, x, tile = (rows.column(c).to_numpy().astype(np.int64) for c in ("y", "x", "tile"))
        top, left = int(y.min()) - radius, int(tile[0]) * TILE
        far = (radius + 1) ** 2
        held = np.zeros((int(y.max()) + radius - top + 1, TILE + 2 * radius), bool)
        held[y - top, x - left + radius] = True
        at = np.arange(held.shape[1])
        before = np.maximum.accumulate(np.where(held, at, -far), axis=1)[:, radius : radius + TILE]
        after = np.minimum.accumulate(np.where(held, at, len(at) + far)[:, ::-1], axis=1)[:, ::-1][:, radius : radius + TILE]
        at = at[radius : radius + TILE]
        held = np.minimum(np.minimum(at - before, after - at), radius + 1) ** 2
        best = held.copy()
        for d in range(1, min(radius, len(held) - 1) + 1):
            np.minimum(best[d:], held[:-d] + d * d, out=best[d:])
            np.minimum(best[:-d], held[d:] + d * d, out=best[:-d])
        yy, xx = np.nonzero(best <= radius * radius)
        frame = pa.array([rows.column("frame_id")[0].as_py()] * len(yy), rows.schema.field("frame_id").type)
        return pa.table([frame, pa.array((yy + top).astype(np.int32)), pa.array((xx + left).astype(np.int32)), pa.array(best[yy, xx])], names=["frame_id", "y", "x", "d2"])

    return lowest


def bounded_distance(mask: DataFrame, radius: int) -> DataFrame:
    """Squared Euclidean distances to the nearest pixel of each frame's mask (frame_id, y, x), up to `radius`: frame_id, y, x, d2.

    Mask pixels go to the tiles of 64 columns of a frame that they can reach; the separable distance is done tile by tile, rows first and then
    columns. No pixel is copied for its neighbours but in its tile's array; a task holds one tile. The number of partitions is given, as Spark
    would join small ones that grow by the distances. Pixels beyond the frame come out too; join them with the image. The mask has 0.
    """
    parts = int(mask.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tiles = F.explode(F.sequence(F.floor((F.col("x") - radius) / TILE), F.floor((F.col("x") + radius) / TILE)))
    rows = mask.select(*PIXEL).withColumn("tile", tiles).repartition(parts, "frame_id", "tile")
    kind = dict(mask.dtypes)["frame_id"]
    return by_sort(rows.groupBy("frame_id", "tile").applyInArrow(_tile_pass(radius), f"frame_id {kind}, y int, x int, d2 long"))


def soft_bands(core: DataFrame, protected: DataFrame, pixels: DataFrame, collar: int) -> DataFrame:
    """The bands of every pixel near a core mask: frame_id, y, x, band, weight.

    core has weight 1; the collar, up to `collar` pixels (Euclidean) outside, falls to 0 by a smoothstep of
    (collar + 1 - d) / (collar + 1) where it is not `protected`; protected pixels of the collar have weight 0. Only pixels of
    the image `pixels` (frame_id, y, x) come out; those not named have weight 0.
    """
    near = bounded_distance(core, collar).join(pixels.select(*PIXEL), PIXEL, "left_semi")
    kept = near.join(by_sort(protected.select(*PIXEL).distinct().withColumn("p", F.lit(True))), PIXEL, "left")
    band = F.when(F.col("d2") == 0, "core").when(F.col("p"), "protected_collar").otherwise("collar")
    weight = F.when(F.col("d2") == 0, 1.0).when(F.col("p"), 0.0).otherwise(smoothstep((collar + 1.0 - F.sqrt(F.col("d2").cast("double"))) / (collar + 1.0)))
    return kept.select(*PIXEL, band.alias("band"), weight.alias("weight"))


def blend(previous: DataFrame, candidate: DataFrame, bands: DataFrame, values: list[str]) -> DataFrame:
    """`candidate` over `previous` (frame_id, y, x and values) by the bands' weights, rounded half even to 0 .. 255; elsewhere the previous."""
    new = candidate.select(*PIXEL, *(F.col(v).alias(f"new_{v}") for v in values))
    rows = previous.select(*PIXEL, *values).join(by_sort(bands.select(*PIXEL, "weight")), PIXEL, "left").join(by_sort(new), PIXEL, "left")
    w = F.when(F.col(f"new_{values[0]}").isNotNull(), F.coalesce("weight", F.lit(0.0))).otherwise(0.0)
    mixed = [F.greatest(F.lit(0.0), F.least(F.lit(255.0), F.rint(F.coalesce(F.col(f"new_{v}"), F.lit(0)) * w + F.col(v) * (1 - w)))).alias(v) for v in values]
    return rows.select(*PIXEL, *mixed)


def _to_nearest(samples: DataFrame, mask: DataFrame, radius: int) -> DataFrame:
    """The exact distance of each sample pixel to the mask of its frame; what lies beyond a radius is looked for within four times that.

    Samples of frames without a mask are left out.
    """
    open_ = checkpointed(samples.join(mask.select("frame_id").distinct(), "frame_id", "left_semi"))
    found = None
    while True:
        near = checkpointed(open_.join(bounded_distance(mask, radius), PIXEL, "left"))
        done = near.where(F.col("d2").isNotNull())
        found = done if found is None else found.unionByName(done)
        open_ = near.where(F.col("d2").isNull()).drop("d2")
        if not open_.limit(1).count():
            return found
        mask = mask.join(open_.select("frame_id").distinct(), "frame_id", "left_semi")
        radius *= 4


def mask_alignment(removal: DataFrame, target: DataFrame, radius: int = 16) -> DataFrame:
    """How two masks of a frame agree: pixels, IoU, precision, recall, and symmetric distances of their inner boundaries.

    Distances are exact at any size. Returns a row for each frame that has both masks.
    """
    both = removal.select(*PIXEL, F.lit(1).alias("k")).union(target.select(*PIXEL, F.lit(2).alias("k"))).groupBy(*PIXEL).agg(F.bit_or("k").alias("k"))
    counts = both.groupBy("frame_id").agg(F.count_if(F.col("k") != 2).alias("removal_pixels"), F.count_if(F.col("k") != 1).alias("target_pixels"), F.count_if(F.col("k") == 3).alias("intersection"), F.count("*").alias("union"))
    edges = [checkpointed(inner_boundary(m)) for m in (removal, target)]
    ways = _to_nearest(edges[0], edges[1], radius).unionByName(_to_nearest(edges[1], edges[0], radius))
    d = F.sqrt(F.col("d2").cast("double"))
    lines = ways.groupBy("frame_id").agg(F.count("*").alias("boundary_samples"), F.percentile(d, 0.5).alias("median_px"), F.percentile(d, 0.95).alias("p95_px"), F.max(d).alias("max_px"))
    share = lambda a, b: (F.col(a) / F.col(b))
    return counts.join(lines, "frame_id").select(
        "frame_id", "removal_pixels", "target_pixels", "intersection", "union", share("intersection", "union").alias("iou"), share("intersection", "removal_pixels").alias("precision"), share("intersection", "target_pixels").alias("recall"),
        (F.col("removal_pixels") - F.col("intersection")).alias("removal_only"), (F.col("target_pixels") - F.col("intersection")).alias("target_only"), "boundary_samples", "median_px", "p95_px", "max_px",
    )


def enclosed_holes(mask: DataFrame, frames: DataFrame, min_pixels: int = 1, min_share: float = 0.0, bridge: int = 0, eight: bool = False) -> DataFrame:
    """Pixels to add to each mask: parts of its complement that do not reach the border of the frame (frame_id, w, h): frame_id, y, x, label.

    Parts of at least max(1, min_pixels, min_share of the frame's pixels) count; neighbours are 4, or 8. With `bridge` the topology is that
    of the mask closed by that radius, but only pixels of the parts are added. Parts are joined run by run: a run of the complement
    between two mask pixels of a row may be enclosed, one at the side of the mask's box is open. A notch stays open.
    """
    topology = close(mask, bridge).join(frames, "frame_id").where((F.col("x") >= 0) & (F.col("x") < F.col("w")) & (F.col("y") >= 0) & (F.col("y") < F.col("h"))).select(*PIXEL) if bridge else mask.select(*PIXEL)
    runs = _row_runs(topology)
    box = runs.groupBy("frame_id").agg(F.min("y").alias("y0"), F.max("y").alias("y1"), F.min("a").alias("x0"), F.max("b").alias("x1")).join(frames.select("frame_id", "w", "h"), "frame_id")
    rows = box.withColumn("y", F.explode(F.sequence(F.greatest(F.col("y0") - 1, F.lit(0)), F.least(F.col("y1") + 1, F.col("h") - 1))))
    rows = rows.withColumns({"left": F.greatest(F.col("x0") - 1, F.lit(0)), "right": F.least(F.col("x1") + 1, F.col("w") - 1), "edge": (F.col("y") == F.greatest(F.col("y0") - 1, F.lit(0))) | (F.col("y") == F.least(F.col("y1") + 1, F.col("h") - 1))})
    held = runs.groupBy("frame_id", "y").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("runs"))  # at most half a row's pixels
    gaps = by_sort(rows).join(held, ["frame_id", "y"], "left").withColumn("runs", F.coalesce("runs", F.array().cast("array<struct<a:int,b:int>>")))
    starts = F.concat(F.array("left"), F.transform("runs", lambda r: r["b"] + 1))
    stops = F.concat(F.transform("runs", lambda r: r["a"] - 1), F.array("right"))
    gaps = gaps.select("frame_id", "y", "left", "right", "edge", "w", "h", F.explode(F.arrays_zip(starts.alias("a"), stops.alias("b"))).alias("g")).select("frame_id", "y", "left", "right", "edge", "w", "h", "g.a", "g.b").where(F.col("a") <= F.col("b"))
    gaps = gaps.withColumn("open", F.col("edge") | (F.col("a") == F.col("left")) | (F.col("b") == F.col("right")))
    gaps = checkpointed(gaps.withColumn("run", F.xxhash64("frame_id", "y", "a")))
    labels = run_labels(gaps.select("frame_id", "y", "a", "b", "run"), 1 if eight else 0)
    parts = gaps.join(labels, "run")
    sizes = parts.groupBy("label").agg(F.bool_or("open").alias("open"), F.sum(F.col("b") - F.col("a") + 1).alias("n"), F.first("w").alias("w"), F.first("h").alias("h"))
    least = F.greatest(F.lit(1), F.lit(min_pixels), F.ceil(F.col("w") * F.col("h") * F.lit(float(min_share))))
    inner = sizes.where(~F.col("open") & (F.col("n") >= least)).select("label")
    return parts.join(inner, "label", "left_semi").select("frame_id", "y", F.explode(F.sequence("a", "b")).alias("x"), "label")


def gradient_cost(texels: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Mean absolute step between neighbouring observed texels down the columns and along the rows, over all values: keys, down, along.

    Texels: keys, row, col, observed and values. Null where no two neighbours are observed.
    """
    steps = []
    for name, line, place in (("down", "col", "row"), ("along", "row", "col")):
        w = Window.partitionBy(*keys, line).orderBy(place)
        ready = F.col("observed") & F.lag("observed").over(w) & (F.lag(place).over(w) == F.col(place) - 1)
        step = sum((F.abs(F.col(v) - F.lag(v).over(w)) for v in values), F.lit(0.0)) / len(values)
        steps.append(F.when(ready, step).alias(name))
    rows = texels.select(*keys, *steps)
    return rows.groupBy(*keys).agg(F.avg("down").alias("down"), F.avg("along").alias("along"))


def _nearest_known(values: list[str], keys: list[str], line: str, place: str) -> Column:
    """Of the known texels before and after on a line, the nearer one's place and values; the one before at equal distance."""
    w = Window.partitionBy(*keys, line).orderBy(place)
    known = F.when(F.col("observed"), F.struct(F.col(place).alias("_at"), *values))
    before = F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(known, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    first = before.isNotNull() & (after.isNull() | (F.col(place) - before["_at"] <= after["_at"] - F.col(place)))
    return F.when(first, before).otherwise(after)


def directional_fill(texels: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Each unobserved texel takes the nearest observed one of its column or row, whichever way the values change less.

    Texels: keys, row, col, observed, values; a dense grid by key. Down the columns if that way's `gradient_cost` is not
    more (a way without neighbours costs most). Adds direction and source (the row or column taken; null
    on a line without observed texels, whose values become null). Two windows that skip nulls; no pairs of texels.
    """
    cost = gradient_cost(texels, keys, values)
    most = F.lit(float("inf"))
    way = F.when(F.coalesce("down", most) <= F.coalesce("along", most), "down").otherwise("along")
    rows = texels.join(cost.select(*keys, way.alias("direction")), keys)
    line, place = F.when(F.col("direction") == "down", F.col("col")).otherwise(F.col("row")), F.when(F.col("direction") == "down", F.col("row")).otherwise(F.col("col"))
    rows = rows.withColumns({"_line": line, "_place": place})
    rows = rows.withColumn("_n", _nearest_known(values, [*keys, "direction"], "_line", "_place"))
    return rows.select(*keys, "row", "col", "observed", "direction", F.col("_n._at").alias("source"), *(F.when(F.col("observed"), F.col(v)).otherwise(F.col(f"_n.{v}")).alias(v) for v in values))


def gaussian_kernel(sigma: float, truncate: float = 3.0) -> list[float]:
    if sigma <= 0:
        raise ValueError("sigma must be positive")
    radius = max(1, math.ceil(sigma * truncate))
    k = [math.exp(-0.5 * (i / sigma) ** 2) for i in range(-radius, radius + 1)]
    return [v / sum(k) for v in k]


def separable_blur(texels: DataFrame, keys: list[str], values: list[str], sigma: float, truncate: float = 3.0) -> DataFrame:
    """Gaussian blur of `values` along rows, then columns, of a dense grid by key (row, col); edge texels stand in beyond the edges.

    Two windows, by row and by column: no texel is copied for its neighbours.
    """
    kernel = gaussian_kernel(sigma, truncate)
    radius = len(kernel) // 2
    for line, place in (("row", "col"), ("col", "row")):
        w = Window.partitionBy(*keys, line).orderBy(place)
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        texels = texels.withColumns({f"_e{e}_{v}": f(v).over(whole) for v in values for e, f in ((0, F.first), (1, F.last))})
        out = {}
        for v in values:
            beside = [F.coalesce(F.lead(v, i).over(w), F.col(f"_e{int(i > 0)}_{v}")) for i in range(-radius, radius + 1)]
            out[v] = sum((F.lit(k) * c for k, c in zip(kernel, beside, strict=True)), F.lit(0.0))
        texels = texels.withColumns(out).drop(*(f"_e{e}_{v}" for v in values for e in (0, 1)))
    return texels


def normalized_fill(texels: DataFrame, keys: list[str], values: list[str], sigma: float) -> DataFrame:
    """Unobserved texels take the blur of the observed ones over the blur of their weight; null where that is under 1e-6."""
    known = texels.withColumns({"_w": F.col("observed").cast("double")} | {f"_b_{v}": F.when(F.col("observed"), F.col(v)).otherwise(0.0).cast("double") for v in values})
    soft = separable_blur(known, keys, ["_w", *(f"_b_{v}" for v in values)], sigma)
    fill = lambda v: F.when(F.col("_w") >= 1e-6, F.col(f"_b_{v}") / F.greatest("_w", F.lit(1e-6)))
    return soft.select(*keys, "row", "col", "observed", *(F.when(F.col("observed"), F.col(v)).otherwise(fill(v)).alias(v) for v in values))


def shadow_collar(removal: DataFrame, support: DataFrame, protected: DataFrame, radius: int) -> DataFrame:
    """Pixels around a removal (Chebyshev, up to `radius`) that lie on a structural plane: frame_id, y, x, kept.

    `support` are pixels on planes (as `plane_support` gives them). Those in `protected` come out with kept false and are not added.
    """
    from .pixels import ring

    near = ring(removal, 0, radius).join(by_sort(support.select(*PIXEL).distinct()), PIXEL, "left_semi")
    own = near.join(by_sort(protected.select(*PIXEL).distinct().withColumn("p", F.lit(True))), PIXEL, "left")
    return own.select(*PIXEL, F.col("p").isNull().alias("kept"))
