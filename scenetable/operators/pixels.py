"""Sparse masks and stencils: set algebra, morphology, seams, texture, components."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import by_sort, checkpointed

PIXEL = ["frame_id", "y", "x"]


def mask_union(*masks: DataFrame) -> DataFrame:
    out = masks[0].select(*PIXEL)
    for m in masks[1:]:
        out = out.union(m.select(*PIXEL))
    return out.distinct()


def mask_partition(base: DataFrame, extra: DataFrame) -> DataFrame:
    """Pixels of either mask with their class: base, extra or both. Each pixel has one."""
    both = base.select(*PIXEL, F.lit(1).alias("k")).union(extra.select(*PIXEL, F.lit(2).alias("k"))).groupBy(*PIXEL).agg(F.bit_or("k").alias("k"))
    return both.select(*PIXEL, F.when(F.col("k") == 3, "both").when(F.col("k") == 1, "base").otherwise("extra").alias("part"))


#: Rows and columns of a tile of a frame; the keys of a pixel in a tile.
TILE, TILED = 64, ["frame_id", "ty", "tx", "y", "x"]


def tiled(rows: DataFrame, reach: int) -> DataFrame:
    """`rows` shuffled by the tiles (ty, tx) of their frame, to each tile that has pixels within `reach` (Chebyshev) of theirs.

    What spreads over neighbours within a tile afterwards, grouped by TILED, needs no shuffle of its copies. The number of partitions is
    given, as Spark would join small ones that grow by the copies.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = lambda c: F.explode(F.sequence(F.floor((F.col(c) - reach) / TILE), F.floor((F.col(c) + reach) / TILE)))
    return rows.withColumn("ty", near("y")).withColumn("tx", near("x")).repartition(parts, "frame_id", "ty", "tx")


def own(axis: str) -> Column:
    """Whether a pixel lies in its tile along an axis, not beside it."""
    return F.floor(F.col(axis) / TILE) == F.col(f"t{axis}")


def dilate(mask: DataFrame, radius: int) -> DataFrame:
    """Chebyshev dilation by tiles, rows first and then columns: 2 (2r + 1) copies a pixel, not (2r + 1)^2, and none is shuffled."""
    steps = F.explode(F.sequence(F.lit(-radius), F.lit(radius)))
    wide = tiled(mask.select(*PIXEL), radius).select(*TILED, steps.alias("d")).select(*TILED[:4], (F.col("x") + F.col("d")).alias("x")).where(own("x")).distinct()
    return wide.select(*TILED, steps.alias("d")).select(*TILED[:3], (F.col("y") + F.col("d")).alias("y"), "x").where(own("y")).distinct().select(*PIXEL)


def erode(mask: DataFrame, radius: int) -> DataFrame:
    """Pixels whose whole Chebyshev neighbourhood is in the mask."""
    steps = F.explode(F.sequence(F.lit(-radius), F.lit(radius)))
    full = 2 * radius + 1
    rows = tiled(mask.select(*PIXEL), radius).distinct().select(*TILED, steps.alias("d")).groupBy(*TILED[:4], (F.col("x") + F.col("d")).alias("x")).count().where(own("x") & (F.col("count") == full))
    return rows.select(*TILED, steps.alias("d")).groupBy(*TILED[:3], (F.col("y") + F.col("d")).alias("y"), "x").count().where(own("y") & (F.col("count") == full)).select(*PIXEL)


def close(mask: DataFrame, radius: int) -> DataFrame:
    return erode(dilate(mask, radius), radius)


def ring(mask: DataFrame, inner: int, outer: int) -> DataFrame:
    """Pixels at a Chebyshev distance over `inner` and up to `outer`."""
    return dilate(mask, outer).join(by_sort(dilate(mask, inner)), PIXEL, "left_anti")


def inner_boundary(mask: DataFrame) -> DataFrame:
    return mask.distinct().join(by_sort(erode(mask, 1)), PIXEL, "left_anti")


def mask_geometry(mask: DataFrame, keys: list[str]) -> DataFrame:
    """Area, half-open box and centre of each mask."""
    return mask.groupBy(*keys).agg(F.count("*").alias("area"), F.min("x").alias("x0"), F.min("y").alias("y0"), (F.max("x") + 1).alias("x1"), (F.max("y") + 1).alias("y1"), F.avg("x").alias("cx"), F.avg("y").alias("cy"))


def beside(value: Column, axis: str, step: int) -> Column:
    """The value of the neighbour pixel along an axis; null over a gap or the border."""
    other = "y" if axis == "x" else "x"
    w = Window.partitionBy("frame_id", other).orderBy(axis)
    return F.when(F.lag(axis, -step).over(w) == F.col(axis) + step, F.lag(value, -step).over(w))


def laplacian(image: DataFrame) -> DataFrame:
    """4-neighbour Laplacian of column v over pixels whose four neighbours are there."""
    v = F.col("v")
    rows = image.select(*PIXEL, "v", *(beside(v, a, s).alias(f"{a}{s + 1}") for a in ("x", "y") for s in (-1, 1)))
    out = F.col("x0") + F.col("x2") + F.col("y0") + F.col("y2") - 4 * v
    return rows.select(*PIXEL, "v", out.alias("lap")).where(F.col("lap").isNotNull())


def seam_jumps(image: DataFrame) -> DataFrame:
    """|v - v of the right or lower neighbour| where one of the two is in the mask column `inside`."""
    parts = []
    for axis in ("x", "y"):
        rows = image.select(*PIXEL, "v", "inside", beside(F.col("v"), axis, 1).alias("nv"), beside(F.col("inside"), axis, 1).alias("ni"))
        parts.append(rows.where(F.col("ni").isNotNull() & (F.col("inside") != F.col("ni"))).select("frame_id", F.abs(F.col("v") - F.col("nv")).alias("jump")))
    return parts[0].union(parts[1])


def energy_ratio(values: DataFrame, quantile: float = 0.95) -> DataFrame:
    """Mean energy of the core over that of the ring, both capped at the common `quantile`: by frame.

    Input rows: frame_id, region ("core" or "ring"), energy.
    """
    cap = values.groupBy("frame_id").agg(F.percentile("energy", quantile).alias("cap"))
    capped = values.join(cap, "frame_id").withColumn("e", F.least("energy", "cap"))
    means = capped.groupBy("frame_id").agg(F.avg(F.when(F.col("region") == "core", F.col("e"))).alias("core"), F.avg(F.when(F.col("region") == "ring", F.col("e"))).alias("ring"))
    return means.withColumn("ratio", F.when(F.col("ring") > 0, F.col("core") / F.col("ring")))


def _band_parts(reach: int) -> Callable[[pa.Table], pa.Table]:
    def joined(rows: pa.Table) -> pa.Table:
        """The least run id of each run's part within the band: runs of two rows in turn are gone through side by side."""
        rows = rows.sort_by([("y", "ascending"), ("a", "ascending")])
        y, a, b, run = (rows.column(c).to_pylist() for c in ("y", "a", "b", "run"))
        up = list(range(len(run)))

        def root(i: int) -> int:
            while up[i] != i:
                up[i] = i = up[up[i]]
            return i

        at = {}
        for i, v in enumerate(y):
            at.setdefault(v, [i, i])[1] = i + 1
        for v, (i, last) in at.items():
            j, end = at.get(v - 1, (0, 0))
            while i < last and j < end:
                if a[i] <= b[j] + reach and a[j] <= b[i] + reach:
                    p, q = root(i), root(j)
                    if run[p] <= run[q]:
                        up[q] = p
                    else:
                        up[p] = q
                if b[i] < b[j]:
                    i += 1
                else:
                    j += 1
        return pa.table([rows.column("run"), pa.array([run[root(i)] for i in range(len(run))], pa.int64())], names=["run", "label"])

    return joined


def run_labels(runs: DataFrame, reach: int = 0) -> DataFrame:
    """The part of each run (frame_id, y, a, b, run) of a mask's rows: run, label, the least run id of its part.

    Runs touch those of the next row that they overlap, or with `reach` 1 meet at a corner. Parts are found in bands of TILE rows of a frame first.
    Parts that touch over a band's edge are then joined: each round every part takes the least label of those it touches, then its label's
    label, until none changes. Only parts at edges go through the rounds. The runs must be a written table.
    """
    parts = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    band = F.floor(F.col("y") / TILE)
    rows = runs.select("frame_id", "y", "a", "b", "run").withColumn("band", band).repartition(parts, "frame_id", "band")
    local = checkpointed(rows.groupBy("frame_id", "band").applyInArrow(_band_parts(reach), "run long, label long"))
    edge = runs.where((F.col("y") % TILE == 0) | ((F.col("y") + 1) % TILE == 0)).select("frame_id", "y", "a", "b", "run")
    edge = edge.join(local.withColumnRenamed("label", "part"), "run")
    above = edge.where((F.col("y") + 1) % TILE == 0).select("frame_id", (F.col("y") + 1).alias("y"), F.col("a").alias("a2"), F.col("b").alias("b2"), F.col("part").alias("part2"))
    touch = edge.where(F.col("y") % TILE == 0).join(above, ["frame_id", "y"]).where((F.col("a") <= F.col("b2") + reach) & (F.col("a2") <= F.col("b") + reach)).select("part", "part2")
    edges = checkpointed(touch.union(touch.select("part2", "part")).distinct())
    if not edges.limit(1).count():
        return local
    labels = checkpointed(edges.select("part", F.col("part").alias("label")).distinct())
    while True:
        near = edges.join(labels.select(F.col("part").alias("part2"), "label"), "part2").groupBy("part").agg(F.min("label").alias("m"))
        step = labels.join(near, "part", "left").select("part", F.least("label", F.coalesce("m", "label")).alias("label"), F.col("label").alias("old"))
        jump = step.select(F.col("part").alias("label"), F.col("label").alias("far"))
        new = checkpointed(step.join(jump, "label", "left").select("part", F.least("label", F.coalesce("far", "label")).alias("label"), "old"))
        labels = new.drop("old")
        if not new.where(F.col("label") != F.col("old")).limit(1).count():
            break
    far = labels.withColumnRenamed("label", "far")
    return local.join(far.withColumnRenamed("part", "label"), "label", "left").select("run", F.coalesce("far", "label").alias("label"))


def connected_components(mask: DataFrame, eight: bool = False) -> DataFrame:
    """4-connected (or 8-connected) parts of masks: adds `label`, the least run id of the part.

    Rows are first made runs of neighbours, so labels travel between runs, not pixels.
    """
    w = Window.partitionBy("frame_id", "y").orderBy("x")
    cells = mask.select(*PIXEL).distinct().withColumn("g", F.col("x") - F.row_number().over(w))
    runs = cells.groupBy("frame_id", "y", "g").agg(F.min("x").alias("a"), F.max("x").alias("b"))
    runs = checkpointed(runs.withColumn("run", F.xxhash64("frame_id", "y", "a")))
    labels = run_labels(runs, int(eight))
    return cells.join(runs.select("frame_id", "y", "g", "run"), ["frame_id", "y", "g"]).join(labels, "run").select(*PIXEL, "label")
