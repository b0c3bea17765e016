"""Layered compositing with provenance, and change between frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["frame_id", "y", "x"]


def layer_composite(source: DataFrame, removal: DataFrame, layers: DataFrame, background: DataFrame | None = None) -> DataFrame:
    """Fill the removed pixels of `source` (frame_id, y, x, v) with the nearest layer (…, layer, depth, v).

    Pixels outside `removal` keep their value. The background is tried where no layer reaches. Returns
    v and label: source, layer:<name>, background or unresolved; every pixel has one label.
    """
    near = layers.where(F.col("depth") > 0).groupBy(*KEYS).agg(F.min_by(F.struct("v", "layer"), F.struct("depth", "layer", "v")).alias("n"))
    rows = source.join(removal.select(*KEYS).distinct().withColumn("gone", F.lit(True)), KEYS, "left").join(near, KEYS, "left")
    if background is not None:
        rows = rows.join(background.select(*KEYS, F.col("v").alias("bg")), KEYS, "left")
    else:
        rows = rows.withColumn("bg", F.lit(None).cast("double"))
    v = F.when(F.col("gone").isNull(), F.col("v")).otherwise(F.coalesce("n.v", "bg"))
    label = F.when(F.col("gone").isNull(), "source").when(F.col("n").isNotNull(), F.concat(F.lit("layer:"), F.col("n.layer"))).when(F.col("bg").isNotNull(), "background").otherwise("unresolved")
    return rows.select(*KEYS, v.alias("v"), label.alias("label"))


def ordered_composite(layers: DataFrame, epsilon: float) -> DataFrame:
    """The layer that wins each pixel when a later one must be nearer by more than `epsilon`: rows frame_id, y, x, ord, depth, layer."""
    own = layers.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("ord", "depth", "layer"))).alias("a"))
    best = F.aggregate("a", F.struct(F.lit(float("inf")).alias("depth"), F.lit(None).cast("string").alias("layer")), lambda acc, x: F.when(x["depth"] < acc["depth"] - epsilon, F.struct(x["depth"].alias("depth"), x["layer"].alias("layer"))).otherwise(acc))
    return own.select(*KEYS, best.alias("b")).select(*KEYS, "b.layer", "b.depth")


def alpha_over(front_v, front_a, back_v):
    return front_v * front_a + back_v * (1 - front_a)


def temporal_pairs(frames: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Each frame's values beside those of the next (seq + 1), with their differences."""
    after = frames.select(*keys, (F.col("seq") - 1).alias("seq"), *(F.col(v).alias(f"next_{v}") for v in values))
    return frames.join(after, [*keys, "seq"]).select(*keys, "seq", *values, *(f"next_{v}" for v in values), *((F.col(f"next_{v}") - F.col(v)).alias(f"d_{v}") for v in values))


def flow_warp(flow: DataFrame, target: DataFrame) -> DataFrame:
    """`target` (frame_id, y, x, v) sampled bilinearly at (x + dx, y + dy) of each flow row (id, frame_id, y, x, dx, dy); rows short of a corner are left out."""
    u, w = F.col("x") + F.col("dx"), F.col("y") + F.col("dy")
    fx, fy = u - F.floor(u), w - F.floor(w)
    corner = F.explode(F.array(*(F.struct((F.floor(u) + i).alias("cx"), (F.floor(w) + j).alias("cy"), ((fx if i else 1 - fx) * (fy if j else 1 - fy)).alias("wt")) for i in (0, 1) for j in (0, 1))))
    rows = flow.select("id", "frame_id", corner.alias("c")).select("id", "frame_id", "c.*").where(F.col("wt") > 0)
    got = rows.join(target.select("frame_id", F.col("x").cast("long").alias("cx"), F.col("y").cast("long").alias("cy"), "v"), ["frame_id", "cx", "cy"], "left")
    return got.groupBy("id", "frame_id").agg(F.sum(F.col("wt") * F.col("v")).alias("v"), F.bool_and(F.col("v").isNotNull()).alias("whole")).where("whole").drop("whole")
