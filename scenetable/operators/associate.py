"""Detections matched with objects over many frames: metrics from projections and masks, one match a frame, evidence from separated views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import camera_center
from .common import by_sort, checkpointed, small
from .match import assign, pair_scores, separated_evidence
from .pixels import dilate
from .visibility import visible_pixels


def _box(x: str, y: str):
    return F.struct(F.min(x).cast("double").alias("x0"), F.min(y).cast("double").alias("y0"), (F.max(x) + 1).cast("double").alias("x1"), (F.max(y) + 1).cast("double").alias("y1"))


def pair_metrics(seen: DataFrame, masks: DataFrame, detections: DataFrame, dilation: int = 4) -> DataFrame:
    """The metrics of each object and detection of a frame that meet at all, with quality and eligibility (`pair_scores`).

    `seen` are objects' pixels (frame_id, obj, px, py, depth, visible; `visible_pixels`), `masks` detections' (frame_id, detection_id, y, x), detections have
    frame_id, detection_id, score. A pair meets if a mask pixel lies within `dilation` (Chebyshev) of a visible pixel; other pairs
    are never eligible and have no row. Adds n_projected, n_occluded and the visible depths' least, median and largest. All joins are on
    pixels; the dilation goes along rows, then columns.
    """
    own = seen.groupBy("frame_id", "obj").agg(F.count("*").alias("n_projected"), F.count_if("visible").alias("n_visible"))
    shown = seen.where("visible")
    sizes = shown.groupBy("frame_id", "obj").agg(_box("px", "py").alias("box_a"), F.min("depth").alias("depth_min"), F.percentile("depth", 0.5).alias("depth_median"), F.max("depth").alias("depth_max"))
    mask = masks.select("frame_id", "detection_id", F.col("y").alias("py"), F.col("x").alias("px")).distinct()
    areas = mask.groupBy("frame_id", "detection_id").agg(F.count("*").alias("n_mask"), _box("px", "py").alias("box_b"))
    hits = shown.join(by_sort(mask), ["frame_id", "px", "py"]).groupBy("frame_id", "obj", "detection_id").agg(F.count("*").alias("n_hit"))
    wide = dilate(shown.select(F.struct("frame_id", "obj").alias("frame_id"), F.col("py").alias("y"), F.col("px").alias("x")), dilation).select("frame_id.frame_id", "frame_id.obj", F.col("y").alias("py"), F.col("x").alias("px"))
    near = wide.join(by_sort(mask), ["frame_id", "px", "py"]).groupBy("frame_id", "obj", "detection_id").agg(F.count("*").alias("n_supported"))
    rows = near.join(hits, ["frame_id", "obj", "detection_id"], "left").join(own, ["frame_id", "obj"]).join(sizes, ["frame_id", "obj"]).join(areas, ["frame_id", "detection_id"]).join(detections.select("frame_id", "detection_id", F.least(F.lit(1.0), F.greatest(F.lit(0.0), "score")).alias("score")), ["frame_id", "detection_id"])
    rows = rows.withColumns({"n_hit": F.coalesce("n_hit", F.lit(0)), "n_occluded": F.col("n_projected") - F.col("n_visible")})
    return pair_scores(rows)


def associate(
    points: DataFrame, projected: DataFrame, cameras: DataFrame, masks: DataFrame, detections: DataFrame, peeled: DataFrame, dilation: int = 4, min_frames: int = 2, min_baseline: float = 0.10, min_angle: float = 5.0, both: bool = True
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Which detection is which object in each frame, and what that says of each object of `points` (obj, x, y, z).

    `projected` are the points in the frames (frame_id, obj, px, py, depth; `project_points`). Identity comes from geometry only: in each frame
    the one-to-one match of greatest quality among eligible pairs. An object's evidence is `min_frames` matched views apart from each other
    (`separated_evidence`, rays from camera to the object's centroid). Returns the metrics of all pairs with `matched`; a row an object
    with n_matches, evidence (frame_ids), disposition; and a warning for each match of an object in `peeled` (obj), which should be gone.
    """
    scored = checkpointed(pair_metrics(visible_pixels(projected), masks, detections, dilation))
    edges = scored.where("eligible").select("frame_id", F.col("obj").alias("object_id"), "detection_id", F.col("quality").alias("weight"))
    found = checkpointed(assign(edges)).select("frame_id", F.col("object_id").alias("obj"), "detection_id", F.lit(True).alias("matched"))
    pairs = scored.join(found, ["frame_id", "obj", "detection_id"], "left").withColumn("matched", F.coalesce("matched", F.lit(False)))
    middles = points.groupBy("obj").agg(*(F.avg(a).alias(f"m{a}") for a in "xyz"))
    matches = checkpointed(pairs.where("matched").select("frame_id", "obj", "detection_id", "quality"))
    views = matches.join(small(cameras.select("frame_id", camera_center().alias("c"))), "frame_id").join(middles, "obj")
    views = views.select(F.col("obj").alias("object_id"), "frame_id", F.col("quality").alias("score"), *(F.col("c")[i].alias(f"p{a}") for i, a in enumerate("xyz")), *((F.col(f"m{a}") - F.col("c")[i]).alias(f"d{a}") for i, a in enumerate("xyz")))
    chosen = separated_evidence(views, min_baseline, min_angle, min_frames, both).groupBy(F.col("object_id").alias("obj")).agg(F.sort_array(F.collect_list("frame_id")).alias("evidence"))
    gone = peeled.select("obj").distinct().withColumn("peeled", F.lit(True))
    objects = middles.select("obj").join(matches.groupBy("obj").agg(F.count("*").alias("n_matches")), "obj", "left").join(chosen, "obj", "left").join(gone, "obj", "left")
    enough = F.coalesce(F.size("evidence") >= min_frames, F.lit(False))
    fate = F.when(F.col("peeled") & F.col("n_matches").isNotNull(), "peeled_residual_warning").when(F.col("peeled"), "peeled_absent_as_expected").when(enough, "accepted_next_layer_target").otherwise("failed_insufficient_separated_evidence")
    objects = objects.select("obj", F.coalesce("n_matches", F.lit(0)).alias("n_matches"), "evidence", fate.alias("disposition"))
    warnings = matches.join(gone.select("obj"), "obj", "left_semi").withColumn("code", F.lit("peeled_object_detection_residual"))
    return pairs, objects, warnings
