"""Completion plans from observed objects, and the rules that their inventories keep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed
from .contracts import violations
from .graph import peel_layers, rootless

#: What a missing object needs; the actions of a round in order, with the needs that ask for them (none: always), their output
#: roles and gates; the actions of the last round.
MISSING_NEEDS = ("segmentation", "multi_view_lift", "backside_geometry", "render_asset", "collider", "visual_qa")
OBJECT_ACTIONS = (
    ("split_instances", ("instance_split",), ("instance_manifest",), ("segmentation_evidence", "instance_identity")),
    ("segment", ("segmentation",), ("masks_manifest",), ("segmentation_evidence",)),
    ("lift_to_3d", ("multi_view_lift",), ("object_clouds_manifest",), ("multi_view_projection",)),
    (
        "complete_object", ("backside_geometry", "render_asset"), ("unified_pbr_glb", "object_completion_report"),
        ("geometry_completeness", "front_silhouette", "front_observation_fidelity", "backside_nonempty", "six_view_coverage", "appearance_fidelity", "six_side_style_consistency", "instance_identity", "vlm_geometry_review"),
    ),
    ("build_collider", ("collider",), ("collision_report",), ("collision",)),
    ("place_object", (), ("aligned_objects_manifest", "interpenetration_report"), ("placement_alignment", "scene_interpenetration")),
    ("clean_plate", (), ("clean_plate_frames", "clean_plate_manifest"), ("mask_outside_unchanged", "cross_view_consistency", "revealed_background")),
    ("reinspect", (), ("next_scene_inventory", "next_occlusion_graph"), ()),
    ("validate_round", (), ("round_quality_report",), ()),
)
BACKGROUND_ACTIONS = (
    ("rebuild_background", (), ("clean_scene_gaussian", "clean_scene_mesh", "background_report"), ("mask_outside_unchanged", "cross_view_consistency", "revealed_background", "background_depth_normal")),
    ("validate_round", (), ("round_quality_report",), ("browser_interaction",)),
)
SYNTHETIC = ("complete_object", "clean_plate", "rebuild_background")


def _words(values: tuple[str, ...]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


def _asked(actions, needs: Column) -> Column:
    """The actions that some of `needs` ask for, in order."""
    rows = [F.struct(F.lit(a).alias("action"), _words(by).alias("by"), _words(roles).alias("roles"), _words(gates).alias("gates")) for a, by, roles, gates in actions]
    return F.filter(F.array(*rows), lambda r: (F.size(r["by"]) == 0) | F.arrays_overlap(r["by"], needs))


def candidates(observations: DataFrame) -> DataFrame:
    """Observations that a plan takes off: independent assets, no structure, not ignored, and complete ones only while they need something."""
    open_ = (F.col("coverage_status") != "modeled_complete") | (F.size("needs") > 0)
    return observations.where((F.col("importance") != "structure") & F.col("granularity").isin("independent_root_asset", "independent_child_asset") & (F.col("coverage_status") != "ignored") & open_)


def chained(rounds: DataFrame) -> DataFrame:
    """The actions of each round (round, kind, targets, actions) one by one: adds ordinal, action_id and prerequisites, the action before."""
    name = lambda i, a: F.format_string("r%02d-%02d-%s", F.col("round"), i + 1, F.translate(a["action"], "_", "-"))
    named = rounds.withColumn("ids", F.transform("actions", lambda a, i: name(i, a))).select("*", F.posexplode("actions").alias("i", "a"))
    before = F.when(F.col("i") > 0, F.array(F.get("ids", F.col("i") - 1))).otherwise(F.array().cast("array<string>"))
    return named.select("round", "kind", "targets", (F.col("i") + 1).alias("ordinal"), F.get("ids", F.col("i")).alias("action_id"), F.col("a.action").alias("action"), before.alias("prerequisites"), F.col("a.action").isin(*SYNTHETIC).alias("synthetic"), F.col("a.roles").alias("roles"), F.col("a.gates").alias("gates"))


def completion_plan(observations: DataFrame, edges: DataFrame, at_once: int = 1, min_confidence: float = 0.5) -> DataFrame:
    """The rounds in which observed objects are completed and taken off, and their actions.

    observations: id, importance, granularity, coverage_status, instance_count, priority, needs (null: none); edges: front, back, confidence,
    verified, as `peel_layers` takes them, and it raises as told there. Layers are cut into rounds of at most `at_once` (1 to 16) targets by
    falling priority, then id. What is missing needs all of MISSING_NEEDS, and to be split if there are several. A round for
    the background follows, and is the only one if nothing is to be done. Returns round, kind, targets, ordinal, action_id, action,
    prerequisites, synthetic, roles, gates. An id that repeats raises. Jobs run while the result is built.
    """
    if not 1 <= at_once <= 16:
        raise ValueError("at_once is 1 to 16")
    rows = observations.withColumn("needs", F.coalesce("needs", F.array().cast("array<string>")))
    twice = rows.groupBy("id").count().where("count > 1").select("id").orderBy("id").limit(5).collect()
    if twice:
        raise ValueError("observations repeat: " + ", ".join(str(r.id) for r in twice))
    todo = checkpointed(candidates(rows).select("id", "coverage_status", "instance_count", "priority", "needs"))
    layers = checkpointed(peel_layers(todo.select(F.col("id").alias("node"), "priority"), edges, min_confidence))
    # Rounds are numbered over one row a layer.
    cut = layers.groupBy("layer").agg(F.ceil(F.count("*") / at_once).alias("rounds"))
    start = cut.withColumn("before", F.sum("rounds").over(Window.orderBy("layer").rowsBetween(Window.unboundedPreceding, -1))).select("layer", F.coalesce("before", F.lit(0)).alias("before"))
    absent = F.col("coverage_status") == "missing"
    more = F.when(absent & (F.col("instance_count") > 1), _words((*MISSING_NEEDS, "instance_split"))).when(absent, _words(MISSING_NEEDS)).otherwise(F.array().cast("array<string>"))
    placed = layers.join(start, "layer").join(todo.withColumnRenamed("id", "node").drop("priority"), "node").withColumn("round", (F.col("before") + F.floor((F.col("place") - 1) / at_once) + 1).cast("int"))
    rounds = placed.withColumn("all", F.concat("needs", more)).groupBy("round").agg(F.array_sort(F.collect_list(F.struct("place", "node"))).alias("t"), F.array_distinct(F.flatten(F.collect_list("all"))).alias("needs"))
    rounds = rounds.select("round", F.lit("object_layer").alias("kind"), F.transform("t", lambda t: t["node"].cast("string")).alias("targets"), _asked(OBJECT_ACTIONS, F.col("needs")).alias("actions"))
    last = cut.agg((F.coalesce(F.sum("rounds"), F.lit(0)) + 1).cast("int").alias("round"))
    none = F.array().cast("array<string>")
    return chained(rounds.union(last.select("round", F.lit("final_background"), none, _asked(BACKGROUND_ACTIONS, none))))


#: Rules of one observation, as the SQL that tells a breach.
OBSERVATION_RULES = {
    "structure_without_role": "importance = 'structure' AND structure_role = 'none'",
    "role_without_structure": "importance <> 'structure' AND structure_role <> 'none'",
    "background_without_structure": "importance <> 'structure' AND (coverage_status = 'structure_background' OR granularity = 'structure_background')",
    "complete_without_match": "coverage_status = 'modeled_complete' AND size(matched_object_ids) = 0",
    "asset_role_differs": "(asset_role = 'structure') <> (importance = 'structure')",
    "parent_missing": "granularity IN ('independent_child_asset', 'merge_into_parent') AND parent_id IS NULL",
    "parent_unexpected": "granularity NOT IN ('independent_child_asset', 'merge_into_parent') AND parent_id IS NOT NULL",
    "own_parent": "parent_id = id",
    "moves_with_parent_differs": "moves_with_parent <> (granularity IN ('independent_child_asset', 'merge_into_parent'))",
    "fixed_part_movable": "granularity IN ('merge_into_parent', 'structure_background', 'reject_fragment') AND independently_movable",
    "needs_repeat": "size(array_distinct(needs)) < size(needs)",
    "no_evidence": "size(evidence_frame_ids) = 0",
}


def breaches(rows: DataFrame, rules: dict[str, str], key: str) -> DataFrame:
    """The rules each row breaks, in one pass: rule, key. A rule that null leaves open is not broken."""
    broken = F.array_compact(F.array(*(F.when(F.expr(sql), F.lit(name)) for name, sql in rules.items())))
    return rows.select(F.col(key).cast("string").alias("key"), F.explode(broken).alias("rule")).select("rule", "key")


def inventory_violations(observations: DataFrame, regions: DataFrame, frames: DataFrame) -> DataFrame:
    """Breaches of an inventory's rules: rule, key.

    observations: id, parent_id and the columns that OBSERVATION_RULES name (arrays: null counts as empty); regions: id, frame_id, x0, y0, x1,
    y1 in thousandths; frames: frame_id. Told are also ids and frames that repeat, frames and parents that nothing declares,
    boxes out of order, region frames that their observation does not name, and nodes on or below a cycle of parents.
    """
    arrays = {c: F.coalesce(c, F.array().cast("array<string>")) for c in ("matched_object_ids", "needs", "evidence_frame_ids")}
    rows = observations.withColumns(arrays)
    named = rows.select("id", F.explode(F.array_distinct("evidence_frame_ids")).alias("frame_id"))
    known, shown = frames.select("frame_id").distinct(), regions.select("id", "frame_id").distinct()
    box = "NOT coalesce(0 <= x0 AND x0 < x1 AND x1 <= 1000 AND 0 <= y0 AND y0 < y1 AND y1 <= 1000, false)"
    keyed = lambda df, c: df.select(F.col(c).alias("key")).distinct()
    parents = rows.where("parent_id IS NOT NULL").select("id", F.col("parent_id").alias("parent"))
    across = violations(
        {
            "id_repeats": keyed(rows.groupBy("id").count().where("count > 1"), "id"),
            "frame_repeats": keyed(frames.groupBy("frame_id").count().where("count > 1"), "frame_id"),
            "unknown_frame": keyed(named.join(known, "frame_id", "left_anti"), "id"),
            "region_of_unknown_frame": keyed(shown.join(known, "frame_id", "left_anti"), "id"),
            "region_not_declared": keyed(shown.join(named, ["id", "frame_id"], "left_anti"), "id"),
            "region_box": keyed(regions.where(box), "id"),
            "unknown_parent": keyed(parents.join(rows.select(F.col("id").alias("parent")), "parent", "left_anti"), "id"),
            "parent_cycle": rootless(parents.select(F.col("id").alias("node"), "parent")).select(F.col("node").alias("key")),
        }
    )
    return breaches(rows, OBSERVATION_RULES, "id").union(across)
