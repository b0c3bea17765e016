"""What a failed clean plate needs next, and the work that mends it; the rules of interactive objects in a manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .contracts import violations
from .graph import rootless
from .planning import breaches

#: Actions, blockers, stages and reasons, and the gate groups that ask for boundary work.
ADD_DONOR = "add_observed_donor_or_switch_to_constrained_generation_for_residual"
REGENERATE = "regenerate_residual_with_constrained_background_prior"
NO_DONOR, RESIDUAL = "no_guard_stable_measured_donor_support", "unresolved_unobserved_residual"
BOUNDARY_GROUPS = ("boundary", "core_texture", "donor_support", "mask_alignment")
REASONS = {
    "donor": "Boundary-guarded measured donor support is missing; do not advance the next layer.",
    "open": "Temporal QA is not evaluable, so candidate quality cannot be promoted.",
    "failed": "Temporal QA has failing directed pairs or triplets.",
    "boundary": "Boundary or local texture gates failed on specific source frames.",
    "residual": "The clean plate still has unresolved unobserved pixels after measured support.",
    "carried": "Carry forward the upstream clean-plate recovery action.",
}
IDS = ("failed_frame_ids", "no_support_frame_ids", "failed_pair_ids", "open_pair_ids", "failed_triplet_ids", "open_triplet_ids", "gate_groups")


def _none() -> Column:
    return F.array().cast("array<string>")


def _given(c: str) -> Column:
    return F.coalesce(F.col(c), _none())


def next_actions(reports: DataFrame, frames: DataFrame) -> DataFrame:
    """What each report that is not approved, has technically failed or left pixels unresolved needs next.

    reports: report_id, status, promotion_approved, unresolved (null: the sum of residual pixels); frames: report_id, ord, frame_id,
    residual, removal, covered, coverage, support_max. A frame fails by residual pixels or, with pixels removed, coverage under 1; it is
    without support if nothing removed was covered. Returns report_id, action, blocker, gate_groups, failed_frame_ids, no_support_frame_ids (in
    order, once each), first_failed_frame_id, unresolved. Null figures count as not given; a report without frames or
    `unresolved` has null there.
    """
    removed = F.coalesce("removal", F.lit(0)) > 0
    failed = (F.coalesce("residual", F.lit(0)) > 0) | (removed & F.coalesce(F.col("coverage") < 1.0, F.lit(False)))
    bare = removed & F.coalesce(F.col("support_max") == 0, F.lit(False)) | removed & F.coalesce(F.col("covered") == 0, F.lit(False)) | removed & F.coalesce(F.col("coverage") == 0.0, F.lit(False))
    told = F.coalesce(F.col("frame_id") != "", F.lit(False))
    ids = lambda when: F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(when & told, F.struct("ord", "frame_id")))), lambda s: s["frame_id"]))
    found = frames.groupBy("report_id").agg(ids(failed).alias("failed_frame_ids"), ids(bare).alias("no_support_frame_ids"), F.sum(F.coalesce("residual", F.lit(0))).alias("left"))
    rows = reports.join(found, "report_id", "left").withColumns({c: _given(c) for c in IDS[:2]}).withColumn("unresolved", F.coalesce("unresolved", "left").cast("long"))
    due = ~F.coalesce("promotion_approved", F.lit(True)) | F.coalesce(F.col("unresolved") > 0, F.lit(False)) | F.coalesce(F.startswith("status", F.lit("technical_failed")), F.lit(False))
    unsupported = F.size("no_support_frame_ids") > 0
    pick = lambda a, b: F.when(unsupported, F.lit(a)).otherwise(F.lit(b))
    first = F.coalesce(F.get("no_support_frame_ids", F.lit(0)), F.get("failed_frame_ids", F.lit(0)))
    return rows.where(due).select("report_id", pick(ADD_DONOR, REGENERATE).alias("action"), pick(NO_DONOR, RESIDUAL).alias("blocker"), F.array(pick("donor_support", "residual_generation")).alias("gate_groups"), *IDS[:2], first.alias("first_failed_frame_id"), "unresolved")


def recovery_actions(rows: DataFrame) -> DataFrame:
    """The work for each next action, most urgent first: report_id, priority, stage, action, blocker, reason, frame_ids, pair_ids, triplet_ids.

    rows: as of `next_actions`, with failed_pair_ids, open_pair_ids (not evaluable), failed_triplet_ids and open_triplet_ids (their centre
    frames) where temporal checks ran (columns absent or null: none). If nothing asks for work, the action itself is carried on.
    """
    for c in IDS:
        rows = rows.withColumn(c, _given(c) if c in rows.columns else _none())
    has = lambda *names: sum((F.size(n) for n in names), F.lit(0)) > 0
    frames = F.array_distinct(F.array_compact(F.concat("failed_frame_ids", F.array("first_failed_frame_id"))))

    def step(when: Column, stage: str, action: str | Column, reason: str, frames=None, pairs=None, triplets=None) -> Column:
        ids = (("frame_ids", frames), ("pair_ids", pairs), ("triplet_ids", triplets))
        action = F.lit(action) if isinstance(action, str) else action
        return F.when(F.coalesce(when, F.lit(False)), F.struct(F.lit(stage).alias("stage"), action.alias("action"), F.lit(REASONS[reason]).alias("reason"), *((_none() if c is None else c).alias(n) for n, c in ids)))

    steps = F.array_compact(
        F.array(
            step(has("no_support_frame_ids") | (F.col("blocker") == NO_DONOR), "donor_support", ADD_DONOR, "donor", F.array_distinct(F.concat(frames, "no_support_frame_ids"))),
            step(has("open_pair_ids", "open_triplet_ids"), "temporal_qa", "repair_temporal_evidence_before_retesting", "open", None, F.col("open_pair_ids"), F.col("open_triplet_ids")),
            step(has("failed_pair_ids", "failed_triplet_ids"), "temporal_qa", "repair_temporal_flicker_or_regenerate_clean_plate_candidates", "failed", None, F.col("failed_pair_ids"), F.col("failed_triplet_ids")),
            step((F.size(frames) > 0) | F.arrays_overlap("gate_groups", F.array(*map(F.lit, BOUNDARY_GROUPS))), "boundary_qa", "repair_removal_mask_or_target_matte_before_regeneration", "boundary", frames),
            step(F.col("unresolved") > 0, "candidate_generation", REGENERATE, "residual", frames),
        )
    )
    carried = step(F.col("action").isNotNull() & (F.col("action") != ""), "candidate_generation", F.col("action"), "carried", frames, F.array_distinct(F.concat("failed_pair_ids", "open_pair_ids")), F.array_distinct(F.concat("failed_triplet_ids", "open_triplet_ids")))
    work = F.when(F.size(steps) > 0, steps).otherwise(F.array_compact(F.array(carried)))
    return rows.select("report_id", "blocker", F.posexplode(work).alias("i", "w")).select("report_id", (F.col("i") + 1).alias("priority"), "w.stage", "w.action", "blocker", "w.reason", "w.frame_ids", "w.pair_ids", "w.triplet_ids")


_ON = "(selectable OR double_click_action <> 'none' OR drag_action <> 'none' OR collision_enabled OR physics_mode <> 'none')"
_LOOKS = "array_compact(array(visual_status, render_mesh_status, unified_status))"
#: Rules of one object of a manifest, as the SQL that tells a breach. Assets are given by their status, null without one; gates by theirs.
OBJECT_RULES = {
    "scoped_id": "scoped_id <> concat_ws('::', world_id, source_run_id, id)",
    "box_frame": "bbox_frame <> scene_frame OR obb_frame <> scene_frame",
    "transform_frame": "transform_frame <> scene_frame",
    "child_without_parent": "(granularity = 'independent_child_asset') <> (parent_id IS NOT NULL)",
    "moves_with_parent": "moves_with_parent <> (granularity = 'independent_child_asset')",
    "merged_movable": "granularity = 'merged_component' AND independently_movable",
    "own_parent": "parent_id = id",
    "unified_with_separate": "unified_status IS NOT NULL AND coalesce(visual_status, render_mesh_status, collider_status) IS NOT NULL",
    "unified_collider_topology": "unified_status IS NOT NULL AND collider_topology IS NOT NULL",
    "unified_topology": "unified_status IS NOT NULL AND collision_enabled <> (collision_topology IS NOT NULL)",
    "topology_without_unified": "unified_status IS NULL AND collision_topology IS NOT NULL",
    "topology_without_collider": "collider_topology IS NOT NULL AND (collider_status IS NULL OR NOT collision_enabled)",
    "unplaced": f"{_ON} AND (bbox_frame IS NULL OR transform_frame IS NULL)",
    "no_visual": f"{_ON} AND size({_LOOKS}) = 0",
    "gates_not_ready": f"{_ON} AND NOT coalesce(file_gate = 'passed' AND semantic_gate = 'passed' AND alignment_gate = 'passed' AND visual_gate = 'passed', false)",
    "visual_not_validated": f"{_ON} AND exists({_LOOKS}, s -> s <> 'validated')",
    "no_collider": "collision_enabled AND unified_status IS NULL AND collider_status IS NULL",
    "collision_not_passed": "collision_enabled AND coalesce(collision_gate, '') <> 'passed'",
    "collider_not_validated": "collision_enabled AND unified_status IS NULL AND collider_status <> 'validated'",
    "collider_of_visual": f"{_ON} AND NOT collision_enabled AND collider_status IS NOT NULL",
    "collision_of_visual": f"({_ON} OR unified_status IS NOT NULL) AND NOT collision_enabled AND collision_gate = 'passed'",
    "dynamic_without_mass": "physics_mode = 'dynamic' AND (physics_status IS NULL OR mass_kg IS NULL)",
    "dynamic_by_estimate": "physics_mode = 'dynamic' AND physics_status = 'unvalidated_estimate'",
}


def manifest_violations(objects: DataFrame) -> DataFrame:
    """Breaches of a manifest's rules over its objects: rule, key (the scoped id).

    objects: the columns that OBJECT_RULES name; world_id parts the manifests. Told across objects: ids and scoped ids that repeat in a world,
    parents that are unknown or merged components, and objects on or below a cycle of parents.
    """
    keyed = lambda df: df.select(F.col("scoped_id").alias("key")).distinct()
    named = F.struct("world_id", "id")
    owned = objects.where("parent_id IS NOT NULL").select("scoped_id", "world_id", F.col("parent_id").alias("id"))
    repeated = lambda c: objects.join(objects.groupBy("world_id", c).count().where("count > 1"), ["world_id", c], "left_semi")
    ring = rootless(objects.where("parent_id IS NOT NULL").select(named.alias("node"), F.struct("world_id", F.col("parent_id").alias("id")).alias("parent"))).select("node.*")
    across = violations(
        {
            "id_repeats": keyed(repeated("id")),
            "scoped_id_repeats": keyed(repeated("scoped_id")),
            "unknown_parent": keyed(owned.join(objects.select("world_id", "id"), ["world_id", "id"], "left_anti")),
            "merged_parent": keyed(owned.join(objects.where("granularity = 'merged_component'").select("world_id", "id"), ["world_id", "id"], "left_semi")),
            "parent_cycle": keyed(objects.join(ring, ["world_id", "id"], "left_semi")),
        }
    )
    return breaches(objects, OBJECT_RULES, "scoped_id").union(across)
