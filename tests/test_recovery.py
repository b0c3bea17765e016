"""Next actions, the work that follows, and each rule of a manifest's objects."""

from pyspark.sql import functions as F

from scenetable.operators import recovery


def test_what_a_report_needs_next(spark):
    reports = [("clean", "checked", True, 0), ("none", "checked", None, None), ("flat", "technical_failed_x", None, None), ("left", "checked", None, None), ("bare", "checked", False, 7), ("told", None, None, 2)]
    frames = [("clean", 0, "f1", 5, 9, 9, 1.0, 3), ("left", 2, "f2", 4, 9, 5, 0.5, 1), ("left", 1, "f3", 0, 9, 8, 0.9, 1), ("left", 3, "f2", 1, 9, 8, 1.0, 1), ("left", 0, "f0", 0, 0, 0, 0.0, 0), ("bare", 1, "f1", 3, 9, 5, 0.5, 2), ("bare", 2, "f2", 0, 9, None, None, 0), ("bare", 3, "", 9, 9, 0, 0.0, 0)]
    out = recovery.next_actions(
        spark.createDataFrame(reports, "report_id string, status string, promotion_approved boolean, unresolved long"),
        spark.createDataFrame(frames, "report_id string, ord int, frame_id string, residual int, removal int, covered int, coverage double, support_max int"),
    )
    got = {r.report_id: (r.blocker == recovery.NO_DONOR, r.failed_frame_ids, r.no_support_frame_ids, r.first_failed_frame_id, r.unresolved) for r in out.collect()}
    assert got == {"flat": (False, [], [], None, None), "left": (False, ["f3", "f2"], [], "f3", 5), "bare": (True, ["f1"], ["f2"], "f2", 7), "told": (False, [], [], None, 2)}
    work = {}
    for r in recovery.recovery_actions(out).orderBy("report_id", "priority").collect():
        work.setdefault(r.report_id, []).append((r.priority, r.stage, r.frame_ids))
    assert work == {
        "bare": [(1, "donor_support", ["f1", "f2"]), (2, "boundary_qa", ["f1", "f2"]), (3, "candidate_generation", ["f1", "f2"])], "flat": [(1, "candidate_generation", [])],
        "left": [(1, "boundary_qa", ["f3", "f2"]), (2, "candidate_generation", ["f3", "f2"])], "told": [(1, "candidate_generation", [])],
    }
    timed = out.where("report_id = 'flat'").withColumn("open_pair_ids", F.array(F.lit("p1"))).withColumn("failed_triplet_ids", F.array(F.lit("t1"))).withColumn("gate_groups", F.array(F.lit("core_texture")))
    assert [(r.stage, r.pair_ids, r.triplet_ids) for r in recovery.recovery_actions(timed).orderBy("priority").collect()] == [("temporal_qa", ["p1"], []), ("temporal_qa", [], ["t1"]), ("boundary_qa", [], [])]
    assert recovery.recovery_actions(out.where("report_id = 'flat'").withColumn("action", F.lit(None).cast("string"))).count() == 0


def test_each_rule_of_a_manifest(spark):
    kinds = {"world_id": "w", "source_run_id": "r", "id": "x", "scoped_id": None, "parent_id": None, "granularity": "independent_root_asset", "scene_frame": "s", "bbox_frame": "s", "obb_frame": None, "transform_frame": "s", "visual_status": "validated", "render_mesh_status": None, "unified_status": None, "collider_status": None, "collider_topology": None, "collision_topology": None}
    kinds |= {"double_click_action": "none", "drag_action": "none", "physics_mode": "none", "physics_status": None, "file_gate": "passed", "semantic_gate": "passed", "alignment_gate": "passed", "visual_gate": "passed", "collision_gate": None}
    flags = {"moves_with_parent": False, "independently_movable": True, "selectable": True, "collision_enabled": False}
    solid = {"collision_enabled": True, "collision_gate": "passed", "collider_status": "validated"}
    child = {"granularity": "independent_child_asset", "moves_with_parent": True}
    rows = [
        ({}, ()), ({"scoped_id": "w::r::other"}, ("scoped_id",)), ({"bbox_frame": "t"}, ("box_frame",)), ({"transform_frame": "t"}, ("transform_frame",)), ({"granularity": "independent_child_asset", "moves_with_parent": True}, ("child_without_parent",)), ({**child, "moves_with_parent": False, "parent_id": "0"}, ("moves_with_parent",)),
        ({"granularity": "merged_component"}, ("merged_movable",)), ({**child, "parent_id": "self"}, ("own_parent", "parent_cycle")), ({**child, "parent_id": "gone"}, ("unknown_parent",)), ({**child, "parent_id": "6"}, ("merged_parent",)), ({"unified_status": "validated"}, ("unified_with_separate",)),
        ({"unified_status": "validated", "visual_status": None, "collision_topology": "m"}, ("unified_topology",)), ({"collision_topology": "m"}, ("topology_without_unified",)), ({**solid, "collider_topology": "m"}, ()), ({"collider_topology": "m"}, ("topology_without_collider",)), ({"bbox_frame": None}, ("unplaced",)),
        ({"visual_status": None}, ("no_visual",)), ({"visual_gate": None}, ("gates_not_ready",)), ({"visual_status": "candidate"}, ("visual_not_validated",)), ({**solid, "collider_status": None}, ("no_collider",)), ({**solid, "collision_gate": None}, ("collision_not_passed",)), ({**solid, "collider_status": "candidate"}, ("collider_not_validated",)),
        ({"collider_status": "validated"}, ("collider_of_visual",)), ({"collision_gate": "passed"}, ("collision_of_visual",)), ({"physics_mode": "dynamic"}, ("dynamic_without_mass",)), ({"physics_mode": "dynamic", "physics_status": "unvalidated_estimate", "mass_kg": 1.0}, ("dynamic_by_estimate",)),
        ({"selectable": False, "visual_status": None, "bbox_frame": None, "visual_gate": None}, ()), ({"unified_status": "validated", "visual_status": None, "collider_topology": "m", **{k: v for k, v in solid.items() if k != "collider_status"}, "collision_topology": "m"}, ("unified_collider_topology", "topology_without_collider")),
    ]
    made, want = [], set()
    for i, (r, rules) in enumerate(rows):
        row = kinds | flags | {"mass_kg": None} | {"id": str(i), "scoped_id": f"w::r::{i}"} | r
        row["parent_id"] = str(i) if row["parent_id"] == "self" else row["parent_id"]
        made.append(row)
        want |= {(rule, row["scoped_id"]) for rule in rules}
    made += [dict(made[0], world_id="v", scoped_id="v::r::0")] * 2
    want |= {("id_repeats", "v::r::0"), ("scoped_id_repeats", "v::r::0")}
    schema = ", ".join([*(f"{k} string" for k in kinds), *(f"{k} boolean" for k in flags), "mass_kg double"])
    got = {(r.rule, r.key) for r in recovery.manifest_violations(spark.createDataFrame([tuple(r.values()) for r in made], schema)).collect()}
    assert got == want
