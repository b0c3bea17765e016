"""Completion plans, chains of actions, rules of inventories, cycles of parents."""

import pytest
from pyspark.sql import functions as F

from scenetable.operators import graph, planning

SEEN = "id string, importance string, granularity string, coverage_status string, instance_count int, priority int, needs array<string>"
EDGE = "front string, back string, confidence double, verified boolean"
ROOT = "independent_root_asset"


def test_rounds_and_their_chains(spark):
    rows = [
        ("lamp", "primary", ROOT, "missing", 2, 10, None), ("desk", "primary", ROOT, "modeled_partial", 1, 90, ["collider"]), ("rug", "secondary", ROOT, "modeled_partial", 1, 90, []),
        ("wall", "structure", ROOT, "missing", 1, 99, None), ("done", "primary", ROOT, "modeled_complete", 1, 99, []), ("off", "primary", ROOT, "ignored", 1, 99, ["collider"]), ("knob", "primary", "merge_into_parent", "missing", 1, 99, None),
    ]
    seen, edges = spark.createDataFrame(rows, SEEN), spark.createDataFrame([("lamp", "desk", 0.9, True), ("wall", "lamp", 0.9, False)], EDGE)
    plan = planning.completion_plan(seen, edges, 2).orderBy("round", "ordinal").collect()
    assert {(r.round, tuple(r.targets)) for r in plan} == {(1, ("rug", "lamp")), (2, ("desk",)), (3, ())}
    first = [r.action for r in plan if r.round == 1]
    assert first == ["split_instances", "segment", "lift_to_3d", "complete_object", "build_collider", "place_object", "clean_plate", "reinspect", "validate_round"]
    assert [r.action_id for r in plan if r.round == 2] == ["r02-01-build-collider", "r02-02-place-object", "r02-03-clean-plate", "r02-04-reinspect", "r02-05-validate-round"]
    assert [(r.action_id, r.prerequisites, r.kind) for r in plan if r.round == 3] == [("r03-01-rebuild-background", [], "final_background"), ("r03-02-validate-round", ["r03-01-rebuild-background"], "final_background")]
    for a, b in zip(plan, plan[1:], strict=False):
        assert b.prerequisites == ([a.action_id] if b.round == a.round else [])
    assert {r.action for r in plan if r.synthetic} == {"complete_object", "clean_plate", "rebuild_background"}
    singles = planning.completion_plan(seen, edges).select("round", "targets").distinct().orderBy("round").collect()
    assert [r.targets for r in singles] == [["rug"], ["lamp"], ["desk"], []]
    assert [r.round for r in planning.completion_plan(seen.limit(0), edges.limit(0)).collect()] == [1, 1]
    for bad in (0, 17):
        with pytest.raises(ValueError, match="1 to 16"):
            planning.completion_plan(seen, edges, bad)
    with pytest.raises(ValueError, match="repeat: lamp"):
        planning.completion_plan(seen.union(seen.limit(1)), edges)
    with pytest.raises(ValueError, match="desk->rug"):
        planning.completion_plan(seen, edges.union(spark.createDataFrame([("desk", "rug", 0.6, False)], EDGE)))


def test_nodes_below_cycles(spark):
    chain = [(f"c{i}", f"c{i + 1}") for i in range(100)]
    rows = [*chain, ("a", "b"), ("b", "c"), ("c", "a"), ("under", "a"), ("own", "own"), ("top", None), ("orphan", "gone"), ("a", "b")]
    assert {r.node for r in graph.rootless(spark.createDataFrame(rows, "node string, parent string")).collect()} == {"a", "b", "c", "under", "own"}
    assert graph.rootless(spark.createDataFrame([], "node string, parent string")).count() == 0


def test_each_rule_of_an_inventory(spark):
    whole = {"id": "x", "importance": "primary", "granularity": ROOT, "coverage_status": "missing", "structure_role": "none", "asset_role": "fixture", "parent_id": None, "moves_with_parent": False, "independently_movable": True, "matched_object_ids": ["m"], "needs": ["collider"], "evidence_frame_ids": ["f1"]}
    child = {"granularity": "independent_child_asset", "moves_with_parent": True}
    rows = [
        whole, {"id": "s1", "importance": "structure", "asset_role": "structure"}, {"id": "s2", "structure_role": "wall"}, {"id": "s3", "coverage_status": "structure_background"}, {"id": "m1", "coverage_status": "modeled_complete", "matched_object_ids": None},
        {"id": "r1", "asset_role": "structure"}, {"id": "p1", **child}, {"id": "p2", "parent_id": "x"}, {"id": "p3", "parent_id": "p3", **child}, {"id": "p4", "parent_id": "x", "granularity": "independent_child_asset"}, {"id": "g1", "granularity": "merge_into_parent", "parent_id": "x", "moves_with_parent": True},
        {"id": "n1", "needs": ["a", "a"]}, {"id": "e1", "evidence_frame_ids": None}, {"id": "f1", "evidence_frame_ids": ["f1", "f9"]}, {"id": "u1", "parent_id": "gone", **child}, {"id": "tw"}, {"id": "tw"}, {"id": "null", "importance": None},
    ]
    kinds = "id string, importance string, granularity string, coverage_status string, structure_role string, asset_role string, parent_id string, moves_with_parent boolean, independently_movable boolean, matched_object_ids array<string>, needs array<string>, evidence_frame_ids array<string>"
    names = [k.split()[0] for k in kinds.split(", ")]
    seen = spark.createDataFrame([tuple((whole | r)[n] for n in names) for r in rows], kinds)
    box = "id string, frame_id string, x0 int, y0 int, x1 int, y1 int"
    regions = spark.createDataFrame([("x", "f1", 0, 0, 1000, 1000), ("f1", "f1", 5, 5, 5, 9), ("m1", "f2", 0, 0, 9, 9), ("r1", "f1", 0, None, 9, 9), ("f1", "f9", 0, 0, 1, 1)], box)
    frames = spark.createDataFrame([("f1",), ("f2",), ("f2",)], "frame_id string")
    got = {(r.rule, r.key) for r in planning.inventory_violations(seen.withColumn("rule", F.lit(0)), regions, frames).collect()}
    assert got == {
        ("structure_without_role", "s1"), ("role_without_structure", "s2"), ("background_without_structure", "s3"), ("complete_without_match", "m1"), ("asset_role_differs", "r1"), ("parent_missing", "p1"), ("parent_unexpected", "p2"), ("own_parent", "p3"), ("parent_cycle", "p3"),
        ("moves_with_parent_differs", "p4"), ("fixed_part_movable", "g1"), ("needs_repeat", "n1"), ("no_evidence", "e1"), ("unknown_frame", "f1"), ("region_of_unknown_frame", "f1"), ("unknown_parent", "u1"), ("id_repeats", "tw"), ("frame_repeats", "f2"),
        ("region_box", "f1"), ("region_box", "r1"), ("region_not_declared", "m1"),
    }
