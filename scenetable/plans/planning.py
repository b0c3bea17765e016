"""Queries over completion plans and inventories."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import planning, recovery
from . import derived as D

#: An observation for each part; each stands before the parts of twice its number.
SEEN = """SELECT p_partkey AS k, 'p' || CAST(p_partkey AS {s}) AS id, CASE WHEN p_size % 10 = 0 THEN 'structure' WHEN p_size % 2 = 0 THEN 'primary' ELSE 'secondary' END AS importance,
 CASE WHEN p_partkey % 9 = 0 THEN 'merge_into_parent' WHEN p_partkey % 4 = 1 THEN 'independent_child_asset' ELSE 'independent_root_asset' END AS granularity,
 CASE p_size % 6 WHEN 0 THEN 'missing' WHEN 1 THEN 'modeled_complete' WHEN 2 THEN 'ignored' ELSE 'modeled_partial' END AS coverage_status, p_partkey % 3 + 1 AS instance_count, p_size % 7 AS priority,
 concat_ws(',', CASE WHEN p_partkey % 2 = 0 THEN 'segmentation' END, CASE WHEN p_partkey % 3 = 0 THEN 'multi_view_lift' END, CASE WHEN p_partkey % 5 = 0 THEN 'backside_geometry' END, CASE WHEN p_partkey % 7 = 0 THEN 'render_asset' END, CASE WHEN p_partkey % 8 = 0 THEN 'collider' END, CASE WHEN p_partkey % 11 = 0 THEN 'instance_split' END) AS needs,
 CASE WHEN p_size % 20 = 0 THEN 'wall' WHEN p_partkey % 50 = 7 THEN 'floor' ELSE 'none' END AS structure_role, CASE WHEN p_size % 10 = 0 AND p_partkey % 13 > 0 THEN 'structure' ELSE 'fixture' END AS asset_role,
 CASE WHEN p_partkey % 17 = 0 THEN 'p' || CAST(p_partkey + 500000 AS {s}) WHEN p_partkey % 19 = 0 THEN 'p' || CAST(p_partkey AS {s}) WHEN p_partkey % 4 = 1 OR p_partkey % 9 = 0 THEN 'p' || CAST(CASE WHEN p_partkey % 40 = 1 THEN p_partkey + 4 WHEN p_partkey % 40 = 5 THEN p_partkey - 4 ELSE p_partkey {div} 2 + 1 END AS {s}) END AS parent_id,
 p_partkey % 4 = 1 AS moves_with_parent, p_partkey % 9 <> 0 OR p_partkey % 27 = 0 AS independently_movable, 'f' || CAST(p_partkey % 30 AS {s}) AS frame FROM part"""
EDGES = """SELECT 'p' || CAST(p_partkey AS {s}) AS front, 'p' || CAST(2 * p_partkey + p_size % 2 AS {s}) AS back, CASE WHEN p_size % 8 = 0 THEN 0.2e0 ELSE 0.7e0 END AS confidence, p_size % 8 <> 0 AS verified FROM part"""
#: Regions, two thirds of them in the frame their observation names; frames, of which some are missing.
REGIONS = """SELECT 'p' || CAST(l_partkey AS {s}) AS id, 'f' || CAST((l_partkey + CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END) % 30 AS {s}) AS frame_id, CAST(l_suppkey % 900 AS INTEGER) AS x0, CAST(l_linenumber AS INTEGER) AS y0,
 CAST(l_suppkey % 900 + l_quantity * 2 - 2 AS INTEGER) AS x1, 990 + CAST(l_linenumber AS INTEGER) AS y1 FROM lineitem WHERE l_linenumber > 2"""
FRAMES = "SELECT 'f' || CAST(n_nationkey + CASE n_nationkey WHEN 24 THEN -1 ELSE 0 END AS {s}) AS frame_id FROM nation"


def _rows(spark, sf_dir, sql):
    for t in ("part", "lineitem", "nation"):
        D.table(spark, sf_dir, t).createOrReplaceTempView(t)
    return spark.sql(sql.format(s="STRING", div="div"))


def _seen(spark, sf_dir):
    return _rows(spark, sf_dir, SEEN).withColumn("needs", F.when(F.col("needs") != "", F.split("needs", ",")))


def completion_plan(spark, sf_dir):
    """Rounds of at most four parts, and the chain of their actions."""
    out = planning.completion_plan(_seen(spark, sf_dir), _rows(spark, sf_dir, EDGES), 4)
    return out.select("round", "kind", F.array_join("targets", ",").alias("targets"), "ordinal", "action_id", F.array_join("prerequisites", ",").alias("prerequisites"), "synthetic", F.size("roles").alias("n_roles"), F.size("gates").alias("n_gates"))


def inventory_violations(spark, sf_dir):
    """What the inventory of parts breaks."""
    seen = _seen(spark, sf_dir).withColumn("matched_object_ids", F.when(F.col("k") % 3 > 0, F.array("id"))).withColumn("evidence_frame_ids", F.when(F.col("k") % 43 > 0, F.array("frame")))
    seen = seen.withColumn("needs", F.when(F.col("k") % 47 == 0, F.concat("needs", "needs")).otherwise(F.col("needs")))
    return planning.inventory_violations(seen, _rows(spark, sf_dir, REGIONS), _rows(spark, sf_dir, FRAMES))


#: A report for each order, a frame for each of its lines.
REPORTS = """SELECT o_orderkey AS report_id, CASE WHEN o_orderkey % 7 = 0 THEN 'technical_failed_boundary' ELSE 'checked' END AS status, CASE o_custkey % 4 WHEN 0 THEN false WHEN 1 THEN true END AS promotion_approved, CASE WHEN o_custkey % 5 = 0 THEN o_custkey % 3 END AS unresolved FROM orders"""
SHOWN = """SELECT l_orderkey AS report_id, l_linenumber AS ord, 'f' || CAST(l_suppkey % 6 AS {s}) AS frame_id, CASE WHEN l_partkey % 3 = 0 THEN l_suppkey % 4 ELSE 0 END AS residual, l_partkey % 5 AS removal,
 CASE WHEN l_partkey % 7 < 6 THEN l_suppkey % 9 END AS covered, CASE WHEN l_suppkey % 5 > 0 THEN (l_suppkey % 11) / 10.0e0 END AS coverage, l_suppkey % 10 AS support_max FROM lineitem"""


def _next(spark, sf_dir):
    for t in ("orders", "lineitem"):
        D.table(spark, sf_dir, t).createOrReplaceTempView(t)
    return recovery.next_actions(spark.sql(REPORTS), spark.sql(SHOWN.format(s="STRING")))


def next_actions(spark, sf_dir):
    """What every report needs next."""
    return _next(spark, sf_dir).select("report_id", "action", "blocker", "first_failed_frame_id", F.coalesce("unresolved", F.lit(-1)).alias("unresolved"), *(F.array_join(c, ",").alias(c) for c in ("failed_frame_ids", "no_support_frame_ids")))


def recovery_actions(spark, sf_dir):
    """The work for every report, some with temporal checks."""
    pairs = {"failed_pair_ids": (3, "a"), "open_pair_ids": (4, "b"), "failed_triplet_ids": (9, "c"), "open_triplet_ids": (16, "d")}
    rows = _next(spark, sf_dir).withColumns({c: F.when(F.col("report_id") % k == 1, F.array(F.lit(v))) for c, (k, v) in pairs.items()})
    out = recovery.recovery_actions(rows)
    return out.select("report_id", "priority", "stage", "action", *(F.array_join(c, ",").alias(c) for c in ("frame_ids", "pair_ids", "triplet_ids")))


#: An object for each customer, a world for each region; customers of a nation hang on each other.
OBJECTS = """SELECT 'w' || CAST(n_regionkey AS {s}) AS world_id, 'r' AS source_run_id, c_custkey AS k, 'o' || CAST(c_custkey % 1400 AS {s}) AS id, 'w' || CAST(n_regionkey AS {s}) || '::r::o' || CAST(CASE WHEN c_custkey % 31 = 3 THEN c_custkey ELSE c_custkey % 1400 END AS {s}) AS scoped_id,
 CASE WHEN c_custkey % 5 < 2 THEN 'o' || CAST(c_custkey % 1400 {div} 3 * 2 AS {s}) END AS parent_id, CASE c_custkey % 5 WHEN 0 THEN 'independent_child_asset' WHEN 1 THEN CASE WHEN c_custkey % 2 = 0 THEN 'independent_child_asset' ELSE 'merged_component' END WHEN 4 THEN 'merged_component' ELSE 'independent_root_asset' END AS granularity,
 's' AS scene_frame, CASE c_custkey % 13 WHEN 0 THEN 't' WHEN 1 THEN NULL ELSE 's' END AS bbox_frame, CASE WHEN c_custkey % 17 = 2 THEN 'q' END AS obb_frame, CASE WHEN c_custkey % 19 = 4 THEN 't' ELSE 's' END AS transform_frame, c_custkey % 7 = 0 AS moves_with_parent, c_custkey % 3 = 0 AS independently_movable,
 c_custkey % 4 > 0 AS selectable, c_custkey % 6 = 0 AS collision_enabled, CASE WHEN c_custkey % 23 = 1 THEN 'dynamic' ELSE 'none' END AS physics_mode, CASE WHEN c_custkey % 2 = 0 THEN 'unvalidated_estimate' END AS physics_status, CASE WHEN c_custkey % 3 = 1 THEN 1.5e0 END AS mass_kg,
 CASE c_custkey % 8 WHEN 0 THEN NULL WHEN 1 THEN 'candidate' ELSE 'validated' END AS visual_status, CASE WHEN c_custkey % 10 = 0 THEN 'validated' END AS unified_status, CASE c_custkey % 9 WHEN 0 THEN 'validated' WHEN 3 THEN 'candidate' END AS collider_status, CASE WHEN c_custkey % 37 = 0 THEN 'm' END AS collider_topology,
 CASE WHEN c_custkey % 20 = 0 THEN 'm' END AS collision_topology, CASE WHEN c_custkey % 11 = 0 THEN 'failed' ELSE 'passed' END AS visual_gate, CASE WHEN c_custkey % 6 < 2 AND c_custkey % 5 > 0 THEN 'passed' END AS collision_gate FROM customer JOIN nation ON c_nationkey = n_nationkey"""


def manifest_rules(spark, sf_dir):
    """What the manifests of the regions break."""
    for t in ("customer", "nation"):
        D.table(spark, sf_dir, t).createOrReplaceTempView(t)
    rows = spark.sql(OBJECTS.format(s="STRING", div="div")).withColumns({c: F.lit("passed") for c in ("file_gate", "semantic_gate", "alignment_gate")} | {c: F.lit("none") for c in ("double_click_action", "drag_action")} | {"render_mesh_status": F.lit(None).cast("string")})
    return recovery.manifest_violations(rows).groupBy("rule").agg(F.count("*").alias("n"), F.min("key").alias("first"), F.max("key").alias("last"))


QUERIES = {f.__name__: f for f in (completion_plan, inventory_violations, next_actions, recovery_actions, manifest_rules)}

_SEEN, _EDGES, _REGIONS, _FRAMES = (q.format(s="VARCHAR", div="//") for q in (SEEN, EDGES, REGIONS, FRAMES))
_ASK = ", ".join(f"CASE WHEN {' OR '.join(f'list_contains(needs, {n!r})' for n in by) or 'true'} THEN {a!r} END" for a, by, _, _ in planning.OBJECT_ACTIONS)
_SIZES = "CASE kind || action " + " ".join(f"WHEN '{k}{a}' THEN {len(r) * 100 + len(g)}" for k, t in (("object_layer", planning.OBJECT_ACTIONS), ("final_background", planning.BACKGROUND_ACTIONS)) for a, _, r, g in t) + " END"

_NEXT = f"""fr AS (SELECT *, coalesce(residual > 0, false) OR coalesce(removal > 0 AND coverage < 1, false) AS bad, removal > 0 AND (support_max = 0 OR coalesce(covered = 0, false) OR coalesce(coverage = 0, false)) AS bare FROM ({SHOWN.format(s='VARCHAR')})),
 fa AS (SELECT report_id, list(frame_id ORDER BY o, frame_id) AS ids FROM (SELECT report_id, frame_id, min(ord) AS o FROM fr WHERE bad GROUP BY 1, 2) GROUP BY 1), ns AS (SELECT report_id, list(frame_id ORDER BY o, frame_id) AS ids FROM (SELECT report_id, frame_id, min(ord) AS o FROM fr WHERE bare GROUP BY 1, 2) GROUP BY 1),
 sm AS (SELECT report_id, sum(residual) AS s FROM fr GROUP BY 1), nx AS (SELECT r.report_id, status, promotion_approved, CAST(coalesce(unresolved, s) AS BIGINT) AS unresolved, coalesce(fa.ids, []) AS f, coalesce(ns.ids, []) AS n FROM ({REPORTS}) r LEFT JOIN fa USING (report_id) LEFT JOIN ns USING (report_id) LEFT JOIN sm USING (report_id)),
 du AS (SELECT *, coalesce(n[1], f[1]) AS head FROM nx WHERE promotion_approved = false OR unresolved > 0 OR status LIKE 'technical_failed%')"""

#: The rules in the oracle's own words, over m.
_RULES = {
    "scoped_id": "k % 31 = 3 AND k >= 1400", "box_frame": "k % 13 = 0 OR k % 17 = 2", "transform_frame": "k % 19 = 4", "child_without_parent": "child AND k % 5 > 1 OR NOT child AND k % 5 < 2", "moves_with_parent": "child <> (k % 7 = 0)", "merged_movable": "merged AND k % 3 = 0",
    "own_parent": "parent_id = id", "unified_with_separate": "uni AND (visual_status IS NOT NULL OR collider_status IS NOT NULL)", "unified_collider_topology": "uni AND k % 37 = 0", "unified_topology": "uni AND (k % 6 = 0) <> (k % 20 = 0)", "topology_without_unified": "NOT uni AND k % 20 = 0",
    "topology_without_collider": "k % 37 = 0 AND (k % 3 > 0 OR k % 9 = 6 OR k % 6 > 0)", "unplaced": "live AND k % 13 = 1", "no_visual": "live AND k % 8 = 0 AND NOT uni", "gates_not_ready": "live AND k % 11 = 0", "visual_not_validated": "live AND k % 8 = 1", "no_collider": "k % 6 = 0 AND NOT uni AND k % 9 = 6",
    "collision_not_passed": "k % 6 = 0 AND k % 5 = 0", "collider_not_validated": "k % 6 = 0 AND NOT uni AND k % 9 = 3", "collider_of_visual": "live AND k % 6 > 0 AND k % 9 IN (0, 3)", "collision_of_visual": "(live OR uni) AND k % 6 = 1 AND k % 5 > 0", "dynamic_without_mass": "k % 23 = 1 AND (k % 2 = 1 OR k % 3 <> 1)", "dynamic_by_estimate": "k % 23 = 1 AND k % 2 = 0",
    "id_repeats": "(world_id, id) IN (SELECT (world_id, id) FROM m GROUP BY world_id, id HAVING count(*) > 1)", "scoped_id_repeats": "scoped_id IN (SELECT scoped_id FROM m GROUP BY 1 HAVING count(*) > 1)", "unknown_parent": "parent_id IS NOT NULL AND (world_id, parent_id) NOT IN (SELECT (world_id, id) FROM m)",
    "merged_parent": "(world_id, parent_id) IN (SELECT (world_id, id) FROM m WHERE merged)", "parent_cycle": "(world_id, id) IN (SELECT (world_id, id) FROM up WHERE steps = 40)",
}
#: Rules across objects tell a key once.
_ONCE = ("id_repeats", "scoped_id_repeats", "unknown_parent", "merged_parent", "parent_cycle")

ORACLE = {
    "manifest_rules": f"""WITH RECURSIVE m AS (SELECT *, granularity = 'independent_child_asset' AS child, granularity = 'merged_component' AS merged, k % 10 = 0 AS uni, k % 4 > 0 OR k % 6 = 0 OR k % 23 = 1 AS live FROM ({OBJECTS.format(s='VARCHAR', div='//')})),
      up(world_id, id, above, steps) AS (SELECT DISTINCT world_id, id, parent_id, 1 FROM m WHERE parent_id IS NOT NULL UNION SELECT up.world_id, up.id, m.parent_id, steps + 1 FROM up JOIN m ON m.world_id = up.world_id AND m.id = up.above WHERE m.parent_id IS NOT NULL AND steps < 40),
      v AS ({" UNION ALL ".join(f"SELECT {'DISTINCT ' if r in _ONCE else ''}'{r}' AS rule, scoped_id AS key FROM m WHERE {w}" for r, w in _RULES.items())}) SELECT rule, count(*) AS n, min(key) AS first, max(key) AS last FROM v GROUP BY rule""",
    "next_actions": f"""WITH {_NEXT} SELECT report_id, CASE WHEN len(n) > 0 THEN 'add_observed_donor_or_switch_to_constrained_generation_for_residual' ELSE 'regenerate_residual_with_constrained_background_prior' END AS action,
      CASE WHEN len(n) > 0 THEN 'no_guard_stable_measured_donor_support' ELSE 'unresolved_unobserved_residual' END AS blocker, head AS first_failed_frame_id, coalesce(unresolved, -1) AS unresolved, array_to_string(f, ',') AS failed_frame_ids, array_to_string(n, ',') AS no_support_frame_ids FROM du""",
    "recovery_actions": f"""WITH {_NEXT}, b AS (SELECT *, CASE WHEN head IS NULL OR list_contains(f, head) THEN f ELSE list_append(f, head) END AS g FROM du),
      w AS (SELECT report_id, 1 AS k, 'donor_support' AS stage, 'add_observed_donor_or_switch_to_constrained_generation_for_residual' AS action, list_concat(g, list_filter(n, lambda x: NOT list_contains(g, x))) AS fs, '' AS pair_ids, '' AS triplet_ids FROM b WHERE len(n) > 0
       UNION ALL SELECT report_id, 2, 'temporal_qa', 'repair_temporal_evidence_before_retesting', [], CASE WHEN report_id % 4 = 1 THEN 'b' ELSE '' END, CASE WHEN report_id % 16 = 1 THEN 'd' ELSE '' END FROM b WHERE report_id % 4 = 1
       UNION ALL SELECT report_id, 3, 'temporal_qa', 'repair_temporal_flicker_or_regenerate_clean_plate_candidates', [], CASE WHEN report_id % 3 = 1 THEN 'a' ELSE '' END, CASE WHEN report_id % 9 = 1 THEN 'c' ELSE '' END FROM b WHERE report_id % 3 = 1
       UNION ALL SELECT report_id, 4, 'boundary_qa', 'repair_removal_mask_or_target_matte_before_regeneration', g, '', '' FROM b WHERE len(g) > 0 OR len(n) > 0 UNION ALL SELECT report_id, 5, 'candidate_generation', 'regenerate_residual_with_constrained_background_prior', g, '', '' FROM b WHERE unresolved > 0),
      v AS (SELECT * FROM w UNION ALL SELECT report_id, 6, 'candidate_generation', 'regenerate_residual_with_constrained_background_prior', g, '', '' FROM b WHERE report_id NOT IN (SELECT report_id FROM w))
      SELECT report_id, CAST(row_number() OVER (PARTITION BY report_id ORDER BY k) AS INTEGER) AS priority, stage, action, array_to_string(fs, ',') AS frame_ids, pair_ids, triplet_ids FROM v""",
    "completion_plan": f"""WITH RECURSIVE ob AS (SELECT *, CASE WHEN needs = '' THEN [] ELSE string_split(needs, ',') END AS n FROM ({_SEEN})),
      c AS (SELECT * FROM ob WHERE importance <> 'structure' AND granularity LIKE 'independent%' AND coverage_status <> 'ignored' AND (coverage_status <> 'modeled_complete' OR len(n) > 0)),
      e AS (SELECT front, back FROM ({_EDGES}) WHERE confidence >= 0.5e0 AND front IN (SELECT id FROM c) AND back IN (SELECT id FROM c)), p(node, layer) AS (SELECT id, 0 FROM c UNION SELECT back, layer + 1 FROM p JOIN e ON front = node),
      l AS (SELECT node AS id, max(layer) AS layer FROM p GROUP BY 1), k AS (SELECT c.*, layer, row_number() OVER (PARTITION BY layer ORDER BY priority DESC, id) AS place FROM l JOIN c USING (id)), d AS (SELECT *, dense_rank() OVER (ORDER BY layer, (place - 1) // 4) AS round FROM k),
      r AS (SELECT round, 'object_layer' AS kind, string_agg(id, ',' ORDER BY place) AS targets, flatten(list(list_concat(n, CASE WHEN coverage_status = 'missing' THEN ['segmentation', 'multi_view_lift', 'backside_geometry', 'render_asset', 'collider', 'visual_qa'] ELSE [] END, CASE WHEN coverage_status = 'missing' AND instance_count > 1 THEN ['instance_split'] ELSE [] END))) AS needs FROM d GROUP BY 1),
      a AS (SELECT round, kind, targets, list_filter([{_ASK}], lambda x: x IS NOT NULL) AS acts FROM r UNION ALL SELECT (SELECT coalesce(max(round), 0) + 1 FROM d), 'final_background', '', ['rebuild_background', 'validate_round']),
      f AS (SELECT round, kind, targets, unnest(acts) AS action, generate_subscripts(acts, 1) AS ordinal FROM a), g AS (SELECT *, printf('r%02d-%02d-%s', round, ordinal, replace(action, '_', '-')) AS action_id, {_SIZES} AS z FROM f)
      SELECT CAST(round AS INTEGER) AS round, kind, targets, CAST(ordinal AS INTEGER) AS ordinal, action_id, coalesce(lag(action_id) OVER (PARTITION BY round ORDER BY ordinal), '') AS prerequisites, action IN ('complete_object', 'clean_plate', 'rebuild_background') AS synthetic, CAST(z // 100 AS INTEGER) AS n_roles, CAST(z % 100 AS INTEGER) AS n_gates FROM g""",
    "inventory_violations": f"""WITH RECURSIVE o AS (SELECT *, granularity IN ('independent_child_asset', 'merge_into_parent') AS owned FROM ({_SEEN})), rg AS (SELECT * FROM ({_REGIONS})), fr AS (SELECT * FROM ({_FRAMES})), nm AS (SELECT id, frame FROM o WHERE k % 43 > 0),
      up(id, above, steps) AS (SELECT id, parent_id, 1 FROM o WHERE parent_id IS NOT NULL UNION ALL SELECT up.id, o.parent_id, steps + 1 FROM up JOIN o ON o.id = up.above WHERE o.parent_id IS NOT NULL AND steps < 64)
      SELECT 'structure_without_role' AS rule, id AS key FROM o WHERE importance = 'structure' AND structure_role = 'none' UNION ALL SELECT 'role_without_structure', id FROM o WHERE importance <> 'structure' AND structure_role <> 'none'
      UNION ALL SELECT 'complete_without_match', id FROM o WHERE coverage_status = 'modeled_complete' AND k % 3 = 0 UNION ALL SELECT 'asset_role_differs', id FROM o WHERE (asset_role = 'structure') <> (importance = 'structure')
      UNION ALL SELECT 'parent_missing', id FROM o WHERE owned AND parent_id IS NULL UNION ALL SELECT 'parent_unexpected', id FROM o WHERE NOT owned AND parent_id IS NOT NULL UNION ALL SELECT 'own_parent', id FROM o WHERE parent_id = id
      UNION ALL SELECT 'moves_with_parent_differs', id FROM o WHERE moves_with_parent <> owned UNION ALL SELECT 'fixed_part_movable', id FROM o WHERE granularity = 'merge_into_parent' AND independently_movable
      UNION ALL SELECT 'needs_repeat', id FROM o WHERE k % 47 = 0 AND needs <> '' UNION ALL SELECT 'no_evidence', id FROM o WHERE k % 43 = 0
      UNION ALL SELECT 'frame_repeats', frame_id FROM fr GROUP BY frame_id HAVING count(*) > 1 UNION ALL SELECT 'unknown_frame', id FROM nm WHERE frame NOT IN (SELECT frame_id FROM fr)
      UNION ALL SELECT DISTINCT 'region_of_unknown_frame', id FROM rg WHERE frame_id NOT IN (SELECT frame_id FROM fr) UNION ALL SELECT DISTINCT 'region_not_declared', id FROM rg WHERE (id, frame_id) NOT IN (SELECT id, frame FROM nm)
      UNION ALL SELECT DISTINCT 'region_box', id FROM rg WHERE x1 <= x0 OR x1 > 1000 OR y1 > 1000 OR y1 <= y0 UNION ALL SELECT 'unknown_parent', id FROM o WHERE parent_id IS NOT NULL AND parent_id NOT IN (SELECT id FROM o)
      UNION ALL SELECT DISTINCT 'parent_cycle', id FROM up WHERE steps = 64""",
}
