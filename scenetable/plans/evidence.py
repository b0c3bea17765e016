"""Queries over documents of evidence, graphs, questions and commands."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import contracts, graph, questions
from ..streaming import commands
from . import derived as D


def gate_worst_case(spark, sf_dir):
    docs = D.table(spark, sf_dir, "documents").join(D.table(spark, sf_dir, "labels"), "doc_id")
    rows = docs.select("doc_id", F.expr("stack(3, 'quality', CAST(quality AS DOUBLE), 'toxicity', CAST(toxic AS DOUBLE), 'length', CAST(n_chars AS DOUBLE)) AS (metric, value)"))
    gates = spark.sql("SELECT * FROM VALUES ('quality', '>=', 0.0D), ('toxicity', '<=', 0.5D), ('length', '>=', 40.0D) AS t(metric, op, bound)")
    return contracts.gate_worst(rows, gates)


def category_audit_merge(spark, sf_dir):
    ev = D.table(spark, sf_dir, "events")
    rows = ev.select(
        contracts.canonical_category(F.concat(F.lit(" "), F.initcap("event_type"), F.lit("--Item! "))).alias("category"), F.col("user_id").alias("run_id"), (F.col("event_id") % 17).alias("n"), F.round("value", 3).alias("confidence"),
        F.element_at(F.array(F.lit("primary"), F.lit("structure"), F.lit("secondary")), (F.col("user_id") % 2 + 2).cast("int")).alias("importance"), F.col("event_id").alias("frame_id"),
    )
    return contracts.audit_merge(rows, ["category"])


def coverage_compare(spark, sf_dir):
    observed = D.table(spark, sf_dir, "events").groupBy(F.concat("event_type", (F.col("user_id") % 9 + 2).cast("string")).alias("category")).agg(F.count("*").alias("n"))
    state = F.element_at(F.array(*map(F.lit, ("candidate", "segmented", "review_failed", "completed", "verified"))), (F.col("user_id") % 5 + 1).cast("int"))
    assets = D.table(spark, sf_dir, "events").groupBy(F.concat("event_type", (F.col("user_id") % 9).cast("string")).alias("category")).agg((F.count("*") - 8).alias("represented"), (F.max("user_id") % 2 == 0).alias("individual"), F.max(state).alias("state"))
    return contracts.coverage(observed, assets)


def digest_mismatch(spark, sf_dir):
    docs = D.table(spark, sf_dir, "documents")
    declared = docs.select(F.col("doc_id").alias("uri"), F.sha2(F.when(F.col("doc_id") % 10 == 3, F.concat("text", F.lit("!"))).otherwise(F.col("text")), 256).alias("sha256"), (F.octet_length("text") + F.when(F.col("doc_id") % 10 == 7, 1).otherwise(0)).cast("long").alias("size_bytes"))
    actual = docs.where("doc_id % 10 <> 5").select(F.col("doc_id").alias("uri"), F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("size_bytes"))
    return contracts.digest_issues(declared, actual)


def duplicate_evidence(spark, sf_dir):
    return contracts.duplicates(D.table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("sha256")), "sha256")


def set_digests(spark, sf_dir):
    docs = D.table(spark, sf_dir, "documents")
    return contracts.set_digest(docs, ["source"], F.concat_ws(":", F.col("doc_id").cast("string"), F.sha2("text", 256)))


def lineage_chain_breaks(spark, sf_dir):
    conv = D.table(spark, sf_dir, "conversations")
    out = F.sha2(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")), 256)
    wanted = F.sha2(F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") - F.when((F.col("conv_id") + F.col("turn")) % 11 == 0, 2).otherwise(1)).cast("string")), 256)
    rows = conv.where("(conv_id * 7 + turn) % 13 <> 0").groupBy("conv_id", "turn").agg(F.count("*").alias("n")).select("conv_id", "turn", wanted.alias("input_sha256"), out.alias("output_sha256"))
    return contracts.lineage_breaks(rows, ["conv_id"], "turn")


def route_backends(spark, sf_dir):
    o = D.table(spark, sf_dir, "orders")
    bit = lambda k: F.col("o_orderkey") % k == 0
    rows = o.select(
        F.col("o_orderkey").alias("object_id"), F.when(bit(6), "structure_background").when(F.col("o_orderkey") % 4 == 1, "fixture").otherwise("object").alias("target_kind"), F.element_at(F.array(*map(F.lit, ("Throw_Pillow", "chair", "sofa", " bean  bag ", "Table", "plant"))), (F.col("o_custkey") % 6 + 1).cast("int")).alias("category"), (~bit(5)).alias("same_instance_multi_frame_verified"), (~bit(7)).alias("appearance_contract_verified"),
        bit(2).alias("source_front_rgba_available"), (F.col("o_custkey") % 6).alias("calibrated_view_count"), (F.col("o_orderkey") % 10 / 100.0).alias("view_baseline_score"), (F.col("o_custkey") % 10 / 10.0).alias("estimated_visible_surface_fraction"),
        bit(9).alias("deformable_prior_available"), (F.col("o_custkey") % 11 / 10.0).alias("cad_retrieval_confidence"), bit(3).alias("support_geometry_available"), (F.col("o_custkey") % 4 == 0).alias("multi_depth_negative_space_verified"),
    )
    return contracts.route(rows).groupBy("backend", "score").agg(F.count("*").alias("n"), F.min("object_id").alias("first_object"))


def violations(spark, sf_dir):
    o, c, n = (D.table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    return contracts.violations({
        "customer_without_order": c.join(o.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select(F.col("c_custkey").alias("key")),
        "order_of_unknown_customer": o.join(c.select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_anti").select(F.col("o_orderkey").alias("key")),
        "repeated_order": contracts.duplicates(o, "o_orderkey").select(F.col("o_orderkey").alias("key")),
        "open_order_of_negative_account": o.where("o_orderstatus = 'O'").join(c.where("c_acctbal < -900"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select(F.col("o_orderkey").alias("key")),
        "nation_without_customer": n.join(c, F.col("n_nationkey") == F.col("c_nationkey"), "left_anti").select(F.col("n_name").alias("key")),
    })


def _hierarchy(spark, sf_dir):
    r, n, c, o = (D.table(spark, sf_dir, t) for t in ("region", "nation", "customer", "orders"))
    return (
        n.select(F.concat(F.lit("r"), "n_regionkey").alias("parent"), F.concat(F.lit("n"), "n_nationkey").alias("node"))
        .union(r.select(F.lit("world").alias("parent"), F.concat(F.lit("r"), "r_regionkey").alias("node")))
        .union(c.select(F.concat(F.lit("n"), "c_nationkey").alias("parent"), F.concat(F.lit("c"), "c_custkey").alias("node")))
        .union(o.select(F.concat(F.lit("c"), "o_custkey").alias("parent"), F.concat(F.lit("o"), "o_orderkey").alias("node")))
    )


def hierarchy_descendants(spark, sf_dir):
    reach = graph.descendants(_hierarchy(spark, sf_dir))
    return reach.where("ancestor LIKE 'r%' OR ancestor = 'world' OR ancestor LIKE 'n%'").groupBy("ancestor").agg(F.count("*").alias("n"), F.max("depth").alias("depth"))


def _layer_edges(spark, sf_dir):
    p = D.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("s"))
    return p.where("k % 40 <> 0").select((F.col("k") - 1 - F.col("s") % 3).alias("front"), F.col("k").alias("back")).where("front >= 0 AND front div 40 = back div 40")


def topological_layers(spark, sf_dir):
    return graph.topological_layers(_layer_edges(spark, sf_dir)).groupBy("layer").agg(F.count("*").alias("n"), F.sum("node").alias("node_sum"))


def stale_closure(spark, sf_dir):
    conv = D.table(spark, sf_dir, "conversations").select("conv_id", "turn").distinct()
    name = lambda t: F.concat_ws(":", "conv_id", t)
    needs = conv.where("turn > 0").select(name(F.col("turn")).alias("node"), name(F.col("turn") - 1).alias("needs"))
    stale = conv.where("(conv_id * 5 + turn) % 17 = 0").select(name(F.col("turn")).alias("node"))
    found = graph.stale_closure(needs, stale)
    return found.groupBy(F.split("node", ":")[0].cast("long").alias("conv_id")).agg(F.count("*").alias("n_stale"))


def _objects(spark, sf_dir):
    n = D.table(spark, sf_dir, "nation")
    return n.select(
        F.concat(F.lit("obj_"), F.col("n_nationkey").cast("string")).alias("object_id"), F.concat(F.lit("world:"), F.col("n_nationkey").cast("string")).alias("scoped_id"), F.array("n_name").alias("names"),
        F.array(F.concat(F.lit("thing"), (F.col("n_nationkey") % 4).cast("string"))).alias("aliases"), F.concat(F.lit("kind"), F.col("n_regionkey").cast("string")).alias("category"),
        F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("by "), "n_name")).alias("location"), F.when(F.col("n_nationkey") % 2 == 0, F.lit("grey")).alias("appearance"),
        F.when(F.col("n_nationkey") % 5 != 0, F.array(*(F.lit(v) for v in (0.0, 1.0, 2.0)))).alias("box_min"), F.when(F.col("n_nationkey") % 5 != 0, F.array(*(F.lit(v) for v in (1.0, 2.0, 4.0)))).alias("box_max"),
    )


def _asked(spark, sf_dir):
    c = D.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    what = F.when(k % 4 == 0, F.concat(F.lit("Where is obj_"), (k % 30).cast("string"), F.lit("?"))).when(k % 4 == 1, F.concat(F.lit("What color is the second thing"), (k % 5).cast("string"))).when(k % 4 == 2, F.concat(F.lit("第二thing"), (k % 5).cast("string"), F.lit("在哪里"))).otherwise(F.concat(F.lit("Describe kind"), (k % 7).cast("string"), F.lit(" please")))
    return c.select(k.alias("question_id"), what.alias("text"))


def scene_question_resolution(spark, sf_dir):
    return questions.resolve(_asked(spark, sf_dir), _objects(spark, sf_dir))


def scene_answers(spark, sf_dir):
    rel = D.table(spark, sf_dir, "nation").select(F.concat(F.lit("obj_"), F.col("n_nationkey").cast("string")).alias("subject"), F.lit("near").alias("predicate"), F.concat(F.lit("region "), F.col("n_regionkey").cast("string")).alias("target"), (F.col("n_nationkey") % 10 / 10.0).alias("confidence"), (F.col("n_nationkey") % 2 == 1).alias("verified"))
    out = questions.answer(_asked(spark, sf_dir), _objects(spark, sf_dir), rel)
    return out.groupBy("lang", "intent", "status", "answer").agg(F.count("*").alias("n"))


def command_intake(spark, sf_dir):
    ev = D.table(spark, sf_dir, "events")
    verb = F.element_at(F.array(*map(F.lit, ("delete it", "rename it", "where is it", "merge them"))), (F.col("event_id") % 4 + 1).cast("int"))
    cmds = ev.select(F.col("event_id").alias("request_id"), F.col("user_id").cast("string").alias("requester"), verb.alias("text"), F.concat(F.lit("t"), (F.col("event_id") % 7).cast("string")).alias("target"), F.concat(F.lit("sha"), (F.col("user_id") % 3).cast("string")).alias("expected_sha"), F.col("ts").alias("submitted_at"))
    manifest = spark.range(6).select(F.concat(F.lit("t"), F.col("id").cast("string")).alias("target"), F.lit("sha1").alias("manifest_sha"))
    planned = commands.plan_commands(cmds, manifest)
    first = commands.enqueue_once(planned.where("status = 'queued'"))
    return first.groupBy("kind", "target").agg(F.count("*").alias("n"), F.min("request_id").alias("first_request"), F.min("plan_id").alias("least_plan"))


def gate_board(spark, sf_dir):
    ev = D.table(spark, sf_dir, "events")
    out = commands.gate_board(ev.select(F.col("user_id").alias("object_id"), F.col("event_type").alias("gate"), F.when(F.col("value") > 50, "failed").otherwise("passed").alias("status"), "ts"))
    return out.groupBy("gate", "status").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (
    gate_worst_case, category_audit_merge, coverage_compare, digest_mismatch, duplicate_evidence, set_digests, lineage_chain_breaks, route_backends, violations, hierarchy_descendants,
    topological_layers, stale_closure, scene_question_resolution, scene_answers, command_intake, gate_board,
)}

_ASKED = """obj AS (SELECT 'obj_' || n_nationkey AS object_id, n_nationkey AS k, lower(regexp_replace(n_name, '[^A-Za-z0-9]', '', 'g')) AS nm, n_name, n_regionkey AS r FROM nation),
 term AS (SELECT object_id, key, max(w) + least(length(key), 99) AS weight FROM (
   SELECT object_id, 'world' || k AS key, 1000 AS w FROM obj UNION ALL SELECT object_id, 'obj' || k, 900 FROM obj UNION ALL SELECT object_id, nm, 800 FROM obj
   UNION ALL SELECT object_id, 'thing' || (k % 4), 600 FROM obj UNION ALL SELECT object_id, 'kind' || r, 400 FROM obj) GROUP BY 1, 2),
 ask AS (SELECT c_custkey AS question_id, CASE c_custkey % 4 WHEN 0 THEN 'Where is obj_' || (c_custkey % 30) || '?' WHEN 1 THEN 'What color is the second thing' || (c_custkey % 5) WHEN 2 THEN '第二thing' || (c_custkey % 5) || '在哪里' ELSE 'Describe kind' || (c_custkey % 7) || ' please' END AS text FROM customer),
 q AS (SELECT question_id, text, lower(regexp_replace(text, '[^A-Za-z0-9]', '', 'g')) AS q, CASE WHEN contains(text, 'second') OR contains(text, '第二') THEN 2 END AS nth FROM ask),
 hit AS (SELECT question_id, nth, object_id, max(weight) AS score FROM q JOIN term ON contains(q.q, key) GROUP BY 1, 2, 3),
 best AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY CAST(regexp_extract(object_id, '([0-9]+)$', 1) AS INTEGER), object_id) AS place, count(*) OVER (PARTITION BY question_id) AS n_best
          FROM (SELECT *, max(score) OVER (PARTITION BY question_id) AS top FROM hit) WHERE score = top),
 one AS (SELECT question_id, max(n_best) AS n_best, max(score) AS score, coalesce(max(object_id) FILTER (WHERE n_best = 1), max(object_id) FILTER (WHERE place = nth)) AS object_id FROM best GROUP BY 1),
 res AS (SELECT q.question_id, q.text, object_id, coalesce(n_best, 0) AS n_best, score, CASE WHEN n_best IS NULL THEN 'not_found' WHEN object_id IS NULL THEN 'ambiguous' ELSE 'resolved' END AS status FROM q LEFT JOIN one USING (question_id))"""

ORACLE = {
    "gate_worst_case": """WITH d AS (SELECT quality, toxic, n_chars FROM documents JOIN labels USING (doc_id)),
      m AS (SELECT 'quality' AS metric, '>=' AS op, 0.0e0 AS bound, CAST(quality AS DOUBLE) AS v FROM d UNION ALL SELECT 'toxicity', '<=', 0.5e0, toxic FROM d UNION ALL SELECT 'length', '>=', 40.0e0, n_chars FROM d)
      SELECT metric, op, bound, CASE WHEN op = '>=' THEN min(v) ELSE max(v) END AS worst, bool_and(CASE WHEN op = '>=' THEN v >= bound ELSE v <= bound END) AS passed, count(*) FILTER (WHERE NOT CASE WHEN op = '>=' THEN v >= bound ELSE v <= bound END) AS n_failed FROM m GROUP BY 1, 2, 3""",
    "category_audit_merge": """WITH e AS (SELECT event_type || '_item' AS category, user_id AS run_id, event_id % 17 AS n, round(value, 3) AS confidence, CASE WHEN user_id % 2 = 0 THEN 1 ELSE 2 END AS i, event_id AS frame_id FROM events),
      f AS (SELECT category, frame_id, row_number() OVER (PARTITION BY category ORDER BY confidence DESC, frame_id) AS k FROM e),
      l AS (SELECT category, string_agg(CAST(frame_id AS VARCHAR), ',' ORDER BY k) AS frames FROM f WHERE k <= 6 GROUP BY 1),
      r AS (SELECT category, run_id FROM e QUALIFY row_number() OVER (PARTITION BY category ORDER BY n DESC, confidence DESC, run_id) = 1)
      SELECT e.category, max(n) AS n, any_value(r.run_id) AS representative, CASE min(i) WHEN 0 THEN 'primary' WHEN 1 THEN 'structure' ELSE 'secondary' END AS importance, any_value(frames) AS frames FROM e JOIN l USING (category) JOIN r USING (category) GROUP BY 1""",
    "coverage_compare": """WITH o AS (SELECT event_type || (user_id % 9 + 2) AS category, count(*) AS n FROM events GROUP BY 1),
      a AS (SELECT event_type || (user_id % 9) AS category, count(*) - 8 AS represented, max(user_id) % 2 = 0 AS individual, max(['candidate', 'segmented', 'review_failed', 'completed', 'verified'][user_id % 5 + 1]) AS state FROM events GROUP BY 1)
      SELECT category, n, represented, individual, state, CASE WHEN represented IS NULL OR represented < coalesce(n, 0) THEN CASE WHEN individual THEN 'instance_split' ELSE 'segment' END WHEN n IS NULL THEN 'unassessed'
        WHEN state = 'candidate' THEN 'segment' WHEN state IN ('segmented', 'review_failed') THEN 'complete' WHEN state = 'completed' THEN 'review' ELSE 'none' END AS action FROM o FULL JOIN a USING (category)""",
    "digest_mismatch": "SELECT doc_id AS uri, CASE doc_id % 10 WHEN 5 THEN 'missing' WHEN 7 THEN 'size_mismatch' ELSE 'sha256_mismatch' END AS issue FROM documents WHERE doc_id % 10 IN (3, 5, 7)",
    "duplicate_evidence": "SELECT sha256(text) AS sha256, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1",
    "set_digests": """WITH p AS (SELECT source, doc_id || ':' || sha256(text) AS p FROM documents), b AS (SELECT source, substr(sha256(p), 1, 3) AS b, sha256(string_agg(p, chr(10) ORDER BY p)) AS d FROM p GROUP BY 1, 2)
      SELECT source, sha256(string_agg(b || ':' || d, chr(10) ORDER BY b)) AS digest FROM b GROUP BY 1""",
    "lineage_chain_breaks": """WITH r AS (SELECT DISTINCT conv_id, turn FROM conversations WHERE (conv_id * 7 + turn) % 13 <> 0), l AS (SELECT *, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM r)
      SELECT conv_id, turn, CASE WHEN p + 1 <> turn THEN 'gap' ELSE 'digest_break' END AS issue FROM l WHERE p IS NOT NULL AND (p + 1 <> turn OR (conv_id + turn) % 11 = 0)""",
    "route_backends": """WITH e AS (SELECT o_orderkey AS k, o_custkey AS c, trim(regexp_replace(lower(['Throw_Pillow', 'chair', 'sofa', ' bean  bag ', 'Table', 'plant'][o_custkey % 6 + 1]), '[\\s_]+', ' ', 'g')) AS kind, k % 5 <> 0 AND k % 7 <> 0 AS ready FROM orders),
      r AS (SELECT k, CASE WHEN NOT ready THEN 'hold_for_more_evidence' WHEN k % 6 = 0 AND k % 3 = 0 THEN 'support_surface_reconstruction' WHEN k % 6 <> 0 AND k % 4 = 1 AND k % 3 = 0 AND c % 4 = 0 THEN 'component_assembly'
        WHEN c % 6 >= 3 AND k % 10 / 100.0e0 >= 0.05e0 AND c % 10 / 10.0e0 >= 0.35e0 THEN 'multi_view_reconstruction' WHEN k % 2 = 0 AND (k % 9 = 0 OR kind IN ('bean bag', 'cushion', 'pillow', 'seat cushion', 'throw pillow')) THEN 'deformable_category_prior'
        WHEN kind IN ('cabinet', 'chair', 'door', 'lamp', 'nightstand', 'stool', 'table', 'vase') AND c % 11 / 10.0e0 >= 0.82e0 THEN 'retrieval_cad_prior' WHEN k % 2 = 0 THEN 'generative_image_to_3d' ELSE 'hold_for_more_evidence' END AS backend, ready FROM e)
      SELECT backend, CAST(CASE backend WHEN 'support_surface_reconstruction' THEN 98 WHEN 'component_assembly' THEN 97 WHEN 'multi_view_reconstruction' THEN 96 WHEN 'deformable_category_prior' THEN 88 WHEN 'retrieval_cad_prior' THEN 82
        WHEN 'generative_image_to_3d' THEN 70 ELSE CASE WHEN ready THEN 1 ELSE 100 END END AS INTEGER) AS score, count(*) AS n, min(k) AS first_object FROM r GROUP BY 1, 2""",
    "violations": """SELECT 'customer_without_order' AS rule, CAST(c_custkey AS VARCHAR) AS key FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
      UNION ALL SELECT 'order_of_unknown_customer', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
      UNION ALL SELECT 'repeated_order', CAST(o_orderkey AS VARCHAR) FROM orders GROUP BY o_orderkey HAVING count(*) > 1
      UNION ALL SELECT 'open_order_of_negative_account', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'O' AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < -900)
      UNION ALL SELECT 'nation_without_customer', n_name FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer)""",
    "hierarchy_descendants": """WITH RECURSIVE e AS (SELECT 'r' || n_regionkey AS p, 'n' || n_nationkey AS c FROM nation UNION ALL SELECT 'world', 'r' || r_regionkey FROM region
        UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer UNION ALL SELECT 'c' || o_custkey, 'o' || o_orderkey FROM orders),
      d(a, c, depth) AS (SELECT p, c, 1 FROM e UNION ALL SELECT d.a, e.c, d.depth + 1 FROM d JOIN e ON d.c = e.p)
      SELECT a AS ancestor, count(DISTINCT c) AS n, max(depth) AS depth FROM d WHERE a LIKE 'r%' OR a = 'world' OR a LIKE 'n%' GROUP BY 1""",
    "topological_layers": """WITH RECURSIVE e AS (SELECT DISTINCT p_partkey - 1 - p_size % 3 AS f, p_partkey AS b FROM part WHERE p_partkey % 40 <> 0 AND p_partkey - 1 - p_size % 3 >= 0 AND (p_partkey - 1 - p_size % 3) // 40 = p_partkey // 40),
      n AS (SELECT f AS node FROM e UNION SELECT b FROM e), d(node, layer) AS (SELECT node, 0 FROM n WHERE node NOT IN (SELECT b FROM e) UNION SELECT e.b, d.layer + 1 FROM d JOIN e ON d.node = e.f),
      m AS (SELECT node, max(layer) AS layer FROM d GROUP BY 1) SELECT layer, count(*) AS n, CAST(sum(node) AS BIGINT) AS node_sum FROM m GROUP BY 1""",
    "stale_closure": """WITH c AS (SELECT DISTINCT conv_id, turn FROM conversations), s AS (SELECT conv_id, min(turn) AS t FROM c WHERE (conv_id * 5 + turn) % 17 = 0 GROUP BY 1),
      g AS (SELECT *, turn - row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM c), f AS (SELECT g.conv_id, g.island, min(g.turn) AS t FROM g WHERE (conv_id * 5 + turn) % 17 = 0 GROUP BY 1, 2)
      SELECT g.conv_id, count(*) AS n_stale FROM g JOIN f ON g.conv_id = f.conv_id AND g.island = f.island AND g.turn >= f.t GROUP BY 1""",
    "scene_question_resolution": f"WITH {_ASKED} SELECT question_id, object_id, n_best, CAST(score AS INTEGER) AS score, status FROM res",
    "scene_answers": f"""WITH {_ASKED}, a AS (SELECT CASE WHEN contains(text, '第二') THEN 'zh' ELSE 'en' END AS lang, CASE WHEN contains(lower(text), 'color') THEN 'appearance' WHEN regexp_matches(lower(text), 'where|在哪') THEN 'location' ELSE 'unknown' END AS intent, res.*, k, n_name, r FROM res LEFT JOIN obj USING (object_id)),
      t AS (SELECT *, CASE WHEN intent = 'location' THEN coalesce(CASE WHEN k % 3 = 0 THEN 'by ' || n_name END, CASE WHEN k % 2 = 1 AND k % 10 / 10.0e0 >= 0.5e0 THEN CASE WHEN lang = 'zh' THEN '在region ' || r || '附近' ELSE 'near region ' || r END END, CASE WHEN k % 5 <> 0 THEN 'centre (0.50, 1.50, 3.00)' END) WHEN intent = 'appearance' THEN CASE WHEN k % 2 = 0 THEN 'grey' END END AS said FROM a),
      u AS (SELECT lang, intent, CASE WHEN status <> 'resolved' THEN status WHEN intent = 'unknown' THEN 'unsupported' WHEN said IS NULL THEN 'unavailable' ELSE 'resolved' END AS status, said FROM t)
      SELECT lang, intent, status, CASE WHEN status = 'resolved' THEN said END AS answer, count(*) AS n FROM u GROUP BY 1, 2, 3, 4""",
    "command_intake": """WITH c AS (SELECT event_id, ts, user_id, CASE event_id % 4 WHEN 0 THEN 'delete' WHEN 1 THEN 'update' WHEN 2 THEN 'query' ELSE 'merge' END AS kind, 't' || (event_id % 7) AS target FROM events WHERE user_id % 3 = 1 AND event_id % 7 < 6),
      k AS (SELECT *, sha256(concat_ws(chr(1), CAST(user_id AS VARCHAR), kind, target)) AS key FROM c WHERE kind <> 'query'), f AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY key ORDER BY ts, event_id) = 1)
      SELECT kind, target, count(*) AS n, min(event_id) AS first_request, min(substr(key, 1, 20)) AS least_plan FROM f GROUP BY 1, 2""",
    "gate_board": """WITH s AS (SELECT user_id, event_type, ts, CASE WHEN value > 50 THEN 'failed' ELSE 'passed' END AS status FROM events), l AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, status DESC) = 1)
      SELECT event_type AS gate, status, count(*) AS n FROM l GROUP BY 1, 2""",
}
