"""Queries over names in questions, relations and peeling order."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import contracts, graph, naming
from . import derived as D

#: Questions of customers; a few are in Chinese, name nothing, or name what is not there.
ASKED = """SELECT c_custkey AS question_id, CASE c_custkey % 8 WHEN 0 THEN 'Where is the ' || lower(n_name) || '?' WHEN 1 THEN 'what about Thing-' || CAST(c_custkey % 5 AS {s}) || ', please' WHEN 2 THEN '椅子' || CAST(c_custkey % 4 AS {s}) || '在哪里' WHEN 3 THEN 'is it grey' WHEN 4 THEN 'the pillow near ' || n_name
 WHEN 5 THEN 'obj_' || CAST(c_custkey % 30 AS {s}) || ' (kind ' || CAST(c_custkey % 6 AS {s}) || ')' WHEN 6 THEN '?!' ELSE 'nothing' || n_name END AS text, CASE WHEN c_custkey % 3 = 0 THEN 'obj_' || CAST(c_custkey % 27 AS {s}) END AS selected_id FROM customer JOIN nation ON c_nationkey = n_nationkey"""


def _sql(spark, sf_dir, sql):
    for t in ("customer", "nation", "supplier", "orders"):
        D.table(spark, sf_dir, t).createOrReplaceTempView(t)
    return spark.sql(sql.replace("{s}", "STRING"))


def _terms(spark, sf_dir):
    n = D.table(spark, sf_dir, "nation").select(F.concat(F.lit("obj_"), F.col("n_nationkey").cast("string")).alias("object_id"), "n_name", F.col("n_nationkey").alias("k"), F.col("n_regionkey").alias("g"))
    kinds = [("id", F.col("object_id")), ("name", F.col("n_name")), ("alias", F.concat(F.lit("thing "), (F.col("k") % 4).cast("string"))), ("alias", F.when(F.col("k") % 6 == 0, F.lit("椅子")).otherwise("桌子")), ("category", F.concat(F.lit("Kind "), F.col("g").cast("string")))]
    return n.select("object_id", F.explode(F.array(*(F.struct(t.alias("term"), F.lit(k).alias("kind")) for k, t in kinds))).alias("t")).select("object_id", "t.term", "t.kind")


def named_resolution(spark, sf_dir):
    """The object each question names, or that it names what is missing."""
    missing = spark.createDataFrame([("pillow",), ("枕头",)], "term string")
    out = naming.resolve_named(_sql(spark, sf_dir, ASKED), _terms(spark, sf_dir), missing)
    return out.select("question_id", "status", "object_id", "term", F.array_join("candidates", ",").alias("candidates"))


RELATIONS = """SELECT s_suppkey AS ord, 'obj_' || CAST(s_nationkey AS {s}) AS subject, CASE s_suppkey % 4 WHEN 0 THEN 'OnTopOf' WHEN 1 THEN 'SupportedBy' WHEN 2 THEN 'Near' ELSE 'FacesTo' END AS predicate, 'obj_' || CAST((s_suppkey * 7) % 29 AS {s}) AS object,
 CASE WHEN s_suppkey % 5 = 0 THEN '床' END AS target_zh, CASE WHEN s_suppkey % 7 = 0 THEN 'the bed' END AS target_en, CASE WHEN s_suppkey % 3 > 0 THEN (s_suppkey % 10) / 10.0e0 END AS confidence, s_suppkey % 6 <> 1 AS verified FROM supplier"""


def told_relations(spark, sf_dir):
    """Each object's first verified relation, from either side."""
    rows = _sql(spark, sf_dir, RELATIONS)
    objects = D.table(spark, sf_dir, "nation").select(F.concat(F.lit("obj_"), F.col("n_nationkey").cast("string")).alias("object_id"), F.col("n_name").alias("name"))
    return naming.told_relations(objects, rows)


#: Who stands before whom: nations before their customers, customers before their orders, orders of one customer by no one.
EDGES = """SELECT 'n' || CAST(c_nationkey AS {s}) AS front, 'c' || CAST(c_custkey AS {s}) AS back, CASE WHEN c_custkey % 5 = 0 THEN 0.3e0 ELSE 0.8e0 END AS confidence, c_custkey % 5 <> 0 AS verified FROM customer
 UNION ALL SELECT 'c' || CAST(o_custkey AS {s}), 'o' || CAST(o_orderkey AS {s}), 0.5e0, true FROM orders UNION ALL SELECT 'n' || CAST(c_nationkey AS {s}), 'o' || CAST(o_orderkey AS {s}), 0.9e0, true FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 3 = 0
 UNION ALL SELECT 'gone', 'o' || CAST(o_orderkey AS {s}), 0.9e0, false FROM orders"""
NODES = """SELECT 'n' || CAST(n_nationkey AS {s}) AS node, n_nationkey % 3 AS priority FROM nation UNION ALL SELECT 'c' || CAST(c_custkey AS {s}), c_custkey % 7 FROM customer UNION ALL SELECT 'o' || CAST(o_orderkey AS {s}), o_orderkey % 11 FROM orders"""


def peel_layers(spark, sf_dir):
    """The order in which nations, customers and orders are taken off."""
    out = graph.peel_layers(_sql(spark, sf_dir, NODES), _sql(spark, sf_dir, EDGES))
    return out.groupBy("layer", (F.col("place") % 50).alias("slot")).agg(F.count("*").alias("n"), F.min("node").alias("first"), F.max("node").alias("last"))


#: Observed instances by category, and assets for each supplier.
OBSERVED = "SELECT event_type || CAST(user_id % 40 AS {s}) AS category, max(event_id % 7) AS n FROM events GROUP BY 1"
ASSETS = """SELECT CASE s_nationkey % 4 WHEN 0 THEN 'view' WHEN 1 THEN 'click' WHEN 2 THEN 'purchase' ELSE 'other' END || CAST(s_suppkey % 44 AS {s}) AS category, s_name AS asset_id, CASE WHEN s_suppkey % 3 = 0 THEN 'group' ELSE 'individual' END AS scope, s_suppkey % 9 + 1 AS represented,
 CASE s_nationkey % 5 WHEN 0 THEN 'candidate' WHEN 1 THEN 'segmented' WHEN 2 THEN 'review_failed' WHEN 3 THEN 'completed' ELSE 'verified' END AS state FROM supplier"""


def asset_coverage(spark, sf_dir):
    """What each observed category still needs."""
    D.table(spark, sf_dir, "events").createOrReplaceTempView("events")
    return contracts.asset_coverage(_sql(spark, sf_dir, OBSERVED), _sql(spark, sf_dir, ASSETS))


QUERIES = {f.__name__: f for f in (named_resolution, told_relations, peel_layers, asset_coverage)}

_ASK = ASKED.replace("{s}", "VARCHAR")
_TERMS = """tm AS (SELECT object_id, trim(regexp_replace(lower(term), '[\\p{P}\\p{S}\\s]+', ' ', 'g')) AS key, rank FROM (SELECT 'obj_' || n_nationkey AS object_id, unnest(['obj_' || n_nationkey, n_name, 'thing ' || n_nationkey % 4, CASE WHEN n_nationkey % 6 = 0 THEN '椅子' ELSE '桌子' END, 'Kind ' || n_regionkey]) AS term, unnest([0, 1, 2, 2, 3]) AS rank FROM nation))"""
_REL = RELATIONS.replace("{s}", "VARCHAR")

ORACLE = {
    "asset_coverage": f"""WITH o AS ({OBSERVED.replace('{s}', 'VARCHAR')}), a AS ({ASSETS.replace('{s}', 'VARCHAR')}), h AS (SELECT category, sum(represented) AS r, sum(CASE WHEN scope = 'individual' THEN represented ELSE 0 END) AS i, list(state) FILTER (WHERE scope = 'individual') AS st FROM a GROUP BY 1), j AS (SELECT * FROM o FULL JOIN h USING (category))
      SELECT category, n, CAST(coalesce(r, 0) AS BIGINT) AS represented, CAST(coalesce(i, 0) AS BIGINT) AS individual, CASE WHEN n IS NULL THEN 'unassessed' WHEN r IS NULL THEN 'missing' WHEN r < n OR i < n THEN 'undercovered' ELSE 'covered' END AS status,
        CASE WHEN n IS NULL THEN 'none' WHEN r IS NULL OR r < n THEN 'segment' WHEN i < n THEN 'instance_split' WHEN list_contains(st, 'candidate') THEN 'segment' WHEN list_contains(st, 'segmented') OR list_contains(st, 'review_failed') THEN 'complete' WHEN list_contains(st, 'completed') THEN 'review' ELSE 'none' END AS next_action FROM j""",
    "named_resolution": f"""WITH a AS (SELECT question_id, selected_id, trim(regexp_replace(lower(text), '[\\p{{P}}\\p{{S}}\\s]+', ' ', 'g')) AS q FROM ({_ASK})), {_TERMS},
      h AS (SELECT question_id, object_id, rank, min(rank) OVER (PARTITION BY question_id) AS best FROM a JOIN tm ON CASE WHEN key IN ('椅子', '桌子') THEN contains(q, key) ELSE contains(' ' || q || ' ', ' ' || key || ' ') END), b AS (SELECT question_id, list_sort(list(DISTINCT object_id)) AS found FROM h WHERE rank = best GROUP BY 1),
      s AS (SELECT *, CASE WHEN q = '' THEN 'empty' WHEN contains(' ' || q || ' ', ' pillow ') OR contains(q, '枕头') THEN 'missing-instance' WHEN len(found) = 1 THEN 'resolved' WHEN len(found) > 1 THEN 'ambiguous'
        WHEN (contains(q, 'it') OR contains(q, 'this object') OR contains(q, '它')) AND selected_id IN (SELECT object_id FROM tm) THEN 'resolved' ELSE 'not-found' END AS status FROM a LEFT JOIN b USING (question_id))
      SELECT question_id, status, CASE WHEN status = 'resolved' THEN coalesce(found[1], selected_id) END AS object_id, CASE WHEN status = 'missing-instance' THEN 'pillow' END AS term, CASE WHEN status = 'ambiguous' THEN array_to_string(found, ',') ELSE '' END AS candidates FROM s""",
    "told_relations": f"""WITH r AS (SELECT * FROM ({_REL}) WHERE verified AND (confidence IS NULL OR confidence >= 0.5e0)), s AS (SELECT subject AS object_id, object AS other, 0 AS side, ord, predicate, target_zh, target_en FROM r UNION ALL SELECT object, subject, 1, ord, predicate, NULL, NULL FROM r WHERE subject <> object),
      f AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY object_id ORDER BY ord) = 1), o AS (SELECT 'obj_' || n_nationkey AS object_id, n_name FROM nation), j AS (SELECT f.*, n_name FROM f SEMI JOIN o USING (object_id) LEFT JOIN o p ON p.object_id = other)
      SELECT object_id, CASE predicate WHEN 'OnTopOf' THEN CASE side WHEN 0 THEN '位于其上方' ELSE '位于其下方' END WHEN 'SupportedBy' THEN CASE side WHEN 0 THEN '由其支撑' ELSE '支撑' END WHEN 'Near' THEN '靠近' ELSE predicate END || ' ' || coalesce(target_zh, target_en, n_name, other) AS zh,
        CASE predicate WHEN 'OnTopOf' THEN CASE side WHEN 0 THEN 'on top of' ELSE 'under' END WHEN 'SupportedBy' THEN CASE side WHEN 0 THEN 'supported by' ELSE 'supports' END WHEN 'Near' THEN 'near' ELSE predicate END || ' ' || coalesce(target_en, target_zh, n_name, other) AS en FROM j""",
    "peel_layers": f"""WITH RECURSIVE nd AS ({NODES.replace('{s}', 'VARCHAR')}), e AS (SELECT front, back FROM ({EDGES.replace('{s}', 'VARCHAR')}) WHERE confidence >= 0.5e0 AND front IN (SELECT node FROM nd)),
      p(node, layer) AS (SELECT node, 0 FROM nd UNION SELECT back, layer + 1 FROM p JOIN e ON front = node), l AS (SELECT node, max(layer) AS layer FROM p GROUP BY 1), k AS (SELECT node, layer, row_number() OVER (PARTITION BY layer ORDER BY priority DESC, node) AS place FROM l JOIN nd USING (node))
      SELECT layer, CAST(place % 50 AS INTEGER) AS slot, count(*) AS n, min(node) AS first, max(node) AS last FROM k GROUP BY 1, 2""",
}
