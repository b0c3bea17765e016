"""Queries that compare masks, images, depths, cameras and id sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics
from . import derived as D


def mask_metrics(spark, sf_dir):
    img = D.image(spark, sf_dir)
    out = metrics.mask_metrics(img.where("v > 25"), img.where("d > 0.04"))
    return out.select("frame_id", *(F.round(c, 6).alias(c) for c in ("iou", "precision", "recall", "centre_error")))


def image_metrics(spark, sf_dir):
    img = D.image(spark, sf_dir)
    out = metrics.image_metrics(img, img.withColumn("v", F.col("v") + F.col("d") * 10), 50.0)
    return out.select("frame_id", "n", *(F.round(c, 6).alias(c) for c in ("l1", "rmse", "psnr")))


def depth_disagreement(spark, sf_dir):
    img = D.image(spark, sf_dir).withColumn("depth", F.col("v") + 1)
    out = metrics.depth_disagreement(img, img.withColumn("depth", F.col("depth") * (1 + F.col("d"))))
    return out.select("frame_id", *(F.round(c, 6).alias(c) for c in ("log_median", "log_p90", "rel_median", "rel_p90")))


def id_reconciliation(spark, sf_dir):
    return metrics.id_reconciliation(D.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), D.table(spark, sf_dir, "orders").select((F.col("o_custkey") * 2).alias("id")), "id").groupBy("issue").agg(F.count("*").alias("n"), F.sum("id").alias("id_sum"))


def frame_coverage(spark, sf_dir):
    ev = D.table(spark, sf_dir, "events")
    return metrics.frame_coverage(D.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("frame_id")), ev.select(F.col("event_type").alias("binding")), ev.select(F.col("event_type").alias("binding"), F.col("user_id").alias("frame_id")).distinct())


def camera_drift(spark, sf_dir):
    cams = D.cameras(spark, sf_dir).select("frame_id", "r", "t")
    fresh = cams.select("frame_id", "r", F.when(F.col("frame_id") % 7 == 3, F.transform("t", lambda x: x + 0.5)).otherwise(F.col("t")).alias("t"))
    return metrics.camera_drift(fresh, cams.where("frame_id <> 11"))


def worst_frames(spark, sf_dir):
    ev = D.table(spark, sf_dir, "events").select("event_type", "event_id", F.round("value", 6).alias("value"))
    return metrics.top_rows(ev, ["event_type"], "value", "event_id", 5)


def prior_comparison(spark, sf_dir):
    ev = D.table(spark, sf_dir, "events")
    run = lambda k: ev.where(F.col("event_id") % 2 == k).groupBy("user_id").agg(F.count("*").alias("n"), F.min("event_id").alias("first"))
    return metrics.prior_verdict(run(0), run(1), {"n": False, "first": True}).groupBy("verdict").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (mask_metrics, image_metrics, depth_disagreement, id_reconciliation, frame_coverage, camera_drift, worst_frames, prior_comparison)}

ORACLE = {
    "mask_metrics": f"""WITH i AS ({D.IMAGE}), c AS (SELECT frame_id, y, x, (v > 25)::INT AS p, (d > 0.04e0)::INT AS t FROM i WHERE v > 25 OR d > 0.04e0)
      SELECT frame_id, round(sum(p * t) / count(*), 6) AS iou, round(CASE WHEN sum(p) > 0 THEN sum(p * t) / sum(p) ELSE 0 END, 6) AS precision, round(CASE WHEN sum(t) > 0 THEN sum(p * t) / sum(t) ELSE 0 END, 6) AS recall,
        round(CASE WHEN sum(p) > 0 AND sum(t) > 0 THEN sqrt(pow(sum(p * x) / sum(p) - sum(t * x) / sum(t), 2) + pow(sum(p * y) / sum(p) - sum(t * y) / sum(t), 2)) END, 6) AS centre_error FROM c GROUP BY 1""",
    "image_metrics": f"""WITH i AS ({D.IMAGE}), m AS (SELECT frame_id, count(*) AS n, avg(abs(v - (v + d * 10))) AS l1, avg((v - (v + d * 10)) * (v - (v + d * 10))) AS e FROM i GROUP BY 1)
      SELECT frame_id, n, round(l1, 6) AS l1, round(sqrt(e), 6) AS rmse, round(CASE WHEN e > 0 THEN 10 * log10(2500.0e0 / e) END, 6) AS psnr FROM m""",
    "depth_disagreement": f"""WITH i AS ({D.IMAGE}), p AS (SELECT frame_id, v + 1 AS a, (v + 1) * (1 + d) AS b FROM i), e AS (SELECT frame_id, abs(ln(b / a)) AS l, abs(b - a) / a AS r FROM p WHERE a > 0 AND b > 0)
      SELECT frame_id, round(quantile_cont(l, 0.5), 6) AS log_median, round(quantile_cont(l, 0.9), 6) AS log_p90, round(quantile_cont(r, 0.5), 6) AS rel_median, round(quantile_cont(r, 0.9), 6) AS rel_p90 FROM e GROUP BY 1""",
    "id_reconciliation": """WITH b AS (SELECT id, sum(e) AS e, sum(a) AS a FROM (SELECT c_custkey AS id, 1 AS e, 0 AS a FROM customer UNION ALL SELECT o_custkey * 2, 0, 1 FROM orders) GROUP BY 1),
      i AS (SELECT id, CASE WHEN a = 0 THEN 'missing' WHEN e = 0 THEN 'extra' WHEN a > 1 THEN 'duplicate' END AS issue FROM b) SELECT issue, count(*) AS n, CAST(sum(id) AS BIGINT) AS id_sum FROM i WHERE issue IS NOT NULL GROUP BY 1""",
    "frame_coverage": """SELECT binding, frame_id FROM (SELECT c_custkey AS frame_id FROM customer) CROSS JOIN (SELECT DISTINCT event_type AS binding FROM events) r
      WHERE NOT EXISTS (SELECT 1 FROM events WHERE event_type = r.binding AND user_id = frame_id)""",
    "camera_drift": "SELECT n_nationkey AS frame_id, CASE WHEN n_nationkey = 11 THEN 'unknown' ELSE 'moved' END AS issue, CASE WHEN n_nationkey <> 11 THEN 0.5e0 END AS delta FROM nation WHERE n_nationkey % 7 = 3 OR n_nationkey = 11",
    "worst_frames": "SELECT event_type, event_id, round(value, 6) AS value, CAST(row_number() OVER (PARTITION BY event_type ORDER BY round(value, 6) DESC, event_id) AS INTEGER) AS rank FROM events QUALIFY rank <= 5",
    "prior_comparison": """WITH r AS (SELECT user_id, event_id % 2 AS k, count(*) AS n, min(event_id) AS f FROM events GROUP BY 1, 2), j AS (SELECT a.n AS an, b.n AS bn, a.f AS af, b.f AS bf FROM r a JOIN r b ON a.user_id = b.user_id AND a.k = 0 AND b.k = 1)
      SELECT CASE WHEN (bn > an OR bf < af) AND (bn < an OR bf > af) THEN 'mixed' WHEN bn > an OR bf < af THEN 'better' WHEN bn < an OR bf > af THEN 'worse' ELSE 'equal' END AS verdict, count(*) AS n FROM j GROUP BY 1""",
}
