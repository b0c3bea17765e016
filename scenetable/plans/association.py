"""Queries that match detections with objects, and votes of views with anchors."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import associate, visibility
from . import derived as D

#: Three objects side by side, from the points of the cloud.
OBJECTS = f"SELECT point_id, CASE WHEN x < -1.75e0 THEN 'left' WHEN x < 1.75e0 THEN 'middle' ELSE 'right' END AS obj, x, y, z FROM ({D.PTS}) WHERE y > -1.0e0"
#: Boxes of detections in the frames of nations; names say nothing of the objects.
DETECTIONS = """SELECT CAST(n_nationkey AS INTEGER) AS frame_id, 'd' || CAST((d + n_nationkey) % 4 AS VARCHAR) AS detection_id, CASE WHEN (n_nationkey + d) % 6 = 0 THEN 0.4e0 ELSE 0.6e0 + d * 0.1e0 END AS score,
 CAST(greatest(0, CASE d WHEN 0 THEN 0 WHEN 1 THEN 42 - (n_nationkey - 12) * 2 WHEN 2 THEN 84 - (n_nationkey - 12) * 2 ELSE 100 END) AS INTEGER) AS x0, CAST(least(127, CASE d WHEN 0 THEN 44 - (n_nationkey - 12) * 2 WHEN 1 THEN 86 - (n_nationkey - 12) * 2 ELSE 127 END) AS INTEGER) AS x1,
 CAST(30 + d AS INTEGER) AS y0, CAST(76 + n_nationkey % 3 AS INTEGER) AS y1 FROM nation, {numbers}"""


def _detections(spark, sf_dir):
    D.table(spark, sf_dir, "nation").createOrReplaceTempView("scene_nation")
    return spark.sql(DETECTIONS.format(numbers="(SELECT explode(sequence(0, 3)) AS d)").replace("FROM nation", "FROM scene_nation").replace("VARCHAR", "STRING"))


def _associated(spark, sf_dir):
    points = D._read(spark, sf_dir, OBJECTS, "lineitem")
    cams = D.cameras(spark, sf_dir).withColumn("frame_id", F.col("frame_id").cast("int"))
    seen = visibility.project_points(points.select("obj", "x", "y", "z"), cams)
    boxes = _detections(spark, sf_dir)
    masks = boxes.withColumn("y", F.explode(F.sequence("y0", "y1"))).withColumn("x", F.explode(F.when(F.col("x0") <= F.col("x1"), F.sequence("x0", "x1")))).where("(x + y) % 9 <> 0")
    peeled = spark.createDataFrame([("right",)], "obj string")
    return associate.associate(points, seen, cams, masks.select("frame_id", "detection_id", "y", "x"), boxes, peeled)


def pair_metrics(spark, sf_dir):
    """The computed metrics of each object and detection of a frame, and the matches (G1)."""
    out = _associated(spark, sf_dir)[0]
    return out.select("frame_id", "obj", "detection_id", "n_projected", "n_visible", "n_hit", "n_mask", "n_supported", *(F.round(c, 9).alias(c) for c in ("hit_ratio", "support_ratio", "iou", "quality", "depth_min", "depth_median", "depth_max")), "eligible", "matched")


def associated_objects(spark, sf_dir):
    """What the matches say of each object."""
    out = _associated(spark, sf_dir)[1]
    return out.select("obj", "n_matches", F.array_join(F.transform("evidence", lambda e: e.cast("string")), ",").alias("evidence"), "disposition")



#: Distinct places of points, and of anchors a little off them.
CELLS = "SELECT DISTINCT ((l_partkey % 101) * 37 + l_suppkey % 37) * 64 + CAST(l_quantity AS BIGINT) AS point_id, (l_partkey % 101) / 10.0e0 - 5.0e0 AS x, (l_suppkey % 37) / 10.0e0 - 1.8e0 AS y, 4.0e0 + l_quantity / 10.0e0 AS z FROM lineitem WHERE l_linenumber"


def anchored_votes(spark, sf_dir):
    """A3: points carved where they and their anchors lie in the masks of two views."""
    points, anchors = (D._read(spark, sf_dir, f"{CELLS} {w}", "lineitem") for w in ("> 2", "<= 2"))
    anchors = anchors.select(F.col("point_id").alias("anchor_id"), *((F.col(a) + 0.03).alias(a) for a in "xyz"))
    masks = D.table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 25).cast("int").alias("frame_id"), (F.col("o_custkey") % 128).cast("int").alias("px"), (F.col("o_orderkey") % 96).cast("int").alias("py"))
    out = visibility.anchored_votes(points, anchors, D.cameras(spark, sf_dir), masks)
    return out.groupBy("matched", "votes", "carved").agg(F.count("*").alias("n"), F.sum("point_id").alias("points"), F.sum("anchor_id").alias("anchors"))


QUERIES = {f.__name__: f for f in (pair_metrics, associated_objects, anchored_votes)}

_MATCH = f"""pt AS ({OBJECTS}), cm AS ({D.CAMS}), pa AS (SELECT CAST(cam AS INTEGER) AS frame_id, obj, round_even(64.0e0 * (x - cam_x) / z + 64.0e0, 0) AS px, round_even(64.0e0 * y / z + 48.0e0, 0) AS py, z FROM pt, cm), pj AS (SELECT frame_id, obj, px, py, min(z) AS d FROM pa WHERE px BETWEEN 0 AND 127 AND py BETWEEN 0 AND 95 GROUP BY 1, 2, 3, 4),
 vi AS (SELECT *, d <= min(d) OVER (PARTITION BY frame_id, px, py) + greatest(0.02e0, 0.005e0 * min(d) OVER (PARTITION BY frame_id, px, py)) AS v FROM pj), sh AS (SELECT frame_id, obj, px, py, d FROM vi WHERE v), ow AS (SELECT frame_id, obj, count(*) AS n_projected, count(*) FILTER (WHERE v) AS n_visible FROM vi GROUP BY 1, 2),
 sz AS (SELECT frame_id, obj, min(px) AS ax0, min(py) AS ay0, max(px) + 1 AS ax1, max(py) + 1 AS ay1, min(d) AS dmin, quantile_cont(d, 0.5) AS dmed, max(d) AS dmax FROM sh GROUP BY 1, 2), de AS ({DETECTIONS.format(numbers='range(4) r(d)')}),
 mk AS (SELECT frame_id, detection_id, y AS py, x AS px FROM (SELECT *, unnest(range(x0, x1 + 1)) AS x FROM (SELECT *, unnest(range(y0, y1 + 1)) AS y FROM de)) WHERE (x + y) % 9 <> 0), ar AS (SELECT frame_id, detection_id, count(*) AS n_mask, min(px) AS bx0, min(py) AS by0, max(px) + 1 AS bx1, max(py) + 1 AS by1 FROM mk GROUP BY 1, 2),
 hi AS (SELECT frame_id, obj, detection_id, count(*) AS n_hit FROM sh JOIN mk USING (frame_id, px, py) GROUP BY 1, 2, 3), wd AS (SELECT DISTINCT frame_id, obj, px + a AS px, py + b AS py FROM sh, (SELECT unnest(range(-4, 5)) AS a), (SELECT unnest(range(-4, 5)) AS b)),
 su AS (SELECT frame_id, obj, detection_id, count(*) AS n_supported FROM wd JOIN mk USING (frame_id, px, py) GROUP BY 1, 2, 3),
 me AS (SELECT su.*, coalesce(n_hit, 0) AS n_hit, n_projected, n_visible, n_mask, score, dmin, dmed, dmax, coalesce(n_hit, 0) / n_visible AS hr, n_supported / n_mask AS sr, greatest(least(ax1, bx1) - greatest(ax0, bx0), 0) * greatest(least(ay1, by1) - greatest(ay0, by0), 0) * 1.0e0 AS ia, (ax1 - ax0) * (ay1 - ay0) + (bx1 - bx0) * (by1 - by0) AS ib
   FROM su LEFT JOIN hi USING (frame_id, obj, detection_id) JOIN ow USING (frame_id, obj) JOIN sz USING (frame_id, obj) JOIN ar USING (frame_id, detection_id) JOIN de USING (frame_id, detection_id)),
 qu AS (SELECT *, ia / (ib - ia) AS iou, 0.45e0 * hr + 0.30e0 * sr + 0.20e0 * (ia / (ib - ia)) + 0.05e0 * score AS q, n_visible >= 25 AND hr >= 0.55e0 AND sr >= 0.20e0 AND ia / (ib - ia) >= 0.30e0 AND score >= 0.50e0 AS ok FROM me),
 op AS (SELECT frame_id, obj, detection_id, q FROM qu WHERE ok UNION ALL SELECT f.frame_id, o.obj, NULL, 0 FROM (SELECT DISTINCT frame_id FROM de) f, (SELECT DISTINCT obj FROM pt) o),
 al AS (SELECT a.frame_id, a.detection_id AS d1, b.detection_id AS d2, c.detection_id AS d3, a.q + b.q + c.q AS t FROM op a JOIN op b ON b.frame_id = a.frame_id AND b.obj = 'middle' JOIN op c ON c.frame_id = a.frame_id AND c.obj = 'right' WHERE a.obj = 'left' AND coalesce(a.detection_id <> b.detection_id, true) AND coalesce(a.detection_id <> c.detection_id, true) AND coalesce(b.detection_id <> c.detection_id, true)
   QUALIFY row_number() OVER (PARTITION BY a.frame_id ORDER BY a.q + b.q + c.q DESC) = 1), ma AS (SELECT frame_id, unnest(['left', 'middle', 'right']) AS obj, unnest([d1, d2, d3]) AS detection_id FROM al)"""

ORACLE = {
    "pair_metrics": f"""WITH {_MATCH} SELECT frame_id, obj, detection_id, n_projected, n_visible, n_hit, n_mask, n_supported, round(hr, 9) AS hit_ratio, round(sr, 9) AS support_ratio, round(iou, 9) AS iou, round(q, 9) AS quality, round(dmin, 9) AS depth_min, round(dmed, 9) AS depth_median, round(dmax, 9) AS depth_max, ok AS eligible, ma.obj IS NOT NULL AS matched
      FROM qu LEFT JOIN ma USING (frame_id, obj, detection_id)""",
    "associated_objects": f"""WITH {_MATCH}, mt AS (SELECT frame_id, obj, q, cam_x FROM ma JOIN qu USING (frame_id, obj, detection_id) JOIN cm ON cam = frame_id), ce AS (SELECT obj, avg(x) AS mx, avg(y) AS my, avg(z) AS mz FROM pt GROUP BY 1),
      vw AS (SELECT mt.*, mx - cam_x AS dx, my AS dy, mz AS dz FROM mt JOIN ce USING (obj)), pr AS (SELECT a.obj, a.frame_id AS f, b.frame_id AS g, a.q + b.q AS s, degrees(acos(least(1, greatest(-1, (a.dx * b.dx + a.dy * b.dy + a.dz * b.dz) / (sqrt(a.dx * a.dx + a.dy * a.dy + a.dz * a.dz) * sqrt(b.dx * b.dx + b.dy * b.dy + b.dz * b.dz)))))) AS ang, abs(a.cam_x - b.cam_x) AS base
        FROM vw a JOIN vw b ON a.obj = b.obj AND (a.q > b.q OR (a.q = b.q AND a.frame_id < b.frame_id))), be AS (SELECT obj, f, g FROM pr WHERE base >= 0.1e0 AND ang >= 5 QUALIFY row_number() OVER (PARTITION BY obj ORDER BY s DESC, f DESC, g DESC) = 1)
      SELECT obj, coalesce(n, 0) AS n_matches, CASE WHEN f IS NOT NULL THEN CAST(least(f, g) AS VARCHAR) || ',' || CAST(greatest(f, g) AS VARCHAR) END AS evidence,
        CASE WHEN obj = 'right' AND n > 0 THEN 'peeled_residual_warning' WHEN obj = 'right' THEN 'peeled_absent_as_expected' WHEN f IS NOT NULL THEN 'accepted_next_layer_target' ELSE 'failed_insufficient_separated_evidence' END AS disposition
      FROM ce LEFT JOIN (SELECT obj, count(*) AS n FROM mt GROUP BY 1) USING (obj) LEFT JOIN be USING (obj)""",
    "anchored_votes": f"""WITH pt AS ({CELLS} > 2), cm AS ({D.CAMS}), nr AS (SELECT pt.*, a.point_id AS anchor_id FROM pt JOIN ({CELLS} <= 2) a USING (point_id)),
      mk AS (SELECT DISTINCT o_orderkey % 25 AS cam, o_custkey % 128 AS px, o_orderkey % 96 AS py FROM orders),
      pj AS (SELECT point_id, anchor_id, cam, round_even(64.0e0 * (x - cam_x) / z + 64.0e0, 0) AS px, round_even(64.0e0 * y / z + 48.0e0, 0) AS py, round_even(64.0e0 * (x + 0.03e0 - cam_x) / (z + 0.03e0) + 64.0e0, 0) AS qx, round_even(64.0e0 * (y + 0.03e0) / (z + 0.03e0) + 48.0e0, 0) AS qy FROM nr, cm),
      ok AS (SELECT pj.* FROM pj JOIN mk a ON a.cam = pj.cam AND a.px = pj.px AND a.py = pj.py JOIN mk b ON b.cam = pj.cam AND b.px = pj.qx AND b.py = pj.qy WHERE greatest(abs(pj.px - qx), abs(pj.py - qy)) <= 3),
      vt AS (SELECT nr.point_id, nr.anchor_id, count(ok.cam) AS k FROM nr LEFT JOIN ok USING (point_id) GROUP BY 1, 2)
      SELECT k AS matched, k AS votes, k >= 2 AS carved, count(*) AS n, CAST(sum(point_id) AS BIGINT) AS points, CAST(sum(anchor_id) AS BIGINT) AS anchors FROM vt GROUP BY 1, 2, 3""",
}
