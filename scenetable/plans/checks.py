"""Queries of scene checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks, visibility
from ..operators.common import checkpointed
from . import derived as D
from .filling import OBJECT, REMOVED, RGBD, _rgbd

#: The cloud's three objects, the last one farther off.
CLOUD = f"SELECT obj, x, y, z + CASE obj WHEN 'R' THEN 6.0e0 ELSE 0.0e0 END AS z FROM ({D.PTS})"
MATRIX = """SELECT s_suppkey AS id, s_suppkey % 4 AS k, 0.5e0 + s_nationkey / 10.0e0 AS s, cos(s_suppkey / 7.0e0) AS c, sin(s_suppkey / 7.0e0) AS n FROM supplier"""
CAMERAS = """SELECT p_partkey % 97 AS scene, 500.0e0 + p_size / 10.0e0 + CASE WHEN p_partkey % 97 < 20 AND p_size > 45 THEN 60.0e0 ELSE 0.0e0 END AS fx, 490.0e0 + p_size / 5.0e0 AS fy, 320.0e0 + p_size % 3 AS cx, 240.0e0 - p_size % 5 AS cy, 640 AS w, 480 AS h FROM part"""
CROPS = """SELECT user_id AS object_id, event_id AS frame_id, (event_id % 101) / 100.0e0 AS support_ratio, (event_id % 37) / 30.0e0 - 0.1e0 AS coverage, (event_id % 23) / 22.0e0 AS fill, (event_id % 13) / 10.0e0 AS sharpness, event_id % 977 AS support_points,
 CAST(event_id % 30 AS INTEGER) AS x0, CAST(event_id % 17 AS INTEGER) AS y0, CAST(event_id % 30 + 5 + event_id % 71 AS INTEGER) AS x1, CAST(event_id % 17 + 4 + event_id % 53 AS INTEGER) AS y1, 96 AS w, 72 AS h, event_id % 501 AS area FROM events"""


def depth_order(spark, sf_dir):
    """Which object of the cloud stands before which, in every frame."""
    cloud = D._read(spark, sf_dir, CLOUD, "lineitem").distinct()  # points of one place are seen alike; dealt anew, as each becomes a row a camera
    keys = ["frame_id", "obj", "px", "py"]
    seen = checkpointed(visibility.zbuffer(visibility.project_points(cloud, D.cameras(spark, sf_dir)), keys))
    masks = seen.where("(px + py) % 3 <> 0").select("frame_id", "obj", "px", "py")
    frames = D.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("frame_id"))
    pairs = frames.select("frame_id", F.explode(F.array(*(F.struct(F.lit(a).alias("front"), F.lit(b).alias("rear")) for a, b in (("A", "R"), ("A", "N"), ("N", "Q"))))).alias("p")).select("frame_id", "p.*")
    out = checks.depth_order(pairs, seen, masks)
    return out.select("frame_id", "front", "rear", "shared", *(F.round(c, 9).alias(c) for c in ("least", "median", "largest", "wrong")), "overlap", "disjoint", "passed")


def support_contact(spark, sf_dir):
    """How each supplier's upper cloud stands on its lower one."""
    pts = D.points(spark, sf_dir)
    of = lambda flag, c: F.when(F.col("obj") == flag, c)
    rows = pts.groupBy("supp").agg(F.percentile(of("A", F.col("z")), 0.98).alias("bottom"), (F.percentile(of("A", F.col("z")), 0.98) - F.percentile(of("A", F.col("z")), 0.02)).alias("thickness"), (F.percentile(of("N", F.col("z")), 0.02) + 4.77).alias("top")).where("bottom IS NOT NULL AND top IS NOT NULL")
    out = checks.contact(rows)
    return out.select("supp", *(F.round(c, 9).alias(c) for c in ("bottom", "thickness", "top", "penetration", "gap", "limit", "excess")), "passed")


def affine_audit(spark, sf_dir):
    """P5: turned, scaled, sheared and mirrored matrices."""
    m = D._read(spark, sf_dir, MATRIX, "supplier")
    s, c, n, k = F.col("s"), F.col("c"), F.col("n"), F.col("k")
    z = F.lit(0.0)
    rows = m.withColumn("matrix", F.array(s * c, z, s * n, F.lit(1.0), F.when(k == 1, 0.2).otherwise(0.0), F.when(k == 2, -s).when(k == 3, s * 2).otherwise(s), z, F.lit(2.0), -s * n, z, s * c, F.lit(3.0), z, z, z, F.lit(1.0)))
    return checks.affine_audit(rows).select("id", "issue", *(F.round(x, 9).alias(x) for x in ("determinant", "scale_x", "scale_y", "scale_z", "scale", "anisotropy")), "orthonormal", "uniform", "right_handed")


def common_intrinsics(spark, sf_dir):
    """Cameras at half size, and one for each scene."""
    cams = checks.resize_intrinsics(D._read(spark, sf_dir, CAMERAS, "part"), F.lit(320), F.lit(240))
    return checks.common_intrinsics(cams, ["scene"]).select("scene", *(F.round(c, 9).alias(c) for c in ("fx", "fy", "cx", "cy", "spread")), "common")


def selection_quality(spark, sf_dir):
    """The quality and rank of every crop."""
    out = checks.selection_quality(D._read(spark, sf_dir, CROPS, "events"))
    return out.groupBy("object_id", "sides").agg(F.count("*").alias("n"), F.round(F.avg("quality"), 9).alias("quality"), F.round(F.max("rank_score"), 9).alias("rank_score"))


def largest_eligible_view(spark, sf_dir):
    """The largest view of each object off the border."""
    return checks.largest_eligible_view(D._read(spark, sf_dir, CROPS, "events"), 5)


def robust_trim(spark, sf_dir):
    """each label's points near its median point."""
    out = checks.robust_trim(D.vectors(spark, sf_dir), ["label"], 0.9)
    return out.groupBy("label").agg(F.count("*").alias("n"), F.sum("point_id").alias("points"), F.round(F.max("distance"), 9).alias("distance"))


def colour_stats(spark, sf_dir):
    """Colours of each frame's removed region and the rest."""
    out = checks.colour_stats(_rgbd(spark, sf_dir).withColumn("inside", F.expr(REMOVED)), ["frame_id", "inside"])
    return out.select("frame_id", "inside", "n", *(F.round(f"{m}_{c}", 6).alias(f"{m}_{c}") for c in "rgb" for m in ("mean", "median", "std", "p10", "p90")))


def outside_unchanged(spark, sf_dir):
    """An output that changes the object's pixels, and a few others in some frames."""
    px = _rgbd(spark, sf_dir).select("frame_id", "y", "x", "r", "g", "b")
    changed = px.withColumns({"r": F.when(F.expr(OBJECT), F.col("r") + 30).when(F.expr("frame_id % 4 = 0 AND x < 9"), F.col("r") + 24).otherwise(F.col("r"))})
    out = checks.outside_unchanged(px, changed, px.where(OBJECT))
    return out.select("frame_id", "n_inside", "n_outside", *(F.round(c, 9).alias(c) for c in ("inside", "outside", "outside_max")), "passed")


QUERIES = {f.__name__: f for f in (depth_order, support_contact, affine_audit, common_intrinsics, selection_quality, largest_eligible_view, robust_trim, colour_stats, outside_unchanged)}

_PX = f"px AS ({RGBD.format(div='//')})"

ORACLE = {
    "depth_order": f"""WITH pt AS ({CLOUD}), cm AS ({D.CAMS}), pj AS (SELECT cam AS frame_id, obj, round_even(64.0e0 * (x - cam_x) / z + 64.0e0, 0) AS px, round_even(64.0e0 * y / z + 48.0e0, 0) AS py, z FROM pt, cm), se AS (SELECT * FROM pj WHERE px BETWEEN 0 AND 127 AND py BETWEEN 0 AND 95), mk AS (SELECT DISTINCT frame_id, obj, px, py FROM se WHERE CAST(px + py AS INTEGER) % 3 <> 0),
      bn AS (SELECT frame_id, obj, floor(py / 8) AS j, floor(px / 8) AS i, min(z) AS d FROM se GROUP BY 1, 2, 3, 4), ok AS (SELECT bn.* FROM bn SEMI JOIN (SELECT DISTINCT frame_id, obj, floor(py / 8) AS j, floor(px / 8) AS i FROM mk) USING (frame_id, obj, j, i)),
      pr AS (SELECT n_nationkey AS frame_id, unnest(['A', 'A', 'N']) AS front, unnest(['R', 'N', 'Q']) AS rear FROM nation), df AS (SELECT pr.*, b.d - a.d AS d FROM pr JOIN ok a ON a.frame_id = pr.frame_id AND a.obj = front JOIN ok b ON b.frame_id = pr.frame_id AND b.obj = rear AND b.i = a.i AND b.j = a.j),
      st AS (SELECT frame_id, front, rear, count(*) AS shared, min(d) AS lo, quantile_cont(d, 0.5) AS mi, max(d) AS hi, avg(CASE WHEN d <= 0 THEN 1.0e0 ELSE 0.0e0 END) AS wr FROM df GROUP BY 1, 2, 3), ov AS (SELECT pr.frame_id, front, rear, count(*) AS n FROM pr JOIN mk a ON a.frame_id = pr.frame_id AND a.obj = front JOIN mk b ON b.frame_id = pr.frame_id AND b.obj = rear AND b.px = a.px AND b.py = a.py GROUP BY 1, 2, 3)
      SELECT frame_id, front, rear, coalesce(shared, 0) AS shared, round(lo, 9) AS least, round(mi, 9) AS median, round(hi, 9) AS largest, round(coalesce(wr, 1), 9) AS wrong, coalesce(n, 0) AS overlap, n IS NULL AS disjoint, coalesce(shared >= 3 AND lo >= 0.1e0 AND wr = 0, false) AS passed FROM pr LEFT JOIN st USING (frame_id, front, rear) LEFT JOIN ov USING (frame_id, front, rear)""",
    "support_contact": f"""WITH p AS ({D.PTS}), q AS (SELECT supp, quantile_cont(z, 0.98) FILTER (WHERE obj = 'A') AS bottom, quantile_cont(z, 0.98) FILTER (WHERE obj = 'A') - quantile_cont(z, 0.02) FILTER (WHERE obj = 'A') AS thickness, quantile_cont(z, 0.02) FILTER (WHERE obj = 'N') + 4.77e0 AS top FROM p GROUP BY 1),
      c AS (SELECT *, greatest(0, bottom - top) AS pen, greatest(0, top - bottom) AS gap, least(0.05e0, 0.25e0 * thickness) AS lim FROM q WHERE bottom IS NOT NULL AND top IS NOT NULL)
      SELECT supp, round(bottom, 9) AS bottom, round(thickness, 9) AS thickness, round(top, 9) AS top, round(pen, 9) AS penetration, round(gap, 9) AS gap, round(lim, 9) AS "limit", round(greatest(0, pen - lim), 9) AS excess, pen <= lim + 1e-12 AND gap <= 0.02e0 + 1e-12 AS passed FROM c""",
    "affine_audit": f"""WITH m AS (SELECT *, CASE k WHEN 1 THEN 0.2e0 ELSE 0.0e0 END AS sh, CASE k WHEN 2 THEN -s WHEN 3 THEN s * 2 ELSE s END AS my FROM ({MATRIX})), d AS (SELECT *, s * s * my AS det, sqrt(s * s + sh * sh) AS sx, abs(my) AS sy, s AS sz FROM m), g AS (SELECT *, (sx + sy + sz) / 3 AS me FROM d)
      SELECT id, CASE WHEN det <= 0 THEN 'turns orientation' END AS issue, CASE WHEN det > 0 THEN round(det, 9) END AS determinant, CASE WHEN det > 0 THEN round(sx, 9) END AS scale_x, CASE WHEN det > 0 THEN round(sy, 9) END AS scale_y, CASE WHEN det > 0 THEN round(sz, 9) END AS scale_z, CASE WHEN det > 0 THEN round(me, 9) END AS scale,
        CASE WHEN det > 0 THEN round(greatest(sx, sy, sz) / least(sx, sy, sz), 9) END AS anisotropy, CASE WHEN det > 0 THEN k <> 1 END AS orthonormal, CASE WHEN det > 0 THEN k = 0 END AS uniform, CASE WHEN det > 0 THEN abs(det / (sx * sy * sz) - 1) <= 2e-5 END AS right_handed FROM g""",
    "common_intrinsics": f"""WITH c AS (SELECT scene, fx * 0.5e0 AS fx, fy * 0.5e0 AS fy, cx * 0.5e0 AS cx, cy * 0.5e0 AS cy FROM ({CAMERAS})), m AS (SELECT scene, quantile_cont(fx, 0.5) AS mx, quantile_cont(fy, 0.5) AS my, quantile_cont(cx, 0.5) AS nx, quantile_cont(cy, 0.5) AS ny FROM c GROUP BY 1)
      SELECT scene, round(mx, 9) AS fx, round(my, 9) AS fy, round(nx, 9) AS cx, round(ny, 9) AS cy, round(max(greatest(abs(fx - mx) / mx, abs(fy - my) / my)), 9) AS spread, max(greatest(abs(fx - mx) / mx, abs(fy - my) / my)) <= 0.05e0 AS common FROM c JOIN m USING (scene) GROUP BY scene, mx, my, nx, ny""",
    "selection_quality": f"""WITH c AS (SELECT *, CAST(x0 <= 2 AS INTEGER) + CAST(y0 <= 2 AS INTEGER) + CAST(x1 >= w - 2 AS INTEGER) + CAST(y1 >= h - 2 AS INTEGER) AS sides, x1 - x0 AS bw, y1 - y0 AS bh FROM ({CROPS})),
      q AS (SELECT *, (0.42e0 * least(1, support_ratio) + 0.32e0 * least(1, sqrt(greatest(0, coverage))) + 0.16e0 * least(1, sharpness) + 0.1e0 * greatest(0, 1 - abs(fill - 0.62e0) / 0.62e0)) * (1 - least(0.72e0, 0.18e0 * sides)) AS quality, greatest(bw / bh, bh / bw) AS aspect FROM c)
      SELECT object_id, sides, count(*) AS n, round(avg(quality), 9) AS quality, round(max(quality * sqrt(greatest(1, least(bw, bh))) * greatest(0.45e0, 1 - least(greatest(aspect - 2.2e0, 0) / 4, 0.55e0)) * greatest(0.35e0, 1 - 0.22e0 * sides) * (1 + least(ln(1 + support_points) / 18, 0.35e0))), 9) AS rank_score FROM q GROUP BY 1, 2""",
    "largest_eligible_view": f"""WITH c AS (SELECT *, x0 >= 5 AND y0 >= 5 AND x1 <= w - 5 AND y1 <= h - 5 AS ok FROM ({CROPS})), b AS (SELECT object_id, frame_id, area FROM c WHERE ok QUALIFY row_number() OVER (PARTITION BY object_id ORDER BY area DESC, frame_id) = 1)
      SELECT object_id, n_views, n_eligible, frame_id, area, frame_id IS NULL AS refused FROM (SELECT object_id, count(*) AS n_views, count(*) FILTER (WHERE ok) AS n_eligible FROM c GROUP BY 1) LEFT JOIN b USING (object_id)""",
    "robust_trim": f"""WITH v AS ({D.VECS_DUCK}), m AS (SELECT label, quantile_cont(x, 0.5) AS a, quantile_cont(y, 0.5) AS b, quantile_cont(z, 0.5) AS c FROM v GROUP BY 1), d AS (SELECT v.*, sqrt((x-a)*(x-a) + (y-b)*(y-b) + (z-c)*(z-c)) AS d FROM v JOIN m USING (label)), q AS (SELECT *, quantile_cont(d, 0.9) OVER (PARTITION BY label) AS cut FROM d)
      SELECT label, count(*) AS n, CAST(sum(point_id) AS BIGINT) AS points, round(max(d), 9) AS distance FROM q WHERE d <= cut GROUP BY 1""",
    "colour_stats": f"WITH {_PX} SELECT frame_id, {REMOVED} AS inside, count(*) AS n, {', '.join(f'round(avg({c}), 6) AS mean_{c}, round(quantile_cont({c}, 0.5), 6) AS median_{c}, round(stddev_pop({c}), 6) AS std_{c}, round(quantile_cont({c}, 0.1), 6) AS p10_{c}, round(quantile_cont({c}, 0.9), 6) AS p90_{c}' for c in 'rgb')} FROM px GROUP BY 1, 2",
    "outside_unchanged": f"""WITH {_PX}, ob AS (SELECT frame_id, y, x FROM px WHERE {OBJECT}), d AS (SELECT p.*, {OBJECT} AS ins, EXISTS (SELECT 1 FROM ob o WHERE o.frame_id = p.frame_id AND abs(o.y - p.y) <= 4 AND abs(o.x - p.x) <= 4) AS near, CASE WHEN {OBJECT} THEN 10.0e0 WHEN frame_id % 4 = 0 AND x < 9 THEN 8.0e0 ELSE 0.0e0 END AS delta FROM px p)
      SELECT frame_id, count(*) FILTER (WHERE ins) AS n_inside, count(*) FILTER (WHERE NOT near) AS n_outside, round(avg(delta) FILTER (WHERE ins), 9) AS inside, round(avg(delta) FILTER (WHERE NOT near), 9) AS outside, round(max(delta) FILTER (WHERE NOT near), 9) AS outside_max,
        coalesce(avg(delta) FILTER (WHERE NOT near) <= 0.5e0 AND avg(delta) FILTER (WHERE ins) >= 2, false) AS passed FROM d GROUP BY 1""",
}
