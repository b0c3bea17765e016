"""Queries over faces, planes and rays."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import planes
from . import derived as D
from .filling import RGBD, _cameras, _rgbd

#: Bounded planes of a scene, one for every supplier: walls before the cameras, a floor, a side wall.
PLANES = """SELECT s_suppkey AS plane_id, s_suppkey {div} 8 AS scene, s_suppkey % 3 AS k, CASE s_suppkey % 3 WHEN 0 THEN 3.8e0 + (s_nationkey % 5) * 0.1e0 WHEN 1 THEN 1.25e0 ELSE 2.0e0 END AS off,
 CASE s_suppkey % 3 WHEN 0 THEN s_suppkey % 4 - 2.0e0 WHEN 1 THEN -3.0e0 ELSE -2.0e0 END AS u0, CASE s_suppkey % 3 WHEN 0 THEN s_suppkey % 4 * 1.0e0 WHEN 1 THEN 3.0e0 ELSE 1.0e0 END AS u1,
 CASE s_suppkey % 3 WHEN 0 THEN (s_nationkey % 4) * 0.5e0 - 1.5e0 ELSE 3.0e0 END AS v0, CASE s_suppkey % 3 WHEN 0 THEN (s_nationkey % 4) * 0.5e0 WHEN 1 THEN 9.0e0 ELSE 8.0e0 END AS v1 FROM supplier"""
_C, _S = math.cos(math.radians(27)), math.sin(math.radians(27))
#: A frame turned by 27 degrees about y; faces along it, at three places of each axis, and some that fit no axis.
FRAME = ((_C, 0.0, _S), (0.0, 1.0, 0.0), (-_S, 0.0, _C))
FACES = """SELECT l_orderkey * 8 + l_linenumber AS fid, CASE WHEN l_linenumber <= 3 THEN 0 WHEN l_linenumber <= 5 THEN 1 WHEN l_linenumber = 6 THEN 2 ELSE 3 END AS k, CASE l_suppkey % 2 WHEN 0 THEN 1.0e0 ELSE -1.0e0 END AS sign,
 l_suppkey % 3 AS place, CASE l_suppkey % 3 WHEN 0 THEN -3.003e0 WHEN 1 THEN 1.003e0 ELSE 4.003e0 END + (l_discount - 0.05e0) AS off, (l_partkey % 101) / 10.0e0 - 5.0e0 AS u, (l_orderkey % 37) / 10.0e0 - 1.8e0 AS v,
 l_quantity * CASE l_suppkey % 3 WHEN 1 THEN 3.0e0 ELSE 1.0e0 END AS area FROM lineitem"""
#: Points of a floor and a ceiling on the second axis, and of clutter.
ANCHORS = """SELECT CASE c_nationkey % 3 WHEN 0 THEN 'floor' WHEN 1 THEN 'ceiling' ELSE 'clutter' END AS role, (c_custkey % 61) / 10.0e0 - 3.0e0 AS a,
 CASE c_nationkey % 3 WHEN 0 THEN 4.02e0 + (c_custkey % 5) * 0.01e0 WHEN 1 THEN -3.05e0 ELSE (c_custkey % 29) / 10.0e0 - 1.4e0 END AS b, (c_custkey % 71) / 10.0e0 - 3.5e0 AS c FROM customer"""


def _planes(spark, sf_dir):
    rows = D._read(spark, sf_dir, PLANES.format(div="div"), "supplier")
    unit = lambda i: F.array(*(F.lit(float(i == j)) for j in range(3)))
    pick = lambda a, b, c: F.when(F.col("k") == 0, unit(a)).when(F.col("k") == 1, unit(b)).otherwise(unit(c))
    return rows.select("scene", "plane_id", pick(2, 1, 0).alias("n"), F.col("off").alias("offset"), pick(0, 0, 1).alias("u"), pick(1, 2, 2).alias("v"), "u0", "u1", "v0", "v1")


def _scene_cameras(spark, sf_dir):
    return _cameras(spark, sf_dir).withColumn("scene", F.expr("frame_id div 8"))


def ray_plane_hits(spark, sf_dir):
    """The nearest bounded plane of every pixel of every frame."""
    out = planes.ray_plane_hits(_rgbd(spark, sf_dir), _scene_cameras(spark, sf_dir), _planes(spark, sf_dir), ["scene"])
    return out.select("frame_id", "y", "x", "plane_id", *(F.round(c, 9).alias(c) for c in ("depth", "wx", "wy", "wz")))


def plane_support(spark, sf_dir):
    """How many pixels of each frame lie on each plane."""
    out = planes.plane_support(_rgbd(spark, sf_dir), _scene_cameras(spark, sf_dir), _planes(spark, sf_dir), ["scene"])
    return out.groupBy("frame_id", "plane_id").agg(F.count("*").alias("n"))


def _faces(spark, sf_dir):
    rows = D._read(spark, sf_dir, FACES, "lineitem")
    at = []
    for j in range(3):
        per = [F.col("off") * FRAME[k][j] + F.col("u") * FRAME[[1, 0, 0][k]][j] + F.col("v") * FRAME[[2, 2, 1][k]][j] for k in range(3)]
        at.append(F.when(F.col("k") == 0, per[0]).when(F.col("k") == 1, per[1]).otherwise(per[2]).alias(f"c{'xyz'[j]}"))
    normal = [F.col("sign") * F.when(F.col("k") == 0, FRAME[0][j]).when(F.col("k") == 1, FRAME[1][j]).when(F.col("k") == 2, FRAME[2][j]).otherwise(3**-0.5) for j in range(3)]
    return rows.select("fid", *at, *(c.alias(f"n{a}") for c, a in zip(normal, "xyz", strict=True)), "area")


def _anchors(spark, sf_dir):
    rows = D._read(spark, sf_dir, ANCHORS, "customer")
    return rows.select("role", *((F.col("a") * FRAME[0][j] + F.col("b") * FRAME[1][j] + F.col("c") * FRAME[2][j]).alias("xyz"[j]) for j in range(3)))


def dominant_axes(spark, sf_dir):
    """The planted frame, found from the faces, and the area of each axis."""
    axes, areas = planes.dominant_axes(_faces(spark, sf_dir))
    rows = [(k, *map(float, axis), float(area)) for k, (axis, area) in enumerate(zip(axes, areas, strict=True))]
    return spark.createDataFrame(rows, "axis int, ax double, ay double, az double, area double").select("axis", *(F.round(c, 6).alias(c) for c in ("ax", "ay", "az")), F.round("area", 3).alias("area"))


def axis_plane_candidates(spark, sf_dir):
    """The planes along each found axis."""
    faces = _faces(spark, sf_dir)
    out = planes.axis_planes(faces, planes.dominant_axes(faces)[0])
    return out.select("axis", *(F.round(c, 6).alias(c) for c in ("offset", "support_area", "rms", "u0", "u1", "v0", "v1")), "inlier_faces")


def envelope_planes(spark, sf_dir):
    """The planes that bound the cameras, moved to their anchors."""
    faces, anchors = _faces(spark, sf_dir), _anchors(spark, sf_dir)
    axes = planes.dominant_axes(faces)[0]
    found = planes.anchored(planes.axis_planes(faces, axes), axes, anchors)
    centres = D.table(spark, sf_dir, "nation").select(((F.col("n_nationkey") - 12) * 0.02).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("z"))
    out = planes.envelope_planes(found, axes, centres, anchors)
    return out.select("plane_id", "axis", "side", "role", *(F.round(c, 6).alias(c) for c in ("offset", "u0", "u1", "v0", "v1", "support_area")))


QUERIES = {f.__name__: f for f in (ray_plane_hits, plane_support, dominant_axes, axis_plane_candidates, envelope_planes)}

_RAYS = f"""px AS ({RGBD.format(div='//')}), pl AS ({PLANES.format(div='//')}), ray AS (SELECT px.frame_id, px.y, px.x, px.depth AS seen, pl.*, (px.frame_id % 8) * 0.125e0 AS ox, (px.x - 32.0e0) / 64.0e0 AS dx, (px.y - 32.0e0) / 64.0e0 AS dy
  FROM px JOIN pl ON px.frame_id // 8 = pl.scene)"""
#: Candidates by what was planted: the faces of one axis and place are one plane.
_CAND = f"""f AS (SELECT * FROM ({FACES}) WHERE k < 3), w AS (SELECT k, place, off, sum(area) AS a FROM f GROUP BY 1, 2, 3),
 r AS (SELECT *, sum(a) OVER (PARTITION BY k, place ORDER BY off ROWS UNBOUNDED PRECEDING) AS run, sum(a) OVER (PARTITION BY k, place) / 2 AS half FROM w), m AS (SELECT k, place, min(off) AS offs FROM r WHERE run >= half GROUP BY 1, 2),
 cand AS (SELECT f.k AS axis, m.offs, sum(area) AS support_area, count(*) AS inlier_faces, sqrt(sum(area * (off - offs) * (off - offs)) / sum(area)) AS rms, quantile_cont(u, 0.002) AS u0, quantile_cont(u, 0.998) AS u1, quantile_cont(v, 0.002) AS v0, quantile_cont(v, 0.998) AS v1
  FROM f JOIN m USING (k, place) WHERE abs(off - offs) <= 0.15e0 GROUP BY 1, 2)"""

ORACLE = {
    "ray_plane_hits": f"""WITH {_RAYS}, hit AS (SELECT *, CASE k WHEN 0 THEN off WHEN 1 THEN CASE WHEN abs(dy) > 1e-9 THEN off / dy END ELSE CASE WHEN abs(dx) > 1e-9 THEN (off - ox) / dx END END AS t FROM ray),
      pt AS (SELECT *, ox + dx * t AS wx, dy * t AS wy, t AS wz FROM hit WHERE t > 1e-5),
      ok AS (SELECT * FROM pt WHERE CASE k WHEN 2 THEN wy ELSE wx END BETWEEN u0 AND u1 AND CASE k WHEN 0 THEN wy ELSE wz END BETWEEN v0 AND v1 QUALIFY row_number() OVER (PARTITION BY frame_id, y, x ORDER BY t, plane_id) = 1)
      SELECT frame_id, y, x, plane_id, round(t, 9) AS depth, round(wx, 9) AS wx, round(wy, 9) AS wy, round(wz, 9) AS wz FROM ok""",
    "plane_support": f"""WITH {_RAYS}, pt AS (SELECT *, ox + dx * seen AS wx, dy * seen AS wy, seen AS wz FROM ray)
      SELECT frame_id, plane_id, count(*) AS n FROM pt WHERE abs(CASE k WHEN 0 THEN wz WHEN 1 THEN wy ELSE wx END - off) <= 0.15e0 AND CASE k WHEN 2 THEN wy ELSE wx END BETWEEN u0 AND u1 AND CASE k WHEN 0 THEN wy ELSE wz END BETWEEN v0 AND v1 GROUP BY 1, 2""",
    "dominant_axes": f"""SELECT k AS axis, round(CASE k WHEN 0 THEN cos(radians(27)) WHEN 1 THEN 0 ELSE -sin(radians(27)) END, 6) AS ax, CASE k WHEN 1 THEN 1.0e0 ELSE 0.0e0 END AS ay, round(CASE k WHEN 0 THEN sin(radians(27)) WHEN 1 THEN 0 ELSE cos(radians(27)) END, 6) AS az,
      round(sum(area), 3) AS area FROM ({FACES}) WHERE k < 3 GROUP BY k""",
    "axis_plane_candidates": f"WITH {_CAND} SELECT axis, round(offs, 6) AS \"offset\", round(support_area, 6) AS support_area, round(rms, 6) AS rms, round(u0, 6) AS u0, round(u1, 6) AS u1, round(v0, 6) AS v0, round(v1, 6) AS v1, inlier_faces FROM cand",
    "envelope_planes": f"""WITH {_CAND}, an AS ({ANCHORS}), t AS (SELECT role, unnest([0, 1, 2]) AS axis, unnest([a, b, c]) AS pos, unnest([b, a, a]) AS u, unnest([c, c, b]) AS v FROM an),
      sp AS (SELECT role, axis, quantile_cont(pos, 0.998) - quantile_cont(pos, 0.002) AS s, count(*) AS n FROM t GROUP BY 1, 2), so AS (SELECT *, row_number() OVER (PARTITION BY role ORDER BY s, axis) AS k, lead(s) OVER (PARTITION BY role ORDER BY s, axis) AS nxt FROM sp),
      only_ AS (SELECT role, n, CASE WHEN s <= greatest(nxt * 0.25e0, 1e-6) THEN axis END AS one FROM so WHERE k = 1),
      fr AS (SELECT c.axis, c.offs, t.role, count(*) / any_value(o.n) AS fraction FROM t JOIN only_ o USING (role) JOIN cand c ON c.axis = t.axis AND abs(t.pos - c.offs) <= 0.35e0 WHERE one IS NULL OR one = t.axis GROUP BY 1, 2, 3),
      sc AS (SELECT c.*, coalesce((SELECT sum(fraction) FROM fr WHERE fr.axis = c.axis AND fr.offs = c.offs), 0) AS score, (SELECT arg_max(role, fraction) FROM fr WHERE fr.axis = c.axis AND fr.offs = c.offs AND fraction >= 0.01e0) AS role FROM cand c),
      sd AS (SELECT *, CASE WHEN offs < (CASE axis WHEN 0 THEN -0.24e0 * cos(radians(27)) WHEN 1 THEN 0 ELSE -0.24e0 * sin(radians(27)) END) - 0.5e0 THEN 'negative' WHEN offs > (CASE axis WHEN 0 THEN 0.24e0 * cos(radians(27)) WHEN 1 THEN 0 ELSE 0.24e0 * sin(radians(27)) END) + 0.5e0 THEN 'positive' END AS side,
        max(support_area) OVER (PARTITION BY axis) AS top FROM sc),
      be AS (SELECT * FROM sd WHERE side IS NOT NULL AND support_area >= 0.05e0 * top QUALIFY row_number() OVER (PARTITION BY axis, side ORDER BY score >= 0.01e0 DESC, score DESC, support_area DESC, offs) = 1),
      mv AS (SELECT be.axis, be.side, quantile_cont(t.pos, 0.5) AS new, quantile_cont(t.u, 0.002) AS au0, quantile_cont(t.u, 0.998) AS au1, quantile_cont(t.v, 0.002) AS av0, quantile_cont(t.v, 0.998) AS av1 FROM be JOIN t ON t.role = be.role AND t.axis = be.axis AND abs(t.pos - be.offs) <= 0.35e0 GROUP BY 1, 2)
      SELECT CAST(row_number() OVER (ORDER BY axis, side) AS INTEGER) AS plane_id, axis, side, coalesce(role, 'structural_boundary') AS role, round(coalesce(new, offs), 6) AS "offset", round(least(u0, coalesce(au0, u0)) - 0.6e0, 6) AS u0, round(greatest(u1, coalesce(au1, u1)) + 0.6e0, 6) AS u1,
        round(least(v0, coalesce(av0, v0)) - 0.6e0, 6) AS v0, round(greatest(v1, coalesce(av1, v1)) + 0.6e0, 6) AS v1, round(support_area, 6) AS support_area FROM be LEFT JOIN mv USING (axis, side)""",
}
