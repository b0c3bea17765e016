"""Queries over Gaussians, depths and atlas colours."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import carve, surface
from ..operators.common import by_sort
from . import derived as D
from .filling import RGBD, _rgbd

GAUSSIANS = """SELECT l_orderkey * 8 + l_linenumber AS point_id, (l_partkey % 101) / 10.0e0 - 5.0e0 AS x, (l_suppkey % 37) / 10.0e0 - 1.8e0 AS y, 4.0e0 + l_quantity / 10.0e0 AS z, l_returnflag AS flag,
 -3.0e0 + l_discount * 10 AS scale_0, -2.5e0 - l_tax * 10 AS scale_1, -3.0e0 + (l_linenumber % 3) * 0.4e0 AS scale_2, 1.0e0 + l_linenumber % 2 AS rot_0, (l_partkey % 7) / 7.0e0 AS rot_1, (l_suppkey % 5) / 5.0e0 AS rot_2, -0.3e0 AS rot_3 FROM lineitem"""
#: Depths of anchors in the frames of suppliers.
ANCHORS = """SELECT CAST(l_suppkey AS BIGINT) AS frame_id, CAST((l_orderkey % 4096) {div} 64 AS INTEGER) AS y, CAST(l_orderkey % 64 AS INTEGER) AS x, 4.003e0 + min(l_tax) * 1.25e0 AS depth FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1, 2, 3"""
#: Atlas colours, one plane a supplier, 12 x 10 texels: a plane of light, and a tenth of the texels far off it.
COLOURS = """SELECT CAST(l_suppkey AS BIGINT) AS plane_id, CAST(l_orderkey % 12 AS INTEGER) AS "row", CAST(l_partkey % 10 AS INTEGER) AS col, count(*) >= 4 AS observed FROM lineitem GROUP BY 1, 2, 3"""


def gaussian_extents(spark, sf_dir):
    """Drawn sizes, and which Gaussians overlap a box."""
    rows = carve.gaussian_extents(D._read(spark, sf_dir, GAUSSIANS, "lineitem")).withColumn("meets", carve.meets_box([-1.0, -1.0, 5.0], [1.5, 1.0, 7.0]))
    return rows.groupBy("flag", "meets").agg(F.count("*").alias("n"), *(F.round(F.avg(c), 9).alias(c) for c in ("sx", "sy", "sz", "footprint")))


def semantic_carve(spark, sf_dir):
    """Points near front anchors, kept where rear anchors are as near."""
    rows = D.vectors(spark, sf_dir).withColumn("footprint", (F.col("point_id") % 40) / 100.0)
    of = lambda k: rows.where(F.col("point_id") % 7 == k).select("x", "y", "z")
    out = carve.semantic_carve(rows.where("point_id % 7 > 1"), of(0), of(1))
    return out.select("point_id", *(F.round(c, 9).alias(c) for c in ("front_distance", "rear_distance")), "removed")


def depth_edges(spark, sf_dir):
    """depth edges of every frame."""
    out = carve.depth_edges(_rgbd(spark, sf_dir).select("frame_id", "y", "x", "depth"), 0.015)
    return out.groupBy("frame_id", "edge").agg(F.count("*").alias("n"), F.round(F.sum("jump"), 9).alias("jump"))


def depth_agreement(spark, sf_dir):
    """how anchors stand to the scene."""
    scene = _rgbd(spark, sf_dir).where("g < 210").select("frame_id", "y", "x", F.col("depth").alias("scene"))
    both = D._read(spark, sf_dir, ANCHORS.format(div="div"), "lineitem").join(scene, ["frame_id", "y", "x"], "left")
    return both.select("frame_id", carve.depth_agreement(F.col("depth"), F.col("scene"), 0.02, 0.004).alias("agreement")).groupBy("frame_id", "agreement").agg(F.count("*").alias("n"))


def depth_splat_close(spark, sf_dir):
    """Splatted anchors that agree with the scene, and what closing adds within their envelope."""
    scene, anchors = _rgbd(spark, sf_dir), D._read(spark, sf_dir, ANCHORS.format(div="div"), "lineitem")
    first = carve.depth_aware_splat(anchors, scene, 1, 0.02, 0.004)
    out = carve.depth_bounded_close(first, anchors, scene, 1, 2, 0.02, 0.004)
    return out.join(first.withColumn("f", F.lit(1)), ["frame_id", "y", "x"], "left").groupBy("frame_id").agg(F.count("f").alias("splatted"), F.count("*").alias("closed"), F.sum(F.col("y") * 64 + F.col("x")).alias("places"))


def _colours(spark, sf_dir):
    seen = D._read(spark, sf_dir, COLOURS.replace('"row"', "row"), "lineitem")
    grid = D.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("plane_id"), F.explode(F.sequence(F.lit(0), F.lit(11))).alias("row")).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(9))))
    rows = by_sort(grid).join(seen, ["plane_id", "row", "col"], "left").withColumn("observed", F.coalesce("observed", F.lit(False)))
    off = F.when((F.col("row") * 7 + F.col("col") * 3 + F.col("plane_id")) % 10 == 0, 60).otherwise(0)
    light = lambda base, du, dv: (F.lit(base) + du * F.col("col") + dv * F.col("row") + F.col("plane_id") % 20 + off).cast("double")
    return rows.select("plane_id", "row", "col", "observed", light(90, 2, 3).alias("r"), light(80, 3, 1).alias("g"), light(70, 1, 2).alias("b"))


def dominant_colour_support(spark, sf_dir):
    """Texels near each plane's bright colour."""
    out = surface.dominant_colour_support(_colours(spark, sf_dir), ["plane_id"], radius=30.0)
    return out.groupBy("plane_id").agg(F.count_if("support").alias("n"), F.sum(F.when(F.col("support"), F.col("row") * 10 + F.col("col"))).alias("places"), F.round(F.first("support_share"), 9).alias("share"))


def illumination_surface(spark, sf_dir):
    """The planes of light, found among outliers, fill what was not observed."""
    rows = _colours(spark, sf_dir)
    sizes = rows.select("plane_id").distinct().withColumns({"height": F.lit(12), "width": F.lit(10)})
    return surface.illumination_surface(rows.withColumn("support", F.col("observed")), ["plane_id"], sizes)[0].drop("support")


QUERIES = {f.__name__: f for f in (gaussian_extents, semantic_carve, depth_edges, depth_agreement, depth_splat_close, dominant_colour_support, illumination_surface)}

_PX = f"px AS ({RGBD.format(div='//')})"
_AN = f"an AS ({ANCHORS.format(div='//')})"
_CO = f"""t AS ({COLOURS}), co AS (SELECT plane_id, "row", col, observed, off, {', '.join(f'{b}.0e0 + {u} * col + {v} * "row" + plane_id % 20 AS {c}' for c, b, u, v in (('r', 90, 2, 3), ('g', 80, 3, 1), ('b', 70, 1, 2)))} FROM (
  SELECT s_suppkey AS plane_id, CAST(i AS INTEGER) AS "row", CAST(j AS INTEGER) AS col, coalesce(observed, false) AS observed, CASE WHEN (i * 7 + j * 3 + s_suppkey) % 10 = 0 THEN 60.0e0 ELSE 0.0e0 END AS off FROM supplier CROSS JOIN range(12) a(i) CROSS JOIN range(10) b(j) LEFT JOIN t ON t.plane_id = s_suppkey AND t."row" = i AND t.col = j))"""
_NEAR = """sqrt(min((p.x-a.x)*(p.x-a.x) + (p.y-a.y)*(p.y-a.y) + (p.z-a.z)*(p.z-a.z)))"""

ORACLE = {
    "gaussian_extents": f"""WITH g AS (SELECT *, sqrt(rot_0*rot_0 + rot_1*rot_1 + rot_2*rot_2 + rot_3*rot_3) AS m FROM ({GAUSSIANS})), q AS (SELECT *, rot_0/m AS w, rot_1/m AS i, rot_2/m AS j, rot_3/m AS k, exp(2*scale_0) AS va, exp(2*scale_1) AS vb, exp(2*scale_2) AS vc FROM g),
      s AS (SELECT *, sqrt(pow(1-2*(j*j+k*k),2)*va + pow(2*(i*j-k*w),2)*vb + pow(2*(i*k+j*w),2)*vc) AS sx, sqrt(pow(2*(i*j+k*w),2)*va + pow(1-2*(i*i+k*k),2)*vb + pow(2*(j*k-i*w),2)*vc) AS sy, sqrt(pow(2*(i*k-j*w),2)*va + pow(2*(j*k+i*w),2)*vb + pow(1-2*(i*i+j*j),2)*vc) AS sz FROM q),
      e AS (SELECT *, sx*sqrt(8) AS ex, sy*sqrt(8) AS ey, sz*sqrt(8) AS ez FROM s)
      SELECT flag, x BETWEEN -1.4e0 AND 1.9e0 AND y BETWEEN -1.4e0 AND 1.4e0 AND z BETWEEN 4.6e0 AND 7.4e0 AND x+ex >= -1 AND x-ex <= 1.5e0 AND y+ey >= -1 AND y-ey <= 1 AND z+ez >= 5 AND z-ez <= 7 AS meets, count(*) AS n, round(avg(sx), 9) AS sx, round(avg(sy), 9) AS sy, round(avg(sz), 9) AS sz, round(avg(greatest(ex, ey, ez)), 9) AS footprint FROM e GROUP BY 1, 2""",
    "semantic_carve": f"""WITH v AS ({D.VECS_DUCK}), p AS (SELECT *, least(0.4e0, 0.08e0 + (point_id % 40) / 100.0e0) AS t FROM v WHERE point_id % 7 > 1), f AS (SELECT p.point_id, {_NEAR} AS f FROM p JOIN v a ON a.point_id % 7 = 0 GROUP BY 1), r AS (SELECT p.point_id, {_NEAR} AS r FROM p JOIN v a ON a.point_id % 7 = 1 GROUP BY 1)
      SELECT point_id, round(f, 9) AS front_distance, round(CASE WHEN r <= f + 0.02e0 THEN r END, 9) AS rear_distance, r > f + 0.02e0 AS removed FROM p JOIN f USING (point_id) JOIN r USING (point_id) WHERE f <= t""",
    "depth_edges": f"""WITH {_PX}, j AS (SELECT p.frame_id, p.y, p.x, (max(q.depth) - min(q.depth)) / greatest(any_value(p.depth), 1e-6) AS jump FROM px p JOIN px q ON q.frame_id = p.frame_id AND abs(q.y - p.y) <= 1 AND abs(q.x - p.x) <= 1 GROUP BY 1, 2, 3)
      SELECT frame_id, jump > 0.015e0 AS edge, count(*) AS n, round(sum(jump), 9) AS jump FROM j GROUP BY 1, 2""",
    "depth_agreement": f"""WITH {_PX}, {_AN}, b AS (SELECT an.frame_id, an.depth AS a, px.depth AS s, greatest(0.02e0, px.depth * 0.004e0) AS t FROM an LEFT JOIN px ON px.frame_id = an.frame_id AND px.y = an.y AND px.x = an.x AND px.g < 210)
      SELECT frame_id, CASE WHEN s IS NULL THEN 'missing_scene_depth' WHEN abs(a - s) <= t THEN 'visible' WHEN a - s > t THEN 'occluded_behind_scene' ELSE 'front_depth_mismatch' END AS agreement, count(*) AS n FROM b GROUP BY 1, 2""",
    "depth_splat_close": f"""WITH {_PX}, {_AN}, k AS (SELECT unnest(range(-2, 3)) AS d), sp AS (SELECT px.frame_id, px.y, px.x, any_value(px.depth) AS s, min(an.depth) FILTER (WHERE an.y = px.y AND an.x = px.x) AS own, min(an.depth) FILTER (WHERE abs(an.y - px.y) <= 1 AND abs(an.x - px.x) <= 1) AS n1, min(an.depth) AS n3
        FROM px JOIN an ON an.frame_id = px.frame_id AND abs(an.y - px.y) <= 3 AND abs(an.x - px.x) <= 3 GROUP BY 1, 2, 3),
      ok AS (SELECT *, greatest(0.02e0, s * 0.004e0) AS t FROM sp), first AS (SELECT frame_id, y, x FROM ok WHERE abs(own - s) <= t OR abs(n1 - s) <= t), env AS (SELECT frame_id, y, x FROM ok WHERE abs(own - s) <= t OR abs(n3 - s) <= t),
      di AS (SELECT DISTINCT frame_id, y + a.d AS y, x + b.d AS x FROM first, k a, k b), er AS (SELECT frame_id, y + a.d AS y, x + b.d AS x FROM di, k a, k b GROUP BY ALL HAVING count(*) = 25), al AS (SELECT * FROM first UNION SELECT er.* FROM er SEMI JOIN env USING (frame_id, y, x))
      SELECT al.frame_id, count(f.frame_id) AS splatted, count(*) AS closed, CAST(sum(al.y * 64 + al.x) AS BIGINT) AS places FROM al LEFT JOIN first f ON f.frame_id = al.frame_id AND f.y = al.y AND f.x = al.x GROUP BY 1""",
    "dominant_colour_support": f"""WITH {_CO}, c AS (SELECT plane_id, "row", col, observed, r + off AS r, g + off AS g, b + off AS b FROM co), s AS (SELECT *, floor(r / 24) AS i, floor(g / 24) AS j, floor(b / 24) AS k FROM c WHERE observed),
      top AS (SELECT plane_id, i, j, k FROM s GROUP BY plane_id, i, j, k QUALIFY row_number() OVER (PARTITION BY plane_id ORDER BY count(*) DESC, i, j, k) = 1), m AS (SELECT plane_id, quantile_cont(r, 0.5) AS mr, quantile_cont(g, 0.5) AS mg, quantile_cont(b, 0.5) AS mb FROM s SEMI JOIN top USING (plane_id, i, j, k) GROUP BY 1),
      n AS (SELECT s.*, 0.2126e0 * r + 0.7152e0 * g + 0.0722e0 * b AS l FROM s JOIN m USING (plane_id) WHERE sqrt((r-mr)*(r-mr) + (g-mg)*(g-mg) + (b-mb)*(b-mb)) <= 30), q AS (SELECT *, quantile_cont(l, 0.65) OVER (PARTITION BY plane_id) AS cut FROM n),
      br AS (SELECT plane_id, quantile_cont(r, 0.5) AS tr, quantile_cont(g, 0.5) AS tg, quantile_cont(b, 0.5) AS tb FROM q WHERE l >= cut GROUP BY 1), o AS (SELECT c.*, observed AND sqrt((r-tr)*(r-tr) + (g-tg)*(g-tg) + (b-tb)*(b-tb)) <= 30 AS sup FROM c JOIN br USING (plane_id)),
      sh AS (SELECT plane_id, count(*) FILTER (WHERE sup) / count(*) FILTER (WHERE observed) AS share FROM o GROUP BY 1), f AS (SELECT o.*, share, CASE WHEN share < 0.08e0 THEN observed ELSE sup END AS support FROM o JOIN sh USING (plane_id))
      SELECT plane_id, count(*) FILTER (WHERE support) AS n, CAST(sum("row" * 10 + col) FILTER (WHERE support) AS BIGINT) AS places, round(any_value(share), 9) AS share FROM f GROUP BY 1""",
    "illumination_surface": f"""WITH {_CO} SELECT plane_id, "row", col, observed, {', '.join(f'CASE WHEN observed THEN {c} + off ELSE {c} END AS {c}' for c in 'rgb')} FROM co""",
}
