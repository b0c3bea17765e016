"""Queries over parts and planes of point clouds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import carve, consensus, spacing
from . import derived as D

#: A cloud for each nation: points strewn over a slanted plane, at any depth across it.
STREWN = """SELECT c_nationkey AS cloud, c_custkey AS point_id, (c_custkey * 7919 % 1009) / 10.0e0 AS x, (c_custkey * 10473 % 997) / 10.0e0 AS y, (c_custkey * 631 % 499) / 10.0e0 AS z FROM customer"""
#: The plane they are seen in, and how near points of one part are there.
NORMAL, REACH = [0.6, 0.0, 0.8], 9.99
#: A cloud for each region: three in five points on a plane of its own, the others well behind it.
PANES = """SELECT n_regionkey AS cloud, c_custkey AS point_id, (c_custkey * 7919 % 1009) / 50.0e0 AS u, (c_custkey * 10473 % 997) / 50.0e0 AS v, n_regionkey + 4.0e0 AS off,
 CASE WHEN c_custkey % 5 < 3 THEN 0.0e0 ELSE 20.0e0 + (c_custkey * 631 % 499) / 10.0e0 END AS behind FROM customer JOIN nation ON c_nationkey = n_nationkey"""
#: A cloud for each region: a sheet across the third axis in scattered points; widths of both are told by the others.
SHEETS = """SELECT n_regionkey AS cloud, c_custkey AS point_id, (c_custkey * 7919 % 1009) / 10.0e0 AS x, (c_custkey * 10473 % 997) / 20.0e0 AS y,
 CASE WHEN c_custkey % 5 < 3 THEN 6.0e0 + (c_custkey % 7) / 8.0e0 ELSE (c_custkey * 631 % 499) / 20.0e0 END AS z FROM customer JOIN nation ON c_nationkey = n_nationkey"""

#: A box for each nation's customers, over anchors at a twelfth of the points.
BOXES = """SELECT n_nationkey AS ord, 'o' || n_nationkey AS object_id, (n_nationkey % 5) * 2.0e0 - 5.0e0 AS x0, (n_nationkey % 5) * 2.0e0 - 2.0e0 AS x1, -1.8e0 AS y0, CASE WHEN n_nationkey % 2 = 0 THEN 1.8e0 ELSE 0.9e0 END AS y1,
 4.0e0 + (n_nationkey {div} 5) * 0.8e0 AS z0, 5.5e0 + (n_nationkey {div} 5) * 0.8e0 AS z1 FROM nation"""
ROOTS = f"SELECT 'o' || point_id % 25 AS object_id, x, y, z + 0.01e0 AS z FROM ({D.PTS}) WHERE point_id % 12 = 5"


def _rows(spark, sf_dir, sql):
    for t in ("customer", "nation"):
        D.table(spark, sf_dir, t).createOrReplaceTempView(t)
    return spark.sql(sql)


def largest_planar_part(spark, sf_dir):
    """The largest part of each cloud in its plane, and how its points are spaced."""
    kept, report = spacing.largest_planar_part(_rows(spark, sf_dir, STREWN), ["cloud"], NORMAL, REACH)
    held = kept.groupBy("cloud").agg(F.sum("point_id").alias("id_sum"))
    return report.join(held, "cloud").select("cloud", "n_points", "n_parts", "largest", F.round("fraction", 9).alias("fraction"), F.col("second").cast("long").alias("second"), "id_sum", *(F.round(c, 6).alias(c) for c in ("minimum", "q05", "median", "q95", "maximum")))


def consensus_planes(spark, sf_dir):
    """The plane of each cloud, its points and tolerance."""
    at = {"x": 0.6 * F.col("d") + 0.8 * F.col("v"), "y": F.col("u"), "z": 0.8 * F.col("d") - 0.6 * F.col("v")}
    points = _rows(spark, sf_dir, PANES).withColumn("d", F.col("off") + F.col("behind")).select("cloud", "point_id", *(c.alias(a) for a, c in at.items()))
    kept, report = consensus.consensus_planes(points, ["cloud"], trials=64)
    held = kept.groupBy("cloud").agg(F.sum("point_id").alias("id_sum"))
    side = F.when(F.col("nz") < 0, -1.0).otherwise(1.0)
    return report.join(held, "cloud").select("cloud", *(F.round(F.col(c) * side, 6).alias(c) for c in ("nx", "nz", "offset")), F.round("tolerance", 6).alias("tolerance"), "n_points", "kept", "id_sum")


def densest_slab(spark, sf_dir):
    """A23's second way: the densest slab of each cloud."""
    return consensus.densest_slab(_rows(spark, sf_dir, SHEETS), ["cloud"])[1].select("cloud", "mode", "n_points", "kept", F.round("width", 6).alias("width"))


def carved_objects(spark, sf_dir):
    """What each object takes of the cloud, near its own anchors."""
    anchors = D._read(spark, sf_dir, ROOTS, "lineitem")
    boxes = carve.grown(_rows(spark, sf_dir, BOXES.format(div="div")), 0.05, 0.02)
    out = carve.carve_objects(D.points(spark, sf_dir).select("point_id", "x", "y", "z"), boxes, anchors, 0.305)
    return out.groupBy("object_id").agg(F.count("*").alias("n"), F.sum("point_id").alias("id_sum"))


QUERIES = {f.__name__: f for f in (largest_planar_part, consensus_planes, densest_slab, carved_objects)}

ORACLE = {
    "carved_objects": f"""WITH b AS (SELECT ord, object_id, x0 - (x1 - x0) * 0.05e0 - 0.02e0 AS x0, x1 + (x1 - x0) * 0.05e0 + 0.02e0 AS x1, y0 - (y1 - y0) * 0.05e0 - 0.02e0 AS y0, y1 + (y1 - y0) * 0.05e0 + 0.02e0 AS y1, z0 - (z1 - z0) * 0.05e0 - 0.02e0 AS z0, z1 + (z1 - z0) * 0.05e0 + 0.02e0 AS z1 FROM ({BOXES.format(div="//")})),
      a AS (SELECT DISTINCT object_id, ord, a.x, a.y, a.z, floor(a.x / 0.305e0) AS gx, floor(a.y / 0.305e0) AS gy, floor(a.z / 0.305e0) AS gz FROM ({ROOTS}) a JOIN b USING (object_id) WHERE a.x BETWEEN x0 - 0.4e0 AND x1 + 0.4e0 AND a.y BETWEEN y0 - 0.4e0 AND y1 + 0.4e0 AND a.z BETWEEN z0 - 0.4e0 AND z1 + 0.4e0),
      g AS (SELECT a.*, gx + i.o AS cx, gy + j.o AS cy, gz + k.o AS cz FROM a, (SELECT unnest([-1, 0, 1]) AS o) i, (SELECT unnest([-1, 0, 1]) AS o) j, (SELECT unnest([-1, 0, 1]) AS o) k), p AS (SELECT *, floor(x / 0.305e0) AS cx, floor(y / 0.305e0) AS cy, floor(z / 0.305e0) AS cz FROM ({D.PTS})),
      h AS (SELECT DISTINCT p.point_id, p.x, p.y, p.z, g.object_id, g.ord FROM p JOIN g USING (cx, cy, cz) WHERE (p.x - g.x) * (p.x - g.x) + (p.y - g.y) * (p.y - g.y) + (p.z - g.z) * (p.z - g.z) <= 0.305e0 * 0.305e0),
      t AS (SELECT h.point_id, arg_min(h.object_id, h.ord) AS object_id FROM h JOIN b USING (object_id) WHERE h.x BETWEEN x0 AND x1 AND h.y BETWEEN y0 AND y1 AND h.z BETWEEN z0 AND z1 GROUP BY 1)
      SELECT object_id, count(*) AS n, CAST(sum(point_id) AS BIGINT) AS id_sum FROM t GROUP BY 1""",
    "largest_planar_part": f"""WITH RECURSIVE p AS (SELECT cloud, point_id, y AS u, 0.8e0 * x - 0.6e0 * z AS v FROM ({STREWN})), d AS (SELECT a.cloud, a.point_id AS a, b.point_id AS b, sqrt((a.u - b.u) * (a.u - b.u) + (a.v - b.v) * (a.v - b.v)) AS d FROM p a JOIN p b ON a.cloud = b.cloud AND a.point_id <> b.point_id),
      e AS (SELECT * FROM d WHERE d <= {REACH}e0), r(cloud, a, b) AS (SELECT cloud, point_id, point_id FROM p UNION SELECT r.cloud, r.a, e.b FROM r JOIN e ON e.cloud = r.cloud AND e.a = r.b), l AS (SELECT cloud, a AS point_id, min(b) AS part FROM r GROUP BY 1, 2),
      s AS (SELECT cloud, part, count(*) AS n, sum(point_id) AS id_sum, row_number() OVER (PARTITION BY cloud ORDER BY count(*) DESC, part) AS k FROM l GROUP BY 1, 2),
      t AS (SELECT cloud, sum(n) AS n_points, count(*) AS n_parts, max(CASE WHEN k = 1 THEN n END) AS largest, max(CASE WHEN k = 1 THEN id_sum END) AS id_sum, max(CASE WHEN k = 2 THEN n END) AS second FROM s GROUP BY 1),
      m AS (SELECT cloud, a, min(d) AS d FROM d GROUP BY 1, 2), q AS (SELECT cloud, min(d) AS lo, quantile_cont(d, 0.05) AS a, quantile_cont(d, 0.5) AS b, quantile_cont(d, 0.95) AS c, max(d) AS hi FROM m GROUP BY 1)
      SELECT cloud, CAST(n_points AS BIGINT) AS n_points, n_parts, CAST(largest AS BIGINT) AS largest, round(largest / n_points, 9) AS fraction, CAST(coalesce(second, 0) AS BIGINT) AS second, CAST(id_sum AS BIGINT) AS id_sum,
        round(lo, 6) AS minimum, round(a, 6) AS q05, round(b, 6) AS median, round(c, 6) AS q95, round(hi, 6) AS maximum FROM t LEFT JOIN q USING (cloud)""",
    "consensus_planes": f"""WITH p AS ({PANES}), n AS (SELECT a.cloud, a.point_id, min((a.u - b.u) * (a.u - b.u) + (a.v - b.v) * (a.v - b.v) + (a.behind - b.behind) * (a.behind - b.behind)) AS d2 FROM p a JOIN p b ON a.cloud = b.cloud AND a.point_id <> b.point_id WHERE (a.u, a.v, a.behind) IS DISTINCT FROM (b.u, b.v, b.behind) GROUP BY 1, 2),
      t AS (SELECT cloud, 1.4e0 * quantile_cont(sqrt(d2), 0.5) AS tolerance FROM n GROUP BY 1)
      SELECT cloud, 0.6e0 AS nx, 0.8e0 AS nz, round(any_value(off), 6) AS "offset", round(any_value(tolerance), 6) AS tolerance, count(*) AS n_points, count(*) FILTER (WHERE behind = 0) AS kept, CAST(sum(CASE WHEN behind = 0 THEN point_id END) AS BIGINT) AS id_sum FROM p JOIN t USING (cloud) GROUP BY 1""",
}
