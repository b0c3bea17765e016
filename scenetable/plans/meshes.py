"""Queries over triangle meshes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.register import register
from ..operators import mesh
from . import derived as D

#: Eight meshes: a vertex for every customer, a face for every order; some faces are flat, some vertices unused.
VERTICES = """SELECT CAST(c_custkey % 8 AS INTEGER) AS mesh_id, c_custkey {div} 8 AS vid, ((c_custkey {div} 8) % 101) / 10.0e0 - 5.0e0 AS x, (((c_custkey {div} 8) {div} 101) % 37) / 10.0e0 - 1.8e0 AS y, 4.0e0 + (c_custkey {div} 8) % 7 / 10.0e0 AS z FROM customer"""
FACES = """SELECT CAST(o_custkey % 8 AS INTEGER) AS mesh_id, o_orderkey AS fid, o_custkey {div} 8 AS v0, (o_custkey {div} 8 + o_orderkey % 5) % {n} AS v1, (o_custkey {div} 8 + o_orderkey % 11) % {n} AS v2 FROM orders"""
#: Boxes of objects, one for every nation.
BOUNDS = """SELECT n_name AS object_id, n_nationkey AS ord, n_nationkey % 9 - 5.0e0 AS x0, n_nationkey % 9 - 4.25e0 AS x1, n_nationkey % 3 - 2.0e0 AS y0, n_nationkey % 3 - 1.5e0 AS y1, 4.0e0 AS z0, 4.0e0 + n_nationkey % 4 / 5.0e0 AS z1 FROM nation"""


def _vertices(spark, sf_dir):
    return D._read(spark, sf_dir, VERTICES.format(div="div"), "customer")


def _faces(spark, sf_dir):
    least = D.table(spark, sf_dir, "customer").agg(F.expr("max(c_custkey) div 8")).first()[0]
    return D._read(spark, sf_dir, FACES.format(div="div", n=least), "orders")


def mesh_audit(spark, sf_dir):
    """What is wrong with each mesh."""
    return mesh.mesh_audit(_vertices(spark, sf_dir), _faces(spark, sf_dir))


def _whole(spark, sf_dir):
    """Faces all of whose vertices are there."""
    vertices, faces = _vertices(spark, sf_dir), _faces(spark, sf_dir)
    return vertices, mesh.with_corners(vertices, faces).where("x0 IS NOT NULL AND x1 IS NOT NULL AND x2 IS NOT NULL").select("mesh_id", "fid", "v0", "v1", "v2")


def face_carve(spark, sf_dir):
    """Faces that each object's box removes."""
    vertices, faces = _whole(spark, sf_dir)
    out = mesh.carve_faces(vertices, faces, D._read(spark, sf_dir, BOUNDS, "nation"))
    return out.groupBy("mesh_id", "object_id").agg(F.count("*").alias("n"), F.sum("fid").alias("fids"))


def carved_mesh(spark, sf_dir):
    """The remaining faces over vertices numbered anew."""
    vertices, faces = _whole(spark, sf_dir)
    kept = mesh.carve_faces(vertices, faces, D._read(spark, sf_dir, BOUNDS, "nation")).where("object_id IS NULL").drop("object_id")
    new, faces = mesh.compact_mesh(vertices, kept)
    sizes = new.groupBy("mesh_id").agg(F.count("*").alias("n_vertices"), F.sum(F.col("vid") * (F.col("old_vid") % 97)).alias("numbers"))
    return faces.groupBy("mesh_id").agg(F.count("*").alias("n_faces"), F.sum(F.col("v0") + 2 * F.col("v1") + 3 * F.col("v2")).alias("corners")).join(sizes, "mesh_id")


def mesh_silhouette(spark, sf_dir):
    """The pixels of each camera that its mesh covers."""
    vertices, faces = _whole(spark, sf_dir)
    cams = D.cameras(spark, sf_dir).withColumn("mesh_id", F.col("frame_id") % 8)
    out = mesh.mesh_silhouette(vertices, faces, cams)
    return out.groupBy("frame_id").agg(F.count("*").alias("n"), F.sum(F.col("y") * 128 + F.col("x")).alias("places"))


def raster_in_sql(spark, sf_dir):
    """2.13: the registered functions in SQL text, a table function in LATERAL."""
    register(spark)
    rows = D.table(spark, sf_dir, "part")
    rows.repartition(D.parts(spark, rows.count() * 50)).createOrReplaceTempView("scene_part")  # a triangle becomes some 50 pixels, and a file of one row group is one task
    return spark.sql("""
        WITH t AS (SELECT p_partkey, p_size, p_partkey % 53 + 0.25D AS x0, p_partkey % 41 + 0.5D AS y0, p_partkey % 53 + p_size % 13 - 4.0D AS x1, p_partkey % 41 + p_size % 7 + 2.0D AS y1, p_partkey % 53 + p_size % 5 * 2.0D AS x2, p_partkey % 41 - p_size % 11 + 5.0D AS y2 FROM scene_part)
        SELECT p_size, count(*) AS n, sum(y * 64 + x) AS places, round(sum(scene_smoothstep(x / 64.0D)), 6) AS soft, round(avg(scene_bbox_iou(x0, y0, x0 + 9, y0 + 9, x, y, x + 7D, y + 5D)), 9) AS iou
        FROM t, LATERAL scene_raster_triangle(x0, y0, x1, y1, x2, y2, 64, 48) GROUP BY p_size""")


QUERIES = {f.__name__: f for f in (mesh_audit, face_carve, carved_mesh, mesh_silhouette, raster_in_sql)}

_MESH = f"""ve AS ({VERTICES.format(div='//')}), fc AS (SELECT CAST(o_custkey % 8 AS INTEGER) AS mesh_id, o_orderkey AS fid, o_custkey // 8 AS v0, (o_custkey // 8 + o_orderkey % 5) % (SELECT max(c_custkey) // 8 FROM customer) AS v1, (o_custkey // 8 + o_orderkey % 11) % (SELECT max(c_custkey) // 8 FROM customer) AS v2 FROM orders),
 tri AS (SELECT f.*, {', '.join(f'p{k}.{a} AS {a}{k}' for k in range(3) for a in 'xyz')} FROM fc f {' '.join(f'LEFT JOIN ve p{k} ON p{k}.mesh_id = f.mesh_id AND p{k}.vid = f.v{k}' for k in range(3))}), ok AS (SELECT * FROM tri WHERE x0 IS NOT NULL AND x1 IS NOT NULL AND x2 IS NOT NULL)"""
_CARVED = f"""{_MESH}, bo AS ({BOUNDS}), hit AS (SELECT ok.mesh_id, fid, arg_min(object_id, ord) AS object_id FROM ok JOIN bo ON {' AND '.join(f'least(ok.{a}0, ok.{a}1, ok.{a}2) <= bo.{a}1 AND greatest(ok.{a}0, ok.{a}1, ok.{a}2) >= bo.{a}0' for a in 'xyz')} GROUP BY 1, 2)"""

ORACLE = {
    "mesh_audit": f"""WITH {_MESH}, vs AS (SELECT mesh_id, count(*) AS vertices, greatest(max(x) - min(x), max(y) - min(y), max(z) - min(z)) AS e FROM ve GROUP BY 1),
      ts AS (SELECT mesh_id, count(*) AS faces, bool_and(x0 IS NOT NULL AND x1 IS NOT NULL AND x2 IS NOT NULL) AS good, count(*) FILTER (WHERE sqrt(pow((y1-y0)*(z2-z0)-(z1-z0)*(y2-y0), 2) + pow((z1-z0)*(x2-x0)-(x1-x0)*(z2-z0), 2) + pow((x1-x0)*(y2-y0)-(y1-y0)*(x2-x0), 2)) <= greatest(e * e * 1e-12, 1e-18)) AS flat FROM tri JOIN vs USING (mesh_id) GROUP BY 1),
      ed AS (SELECT mesh_id, least(a, b) AS a, greatest(a, b) AS b, count(*) AS n FROM (SELECT mesh_id, unnest([v0, v1, v2]) AS a, unnest([v1, v2, v0]) AS b FROM fc) GROUP BY 1, 2, 3), es AS (SELECT mesh_id, count(*) FILTER (WHERE n = 1) AS boundary_edges, count(*) FILTER (WHERE n > 2) AS crowded_edges FROM ed GROUP BY 1),
      un AS (SELECT mesh_id, count(*) AS unused_vertices FROM ve WHERE NOT EXISTS (SELECT 1 FROM fc WHERE fc.mesh_id = ve.mesh_id AND ve.vid IN (v0, v1, v2)) GROUP BY 1)
      SELECT mesh_id, vertices, faces, true AS finite_vertices, good AS valid_indices, CASE WHEN good THEN flat ELSE 0 END AS degenerate_faces, boundary_edges, crowded_edges, coalesce(unused_vertices, 0) AS unused_vertices FROM vs JOIN ts USING (mesh_id) JOIN es USING (mesh_id) LEFT JOIN un USING (mesh_id)""",
    "face_carve": f"WITH {_CARVED} SELECT ok.mesh_id, object_id, count(*) AS n, CAST(sum(fid) AS BIGINT) AS fids FROM ok LEFT JOIN hit USING (mesh_id, fid) GROUP BY 1, 2",
    "carved_mesh": f"""WITH {_CARVED}, k AS (SELECT ok.* FROM ok ANTI JOIN hit USING (mesh_id, fid)), u AS (SELECT mesh_id, v, row_number() OVER (PARTITION BY mesh_id ORDER BY v) - 1 AS i FROM (SELECT DISTINCT mesh_id, unnest([v0, v1, v2]) AS v FROM k)),
      c AS (SELECT k.mesh_id, count(*) AS n_faces, CAST(sum(a.i + 2 * b.i + 3 * c.i) AS BIGINT) AS corners FROM k JOIN u a ON a.mesh_id = k.mesh_id AND a.v = v0 JOIN u b ON b.mesh_id = k.mesh_id AND b.v = v1 JOIN u c ON c.mesh_id = k.mesh_id AND c.v = v2 GROUP BY 1)
      SELECT mesh_id, n_faces, corners, n_vertices, numbers FROM c JOIN (SELECT mesh_id, count(*) AS n_vertices, CAST(sum(i * (v % 97)) AS BIGINT) AS numbers FROM u GROUP BY 1) USING (mesh_id)""",
    "mesh_silhouette": f"""WITH {_MESH}, cams AS ({D.CAMS}), im AS (SELECT cam AS frame_id, {', '.join(f'64.0e0 * (x{k} - cam_x) / z{k} + 64.0e0 AS u{k}, 64.0e0 * y{k} / z{k} + 48.0e0 AS w{k}' for k in range(3))} FROM ok JOIN cams ON cam % 8 = mesh_id),
      bx AS (SELECT *, CAST(greatest(ceil(least(u0, u1, u2)), 0) AS INTEGER) AS a, CAST(least(floor(greatest(u0, u1, u2)), 127) AS INTEGER) AS b, CAST(greatest(ceil(least(w0, w1, w2)), 0) AS INTEGER) AS c, CAST(least(floor(greatest(w0, w1, w2)), 95) AS INTEGER) AS d FROM im),
      px AS (SELECT *, unnest(range(a, b + 1)) AS x FROM (SELECT *, unnest(range(c, d + 1)) AS y FROM bx)), e AS (SELECT frame_id, y, x, (u1-u0)*(y-w0)-(w1-w0)*(x-u0) AS p, (u2-u1)*(y-w1)-(w2-w1)*(x-u1) AS q, (u0-u2)*(y-w2)-(w0-w2)*(x-u2) AS r FROM px),
      s AS (SELECT DISTINCT frame_id, y, x FROM e WHERE (p >= 0 AND q >= 0 AND r >= 0) OR (p <= 0 AND q <= 0 AND r <= 0))
      SELECT frame_id, count(*) AS n, CAST(sum(y * 128 + x) AS BIGINT) AS places FROM s GROUP BY 1""",
    "raster_in_sql": """WITH t AS (SELECT p_partkey, p_size, p_partkey % 53 + 0.25e0 AS x0, p_partkey % 41 + 0.5e0 AS y0, p_partkey % 53 + p_size % 13 - 4.0e0 AS x1, p_partkey % 41 + p_size % 7 + 2.0e0 AS y1, p_partkey % 53 + p_size % 5 * 2.0e0 AS x2, p_partkey % 41 - p_size % 11 + 5.0e0 AS y2 FROM part),
      px AS (SELECT t.*, x, y FROM t, range(64) a(x), range(48) b(y) WHERE x BETWEEN least(x0, x1, x2) AND greatest(x0, x1, x2) AND y BETWEEN least(y0, y1, y2) AND greatest(y0, y1, y2)),
      e AS (SELECT *, (x1-x0)*(y-y0)-(y1-y0)*(x-x0) AS p, (x2-x1)*(y-y1)-(y2-y1)*(x-x1) AS q, (x0-x2)*(y-y2)-(y0-y2)*(x-x2) AS r FROM px), i AS (SELECT *, x / 64.0e0 AS s, greatest(least(x0 + 9, x + 7) - greatest(x0, x), 0) * greatest(least(y0 + 9, y + 5) - greatest(y0, y), 0) AS v FROM e WHERE (p >= 0 AND q >= 0 AND r >= 0) OR (p <= 0 AND q <= 0 AND r <= 0))
      SELECT p_size, count(*) AS n, CAST(sum(y * 64 + x) AS BIGINT) AS places, round(sum(s * s * (3 - 2 * s)), 6) AS soft, round(avg(v / (81 + 35 - v)), 9) AS iou FROM i GROUP BY 1""",
}
