"""Queries over points, views and neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.geometry import transform_point
from ..operators import fit, fuse, match, neighbors, visibility
from ..operators.common import small
from . import derived as D


def _spread(points):
    """Points dealt anew by id: each becomes a row a camera next, and a file of one row group is one task. AQE sizes the partitions."""
    return points.repartition("point_id")


def visible_pixels_by_object(spark, sf_dir):
    rows = visibility.visible_pixels(visibility.project_points(_spread(D.points(spark, sf_dir).select("point_id", "obj", "x", "y", "z")).drop("point_id"), D.cameras(spark, sf_dir)))
    return rows.groupBy(F.col("frame_id").alias("cam"), "obj").agg(F.count("*").alias("n_pixels"), F.count_if("visible").alias("n_visible"))


def zbuffer_payload(spark, sf_dir):
    seen = visibility.project_points(_spread(D.points(spark, sf_dir).select("point_id", "weight", "x", "y", "z")), D.cameras(spark, sf_dir))
    near = visibility.zbuffer(seen, ["frame_id", "px", "py"], ["point_id", "weight"], "point_id")
    return near.groupBy(F.col("frame_id").alias("cam")).agg(F.count("*").alias("n_pixels"), F.sum("point_id").alias("point_sum"), F.round(F.avg("depth"), 6).alias("mean_depth"))


def view_votes_histogram(spark, sf_dir):
    seen = visibility.project_points(_spread(D.points(spark, sf_dir).select("point_id", "x", "y", "z")), D.cameras(spark, sf_dir))
    masks = D.table(spark, sf_dir, "part").select((F.col("p_partkey") % 25).cast("int").alias("frame_id"), (F.col("p_size") * 2).cast("int").alias("px"), (F.col("p_partkey") % 96).cast("int").alias("py"))
    return visibility.view_votes(seen, masks).groupBy("votes").agg(F.count("*").alias("n_points"), F.count_if("carved").alias("n_carved"))


def split_points_by_mask(spark, sf_dir):
    pts = D.points(spark, sf_dir).select("point_id", F.col("x").alias("u"), F.col("y").alias("v"))
    supp = D.table(spark, sf_dir, "supplier")
    x0, y0 = (F.col("s_suppkey") % 8) - 4.0, (F.col("s_nationkey") % 5) * 0.7 - 1.8
    boxes = supp.select(F.col("s_name").alias("mask"), x0.alias("x0"), y0.alias("y0"), (x0 + 1.5).alias("x1"), (y0 + 1.0).alias("y1"), F.lit(0.5).alias("score"))
    return visibility.split_by_boxes(pts, boxes).groupBy("label").agg(F.count("*").alias("n_points"), F.count_if(F.col("n_boxes") > 1).alias("n_overlap"))


def nearest_anchor_within_radius(spark, sf_dir):
    rows = D.vectors(spark, sf_dir)
    anchors = rows.where("point_id % 7 = 0").select(F.col("point_id").alias("anchor_id"), "x", "y", "z")
    near = neighbors.nearest_within(rows.where("point_id % 7 <> 0"), anchors, 0.15)
    return near.select("point_id", "anchor_id", F.round("d2", 9).alias("d2"))


def points_near_any_anchor(spark, sf_dir):
    rows = D.vectors(spark, sf_dir)
    anchors = rows.where("point_id % 7 = 0").select(F.col("point_id").alias("anchor_id"), "x", "y", "z")
    return neighbors.near_any(rows.where("point_id % 7 <> 0"), anchors, 0.1).groupBy("label").agg(F.count("*").alias("n"))


def carve_by_boxes(spark, sf_dir):
    boxes = D.table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("box_id"), F.col("n_nationkey").alias("ord"),
        *((F.col("n_nationkey") % m - b).cast("double").alias(f"{a}0") for a, m, b in (("x", 9, 5), ("y", 3, 2), ("z", 4, -4))),
        *((F.col("n_nationkey") % m - b + 1.25).cast("double").alias(f"{a}1") for a, m, b in (("x", 9, 5), ("y", 3, 2), ("z", 4, -4))),
    )
    return neighbors.carve_boxes(D.points(spark, sf_dir).select("point_id", "x", "y", "z"), boxes).groupBy("box_id").agg(F.count("*").alias("n_points"))


def voxel_cluster(spark, sf_dir):
    cells = neighbors.voxel_means(D.points(spark, sf_dir).select("x", "y", "z"), 0.5)
    return cells.select("vx", "vy", "vz", "n", *(F.round(f"m{a}", 6).alias(f"m{a}") for a in "xyz"))


def robust_fuse_support(spark, sf_dir):
    samples = D.points(spark, sf_dir).select("part", F.col("z").alias("depth"), F.col("discount").alias("v"))
    out = fuse.robust_fuse(samples, ["part"], ["v"], absolute=0.8, relative=0.05)
    return out.select("part", "support", F.round("depth", 6).alias("depth"), F.round("v", 6).alias("v"))


def robust_bounds(spark, sf_dir):
    out = fuse.robust_bounds(D.vectors(spark, sf_dir), ["label"])
    return out.select("label", "n", *(F.round(f"{a}{e}", 6).alias(f"{a}{e}") for a in "xyz" for e in ("0", "1", "c", "e")))


def weighted_median_price(spark, sf_dir):
    rows = D.points(spark, sf_dir).withColumn("discount", F.col("discount").cast("decimal(12,2)"))  # exact sums
    return fuse.weighted_median(rows, ["supp"], "quantity", "discount").select("supp", F.col("median").alias("median_quantity"))


def plane_peaks(spark, sf_dir):
    rows = D.points(spark, sf_dir).select("obj", F.col("x").alias("offset"), F.lit(1.0).alias("weight"))
    return fuse.plane_peaks(rows, ["obj"], width=0.5, most=16).select("obj", F.col("bin").cast("long").alias("bin"), F.round("s", 6).alias("s"), "rank")


def two_level_atlas_mean(spark, sf_dir):
    rows = D.points(spark, sf_dir).select((F.col("supp") % 10).alias("plane_id"), (F.col("part") % 16).alias("row"), (F.col("part") % 13).alias("col"), F.col("line").alias("frame_id"), F.col("quantity").alias("v"))
    return fuse.texture_atlas(rows).select("plane_id", "row", "col", F.round("v", 6).alias("v"), "frame_support", "observed")


def coverage_by_frame(spark, sf_dir):
    rows = D.points(spark, sf_dir).select(F.col("line").alias("frame_id"), (F.col("discount") >= 0.05).alias("measured"))
    return fuse.coverage_summary(rows).select("frame_id", "n", "measured", F.round("fraction", 6).alias("fraction"), "next_action")


def transformed_bounds(spark, sf_dir):
    turned = transform_point([[0, -2, 0, 3], [2, 0, 0, -1], [0, 0, 2, 0.5], [0, 0, 0, 1]], F.col("x"), F.col("y"), F.col("z"))
    rows = D.points(spark, sf_dir).select("obj", *(c.alias(a) for a, c in zip("xyz", turned, strict=True)))
    return rows.groupBy("obj").agg(*(F.round(f(a), 6).alias(f"{a}{e}") for a in "xyz" for e, f in (("0", F.min), ("1", F.max))))


def exposure_fit(spark, sf_dir):
    rows = D.points(spark, sf_dir).select("supp", F.col("quantity").alias("x"), (F.col("quantity") * 1.2 + F.col("discount") * 10).alias("y"))
    return fit.huber_line(rows, ["supp"], rounds=4)


def similarity_fit(spark, sf_dir):
    v = D.vectors(spark, sf_dir)
    pairs = v.select("label", F.col("x").alias("sx"), F.col("y").alias("sy"), F.col("z").alias("sz"), (3 - 2.5 * F.col("y")).alias("tx"), (2.5 * F.col("x") - 2).alias("ty"), (2.5 * F.col("z") + 1).alias("tz"))
    return fit.similarity_fit(pairs, ["label"])


def similarity_fit_summary(spark, sf_dir):
    """The recovered scale and translation, which the planted transform gives in closed form."""
    out = similarity_fit(spark, sf_dir)
    return out.select("label", "n", F.round("scale", 6).alias("scale"), *(F.round(F.col("translation")[i], 6).alias(f"t{i}") for i in range(3)))


def principal_frames(spark, sf_dir):
    return fit.principal_frame(D.vectors(spark, sf_dir), ["label"]).select("label", "n", F.round(F.aggregate("variances", F.lit(0.0), lambda a, x: a + x), 6).alias("total_variance"))


def plane_consensus(spark, sf_dir):
    return fit.plane_consensus(D.points(spark, sf_dir).select("x", "y", "z"), 0.05)


def maximin_views(spark, sf_dir):
    d = F.sqrt(F.lit(1.0) + F.pow((F.col("n_nationkey") - 12) * 0.25, 2))
    rays = D.table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("region"), F.col("n_nationkey").alias("frame_id"), ((F.col("n_nationkey") - 12) * 0.25 / d).alias("dx"), F.lit(0.0).alias("dy"), (1 / d).alias("dz"))
    customers = D.table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("frame_id")).agg(F.count("*").alias("n_anchors"))
    return match.maximin_views(rays, ["region"], 3).join(small(customers), "frame_id", "left")


_ANCHOR = f"v AS ({D.VECS_DUCK}), a AS (SELECT * FROM v WHERE point_id % 7 = 0), p AS (SELECT * FROM v WHERE point_id % 7 <> 0)"
_D2 = "(p.x-a.x)*(p.x-a.x) + (p.y-a.y)*(p.y-a.y) + (p.z-a.z)*(p.z-a.z)"

QUERIES = {f.__name__: f for f in (
    visible_pixels_by_object, zbuffer_payload, view_votes_histogram, split_points_by_mask, nearest_anchor_within_radius, points_near_any_anchor, carve_by_boxes, voxel_cluster,
    robust_fuse_support, robust_bounds, weighted_median_price, plane_peaks, two_level_atlas_mean, coverage_by_frame, transformed_bounds, exposure_fit, similarity_fit, similarity_fit_summary,
    principal_frames, plane_consensus, maximin_views,
)}

ORACLE = {
    "visible_pixels_by_object": f"""WITH {D.PROJECTED_SQL}, own AS (SELECT cam, obj, px, py, min(depth) AS d FROM seen GROUP BY ALL),
      w AS (SELECT *, min(d) OVER (PARTITION BY cam, px, py) AS g FROM own)
      SELECT cam, obj, count(*) AS n_pixels, count(*) FILTER (WHERE d <= g + greatest(0.02e0, 0.005e0 * g)) AS n_visible FROM w GROUP BY cam, obj""",
    "zbuffer_payload": f"""WITH {D.PROJECTED_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY cam, px, py ORDER BY depth, point_id) AS k FROM seen)
      SELECT cam, count(*) AS n_pixels, CAST(sum(point_id) AS BIGINT) AS point_sum, round(avg(depth), 6) AS mean_depth FROM r WHERE k = 1 GROUP BY cam""",
    "view_votes_histogram": f"""WITH {D.PROJECTED_SQL}, m AS (SELECT DISTINCT p_partkey % 25 AS cam, p_size * 2 AS px, p_partkey % 96 AS py FROM part),
      v AS (SELECT point_id, count(m.cam) AS votes FROM seen s LEFT JOIN m ON m.cam = s.cam AND m.px = s.px AND m.py = s.py GROUP BY point_id)
      SELECT votes, count(*) AS n_points, count(*) FILTER (WHERE votes >= 2) AS n_carved FROM v GROUP BY votes""",
    "split_points_by_mask": f"""WITH pts AS ({D.PTS}), b AS (SELECT s_name AS mask, (s_suppkey % 8) - 4.0e0 AS x0, (s_nationkey % 5) * 0.7e0 - 1.8e0 AS y0 FROM supplier),
      h AS (SELECT point_id, mask, row_number() OVER (PARTITION BY point_id ORDER BY du * du + dv * dv - 0.5e0 * 1e-9, mask) AS k,
              count(mask) OVER (PARTITION BY point_id) AS n
            FROM (SELECT p.point_id, b.mask, (x - (x0 + (x0 + 1.5e0)) / 2) / greatest(((x0 + 1.5e0) - x0) / 2, 1) AS du, (y - (y0 + (y0 + 1.0e0)) / 2) / greatest(((y0 + 1.0e0) - y0) / 2, 1) AS dv
                  FROM pts p LEFT JOIN b ON x BETWEEN x0 AND x0 + 1.5e0 AND y BETWEEN y0 AND y0 + 1.0e0))
      SELECT mask AS label, count(*) AS n_points, count(*) FILTER (WHERE n > 1) AS n_overlap FROM h WHERE k = 1 GROUP BY mask""",
    "nearest_anchor_within_radius": f"""WITH {_ANCHOR}, j AS (SELECT p.point_id, a.point_id AS anchor_id, {_D2} AS d2 FROM p JOIN a ON {_D2} <= 0.15e0 * 0.15e0),
      r AS (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY d2, anchor_id) AS k FROM j) SELECT point_id, anchor_id, round(d2, 9) AS d2 FROM r WHERE k = 1""",
    "points_near_any_anchor": f"WITH {_ANCHOR} SELECT label, count(*) AS n FROM p WHERE EXISTS (SELECT 1 FROM a WHERE {_D2} <= 0.1e0 * 0.1e0) GROUP BY label",
    "carve_by_boxes": f"""WITH pts AS ({D.PTS}), b AS (SELECT n_name, n_nationkey, n_nationkey % 9 - 5 AS x0, n_nationkey % 3 - 2 AS y0, n_nationkey % 4 + 4 AS z0 FROM nation),
      r AS (SELECT n_name, row_number() OVER (PARTITION BY point_id ORDER BY n_nationkey) AS k FROM pts JOIN b ON x BETWEEN x0 AND x0 + 1.25e0 AND y BETWEEN y0 AND y0 + 1.25e0 AND z BETWEEN z0 AND z0 + 1.25e0)
      SELECT n_name AS box_id, count(*) AS n_points FROM r WHERE k = 1 GROUP BY n_name""",
    "voxel_cluster": f"""WITH pts AS ({D.PTS}) SELECT CAST(floor(x / 0.5e0) AS BIGINT) AS vx, CAST(floor(y / 0.5e0) AS BIGINT) AS vy, CAST(floor(z / 0.5e0) AS BIGINT) AS vz, count(*) AS n,
      round(avg(x), 6) AS mx, round(avg(y), 6) AS my, round(avg(z), 6) AS mz FROM pts GROUP BY 1, 2, 3""",
    "robust_fuse_support": f"""WITH pts AS ({D.PTS}), m AS (SELECT part, quantile_cont(z, 0.5) AS m FROM pts GROUP BY part),
      i AS (SELECT p.part, z, discount FROM pts p JOIN m USING (part) WHERE abs(z - m) <= greatest(0.8e0, 0.05e0 * m))
      SELECT part, count(*) AS support, round(quantile_cont(z, 0.5), 6) AS depth, round(quantile_cont(discount, 0.5), 6) AS v FROM i GROUP BY part HAVING count(*) >= 2""",
    "robust_bounds": f"""WITH v AS ({D.VECS_DUCK}), q AS (SELECT label, count(*) AS n, {', '.join(f'quantile_cont({a}, 0.02) AS {a}0, quantile_cont({a}, 0.98) AS {a}1' for a in 'xyz')} FROM v GROUP BY label)
      SELECT label, n, {', '.join(f'round({a}0, 6) AS {a}0, round({a}1, 6) AS {a}1, round(({a}0 + {a}1) / 2, 6) AS {a}c, round(greatest({a}1 - {a}0, 1e-5), 6) AS {a}e' for a in 'xyz')} FROM q""",
    "weighted_median_price": """WITH e AS (SELECT l_suppkey AS supp, l_quantity AS q, sum(CAST(l_discount AS DECIMAL(12, 2))) AS w FROM lineitem GROUP BY 1, 2),
      r AS (SELECT supp, q, sum(w) OVER (PARTITION BY supp ORDER BY q ROWS UNBOUNDED PRECEDING) AS c, sum(w) OVER (PARTITION BY supp) AS h FROM e)
      SELECT supp, min(q) AS median_quantity FROM r WHERE 2 * c >= h GROUP BY supp""",
    "plane_peaks": f"""WITH pts AS ({D.PTS}), b AS (SELECT obj, CAST(floor(x / 0.5e0) AS BIGINT) AS bin, CAST(count(*) AS DOUBLE) AS w FROM pts GROUP BY 1, 2),
      s AS (SELECT obj, bin + d AS bin, sum(w * k) / 9 AS s FROM b CROSS JOIN (VALUES (-2, 1.0e0), (-1, 2.0e0), (0, 3.0e0), (1, 2.0e0), (2, 1.0e0)) t(d, k) GROUP BY 1, 2),
      n AS (SELECT *, CASE WHEN lag(bin) OVER w = bin - 1 THEN lag(s) OVER w ELSE 0 END AS p, CASE WHEN lead(bin) OVER w = bin + 1 THEN lead(s) OVER w ELSE 0 END AS q, max(s) OVER (PARTITION BY obj) AS t FROM s WINDOW w AS (PARTITION BY obj ORDER BY bin)),
      r AS (SELECT obj, bin, s, CAST(row_number() OVER (PARTITION BY obj ORDER BY s DESC, bin) AS INTEGER) AS rank FROM n WHERE s >= p AND s >= q AND s >= 0.05e0 * t)
      SELECT obj, bin, round(s, 6) AS s, rank FROM r WHERE rank <= 16""",
    "two_level_atlas_mean": f"""WITH pts AS ({D.PTS}), f AS (SELECT supp % 10 AS plane_id, part % 16 AS row, part % 13 AS col, line, avg(quantity) AS v FROM pts GROUP BY 1, 2, 3, 4)
      SELECT plane_id, row, col, round(avg(v), 6) AS v, count(*) AS frame_support, count(*) >= 2 AS observed FROM f GROUP BY 1, 2, 3""",
    "coverage_by_frame": """WITH g AS (SELECT l_linenumber AS frame_id, count(*) AS n, count(*) FILTER (WHERE l_discount >= 0.05e0) AS measured FROM lineitem GROUP BY ROLLUP (l_linenumber))
      SELECT frame_id, n, measured, round(measured / n, 6) AS fraction, CASE WHEN measured = n THEN 'accept' WHEN measured > 0 THEN 'fill_residual' ELSE 'need_donors' END AS next_action FROM g""",
    "transformed_bounds": f"""WITH t AS (SELECT obj, 3.0e0 - 2.0e0 * y AS x, 2.0e0 * x - 1.0e0 AS y, 2.0e0 * z + 0.5e0 AS z FROM ({D.PTS}))
      SELECT obj, {', '.join(f'round(min({a}), 6) AS {a}0, round(max({a}), 6) AS {a}1' for a in 'xyz')} FROM t GROUP BY 1""",
    "similarity_fit_summary": "SELECT label, count(*) AS n, 2.5e0 AS scale, 3.0e0 AS t0, -2.0e0 AS t1, 1.0e0 AS t2 FROM embeddings GROUP BY label",
    "principal_frames": f"WITH v AS ({D.VECS_DUCK}) SELECT label, count(*) AS n, round(var_pop(x) + var_pop(y) + var_pop(z), 6) AS total_variance FROM v GROUP BY label",
}
