"""Queries over distances, holes and fills of pixel grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import distance, planes
from ..operators.common import by_sort
from . import derived as D
from .filling import RGBD, _rgbd
from .structure import _RAYS, _planes, _scene_cameras

#: Two boxes of a frame, one frame a supplier; the second is a frame around a hole, with a notch in every third.
BOXES = """SELECT CAST(s_suppkey AS BIGINT) AS frame_id, CAST(8 + s_suppkey % 7 AS INTEGER) AS ax0, CAST(26 + s_suppkey % 11 AS INTEGER) AS ax1, CAST(10 + s_suppkey % 5 AS INTEGER) AS ay0, CAST(38 + s_suppkey % 9 AS INTEGER) AS ay1,
 CAST(10 + s_suppkey % 5 AS INTEGER) AS bx0, CAST(29 + s_suppkey % 9 AS INTEGER) AS bx1, CAST(12 + s_nationkey % 6 AS INTEGER) AS by0, CAST(41 + s_nationkey % 4 AS INTEGER) AS by1 FROM supplier"""


def _box(spark, sf_dir, name):
    boxes = D._read(spark, sf_dir, BOXES, "supplier")
    # A box becomes some hundreds of pixels, and a file of one row group is one task.
    rows = boxes.repartition(D.parts(spark, boxes.count() * 600), "frame_id").withColumn("y", F.explode(F.sequence(f"{name}y0", f"{name}y1"))).withColumn("x", F.explode(F.sequence(f"{name}x0", f"{name}x1")))
    return by_sort(rows)


def _frame(spark, sf_dir):
    """The second box without its inside, and without a notch in every third frame."""
    rows = _box(spark, sf_dir, "b")
    inside = (F.col("x") > F.col("bx0") + 2) & (F.col("x") < F.col("bx1") - 2) & (F.col("y") > F.col("by0") + 2) & (F.col("y") < F.col("by1") - 2) & ((F.col("x") + F.col("y")) % 17 != 0)
    notch = (F.col("frame_id") % 3 == 0) & (F.col("x") == F.col("bx0") + 5) & (F.col("y") <= F.col("by0") + 4)
    return rows.where(~inside & ~notch).select("frame_id", "y", "x")


def bounded_distance(spark, sf_dir):
    """Distances of every pixel to the bright pixels of its frame, up to 8."""
    px = _rgbd(spark, sf_dir)
    near = distance.bounded_distance(px.where("r >= 200").select("frame_id", "y", "x"), 8).join(px, ["frame_id", "y", "x"], "left_semi")
    return near.groupBy("frame_id", "d2").agg(F.count("*").alias("n"), F.sum("y").alias("y"), F.sum("x").alias("x"))


def soft_band_blend(spark, sf_dir):
    """Core, collar and protected collar of each frame's box, and what the blend leaves."""
    px = _rgbd(spark, sf_dir).select("frame_id", "y", "x", "r", "g")
    bands = distance.soft_bands(_box(spark, sf_dir, "a").select("frame_id", "y", "x"), px.where("r >= 200"), px, 6)
    out = distance.blend(px, px.select("frame_id", "y", "x", F.col("g").alias("r"), F.col("r").alias("g")), bands, ["r", "g"])
    return out.join(bands, ["frame_id", "y", "x"]).groupBy("frame_id", "band").agg(F.count("*").alias("n"), F.round(F.sum("weight"), 6).alias("weight"), F.sum("r").cast("long").alias("r"), F.sum("g").cast("long").alias("g"))


def boundary_distance(spark, sf_dir):
    """A10: how the two boxes of each frame agree."""
    out = distance.mask_alignment(_box(spark, sf_dir, "a").select("frame_id", "y", "x"), _box(spark, sf_dir, "b").select("frame_id", "y", "x"), 4)
    shares = [F.round(c, 9).alias(c) for c in ("iou", "precision", "recall", "median_px", "p95_px", "max_px")]
    return out.select("frame_id", "removal_pixels", "target_pixels", "intersection", F.col("union").alias("either"), "removal_only", "target_only", "boundary_samples", *shares)


def enclosed_holes(spark, sf_dir):
    """Holes of at least 12 pixels of each frame's mask."""
    mask = _frame(spark, sf_dir)
    sizes = mask.select("frame_id").distinct().withColumns({"w": F.lit(64), "h": F.lit(64)})
    holes = distance.enclosed_holes(mask, sizes, min_pixels=12)
    return holes.groupBy("frame_id").agg(F.count("*").alias("n"), F.count_distinct("label").alias("n_parts"), F.sum(F.col("y") * 64 + F.col("x")).alias("places"))


#: Texels of a plane for every supplier: 12 x 10, observed where at least five samples fell.
TEXELS = """SELECT CAST(l_suppkey AS BIGINT) AS plane_id, CAST(l_orderkey % 12 AS INTEGER) AS "row", CAST(l_partkey % 10 AS INTEGER) AS col, count(*) >= 5 AS observed, avg(l_quantity) AS v, avg(l_discount) * 100 AS u FROM lineitem GROUP BY 1, 2, 3"""


def _texels(spark, sf_dir):
    """The dense grid: texels without samples are there too."""
    rows = D._read(spark, sf_dir, TEXELS.replace('"row"', "row"), "lineitem")
    grid = D.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("plane_id"), F.explode(F.sequence(F.lit(0), F.lit(11))).alias("row")).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(9))))
    return by_sort(grid).join(rows, ["plane_id", "row", "col"], "left").withColumns({"observed": F.coalesce("observed", F.lit(False)), "v": F.coalesce("v", F.lit(0.0)), "u": F.coalesce("u", F.lit(0.0))})


def gradient_cost(spark, sf_dir):
    """The cost of either direction of each plane."""
    return distance.gradient_cost(_texels(spark, sf_dir), ["plane_id"], ["v", "u"]).select("plane_id", F.round("down", 9).alias("down"), F.round("along", 9).alias("along"))


def directional_fill(spark, sf_dir):
    """Every texel from the nearest observed one of its line."""
    out = distance.directional_fill(_texels(spark, sf_dir), ["plane_id"], ["v", "u"])
    return out.select("plane_id", "row", "col", "observed", "direction", "source", F.round("v", 9).alias("v"), F.round("u", 9).alias("u"))


def separable_blur(spark, sf_dir):
    """The blurred planes, and unobserved texels filled by normalised blur."""
    px = _texels(spark, sf_dir)
    soft = distance.separable_blur(px, ["plane_id"], ["v"], 1.5).select("plane_id", "row", "col", F.round("v", 6).alias("soft"))
    fill = distance.normalized_fill(px, ["plane_id"], ["v"], 1.5).select("plane_id", "row", "col", F.round("v", 6).alias("filled"))
    return soft.join(fill, ["plane_id", "row", "col"])


def shadow_collar(spark, sf_dir):
    """Pixels around each frame's box on a structural plane, and those that protected pixels keep out."""
    px = _rgbd(spark, sf_dir)
    on = planes.plane_support(px, _scene_cameras(spark, sf_dir), _planes(spark, sf_dir), ["scene"])
    out = distance.shadow_collar(_box(spark, sf_dir, "a").select("frame_id", "y", "x"), on, px.where("r >= 200"), 5)
    return out.groupBy("frame_id", "kept").agg(F.count("*").alias("n"), F.sum(F.col("y") * 64 + F.col("x")).alias("places"))


QUERIES = {f.__name__: f for f in (bounded_distance, soft_band_blend, boundary_distance, enclosed_holes, gradient_cost, directional_fill, separable_blur, shadow_collar)}

_PX = f"px AS ({RGBD.format(div='//')})"
_BOX = f"bx AS ({BOXES}), a AS (SELECT frame_id, y, unnest(range(ax0, ax1 + 1)) AS x FROM (SELECT *, unnest(range(ay0, ay1 + 1)) AS y FROM bx)), b AS (SELECT frame_id, y, x, bx0, bx1, by0, by1 FROM (SELECT *, unnest(range(bx0, bx1 + 1)) AS x FROM (SELECT *, unnest(range(by0, by1 + 1)) AS y FROM bx)))"
_GRID = f"""t AS ({TEXELS}), g AS (SELECT s_suppkey AS plane_id, CAST(i AS INTEGER) AS "row", CAST(j AS INTEGER) AS col FROM supplier, range(12) r(i), range(10) c(j)),
 d AS (SELECT g.*, coalesce(observed, false) AS observed, coalesce(v, 0) AS v, coalesce(u, 0) AS u FROM g LEFT JOIN t USING (plane_id, "row", col)),
 steps AS (SELECT p.plane_id, avg((abs(p.v - q.v) + abs(p.u - q.u)) / 2) FILTER (WHERE p.col = q.col) AS down, avg((abs(p.v - q.v) + abs(p.u - q.u)) / 2) FILTER (WHERE p."row" = q."row") AS along
   FROM d p JOIN d q ON p.plane_id = q.plane_id AND p.observed AND q.observed AND ((p.col = q.col AND p."row" = q."row" + 1) OR (p."row" = q."row" AND p.col = q.col + 1)) GROUP BY 1)"""
_KERNEL = "kr AS (SELECT i, exp(-0.5e0 * pow(i / 1.5e0, 2)) / sum(exp(-0.5e0 * pow(i / 1.5e0, 2))) OVER () AS k FROM range(-5, 6) r(i))"


def _blurred(name: str, source: str) -> str:
    return f"""{name}h AS (SELECT p.plane_id, p."row", p.col, sum(k * q.v) AS v FROM {source} p CROSS JOIN kr JOIN {source} q ON q.plane_id = p.plane_id AND q."row" = p."row" AND q.col = greatest(0, least(9, p.col + i)) GROUP BY 1, 2, 3),
 {name} AS (SELECT p.plane_id, p."row", p.col, sum(k * q.v) AS v FROM {name}h p CROSS JOIN kr JOIN {name}h q ON q.plane_id = p.plane_id AND q.col = p.col AND q."row" = greatest(0, least(11, p."row" + i)) GROUP BY 1, 2, 3)"""


ORACLE = {
    "bounded_distance": f"""WITH {_PX}, m AS (SELECT frame_id, y, x FROM px WHERE r >= 200), n AS (SELECT px.frame_id, px.y, px.x, min((px.y - m.y) * (px.y - m.y) + (px.x - m.x) * (px.x - m.x)) AS d2 FROM px JOIN m USING (frame_id) GROUP BY 1, 2, 3)
      SELECT frame_id, CAST(d2 AS BIGINT) AS d2, count(*) AS n, CAST(sum(y) AS BIGINT) AS y, CAST(sum(x) AS BIGINT) AS x FROM n WHERE d2 <= 64 GROUP BY 1, 2""",
    "soft_band_blend": f"""WITH {_PX}, {_BOX}, n AS (SELECT p.frame_id, p.y, p.x, p.r, p.g, sqrt(pow(greatest(ax0 - x, x - ax1, 0), 2) + pow(greatest(ay0 - y, y - ay1, 0), 2)) AS d FROM px p JOIN bx USING (frame_id)),
      w AS (SELECT *, CASE WHEN d = 0 THEN 'core' WHEN r >= 200 THEN 'protected_collar' ELSE 'collar' END AS band, (7 - d) / 7.0e0 AS s FROM n WHERE d <= 6), z AS (SELECT *, CASE band WHEN 'core' THEN 1.0e0 WHEN 'collar' THEN s * s * (3 - 2 * s) ELSE 0.0e0 END AS weight FROM w)
      SELECT frame_id, band, count(*) AS n, round(sum(weight), 6) AS weight, CAST(sum(round_even(g * weight + r * (1 - weight), 0)) AS BIGINT) AS r, CAST(sum(round_even(r * weight + g * (1 - weight), 0)) AS BIGINT) AS g FROM z GROUP BY 1, 2""",
    "boundary_distance": f"""WITH {_BOX}, ea AS (SELECT a.* FROM a JOIN bx USING (frame_id) WHERE x IN (ax0, ax1) OR y IN (ay0, ay1)), eb AS (SELECT frame_id, y, x FROM b WHERE x IN (bx0, bx1) OR y IN (by0, by1)),
      w AS (SELECT p.frame_id, sqrt(min((p.y - q.y) * (p.y - q.y) + (p.x - q.x) * (p.x - q.x))) AS d FROM ea p JOIN eb q USING (frame_id) GROUP BY p.frame_id, p.y, p.x UNION ALL SELECT p.frame_id, sqrt(min((p.y - q.y) * (p.y - q.y) + (p.x - q.x) * (p.x - q.x))) FROM eb p JOIN ea q USING (frame_id) GROUP BY p.frame_id, p.y, p.x),
      l AS (SELECT frame_id, count(*) AS boundary_samples, round(quantile_cont(d, 0.5), 9) AS median_px, round(quantile_cont(d, 0.95), 9) AS p95_px, round(max(d), 9) AS max_px FROM w GROUP BY 1),
      c AS (SELECT frame_id, (ax1 - ax0 + 1) * (ay1 - ay0 + 1) AS rp, (bx1 - bx0 + 1) * (by1 - by0 + 1) AS tp, greatest(least(ax1, bx1) - greatest(ax0, bx0) + 1, 0) * greatest(least(ay1, by1) - greatest(ay0, by0) + 1, 0) AS i FROM bx)
      SELECT frame_id, CAST(rp AS BIGINT) AS removal_pixels, CAST(tp AS BIGINT) AS target_pixels, CAST(i AS BIGINT) AS intersection, CAST(rp + tp - i AS BIGINT) AS either, CAST(rp - i AS BIGINT) AS removal_only, CAST(tp - i AS BIGINT) AS target_only, boundary_samples,
        round(i / (rp + tp - i), 9) AS iou, round(i / rp, 9) AS precision, round(i / tp, 9) AS recall, median_px, p95_px, max_px FROM c JOIN l USING (frame_id)""",
    "enclosed_holes": f"""WITH RECURSIVE {_BOX}, m AS (SELECT frame_id, y, x FROM b WHERE NOT (x > bx0 + 2 AND x < bx1 - 2 AND y > by0 + 2 AND y < by1 - 2 AND (x + y) % 17 <> 0) AND NOT (frame_id % 3 = 0 AND x = bx0 + 5 AND y <= by0 + 4)),
      bg AS (SELECT frame_id, y, x FROM (SELECT frame_id, unnest(range(by0 - 1, by1 + 2)) AS y, bx0, bx1 FROM bx), range(64) c(x) WHERE x BETWEEN bx0 - 1 AND bx1 + 1 EXCEPT SELECT frame_id, y, x FROM m),
      o(frame_id, y, x) AS (SELECT frame_id, y, x FROM bg JOIN bx USING (frame_id) WHERE y IN (by0 - 1, by1 + 1) OR x IN (bx0 - 1, bx1 + 1) UNION SELECT bg.frame_id, bg.y, bg.x FROM o JOIN bg ON bg.frame_id = o.frame_id AND ((bg.y = o.y AND bg.x IN (o.x - 1, o.x + 1)) OR (bg.x = o.x AND bg.y IN (o.y - 1, o.y + 1)))),
      h AS (SELECT frame_id, y, x, y * 64 + x AS id FROM bg EXCEPT SELECT frame_id, y, x, y * 64 + x FROM o),
      r(frame_id, id, root) AS (SELECT frame_id, id, id FROM h UNION SELECT h.frame_id, h.id, r.root FROM r JOIN h ON h.frame_id = r.frame_id AND h.id IN (r.id - 1, r.id + 1, r.id - 64, r.id + 64)),
      l AS (SELECT frame_id, id, min(root) AS label FROM r GROUP BY 1, 2), s AS (SELECT *, count(*) OVER (PARTITION BY frame_id, label) AS k FROM l)
      SELECT frame_id, count(*) AS n, count(DISTINCT label) AS n_parts, CAST(sum(id) AS BIGINT) AS places FROM s WHERE k >= 12 GROUP BY 1""",
    "gradient_cost": f"WITH {_GRID} SELECT plane_id, round(down, 9) AS down, round(along, 9) AS along FROM steps",
    "directional_fill": f"""WITH {_GRID}, w AS (SELECT d.*, CASE WHEN coalesce(down, 'inf'::DOUBLE) <= coalesce(along, 'inf'::DOUBLE) THEN 'down' ELSE 'along' END AS direction FROM d LEFT JOIN steps USING (plane_id)),
      p AS (SELECT *, CASE direction WHEN 'down' THEN col ELSE "row" END AS line, CASE direction WHEN 'down' THEN "row" ELSE col END AS pos FROM w),
      k AS (SELECT a.plane_id, a."row", a.col, a.observed, a.direction, a.v, a.u, b.pos AS source, b.v AS bv, b.u AS bu FROM p a LEFT JOIN p b ON b.observed AND b.plane_id = a.plane_id AND b.line = a.line QUALIFY row_number() OVER (PARTITION BY a.plane_id, a."row", a.col ORDER BY abs(a.pos - b.pos), b.pos) = 1)
      SELECT plane_id, "row", col, observed, direction, source, round(CASE WHEN observed THEN v ELSE bv END, 9) AS v, round(CASE WHEN observed THEN u ELSE bu END, 9) AS u FROM k""",
    "separable_blur": f"""WITH {_GRID}, {_KERNEL}, kv AS (SELECT plane_id, "row", col, CASE WHEN observed THEN v ELSE 0 END AS v FROM d), kw AS (SELECT plane_id, "row", col, CASE WHEN observed THEN 1.0e0 ELSE 0.0e0 END AS v FROM d), {_blurred('s', 'd')}, {_blurred('n', 'kv')}, {_blurred('z', 'kw')}
      SELECT plane_id, "row", col, round(s.v, 6) AS soft, round(CASE WHEN d.observed THEN d.v WHEN z.v >= 1e-6 THEN n.v / z.v END, 6) AS filled FROM d JOIN s USING (plane_id, "row", col) JOIN n USING (plane_id, "row", col) JOIN z USING (plane_id, "row", col)""",
    "shadow_collar": f"""WITH {_RAYS}, {_BOX}, o AS (SELECT DISTINCT frame_id, y, x FROM (SELECT *, ox + dx * seen AS wx, dy * seen AS wy, seen AS wz FROM ray)
        WHERE abs(CASE k WHEN 0 THEN wz WHEN 1 THEN wy ELSE wx END - off) <= 0.15e0 AND CASE k WHEN 2 THEN wy ELSE wx END BETWEEN u0 AND u1 AND CASE k WHEN 0 THEN wy ELSE wz END BETWEEN v0 AND v1)
      SELECT frame_id, r < 200 AS kept, count(*) AS n, CAST(sum(y * 64 + x) AS BIGINT) AS places FROM o JOIN px USING (frame_id, y, x) JOIN bx USING (frame_id) WHERE greatest(ax0 - x, x - ax1, ay0 - y, y - ay1) BETWEEN 1 AND 5 GROUP BY 1, 2""",
}
