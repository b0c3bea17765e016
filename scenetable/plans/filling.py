"""Queries over donors and removed regions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import prefill
from ..operators.common import checkpointed
from . import derived as D

#: RGB-D pixels of 64 x 64: a frame for every supplier, eight frames a scene, cameras in a row.
RGBD = """SELECT CAST(l_suppkey AS BIGINT) AS frame_id, CAST((l_orderkey % 4096) {div} 64 AS INTEGER) AS y, CAST(l_orderkey % 64 AS INTEGER) AS x,
 4.0e0 + max(l_discount) AS depth, CAST(floor(avg(l_quantity) * 5) AS INTEGER) AS r, CAST(max(l_linenumber) * 30 AS INTEGER) AS g, CAST(min(l_linenumber) * 20 AS INTEGER) AS b
 FROM lineitem GROUP BY 1, 2, 3"""
#: The removed region of a frame and the object in it, which stands elsewhere in every frame.
REMOVED, OBJECT = "x BETWEEN 18 AND 45 AND y BETWEEN 18 AND 45", "x BETWEEN 28 + frame_id % 8 AND 33 + frame_id % 8 AND y BETWEEN 29 AND 34"


def _rgbd(spark, sf_dir):
    """The pixels, dealt by frame, row and column before they are grouped: joins by pixel need no other shuffle of them."""
    return D.spread(spark, sf_dir, RGBD.format(div="div"), "lineitem", ["CAST(l_suppkey AS BIGINT)", "CAST((l_orderkey % 4096) div 64 AS INTEGER)", "CAST(l_orderkey % 64 AS INTEGER)"])


def _cameras(spark, sf_dir):
    one = F.array(*(F.lit(float(i % 4 == 0)) for i in range(9)))
    return D.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("long").alias("frame_id"), *(F.lit(v).alias(n) for n, v in (("fx", 64.0), ("fy", 64.0), ("cx", 32.0), ("cy", 32.0))), F.lit(64).alias("w"), F.lit(64).alias("h"),
        one.alias("r"), F.array(-((F.col("s_suppkey") % 8) * 0.125), F.lit(0.0), F.lit(0.0)).alias("t"),
    )


def _views(spark, sf_dir):
    """Each frame's donors: the eight frames of its scene."""
    frames = D.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("frame_id"), F.expr("s_suppkey div 8").alias("scene"))
    return frames.select("scene", F.col("frame_id").alias("donor_id")).join(frames, "scene").select("donor_id", "frame_id")


def reproject_nearest(spark, sf_dir):
    """All donors of all frames, their nearest pixels."""
    views = _views(spark, sf_dir).where("donor_id <> frame_id")
    out = prefill.reproject_pixels(_rgbd(spark, sf_dir), _cameras(spark, sf_dir), views)
    return out.groupBy("frame_id", "donor_id").agg(F.count("*").alias("n"), F.round(F.sum("depth"), 6).alias("depth"), F.sum("r").alias("r"), F.sum("g").alias("g"), F.sum("b").alias("b"))


def _filled(spark, sf_dir):
    px = checkpointed(_rgbd(spark, sf_dir))
    return prefill.donor_prefill(px, _cameras(spark, sf_dir), px.where(REMOVED), px.where(OBJECT), _views(spark, sf_dir))


def guard_stable_fuse(spark, sf_dir):
    """A5: what both exclusions support, and the retention of each frame."""
    frames = _filled(spark, sf_dir)[1]
    return frames.select("frame_id", "configured_pixels", "guard_pixels", "stable_pixels", F.round("retention", 9).alias("retention"), "passed", "failure_reason", "removed_pixels", F.round("coverage", 9).alias("coverage"))


def donor_prefill(spark, sf_dir):
    """Every pixel of every frame, filled from its donors."""
    out = _filled(spark, sf_dir)[0]
    return out.select("frame_id", "y", "x", "r", "g", "b", F.round("depth", 9).alias("depth"), F.col("support").cast("long").alias("support"), "label")


QUERIES = {f.__name__: f for f in (reproject_nearest, guard_stable_fuse, donor_prefill)}

_PX = f"""px AS ({RGBD.format(div='//')}), vw AS (SELECT a.s_suppkey AS donor_id, b.s_suppkey AS frame_id FROM supplier a JOIN supplier b ON a.s_suppkey // 8 = b.s_suppkey // 8 AND a.s_suppkey <> b.s_suppkey)"""


def _moved(name: str, free: str) -> str:
    """Common tables that move the pixels of `free` into their targets; `name` has the nearest."""
    return f"""{name}m AS (SELECT v.frame_id, v.donor_id, p.depth, p.r, p.g, p.b, p.y AS sy, p.x AS sx,
  round_even(64.0e0 * ((p.x - 32.0e0) / 64.0e0 * p.depth + (v.donor_id % 8) * 0.125e0 - (v.frame_id % 8) * 0.125e0) / p.depth + 32.0e0, 0) AS px, round_even(64.0e0 * ((p.y - 32.0e0) / 64.0e0 * p.depth) / p.depth + 32.0e0, 0) AS py
  FROM {free} p JOIN vw v ON v.donor_id = p.frame_id WHERE p.x % 2 = 0 AND p.y % 2 = 0),
 {name} AS (SELECT frame_id, donor_id, CAST(py + oy AS INTEGER) AS y, CAST(px + ox AS INTEGER) AS x, depth, r, g, b FROM {name}m, (SELECT unnest([-1, 0, 1]) AS oy), (SELECT unnest([-1, 0, 1]) AS ox)
  WHERE px + ox BETWEEN 0 AND 63 AND py + oy BETWEEN 0 AND 63 QUALIFY row_number() OVER (PARTITION BY frame_id, donor_id, py + oy, px + ox ORDER BY depth, oy, ox, sy, sx) = 1)"""


def _free(name: str, wide: int) -> str:
    return f"{name} AS (SELECT * FROM px p WHERE NOT EXISTS (SELECT 1 FROM ob o WHERE o.frame_id = p.frame_id AND abs(o.y - p.y) <= {wide} AND abs(o.x - p.x) <= {wide}))"


def _fused(name: str, samples: str) -> str:
    """Medians by window in place of grouped arrays: of each removed pixel, its samples' and then its inliers'."""
    return f"""{name}d AS (SELECT s.*, quantile_cont(s.depth, 0.5) OVER (PARTITION BY frame_id, y, x) AS m FROM {samples} s SEMI JOIN rm USING (frame_id, y, x)),
 {name} AS (SELECT frame_id, y, x, count(*) AS support, quantile_cont(depth, 0.5) AS depth, {', '.join(f'round_even(quantile_cont({c}, 0.5), 0) AS {c}' for c in 'rgb')}
  FROM {name}d WHERE abs(depth - m) <= greatest(0.08e0, 0.01e0 * m) GROUP BY 1, 2, 3 HAVING count(*) >= 2)"""


_FILLED = f"WITH {_PX}, rm AS (SELECT frame_id, y, x FROM px WHERE {REMOVED}), ob AS (SELECT frame_id, y, x FROM px WHERE {OBJECT}), {_free('f4', 4)}, {_free('f8', 8)}, {_moved('s4', 'f4')}, {_moved('s8', 'f8')}, {_fused('c', 's4')}, {_fused('g', 's8')}, st AS (SELECT g.* FROM g SEMI JOIN c USING (frame_id, y, x))"

ORACLE = {
    "reproject_nearest": f"""WITH {_PX}, {_moved('s', 'px')}
      SELECT frame_id, donor_id, count(*) AS n, round(sum(depth), 6) AS depth, CAST(sum(r) AS BIGINT) AS r, CAST(sum(g) AS BIGINT) AS g, CAST(sum(b) AS BIGINT) AS b FROM s GROUP BY 1, 2""",
    "guard_stable_fuse": f"""{_FILLED}, n AS (SELECT frame_id, count(*) AS removed_pixels FROM rm GROUP BY 1),
      k AS (SELECT frame_id, (SELECT count(*) FROM c WHERE c.frame_id = n.frame_id) AS configured_pixels, (SELECT count(*) FROM g WHERE g.frame_id = n.frame_id) AS guard_pixels, (SELECT count(*) FROM st WHERE st.frame_id = n.frame_id) AS stable_pixels, removed_pixels FROM n)
      SELECT frame_id, configured_pixels, guard_pixels, stable_pixels, round(CASE WHEN configured_pixels > 0 THEN stable_pixels / configured_pixels END, 9) AS retention, configured_pixels > 0 AND stable_pixels / configured_pixels >= 0.25e0 AS passed,
        CASE WHEN configured_pixels = 0 THEN 'no_configured_support' WHEN stable_pixels / configured_pixels < 0.25e0 THEN 'boundary_guard_retention_below_minimum' END AS failure_reason, removed_pixels, round(stable_pixels / removed_pixels, 9) AS coverage FROM k""",
    "donor_prefill": f"""{_FILLED} SELECT p.frame_id, p.y, p.x, {', '.join(f'CAST(coalesce(st.{c}, p.{c}) AS DOUBLE) AS {c}' for c in 'rgb')}, round(st.depth, 9) AS depth, coalesce(st.support, 0) AS support,
      CASE WHEN rm.frame_id IS NULL THEN 'source' WHEN st.frame_id IS NOT NULL THEN 'measured' ELSE 'residual' END AS label
      FROM px p SEMI JOIN (SELECT DISTINCT frame_id FROM rm) USING (frame_id) LEFT JOIN rm ON rm.frame_id = p.frame_id AND rm.y = p.y AND rm.x = p.x LEFT JOIN st ON st.frame_id = p.frame_id AND st.y = p.y AND st.x = p.x""",
}
