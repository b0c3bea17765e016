"""Queries over flows and sequences of frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import temporal
from . import derived as D

#: Regions and images are 48 x 48, a frame for every supplier, eight frames a sequence; a region needs this many valid pixels here.
LIMITS = {"region_pixels": 100}
CORE, CONTROL = "x BETWEEN 16 AND 31 AND y BETWEEN 16 AND 31", "x BETWEEN 7 AND 40 AND y BETWEEN 7 AND 40 AND NOT (x BETWEEN 12 AND 35 AND y BETWEEN 12 AND 35)"
#: A pattern of light that moves by (0.5, 0.25) a frame, with an exposure by frame, and flicker in the cores of some.
IMAGE = """SELECT frame_id, y, x, (80.0e0 + 2 * px + py) * gain + off + fl AS r, (90.0e0 + px + 2 * py) * gain + off + fl AS g, (100.0e0 + 1.5e0 * px - py) * gain + off + fl AS b FROM (
 SELECT frame_id, y, x, x - 0.5e0 * (frame_id % 8) AS px, y - 0.25e0 * (frame_id % 8) AS py, 1.0e0 + (frame_id % 3) * 0.1e0 AS gain, (frame_id % 5) * 1.0e0 AS off, CASE WHEN nation % 4 = 0 AND x BETWEEN 17 AND 30 AND y BETWEEN 17 AND 30 THEN (x * y % 7) * sqrt(82.0e0) ELSE 0.0e0 END AS fl FROM {grid})"""
FLOW = """SELECT src, dst, y, x, (dst - src) * 0.5e0 + CASE WHEN dst < src AND nation % 5 = 0 AND y % 3 = 0 THEN 2.5e0 ELSE 0.0e0 END AS dx, (dst - src) * 0.25e0 AS dy FROM {grid}"""


def _grid(spark, sf_dir):
    rows = D.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("frame_id"), F.col("s_nationkey").alias("nation"))
    rows = rows.repartition(D.parts(spark, rows.count() * 48 * 48), "frame_id")  # dealt before each row becomes an image
    rows.withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(47)))).withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(47)))).createOrReplaceTempView("scene_grid")
    steps = rows.withColumn("dst", F.explode(F.array(F.col("frame_id") - 1, F.col("frame_id") + 1))).withColumnRenamed("frame_id", "src").where("src div 8 = dst div 8")
    steps = steps.join(rows.select(F.col("frame_id").alias("dst")), "dst", "left_semi")
    steps.withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(47)))).withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(47)))).createOrReplaceTempView("scene_steps")
    return rows


def _inputs(spark, sf_dir):
    rows = _grid(spark, sf_dir)
    grid = spark.table("scene_grid")
    regions = grid.where(CORE).select("frame_id", "y", "x", F.lit("core").alias("region")).union(grid.where(CONTROL).select("frame_id", "y", "x", F.lit("control")))
    sizes = rows.select("frame_id", F.lit(48).alias("w"), F.lit(48).alias("h"))
    return spark.sql(FLOW.format(grid="scene_steps")), regions, sizes, spark.sql(IMAGE.format(grid="scene_grid"))


def flow_validity(spark, sf_dir):
    """What of each region can be followed to the neighbouring frames."""
    flow, regions, sizes, _ = _inputs(spark, sf_dir)
    out = temporal.pair_coverage(temporal.flow_validity(flow, regions, sizes))
    return out.select("src", "dst", *(f"{r}_{c}" for r in ("core", "control") for c in ("pixels", "overlap", "consistent", "valid")), *(F.round(f"{r}_{c}", 9).alias(f"{r}_{c}") for r in ("core", "control") for c in ("fb_p95", "valid_fraction")))


def temporal_pair_qa(spark, sf_dir):
    """Every directed pair against its gates."""
    out = temporal.temporal_pairs(*_inputs(spark, sf_dir), limits=LIMITS)[0]
    measures = [F.round(c, 6).alias(c) for c in ("control_colour_p95", "core_colour_mean", "core_colour_p95", "core_gradient_p95", "bad_pixel_fraction", "core_excess_p95")]
    return out.select("src", "dst", "evaluable", "reason", "passed", F.array_join("failed_gates", ",").alias("failed"), *measures)


def temporal_triplet_qa(spark, sf_dir):
    """Every triplet of neighbouring frames."""
    flow, regions, sizes, images = _inputs(spark, sf_dir)
    pixels = temporal.temporal_pairs(flow, regions, sizes, images, limits=LIMITS)[1]
    steps = flow.select("src", "dst").distinct()
    triplets = steps.where("dst < src").select(F.col("dst").alias("previous"), F.col("src").alias("centre")).join(steps.where("dst > src").select(F.col("src").alias("centre"), F.col("dst").alias("following")), "centre")
    out = temporal.temporal_triplets(triplets, pixels, regions, temporal.flow_validity(flow, regions, sizes), limits=LIMITS)
    return out.select("previous", "centre", "following", "core_valid", "control_valid", "evaluable", "reason", "passed", F.array_join("failed_gates", ",").alias("failed"), *(F.round(c, 6).alias(c) for c in ("core_mean", "core_difference_p95", "excess_p95")))


QUERIES = {f.__name__: f for f in (flow_validity, temporal_pair_qa, temporal_triplet_qa)}

_SEQ = f"""gr AS (SELECT s_suppkey AS frame_id, s_nationkey AS nation, y, x FROM supplier, range(48) a(y), range(48) b(x)), im AS ({IMAGE.format(grid='gr')}), rg AS (SELECT frame_id, y, x, 'core' AS region FROM gr WHERE {CORE} UNION ALL SELECT frame_id, y, x, 'control' FROM gr WHERE {CONTROL}),
 st AS (SELECT a.frame_id AS src, a.frame_id + d AS dst, nation, y, x FROM gr a, (SELECT unnest([-1, 1]) AS d) WHERE a.frame_id // 8 = (a.frame_id + d) // 8 AND a.frame_id + d IN (SELECT s_suppkey FROM supplier)), fl AS ({FLOW.format(grid='st')}),
 cn AS (SELECT * FROM (SELECT unnest([0, 1]) AS i), (SELECT unnest([0, 1]) AS j)), ow AS (SELECT f.*, region, f.x + dx AS tx, f.y + dy AS ty, greatest(0, least(47, f.x + dx)) AS cx, greatest(0, least(47, f.y + dy)) AS cy FROM fl f JOIN rg ON rg.frame_id = f.src AND rg.y = f.y AND rg.x = f.x),
 co AS (SELECT src, dst, y, x, floor(cy) + j AS qy, floor(cx) + i AS qx, (CASE i WHEN 1 THEN cx - floor(cx) ELSE 1 - (cx - floor(cx)) END) * (CASE j WHEN 1 THEN cy - floor(cy) ELSE 1 - (cy - floor(cy)) END) AS k FROM ow, cn),
 bk AS (SELECT c.src, c.dst, c.y, c.x, sum(k * f.dx) AS bx, sum(k * f.dy) AS by_ FROM co c JOIN fl f ON f.src = c.dst AND f.dst = c.src AND f.y = qy AND f.x = qx WHERE k > 0 GROUP BY 1, 2, 3, 4),
 va AS (SELECT o.src, o.dst, o.y, o.x, o.region, sqrt(pow(dx + bx, 2) + pow(dy + by_, 2)) AS e, tx BETWEEN 0 AND 47 AND ty BETWEEN 0 AND 47 AS ins, e <= 1.5e0 + 0.01e0 * sqrt(dx * dx + dy * dy) AND ins AS con, ins AND t.frame_id IS NOT NULL AS ov
   FROM ow o JOIN bk USING (src, dst, y, x) LEFT JOIN rg t ON t.frame_id = o.dst AND t.region = o.region AND t.y = greatest(0, least(47, round_even(ty, 0))) AND t.x = greatest(0, least(47, round_even(tx, 0)))),
 cv AS (SELECT src, dst, {', '.join(f"count(*) FILTER (WHERE region = '{r}'{c}) AS {r}_{n}" for r in ('core', 'control') for n, c in (('pixels', ''), ('overlap', ' AND ov'), ('consistent', ' AND con'), ('valid', ' AND ov AND con')))}, {', '.join(f"quantile_cont(e, 0.95) FILTER (WHERE region = '{r}' AND ov AND con) AS {r}_fb_p95" for r in ('core', 'control'))} FROM va GROUP BY 1, 2)"""
_WARPED = f"""wp AS (SELECT v.src, v.dst, v.y, v.x, v.region, sum(k * im.r) AS wr, sum(k * im.g) AS wg, sum(k * im.b) AS wb FROM va v JOIN co USING (src, dst, y, x) JOIN im ON im.frame_id = v.dst AND im.y = qy AND im.x = qx WHERE ov AND con AND k > 0 GROUP BY ALL),
 px AS (SELECT w.*, im.r, im.g, im.b FROM wp w JOIN im ON im.frame_id = w.src AND im.y = w.y AND im.x = w.x), ok AS (SELECT src, dst FROM cv WHERE core_valid >= 100 AND control_valid >= 100),
 ft AS (SELECT src, dst, {', '.join(f'regr_slope({c}, w{c}) AS a{c}, regr_intercept({c}, w{c}) AS z{c}' for c in 'rgb')} FROM px SEMI JOIN ok USING (src, dst) WHERE region = 'control' GROUP BY 1, 2),
 fx AS (SELECT px.src, px.dst, px.y, px.x, region, r, g, b, ar, ag, ab, {', '.join(f'w{c} * a{c} + z{c} AS f{c}' for c in 'rgb')} FROM px JOIN ft USING (src, dst)), er AS (SELECT *, (abs(r - fr) + abs(g - fg) + abs(b - fb)) / 3 AS e FROM fx)"""
_SOBEL = """h1 AS (SELECT frame_id, y, x, {h} FROM im WINDOW w AS (PARTITION BY frame_id, y ORDER BY x)), gd AS (SELECT frame_id, y, x, {v} FROM h1 WINDOW w AS (PARTITION BY frame_id, x ORDER BY y))""".format(
    h=", ".join(f"lead({c}, 1, {c}) OVER w - lag({c}, 1, {c}) OVER w AS d{c}, lag({c}, 1, {c}) OVER w + 2 * {c} + lead({c}, 1, {c}) OVER w AS s{c}" for c in "rgb"),
    v=", ".join(f"sqrt(pow((lag(d{c}, 1, d{c}) OVER w + 2 * d{c} + lead(d{c}, 1, d{c}) OVER w) / 8, 2) + pow((lead(s{c}, 1, s{c}) OVER w - lag(s{c}, 1, s{c}) OVER w) / 8, 2)) AS {c}" for c in "rgb"),
)
_FEW = "CASE WHEN core_valid < 100 THEN 'too few valid core pixels' WHEN control_valid < 100 THEN 'too few valid control pixels' END"

ORACLE = {
    "flow_validity": f"""WITH {_SEQ} SELECT src, dst, {', '.join(f'{r}_{c}' for r in ('core', 'control') for c in ('pixels', 'overlap', 'consistent', 'valid'))}, {', '.join(f'round({r}_fb_p95, 9) AS {r}_fb_p95, round({r}_valid / {r}_pixels, 9) AS {r}_valid_fraction' for r in ('core', 'control'))} FROM cv""",
    "temporal_pair_qa": f"""WITH {_SEQ}, {_WARPED}, {_SOBEL}, bt AS (SELECT v.src, v.dst, v.y, v.x, sum(k * gd.r) AS br, sum(k * gd.g) AS bg, sum(k * gd.b) AS bb FROM va v JOIN co USING (src, dst, y, x) JOIN gd ON gd.frame_id = v.dst AND gd.y = qy AND gd.x = qx WHERE ov AND con AND k > 0 AND v.region = 'core' GROUP BY ALL),
      sl AS (SELECT e.src, e.dst, (abs(gd.r - br * abs(ar)) + abs(gd.g - bg * abs(ag)) + abs(gd.b - bb * abs(ab))) / 3 AS s FROM er e JOIN bt USING (src, dst, y, x) JOIN gd ON gd.frame_id = e.src AND gd.y = e.y AND gd.x = e.x), sm AS (SELECT src, dst, quantile_cont(s, 0.95) AS gp FROM sl GROUP BY 1, 2),
      m AS (SELECT src, dst, quantile_cont(e, 0.95) FILTER (WHERE region = 'control') AS np, avg(e) FILTER (WHERE region = 'core') AS cm, quantile_cont(e, 0.95) FILTER (WHERE region = 'core') AS cp, avg(CASE WHEN e > 24 THEN 1.0e0 ELSE 0.0e0 END) FILTER (WHERE region = 'core') AS bad FROM er GROUP BY 1, 2),
      a AS (SELECT *, {_FEW} AS reason FROM cv LEFT JOIN m USING (src, dst) LEFT JOIN sm USING (src, dst))
      SELECT src, dst, reason IS NULL AS evaluable, reason, coalesce(failed = '', false) AS passed, failed, round(np, 6) AS control_colour_p95, round(cm, 6) AS core_colour_mean, round(cp, 6) AS core_colour_p95, round(gp, 6) AS core_gradient_p95, round(bad, 6) AS bad_pixel_fraction, round(cp - np, 6) AS core_excess_p95
      FROM (SELECT *, CASE WHEN reason IS NULL THEN array_to_string(list_filter([CASE WHEN core_valid / core_pixels < 0.7e0 THEN 'core_valid_fraction' END, CASE WHEN control_valid / control_pixels < 0.8e0 THEN 'control_valid_fraction' END, CASE WHEN np > 20 THEN 'control_colour_p95' END, CASE WHEN cp > 24 THEN 'core_colour_p95' END,
        CASE WHEN cp - np > 8 THEN 'core_excess_p95' END, CASE WHEN gp > 32 THEN 'core_gradient_p95' END, CASE WHEN bad > 0.1e0 THEN 'bad_pixel_fraction' END], lambda s: s IS NOT NULL), ',') END AS failed FROM a)""",
    "temporal_triplet_qa": f"""WITH {_SEQ}, {_WARPED}, tr AS (SELECT s_suppkey - 1 AS previous, s_suppkey AS centre, s_suppkey + 1 AS following FROM supplier WHERE s_suppkey // 8 = (s_suppkey - 1) // 8 AND s_suppkey // 8 = (s_suppkey + 1) // 8 AND s_suppkey - 1 IN (SELECT s_suppkey FROM supplier) AND s_suppkey + 1 IN (SELECT s_suppkey FROM supplier)),
      bo AS (SELECT tr.*, p.y, p.x, p.region FROM tr JOIN va p ON p.src = centre AND p.dst = previous AND p.ov AND p.con JOIN va n ON n.src = centre AND n.dst = following AND n.y = p.y AND n.x = p.x AND n.ov AND n.con),
      c AS (SELECT tr.*, count(*) FILTER (WHERE region = 'core') AS core_valid, count(*) FILTER (WHERE region = 'control') AS control_valid FROM tr LEFT JOIN bo USING (previous, centre, following) GROUP BY ALL),
      d AS (SELECT bo.*, (abs(p.r - (p.fr + n.fr) / 2) + abs(p.g - (p.fg + n.fg) / 2) + abs(p.b - (p.fb + n.fb) / 2)) / 3 AS e FROM bo JOIN fx p ON p.src = centre AND p.dst = previous AND p.y = bo.y AND p.x = bo.x JOIN fx n ON n.src = centre AND n.dst = following AND n.y = bo.y AND n.x = bo.x),
      m AS (SELECT previous, centre, following, avg(e) FILTER (WHERE region = 'core') AS cm, quantile_cont(e, 0.95) FILTER (WHERE region = 'core') AS cp, quantile_cont(e, 0.95) FILTER (WHERE region = 'control') AS np, avg(e) FILTER (WHERE region = 'control') AS nm FROM d GROUP BY ALL),
      a AS (SELECT *, coalesce({_FEW}, CASE WHEN cm IS NULL OR nm IS NULL THEN 'an exposure fit is missing' END) AS reason FROM c LEFT JOIN m USING (previous, centre, following))
      SELECT previous, centre, following, core_valid, control_valid, reason IS NULL AS evaluable, reason, coalesce(failed = '', false) AS passed, failed, round(cm, 6) AS core_mean, round(cp, 6) AS core_difference_p95, round(cp - np, 6) AS excess_p95
      FROM (SELECT *, CASE WHEN reason IS NULL THEN array_to_string(list_filter([CASE WHEN core_valid / 256 < 0.5e0 THEN 'triplet_valid_fraction' END, CASE WHEN cp > 20 THEN 'triplet_difference_p95' END, CASE WHEN cp - np > 6 THEN 'triplet_excess_p95' END], lambda s: s IS NOT NULL), ',') END AS failed FROM a)""",
}
