"""Queries over masks, images, layers and frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import composite, match, pixels
from . import derived as D


def _mask(spark, sf_dir, where):
    return D.image(spark, sf_dir).where(where).select("frame_id", "y", "x")


def mask_union_partition(spark, sf_dir):
    parts = pixels.mask_partition(_mask(spark, sf_dir, "v > 30"), _mask(spark, sf_dir, "d > 0.06"))
    return parts.groupBy("frame_id", "part").agg(F.count("*").alias("n"))


def dilate_radius_2(spark, sf_dir):
    return pixels.mask_geometry(pixels.dilate(_mask(spark, sf_dir, "v > 45"), 2), ["frame_id"]).select("frame_id", "area", "x0", "y0", "x1", "y1", F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy"))


def erode_and_ring(spark, sf_dir):
    mask = _mask(spark, sf_dir, "v > 8")
    a = pixels.erode(mask, 1).groupBy("frame_id").agg(F.count("*").alias("eroded"))
    b = pixels.inner_boundary(mask).groupBy("frame_id").agg(F.count("*").alias("boundary"))
    c = pixels.ring(_mask(spark, sf_dir, "v > 47"), 1, 2).groupBy("frame_id").agg(F.count("*").alias("ring"))
    return c.join(b, "frame_id").join(a, "frame_id", "left").select("frame_id", F.coalesce("eroded", F.lit(0)).alias("eroded"), "boundary", "ring")


def mask_components(spark, sf_dir):
    labels = pixels.connected_components(_mask(spark, sf_dir, "v > 42"))
    sizes = labels.groupBy("frame_id", "label").agg(F.count("*").alias("n"))
    return sizes.groupBy("frame_id").agg(F.count("*").alias("n_parts"), F.max("n").alias("largest"))


def seam_jump_p95(spark, sf_dir):
    rows = D.image(spark, sf_dir).withColumn("inside", F.col("d") > 0.06)
    return pixels.seam_jumps(rows).groupBy("frame_id").agg(F.count("*").alias("n"), F.round(F.avg("jump"), 6).alias("mean"), F.round(F.percentile("jump", 0.95), 6).alias("p95"))


def texture_energy_ratio(spark, sf_dir):
    img = D.image(spark, sf_dir)
    lap = pixels.laplacian(img).join(img.select("frame_id", "y", "x", "d"), ["frame_id", "y", "x"])
    rows = lap.select("frame_id", F.when(F.col("d") > 0.06, "core").otherwise("ring").alias("region"), (F.col("lap") * F.col("lap")).alias("energy"))
    return pixels.energy_ratio(rows).select("frame_id", F.round("core", 5).alias("core"), F.round("ring", 5).alias("ring"), F.round("ratio", 5).alias("ratio"))


def _layers(spark, sf_dir):
    pts = D.points(spark, sf_dir)
    return pts.select((F.col("line")).alias("frame_id"), (F.col("part") % 48).alias("y"), (F.col("supp") % 64).alias("x"), F.col("obj").alias("layer"), F.col("z").alias("depth"), F.col("point_id").cast("double").alias("v"))


def layer_composite_provenance(spark, sf_dir):
    layers = _layers(spark, sf_dir)
    source = layers.groupBy("frame_id", "y", "x").agg(F.max("v").alias("v"))
    removal = source.where("(x + y) % 3 = 0")
    out = composite.layer_composite(source, removal, layers.where("depth > 5 AND layer <> 'N'"), source.where("x % 2 = 0"))
    return out.groupBy("frame_id", "label").agg(F.count("*").alias("n"), F.sum("v").cast("long").alias("v_sum"))


def layer_order_with_epsilon(spark, sf_dir):
    layers = _layers(spark, sf_dir).withColumn("ord", F.col("v").cast("long")).where("layer <> 'N'")
    out = composite.ordered_composite(layers.select("frame_id", "y", "x", "ord", "depth", "layer"), 0.0)
    return out.groupBy("frame_id", "layer").agg(F.count("*").alias("n"), F.round(F.avg("depth"), 6).alias("depth"))


def temporal_pair_delta(spark, sf_dir):
    ev = D.table(spark, sf_dir, "events")
    day = F.datediff(F.to_date("ts"), F.lit("2020-01-01").cast("date")).alias("seq")
    frames = ev.groupBy("event_type", day).agg(F.count("*").alias("n"), F.avg("value").alias("v"))
    out = composite.temporal_pairs(frames, ["event_type"], ["n", "v"])
    return out.select("event_type", "seq", "n", "next_n", "d_n", F.round("v", 6).alias("v"), F.round("d_v", 6).alias("d_v"))


def flow_warp(spark, sf_dir):
    target = D.image(spark, sf_dir).select("frame_id", "y", "x", "v")
    flow = D.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") % 7 + 1).cast("int").alias("frame_id"), (F.col("p_partkey") % 64).alias("y"), (F.col("p_partkey") * 7 % 64).alias("x"), (F.col("p_size") % 4 / 4.0).alias("dx"), (F.col("p_size") % 2 / 2.0).alias("dy"))
    return composite.flow_warp(flow, target).select("id", "frame_id", F.round("v", 6).alias("v"))


def _pairs(spark, sf_dir):
    ev = D.table(spark, sf_dir, "events")
    box = lambda a, b: F.struct((F.col("user_id") % a).cast("double").alias("x0"), (F.col("event_id") % b).cast("double").alias("y0"), (F.col("user_id") % a + 12).cast("double").alias("x1"), (F.col("event_id") % b + 9).cast("double").alias("y1"))
    return ev.select(
        "event_id", F.col("user_id").alias("frame_id"), "event_type", (F.col("event_id") % 60).alias("n_visible"), F.least(F.col("event_id") % 60, F.col("event_id") % 41).alias("n_hit"),
        (F.col("event_id") % 50 + 1).alias("n_mask"), (F.col("event_id") % 31).alias("n_supported"), box(5, 4).alias("box_a"), box(7, 6).alias("box_b"), (F.col("event_id") % 101 / 100.0).alias("score"),
    )


def pair_metric_scores(spark, sf_dir):
    out = match.pair_scores(_pairs(spark, sf_dir))
    return out.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if("eligible").alias("n_eligible"), F.round(F.avg("quality"), 6).alias("quality"), F.round(F.avg("iou"), 6).alias("iou"))


def best_with_margin(spark, sf_dir):
    ev = D.table(spark, sf_dir, "events")
    return match.best_with_margin(ev.select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], "value", "event_id").select("user_id", "event_type", "event_id", F.round("value", 6).alias("value"), F.round("margin", 6).alias("margin"))


def one_to_one_assignment(spark, sf_dir):
    scored = match.pair_scores(_pairs(spark, sf_dir)).where("frame_id IS NOT NULL")
    edges = scored.groupBy("frame_id", F.col("event_type").alias("object_id"), (F.col("event_id") % 6).alias("detection_id")).agg(F.max("quality").alias("weight"))
    return match.assign(edges)


def track_cost(spark, sf_dir):
    ev = D.table(spark, sf_dir, "events")
    rows = ev.select("user_id", "ts", "event_id", F.col("value").alias("bx"), (F.col("event_id") % 100).cast("double").alias("by"), (F.col("event_id") % 7 + 5).cast("double").alias("bw"), (F.col("event_id") % 5 + 4).cast("double").alias("bh"))
    out = match.tracking_cost(rows, ["user_id"], ["ts", "event_id"])
    return out.groupBy("user_id").agg(F.count("cost").alias("n"), F.round(F.avg("cost"), 6).alias("mean_cost"), F.round(F.max("cost"), 6).alias("max_cost"))


QUERIES = {f.__name__: f for f in (
    mask_union_partition, dilate_radius_2, erode_and_ring, mask_components, seam_jump_p95, texture_energy_ratio, layer_composite_provenance, layer_order_with_epsilon,
    temporal_pair_delta, flow_warp, pair_metric_scores, best_with_margin, one_to_one_assignment, track_cost,
)}

_LAYERS = f"l AS (SELECT line AS frame_id, part % 48 AS y, supp % 64 AS x, obj AS layer, z AS depth, CAST(point_id AS DOUBLE) AS v FROM ({D.PTS}))"
_PAIRS = """p AS (SELECT *, event_id % 60 AS nv, least(event_id % 60, event_id % 41) AS nh, event_id % 50 + 1 AS nm, event_id % 31 AS ns, user_id % 5 AS ax, event_id % 4 AS ay, user_id % 7 AS bx, event_id % 6 AS by_, event_id % 101 / 100.0e0 AS sc FROM events),
 o AS (SELECT *, greatest(least(ax, bx) + 12 - greatest(ax, bx), 0) * greatest(least(ay, by_) + 9 - greatest(ay, by_), 0) * 1.0e0 AS i FROM p),
 q AS (SELECT *, i / (216.0e0 - i) AS iou, CASE WHEN nv > 0 THEN nh / nv ELSE 0 END AS hr, ns / nm AS sr FROM o),
 s AS (SELECT *, 0.45e0 * hr + 0.30e0 * sr + 0.20e0 * iou + 0.05e0 * sc AS quality, nv >= 25 AND hr >= 0.55e0 AND sr >= 0.20e0 AND iou >= 0.30e0 AND sc >= 0.50e0 AS ok FROM q)"""

ORACLE = {
    "mask_union_partition": f"""WITH i AS ({D.IMAGE}), a AS (SELECT frame_id, v > 30 AS a, d > 0.06e0 AS b FROM i WHERE v > 30 OR d > 0.06e0)
      SELECT frame_id, CASE WHEN a AND b THEN 'both' WHEN a THEN 'base' ELSE 'extra' END AS part, count(*) AS n FROM a GROUP BY 1, 2""",
    "dilate_radius_2": f"""WITH i AS ({D.IMAGE}), m AS (SELECT DISTINCT frame_id, y + dy AS y, x + dx AS x FROM i CROSS JOIN (SELECT unnest([-2,-1,0,1,2]) AS dx) CROSS JOIN (SELECT unnest([-2,-1,0,1,2]) AS dy) WHERE v > 45)
      SELECT frame_id, count(*) AS area, min(x) AS x0, min(y) AS y0, max(x) + 1 AS x1, max(y) + 1 AS y1, round(avg(x), 6) AS cx, round(avg(y), 6) AS cy FROM m GROUP BY frame_id""",
    "erode_and_ring": f"""WITH i AS ({D.IMAGE}), n AS (SELECT unnest([-1,0,1]) AS d), w AS (SELECT unnest([-2,-1,0,1,2]) AS d),
      m AS (SELECT frame_id, y, x FROM i WHERE v > 8), e AS (SELECT frame_id, y + b.d AS y, x + a.d AS x FROM m, n a, n b GROUP BY ALL HAVING count(*) = 9),
      s AS (SELECT frame_id, y, x FROM i WHERE v > 47), d1 AS (SELECT DISTINCT frame_id, y + b.d AS y, x + a.d AS x FROM s, n a, n b), d2 AS (SELECT DISTINCT frame_id, y + b.d AS y, x + a.d AS x FROM s, w a, w b),
      r AS (SELECT frame_id, count(*) AS ring FROM (SELECT * FROM d2 EXCEPT SELECT * FROM d1) GROUP BY 1), f AS (SELECT frame_id, count(*) AS boundary FROM (SELECT * FROM m EXCEPT SELECT * FROM e) GROUP BY 1),
      g AS (SELECT frame_id, count(*) AS eroded FROM e GROUP BY 1)
      SELECT r.frame_id, coalesce(eroded, 0) AS eroded, boundary, ring FROM r JOIN f USING (frame_id) LEFT JOIN g USING (frame_id)""",
    "mask_components": f"""WITH RECURSIVE i AS ({D.IMAGE}), m AS (SELECT frame_id, y, x, y * 64 + x AS id FROM i WHERE v > 42),
      e AS (SELECT a.frame_id, a.id AS a, b.id AS b FROM m a JOIN m b ON a.frame_id = b.frame_id AND abs(a.y - b.y) + abs(a.x - b.x) = 1),
      r(frame_id, a, b) AS (SELECT frame_id, id, id FROM m UNION SELECT r.frame_id, r.a, e.b FROM r JOIN e ON r.frame_id = e.frame_id AND r.b = e.a),
      c AS (SELECT frame_id, a, min(b) AS label FROM r GROUP BY 1, 2), s AS (SELECT frame_id, label, count(*) AS n FROM c GROUP BY 1, 2)
      SELECT frame_id, count(*) AS n_parts, max(n) AS largest FROM s GROUP BY 1""",
    "seam_jump_p95": f"""WITH i AS (SELECT frame_id, y, x, v, d > 0.06e0 AS m FROM ({D.IMAGE})), j AS (
      SELECT a.frame_id, abs(a.v - b.v) AS jump FROM i a JOIN i b ON a.frame_id = b.frame_id AND ((a.y = b.y AND b.x = a.x + 1) OR (a.x = b.x AND b.y = a.y + 1)) AND a.m <> b.m)
      SELECT frame_id, count(*) AS n, round(avg(jump), 6) AS mean, round(quantile_cont(jump, 0.95), 6) AS p95 FROM j GROUP BY 1""",
    "texture_energy_ratio": f"""WITH i AS ({D.IMAGE}), n AS (SELECT *, CASE WHEN lag(x) OVER h = x - 1 THEN lag(v) OVER h END AS a, CASE WHEN lead(x) OVER h = x + 1 THEN lead(v) OVER h END AS b,
        CASE WHEN lag(y) OVER u = y - 1 THEN lag(v) OVER u END AS e, CASE WHEN lead(y) OVER u = y + 1 THEN lead(v) OVER u END AS f FROM i WINDOW h AS (PARTITION BY frame_id, y ORDER BY x), u AS (PARTITION BY frame_id, x ORDER BY y)),
      l AS (SELECT frame_id, CASE WHEN d > 0.06e0 THEN 'core' ELSE 'ring' END AS region, a + b + e + f - 4 * v AS lap FROM n WHERE a + b + e + f IS NOT NULL),
      q AS (SELECT frame_id, quantile_cont(lap * lap, 0.95) AS cap FROM l GROUP BY 1), m AS (SELECT frame_id, avg(least(lap * lap, cap)) FILTER (WHERE region = 'core') AS core, avg(least(lap * lap, cap)) FILTER (WHERE region = 'ring') AS ring FROM l JOIN q USING (frame_id) GROUP BY 1)
      SELECT frame_id, round(core, 5) AS core, round(ring, 5) AS ring, round(CASE WHEN ring > 0 THEN core / ring END, 5) AS ratio FROM m""",
    "layer_composite_provenance": f"""WITH {_LAYERS}, s AS (SELECT frame_id, y, x, max(v) AS v FROM l GROUP BY 1, 2, 3),
      n AS (SELECT frame_id, y, x, v AS nv, layer FROM l WHERE depth > 5 AND layer <> 'N' QUALIFY row_number() OVER (PARTITION BY frame_id, y, x ORDER BY depth, layer, v) = 1),
      c AS (SELECT s.frame_id, CASE WHEN (x + y) % 3 <> 0 THEN 'source' WHEN layer IS NOT NULL THEN 'layer:' || layer WHEN x % 2 = 0 THEN 'background' ELSE 'unresolved' END AS label,
              CASE WHEN (x + y) % 3 <> 0 THEN v WHEN layer IS NOT NULL THEN nv WHEN x % 2 = 0 THEN v END AS v FROM s LEFT JOIN n USING (frame_id, y, x))
      SELECT frame_id, label, count(*) AS n, CAST(sum(v) AS BIGINT) AS v_sum FROM c GROUP BY 1, 2""",
    "layer_order_with_epsilon": f"""WITH {_LAYERS}, r AS (SELECT *, row_number() OVER (PARTITION BY frame_id, y, x ORDER BY depth, v) AS k FROM l WHERE layer <> 'N')
      SELECT frame_id, layer, count(*) AS n, round(avg(depth), 6) AS depth FROM r WHERE k = 1 GROUP BY 1, 2""",
    "temporal_pair_delta": """WITH f AS (SELECT event_type, CAST(date_diff('day', DATE '2020-01-01', CAST(ts AS DATE)) AS INTEGER) AS seq, count(*) AS n, avg(value) AS v FROM events GROUP BY 1, 2)
      SELECT a.event_type, a.seq, a.n, b.n AS next_n, b.n - a.n AS d_n, round(a.v, 6) AS v, round(b.v - a.v, 6) AS d_v FROM f a JOIN f b ON a.event_type = b.event_type AND b.seq = a.seq + 1""",
    "flow_warp": f"""WITH i AS ({D.IMAGE}), t AS (SELECT frame_id, y, x, v FROM i),
      f AS (SELECT p_partkey AS id, CAST(p_size % 7 + 1 AS INTEGER) AS frame_id, p_partkey % 64 + p_size % 2 / 2.0e0 AS w, p_partkey * 7 % 64 + p_size % 4 / 4.0e0 AS u FROM part),
      c AS (SELECT id, frame_id, floor(u) + i AS cx, floor(w) + j AS cy, (CASE WHEN i = 1 THEN u - floor(u) ELSE 1 - (u - floor(u)) END) * (CASE WHEN j = 1 THEN w - floor(w) ELSE 1 - (w - floor(w)) END) AS wt FROM f, (SELECT unnest([0, 1]) AS i), (SELECT unnest([0, 1]) AS j))
      SELECT id, c.frame_id, round(sum(wt * v), 6) AS v FROM c LEFT JOIN t ON c.frame_id = t.frame_id AND cx = x AND cy = y WHERE wt > 0 GROUP BY 1, 2 HAVING count(v) = count(*)""",
    "pair_metric_scores": f"WITH {_PAIRS} SELECT event_type, count(*) AS n, count(*) FILTER (WHERE ok) AS n_eligible, round(avg(quality), 6) AS quality, round(avg(iou), 6) AS iou FROM s GROUP BY 1",
    "best_with_margin": """WITH r AS (SELECT user_id, event_type, event_id, value, row_number() OVER w AS k, lead(value) OVER w AS nxt FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY value DESC, event_id))
      SELECT user_id, event_type, event_id, round(value, 6) AS value, round(CASE WHEN nxt IS NULL THEN 0 ELSE value - nxt END, 6) AS margin FROM r WHERE k = 1""",
    "track_cost": """WITH b AS (SELECT user_id, ts, event_id, value AS bx, event_id % 100 AS by_, event_id % 7 + 5 AS bw, event_id % 5 + 4 AS bh FROM events),
      l AS (SELECT *, lag(bx) OVER w AS px, lag(by_) OVER w AS py, lag(bw) OVER w AS pw, lag(bh) OVER w AS ph FROM b WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
      c AS (SELECT user_id, sqrt(pow(bx - px, 2) + pow(by_ - py, 2)) / sqrt(CAST(pw * pw + ph * ph AS DOUBLE)) + 0.25e0 * abs(ln(bw * bh / (pw * ph))) AS cost FROM l)
      SELECT user_id, count(cost) AS n, round(avg(cost), 6) AS mean_cost, round(max(cost), 6) AS max_cost FROM c GROUP BY 1""",
}
