"""Matching: pair scores, best candidates, one-to-one assignment, view choice, tracks."""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import bbox_iou


def pair_scores(pairs: DataFrame) -> DataFrame:
    """Quality and eligibility of object-detection pairs.

    Rows: n_visible, n_hit, n_mask, n_supported, box_a, box_b, score. Fixed weights 0.45 hit ratio, 0.30
    dilated support, 0.20 box IoU, 0.05 score; gates 25 pixels, 0.55, 0.20, 0.30 and 0.50.
    """
    hit = F.when(F.col("n_visible") > 0, F.col("n_hit") / F.col("n_visible")).otherwise(0.0)
    support = F.when(F.col("n_mask") > 0, F.col("n_supported") / F.col("n_mask")).otherwise(0.0)
    rows = pairs.withColumns({"hit_ratio": hit, "support_ratio": support, "iou": bbox_iou(F.col("box_a"), F.col("box_b"))})
    quality = 0.45 * F.col("hit_ratio") + 0.30 * F.col("support_ratio") + 0.20 * F.col("iou") + 0.05 * F.col("score")
    good = (F.col("n_visible") >= 25) & (F.col("hit_ratio") >= 0.55) & (F.col("support_ratio") >= 0.20) & (F.col("iou") >= 0.30) & (F.col("score") >= 0.50)
    return rows.withColumns({"quality": quality, "eligible": good})


def best_with_margin(rows: DataFrame, keys: list[str], score: str, tie: str) -> DataFrame:
    """The best row of each key by score, ties to the least `tie`, and its lead over the next (0 if alone)."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), tie)
    ranked = rows.withColumns({"_rank": F.row_number().over(order), "_next": F.lead(score).over(order)})
    best = ranked.where(F.col("_rank") == 1)
    return best.withColumn("margin", F.when(F.col("_next").isNull(), 0.0).otherwise(F.col(score) - F.col("_next"))).drop("_rank", "_next")


def _hungarian(cost: np.ndarray) -> list[int]:
    """Column of each row in a least-cost assignment (rows <= columns): shortest augmenting paths with potentials."""
    n, m = cost.shape
    u, v, owner = np.zeros(n), np.zeros(m), np.full(m, -1)
    for row in range(n):
        dist, before, done = cost[row] - u[row] - v, np.full(m, -1), np.zeros(m, bool)
        while True:
            j = int(np.argmin(np.where(done, np.inf, dist)))
            least, done[j] = dist[j], True
            if owner[j] < 0:
                break
            i = owner[j]
            slack = least + cost[i] - u[i] - v - (cost[i, j] - u[i] - v[j])
            better = ~done & (slack < dist)
            dist[better], before[better] = slack[better], j
        reached = done & (np.arange(m) != j)
        u[row] += least
        u[owner[reached]] += least - dist[reached]
        v[reached] -= least - dist[reached]
        while before[j] >= 0:
            owner[j] = owner[before[j]]
            j = before[j]
        owner[j] = row
    out = [-1] * n
    for j, i in enumerate(owner):
        if i >= 0:
            out[i] = j
    return out


def assign(edges: DataFrame, group: str = "frame_id") -> DataFrame:
    """The one-to-one match of greatest total weight in each group; either side may stay alone.

    Rows: group, object_id, detection_id, weight (only positive weights match).
    """
    schema = edges.select(group, "object_id", "detection_id", "weight").schema

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf[pdf.weight > 0].sort_values(["object_id", "detection_id"])
        objects, found = sorted(pdf.object_id.unique()), sorted(pdf.detection_id.unique())
        weight = np.zeros((len(objects), len(found) + len(objects)))
        for r in pdf.itertuples():
            i, j = objects.index(r.object_id), found.index(r.detection_id)
            weight[i, j] = max(weight[i, j], r.weight)
        pick = _hungarian(-weight) if len(objects) else []
        keep = [(objects[i], found[j], weight[i, j]) for i, j in enumerate(pick) if j < len(found) and weight[i, j] > 0]
        out = pd.DataFrame(keep, columns=["object_id", "detection_id", "weight"])
        out.insert(0, group, pdf[group].iloc[0] if len(pdf) else None)
        return out[[f.name for f in schema]]

    return edges.select(group, "object_id", "detection_id", "weight").groupBy(group).applyInPandas(solve, schema)


def brute_assign(weight: np.ndarray) -> float:
    """The greatest total weight by trying all matches (small matrices)."""
    n, m = weight.shape
    wide = np.concatenate([weight, np.zeros((n, n))], axis=1)
    return max(sum(wide[i, j] for i, j in enumerate(p)) for p in permutations(range(m + n), n))


def maximin_views(views: DataFrame, keys: list[str], k: int = 4) -> DataFrame:
    """k views of each key, spread by ray angle: the farthest pair, then the view farthest from its nearest chosen one.

    Rows: keys, frame_id, dx, dy, dz (unit rays). Ties go to the least frame_id. All keys advance
    together, one aggregate a round over the chosen few.
    """
    other = views.select(*keys, F.col("frame_id").alias("f2"), *(F.col(f"d{a}").alias(f"e{a}") for a in "xyz"))
    dot = sum(F.col(f"d{a}") * F.col(f"e{a}") for a in "xyz")
    pairs = views.join(other, keys).where(F.col("frame_id") < F.col("f2"))
    first = pairs.groupBy(*keys).agg(F.min_by(F.struct("frame_id", "f2"), F.struct(F.round(dot, 12), "frame_id", "f2")).alias("p"))
    chosen = first.select(*keys, F.explode(F.array("p.frame_id", "p.f2")).alias("frame_id"))
    for _ in range(k - 2):
        rays = chosen.join(views, [*keys, "frame_id"]).select(*keys, *(F.col(f"d{a}").alias(f"e{a}") for a in "xyz"))
        left = views.join(chosen, [*keys, "frame_id"], "left_anti")
        gap = left.join(rays, keys).groupBy(*keys, "frame_id").agg(F.round(F.max(dot), 12).alias("near"))
        chosen = chosen.union(gap.groupBy(*keys).agg(F.min_by("frame_id", F.struct("near", "frame_id")).alias("frame_id")))
    return chosen


def separated_evidence(views: DataFrame, min_baseline: float = 0.10, min_angle: float = 5.0, count: int = 2, both: bool = True) -> DataFrame:
    """For each object the `count` views far enough apart from each other with the greatest sum of scores.

    Rows: object_id, frame_id, score, px, py, pz (camera centres), dx, dy, dz (rays). Two views are apart if their cameras are `min_baseline` and their
    rays `min_angle` degrees apart (`both`, or either). A set grows from each pair that is apart, taking the best-scored view
    apart from all chosen ones; of equal sums the one with the later frame_ids wins. Objects without such a set are left out.

    Views are gone through by falling score, each against all later ones at once, and no further than a better sum is possible.
    """

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["score", "frame_id"], ascending=[False, True]).reset_index(drop=True)
        at, ray, score, frames = pdf[["px", "py", "pz"]].to_numpy(float), pdf[["dx", "dy", "dz"]].to_numpy(float), pdf["score"].to_numpy(float), pdf["frame_id"].tolist()
        if count == 1:
            return pdf.iloc[:1][["object_id", "frame_id"]]
        size = np.linalg.norm(ray, axis=1)

        def apart(i: int, others: np.ndarray) -> np.ndarray:
            far = np.linalg.norm(at[others] - at[i], axis=1) >= min_baseline
            long = size[others] * size[i]
            cosine = np.clip(ray[others] @ ray[i] / np.where(long > 1e-12, long, 1), -1, 1)
            wide = np.where(long > 1e-12, np.degrees(np.arccos(cosine)), 0.0) >= min_angle
            return far & wide if both else far | wide

        best, picked, rest = None, [], float(score[: count - 2].sum())
        for i in range(len(pdf) - 1):
            if best is not None and score[i] + score[i + 1] + rest < best[0]:
                break
            later = np.arange(i + 1, len(pdf))
            for j in later[apart(i, later)].tolist():
                if best is not None and score[i] + score[j] + rest < best[0]:
                    break
                chosen = [i, j]
                for n in range(len(pdf) if count > 2 else 0):
                    if len(chosen) == count:
                        break
                    if n not in chosen and apart(n, np.array(chosen)).all():
                        chosen.append(n)
                key = (float(score[chosen].sum()), tuple(frames[k] for k in chosen))
                if len(chosen) == count and (best is None or key > best):
                    best, picked = key, chosen
        return pdf.iloc[picked][["object_id", "frame_id"]]

    kinds = dict(views.dtypes)
    return views.groupBy("object_id").applyInPandas(grow, f"object_id {kinds['object_id']}, frame_id {kinds['frame_id']}")


def tracking_cost(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Cost of each box (bx, by, bw, bh) after the one before: centre shift over the diagonal + 0.25 |log size change|."""
    w = Window.partitionBy(*keys).orderBy(*order)
    before = {f"_{c}": F.lag(c).over(w) for c in ("bx", "by", "bw", "bh")}
    shift = F.sqrt(F.pow(F.col("bx") - F.col("_bx"), 2) + F.pow(F.col("by") - F.col("_by"), 2)) / F.sqrt(F.col("_bw") * F.col("_bw") + F.col("_bh") * F.col("_bh"))
    size = 0.25 * F.abs(F.log(F.col("bw") * F.col("bh") / (F.col("_bw") * F.col("_bh"))))
    return rows.withColumns(before).withColumn("cost", shift + size).drop(*before)
