"""Colours of texture atlases: dominant colour support and robust illumination surfaces."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed

COLOURS = ("r", "g", "b")


def dominant_colour_support(texels: DataFrame, keys: list[str], quantum: int = 24, radius: float = 72.0, quantile: float = 0.65, min_share: float = 0.08) -> DataFrame:
    """Adds support to texels (keys, observed, r, g, b): observed and within `radius` of the surface's bright colour.

    Observed colours fall into bins of `quantum`; the medians of the fullest bin (ties: the least colour) pick the colours around it, of which
    the brighter than the `quantile` of luminance give the bright colour by their medians. If fewer than `min_share` of the observed texels
    are supported, all of them are. Medians are of one atlas each, whose size is bounded.
    """
    seen = texels.where("observed")
    bins = [F.floor(F.col(c) / quantum).alias(f"_{c}") for c in COLOURS]
    full = seen.groupBy(*keys, *bins).agg(F.count("*").alias("_n"))
    order = Window.partitionBy(*keys).orderBy(F.desc("_n"), *(f"_{c}" for c in COLOURS))
    top = full.withColumn("_k", F.row_number().over(order)).where("_k = 1").drop("_k", "_n")
    medians = lambda name: [F.percentile(c, 0.5).alias(f"{name}{c}") for c in COLOURS]
    main = seen.select("*", *bins).join(top, [*keys, *(f"_{c}" for c in COLOURS)]).groupBy(*keys).agg(*medians("m"))
    apart = lambda name: F.sqrt(sum((F.col(c) - F.col(f"{name}{c}")) * (F.col(c) - F.col(f"{name}{c}")) for c in COLOURS))
    near = seen.join(main, keys).where(apart("m") <= radius).withColumn("_l", 0.2126 * F.col("r") + 0.7152 * F.col("g") + 0.0722 * F.col("b"))
    bright = near.withColumn("_q", F.percentile("_l", quantile).over(Window.partitionBy(*keys))).where(F.col("_l") >= F.col("_q")).groupBy(*keys).agg(*medians("t"))
    own = texels.join(bright, keys, "left").withColumn("_s", F.col("observed") & F.coalesce(apart("t") <= radius, F.lit(False)))
    share = own.groupBy(*keys).agg((F.count_if("_s") / F.greatest(F.count_if("observed"), F.lit(1))).alias("support_share"))
    out = own.join(share, keys).withColumn("support", F.when(F.col("support_share") < min_share, F.col("observed")).otherwise(F.col("_s")))
    return out.drop("_s", *(f"t{c}" for c in COLOURS))


def _features(degree: int) -> list[Column]:
    """Monomials of u and v by total degree, the power of u falling."""
    u, v = F.col("_u"), F.col("_v")
    power = lambda x, n: F.lit(1.0) if n == 0 else x if n == 1 else F.pow(x, F.lit(float(n)))
    return [power(u, t - k) * power(v, k) for t in range(degree + 1) for k in range(t + 1)]


def illumination_surface(texels: DataFrame, keys: list[str], sizes: DataFrame, degree: int = 1, rounds: int = 8, delta: float = 1.5, ridge: float = 1e-4) -> tuple[DataFrame, DataFrame]:
    """A polynomial surface through the supported texels' colours, by iteratively reweighted least squares, for each key.

    Texels: keys, row, col, observed, support, r, g, b; sizes: keys, height, width. u and v run from -1 to 1 over the atlas. Each
    round sums the features' products by key, solves the normal equations (plus `ridge`) of each key, and weighs a texel by
    min(1, delta * scale / residual), scale = max(1.4826 * median residual, 1). Returns the texels with unobserved colours
    from the surface (rounded half even, 0 to 255), and the fit: keys, n, scale, coefficients (features x 3, by feature).
    Keys with fewer than 12 supported texels raise.
    """
    if not 1 <= degree <= 4:
        raise ValueError("degree must be 1 to 4")
    place = {"_u": (F.col("col") + 0.5) / F.greatest("width", F.lit(1)) * 2 - 1, "_v": (F.col("row") + 0.5) / F.greatest("height", F.lit(1)) * 2 - 1}
    rows = checkpointed(texels.join(sizes.select(*keys, "height", "width"), keys).withColumns(place).drop("height", "width"))
    used, features = rows.where("support"), _features(degree)
    n = len(features)
    counts = used.groupBy(*keys).agg(F.count("*").alias("n"))
    if rows.select(*keys).distinct().join(counts.where("n >= 12"), keys, "left_anti").limit(1).count():
        raise ValueError("a surface has too few supported texels")
    kinds = ", ".join(f"{k} {dict(texels.dtypes)[k]}" for k in keys)

    def solved(batches):
        for pdf in batches:
            out = []
            for gram, right in zip(pdf["gram"], pdf["right"], strict=True):
                a = np.zeros((n, n))
                a[np.triu_indices(n)] = gram
                a = a + np.triu(a, 1).T + np.eye(n) * ridge
                out.append(np.linalg.solve(a, np.array(right).reshape(n, 3)).ravel().tolist())
            yield pdf[[*keys, "n"]].assign(coefficients=out)

    def fitted(c: int) -> Column:
        return sum((F.col("coefficients")[3 * i + c] * f for i, f in enumerate(features)), F.lit(0.0))

    residual = F.sqrt(sum((F.col(c) - fitted(k)) * (F.col(c) - fitted(k)) for k, c in enumerate(COLOURS)))
    fit, weighed = None, used.withColumn("_w", F.lit(1.0))
    for _ in range(rounds):
        gram = F.array(*(F.sum(F.col("_w") * features[i] * features[j]) for i in range(n) for j in range(i, n)))
        right = F.array(*(F.sum(F.col("_w") * features[i] * F.col(c)) for i in range(n) for c in COLOURS))
        sums = weighed.groupBy(*keys).agg(F.count("*").alias("n"), gram.alias("gram"), right.alias("right"))
        fit = checkpointed(sums.mapInPandas(solved, f"{kinds}, n long, coefficients array<double>"))
        left = used.join(fit.drop("n"), keys).withColumn("_e", residual)
        scales = left.groupBy(*keys).agg(F.greatest(F.percentile("_e", 0.5) * 1.4826, F.lit(1.0)).alias("scale"))
        weighed = left.join(scales, keys).withColumn("_w", F.least(F.lit(1.0), delta * F.col("scale") / F.greatest("_e", F.lit(1e-9)))).drop("coefficients", "_e", "scale")
    fit = fit.join(checkpointed(scales), keys)
    full = rows.join(fit.select(*keys, "coefficients"), keys)
    colour = lambda k, c: F.when(F.col("observed"), F.col(c).cast("double")).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(255.0), F.rint(fitted(k))))).alias(c)
    return full.select(*(x for x in texels.columns if x not in COLOURS), *(colour(k, c) for k, c in enumerate(COLOURS))), fit
