"""Comparisons of masks, images, depths, cameras and id sets; worst and best rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def mask_metrics(predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """IoU, precision, recall and centre error of two masks (frame_id, y, x) by frame; a mask without pixels scores 0."""
    both = predicted.select("frame_id", "y", "x", F.lit(1).alias("p"), F.lit(0).alias("t")).union(truth.select("frame_id", "y", "x", F.lit(0), F.lit(1)))
    cells = both.groupBy("frame_id", "y", "x").agg(F.max("p").alias("p"), F.max("t").alias("t"))
    hit, p, t = F.sum(F.col("p") * F.col("t")), F.sum("p"), F.sum("t")
    centre = lambda m, a: F.sum(F.col(m) * F.col(a)) / F.sum(m)
    off = F.sqrt(F.pow(centre("p", "x") - centre("t", "x"), 2) + F.pow(centre("p", "y") - centre("t", "y"), 2))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return cells.groupBy("frame_id").agg(ratio(hit, F.count("*")).alias("iou"), ratio(hit, p).alias("precision"), ratio(hit, t).alias("recall"), F.when((p > 0) & (t > 0), off).alias("centre_error"))


def image_metrics(a: DataFrame, b: DataFrame, peak: float = 255.0) -> DataFrame:
    """L1, RMSE and PSNR of the shared pixels of two images (frame_id, y, x, v); PSNR is null where they are equal."""
    d = F.col("v") - F.col("w")
    rows = a.select("frame_id", "y", "x", "v").join(b.select("frame_id", "y", "x", F.col("v").alias("w")), ["frame_id", "y", "x"])
    out = rows.groupBy("frame_id").agg(F.count("*").alias("n"), F.avg(F.abs(d)).alias("l1"), F.avg(d * d).alias("mse"))
    return out.select("frame_id", "n", "l1", F.sqrt("mse").alias("rmse"), F.when(F.col("mse") > 0, 10 * F.log10(peak * peak / F.col("mse"))).alias("psnr"))


def depth_disagreement(a: DataFrame, b: DataFrame) -> DataFrame:
    """Median and 90th percentile of absolute log and relative error between two depths of the same pixels, by frame."""
    rows = a.select("frame_id", "y", "x", F.col("depth").alias("d")).join(b.select("frame_id", "y", "x", F.col("depth").alias("e")), ["frame_id", "y", "x"]).where("d > 0 AND e > 0")
    log, rel = F.abs(F.log(F.col("e") / F.col("d"))), F.abs(F.col("e") - F.col("d")) / F.col("d")
    return rows.groupBy("frame_id").agg(*(F.percentile(c, q).alias(f"{n}_{s}") for n, c in (("log", log), ("rel", rel)) for s, q in (("median", 0.5), ("p90", 0.9))))


def id_reconciliation(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Ids that are missing, extra or repeated: key, issue, n."""
    both = expected.select(key, F.lit(1).alias("e"), F.lit(0).alias("a")).union(actual.select(key, F.lit(0), F.lit(1))).groupBy(key).agg(F.sum("e").alias("e"), F.sum("a").alias("a"))
    issue = F.when(F.col("a") == 0, "missing").when(F.col("e") == 0, "extra").when(F.col("a") > 1, "duplicate")
    return both.withColumn("issue", issue).where(F.col("issue").isNotNull()).select(key, "issue", F.col("a").alias("n"))


def frame_coverage(required: DataFrame, bindings: DataFrame, available: DataFrame) -> DataFrame:
    """Required frames that a binding lacks: every (binding, frame_id) without a row in `available`."""
    return required.select("frame_id").distinct().crossJoin(bindings.select("binding").distinct()).join(available, ["binding", "frame_id"], "left_anti")


def camera_drift(fresh: DataFrame, base: DataFrame, tolerance: float = 1e-12) -> DataFrame:
    """Cameras (frame_id, r, t) of `fresh` that `base` lacks or that moved: frame_id, issue, delta."""
    b = base.select("frame_id", F.col("r").alias("br"), F.col("t").alias("bt"))
    delta = F.array_max(F.concat(F.zip_with("r", "br", lambda x, y: F.abs(x - y)), F.zip_with("t", "bt", lambda x, y: F.abs(x - y))))
    rows = fresh.join(b, "frame_id", "left").withColumn("delta", delta)
    return rows.withColumn("issue", F.when(F.col("br").isNull(), "unknown").when(F.col("delta") > tolerance, "moved")).where(F.col("issue").isNotNull()).select("frame_id", "issue", "delta")


def top_rows(rows: DataFrame, keys: list[str], score: str, tie: str, n: int, largest: bool = True) -> DataFrame:
    """The n best rows of each key with their rank."""
    w = Window.partitionBy(*keys).orderBy(F.desc(score) if largest else F.asc(score), tie)
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def prior_verdict(a: DataFrame, b: DataFrame, lower_is_better: dict[str, bool]) -> DataFrame:
    """Two runs' metrics by key (the first column): better, worse, equal or mixed, seen from `b`."""
    key = a.columns[0]
    rows = a.join(b.select(key, *(F.col(m).alias(f"_{m}") for m in lower_is_better)), key)
    gains = F.array(*(F.signum((F.col(m) - F.col(f"_{m}")) * (1 if low else -1)) for m, low in lower_is_better.items()))
    up, down = F.exists(gains, lambda x: x > 0), F.exists(gains, lambda x: x < 0)
    return rows.select(key, F.when(up & down, "mixed").when(up, "better").when(down, "worse").otherwise("equal").alias("verdict"))
