"""Scans of cameras, masks, manifests, metric logs and binary parts, and checked sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CAMERA_JSON = "cameras array<struct<frame_id:string,fx:double,fy:double,cx:double,cy:double,w:int,h:int,rotation:array<array<double>>,position:array<double>,world_to_camera:array<array<double>>>>"


def read_cameras(spark: SparkSession, path: str) -> DataFrame:
    """Cameras of both conventions as frame_id, fx, fy, cx, cy, w, h, r (row-major world to camera), t.

    world_to_camera is taken as it is; rotation (camera to world) and position become R^T and -R^T p.
    """
    rows = spark.read.schema(CAMERA_JSON).option("multiLine", True).option("mode", "FAILFAST").json(path).select(F.explode("cameras").alias("c")).select("c.*")
    given, rot, pos = F.col("world_to_camera"), F.col("rotation"), F.col("position")
    direct = F.array(*(given[i][j] for i in range(3) for j in range(3)))
    turned = F.array(*(rot[j][i] for i in range(3) for j in range(3)))
    moved = F.array(*(-(rot[0][i] * pos[0] + rot[1][i] * pos[1] + rot[2][i] * pos[2]) for i in range(3)))
    return rows.select("frame_id", "fx", "fy", "cx", "cy", "w", "h", F.when(given.isNotNull(), direct).otherwise(turned).alias("r"), F.when(given.isNotNull(), F.array(*(given[i][3] for i in range(3)))).otherwise(moved).alias("t"))


def orthonormal_error(r: Column) -> Column:
    """The largest deviation of R R^T from the identity."""
    return F.greatest(*(F.abs(sum(r[3 * i + k] * r[3 * j + k] for k in range(3)) - (1.0 if i == j else 0.0)) for i in range(3) for j in range(3)))


def expand_rle(masks: DataFrame) -> DataFrame:
    """Masks as column-major run lengths (frame_id, mask_id, h, runs; zeros first) to pixels frame_id, mask_id, y, x."""
    run = F.posexplode("runs").alias("i", "n")
    w = Window.partitionBy("frame_id", "mask_id").orderBy("i")
    rows = masks.select("frame_id", "mask_id", "h", run).withColumn("stop", F.sum("n").over(w)).where((F.col("i") % 2 == 1) & (F.col("n") > 0))
    at = rows.select("frame_id", "mask_id", "h", F.explode(F.sequence(F.col("stop") - F.col("n"), F.col("stop") - 1)).alias("p"))
    return at.select("frame_id", "mask_id", (F.col("p") % F.col("h")).alias("y"), F.floor(F.col("p") / F.col("h")).alias("x"))


def metric_log(lines: DataFrame) -> DataFrame:
    """Lines (value) with "[ITER n] ... L1 a PSNR b" to the figures of the latest iteration, for each column in front."""
    num = r"([0-9]+\.?[0-9]*(?:[eE][-+]?[0-9]+)?)"
    rows = lines.select(F.regexp_extract("value", r"ITER\s+([0-9]+)", 1).try_cast("long").alias("iteration"), F.regexp_extract("value", r"L1\s+" + num, 1).try_cast("double").alias("l1"), F.regexp_extract("value", r"PSNR\s+" + num, 1).try_cast("double").alias("psnr"))
    return rows.where(F.col("iteration").isNotNull() & F.col("psnr").isNotNull()).groupBy().agg(F.max_by(F.struct("iteration", "l1", "psnr"), "iteration").alias("m")).select("m.*")


def file_parts(spark: SparkSession, path: str) -> DataFrame:
    """Files below a path with size, digest and their offset in the whole, in order of name."""
    rows = spark.read.format("binaryFile").load(path).select(F.col("path").alias("uri"), F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))
    before = F.sum("size_bytes").over(Window.orderBy("uri").rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("offset", F.coalesce(before, F.lit(0)))


def write_checked(rows: DataFrame, path: str) -> int:
    """Write Parquet where nothing is yet, read it again and compare counts."""
    rows.write.mode("errorifexists").parquet(path)
    kept, now = rows.count(), rows.sparkSession.read.parquet(path).count()
    if kept != now:
        raise ValueError(f"{kept} rows were to be written; {now} are there")
    return now


def write_receipt(rows: DataFrame, path: str) -> None:
    """Rows as JSON lines, keys in order of their names, one file."""
    ordered = rows.select(*sorted(rows.columns))
    ordered.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("errorifexists").text(path)
