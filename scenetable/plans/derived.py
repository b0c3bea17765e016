"""Scene tables derived from the shared tables: the same SQL text serves Spark and the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Points of a cloud, from lineitem.
PTS = """SELECT l_orderkey * 8 + l_linenumber AS point_id, l_returnflag AS obj, l_suppkey AS supp, l_partkey AS part, l_linenumber AS line,
 (l_partkey % 101) / 10.0e0 - 5.0e0 AS x, (l_suppkey % 37) / 10.0e0 - 1.8e0 AS y, 4.0e0 + l_quantity / 10.0e0 AS z,
 l_quantity AS quantity, l_extendedprice AS weight, l_discount AS discount FROM lineitem"""
#: Cameras in a row along x with identity rotations, from nation.
CAMS = "SELECT n_nationkey AS cam, (n_nationkey - 12) * 0.25e0 AS cam_x FROM nation"
#: Three-dimensional points with cloud labels, from embeddings.
VECS = "SELECT vec_id AS point_id, label, CAST(embedding[{0}] AS DOUBLE) AS x, CAST(embedding[{1}] AS DOUBLE) AS y, CAST(embedding[{2}] AS DOUBLE) AS z FROM embeddings"
VECS_SPARK, VECS_DUCK = VECS.format(0, 1, 2), VECS.format(1, 2, 3)
#: A sparse image by order priority: pixels of 64 columns with a grey value.
IMAGE = """SELECT CAST(l_linenumber AS INTEGER) AS frame_id, CAST((l_orderkey % 4096) // 64 AS INTEGER) AS y, CAST(l_orderkey % 64 AS INTEGER) AS x,
 avg(l_quantity) AS v, max(l_discount) AS d FROM lineitem GROUP BY 1, 2, 3"""
IMAGE_SPARK = IMAGE.replace("(l_orderkey % 4096) // 64", "(l_orderkey % 4096) div 64")


def _read(spark: SparkSession, sf_dir: str, sql: str, table: str) -> DataFrame:
    spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(f"scene_{table}")
    return spark.sql(sql.replace(f"FROM {table}", f"FROM scene_{table}"))


#: Rows of a partition that is sorted and grouped in one task.
PART_ROWS = 250_000


def parts(spark: SparkSession, rows: int) -> int:
    """How many partitions so many rows take: more as they grow, so that what a task sorts does not grow with the table."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // PART_ROWS))


def spread(spark: SparkSession, sf_dir: str, sql: str, table: str, keys: list[str]) -> DataFrame:
    """`_read` of a table dealt by the SQL expressions that `sql` groups by first, in `parts` of its rows (which the files tell)."""
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    rows.repartition(parts(spark, rows.count()), *map(F.expr, keys)).createOrReplaceTempView(f"scene_dealt_{table}")
    return spark.sql(sql.replace(f"FROM {table}", f"FROM scene_dealt_{table}"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, PTS, "lineitem")


def cameras(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = [1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0]
    return _read(spark, sf_dir, CAMS, "nation").select(
        F.col("cam").alias("frame_id"), *(F.lit(v).alias(n) for n, v in (("fx", 64.0), ("fy", 64.0), ("cx", 64.0), ("cy", 48.0))), F.lit(128).alias("w"), F.lit(96).alias("h"),
        F.array(*map(F.lit, one)).alias("r"), F.array(-F.col("cam_x"), F.lit(0.0), F.lit(0.0)).alias("t"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, VECS_SPARK, "embeddings")


def image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, IMAGE_SPARK, "lineitem")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The oracle's projection: every point in every camera that sees it.
PROJECTED_SQL = f"""pts AS ({PTS}), cams AS ({CAMS}),
proj AS (SELECT p.*, c.cam, round_even(64.0e0 * (x - cam_x) / z + 64.0e0, 0) AS px, round_even(64.0e0 * y / z + 48.0e0, 0) AS py, z AS depth
         FROM pts p CROSS JOIN cams c),
seen AS (SELECT * FROM proj WHERE depth > 1e-6 AND px >= 0 AND px < 128 AND py >= 0 AND py < 96)"""
