"""Helpers of the scene operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def small(df: DataFrame, most_rows: int = 10_000) -> DataFrame:
    """`df` with a broadcast hint if it has at most so many rows (counted); else as it is."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def by_sort(df: DataFrame) -> DataFrame:
    """`df` so hinted that its next join does not broadcast either side unless that is told to.

    Spark takes exploded rows for as small as the rows they come from, and written rows for as small as their compressed
    files, so by its estimate it would send whole images through the driver.
    """
    return df.hint("merge")


#: Rows of a partition that is sorted and grouped in one task.
PART_ROWS = 250_000


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """`df` dealt by keys in more partitions as its rows (counted) grow, so that what a task sorts does not grow with them."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // PART_ROWS)), *keys)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows as a table in the folder of spark.checkpoint.dir, which cuts the lineage of loops; joined by sort (`by_sort`)."""
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        root = tempfile.mkdtemp(prefix="scenetable-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return by_sort(spark.read.schema(df.schema).parquet(path))
