"""Helpers shared by the text operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the contracts: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character stays, so that lengths do not change."""
    return F.translate(text, _UPPER, _UPPER.lower())


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which all executors share.

    Only a session without that setting (a local test) gets a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        root = tempfile.mkdtemp(prefix="scenetable-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: later reads survive lost executors."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a `staged` table that nothing reads any more."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for name in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


def give_back() -> None:
    """Return freed memory to the system, as Spark keeps a Python worker for the next task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


def sliced(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that `column` has at most so many bytes in each, or one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(size) - 1) // most_bytes
        starts = np.flatnonzero(np.diff(part, prepend=part[0] - 1))
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(a, b - a)
