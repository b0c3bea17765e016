"""Depth arrays of frames as a Spark data source: format("depth_arrays")."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition


class _Rows(InputPartition):
    def __init__(self, frame: str, path: str, first: int, last: int):
        super().__init__((frame, first, last))
        self.frame, self.path, self.first, self.last = frame, path, first, last


class DepthArrays(DataSource):
    """Pixels (frame_id, y, x, depth) of the .npy and .npz files of a folder; a file's name is its frame_id.

    Options: path, rows_per_partition. A file is read by ranges of image rows; of a .npy file only those rows are read, as it is
    mapped. Filters frame_id = .. and frame_id IN (..) choose the files to open (with spark.sql.python.filterPushdown.enabled). Invalid depths (not finite, or 0 and
    less) are null. Arrays must be numbers of two dimensions; an archive must hold one array, named depth.
    """

    @classmethod
    def name(cls) -> str:
        return "depth_arrays"

    def schema(self) -> str:
        return "frame_id string, y int, x int, depth double"

    def reader(self, schema) -> DataSourceReader:
        return _DepthReader(self.options["path"], int(self.options.get("rows_per_partition", "256")))


def _opened(path: str) -> np.ndarray:
    if path.endswith(".npy"):
        array = np.load(path, mmap_mode="r", allow_pickle=False)
    else:
        with np.load(path, allow_pickle=False) as archive:
            if archive.files != ["depth"]:
                raise ValueError(f"{path} must hold exactly one array, named depth")
            array = archive["depth"]
    if array.ndim != 2 or not np.issubdtype(array.dtype, np.number):
        raise ValueError(f"{path} is no array of numbers with two dimensions")
    return array


class _DepthReader(DataSourceReader):
    def __init__(self, path: str, rows: int):
        self.path, self.rows, self.frames = path, rows, None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, EqualTo | In) and f.attribute == ("frame_id",):
                asked = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.frames = asked if self.frames is None else self.frames & asked
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        out, seen = [], {}
        for p in sorted(Path(self.path).iterdir()):
            if p.suffix in (".npy", ".npz") and (self.frames is None or p.stem in self.frames):
                if p.stem in seen:
                    raise ValueError(f"two arrays for frame {p.stem}")
                seen[p.stem] = p
                height = _opened(str(p)).shape[0]
                out += [_Rows(p.stem, str(p), a, min(a + self.rows, height)) for a in range(0, height, self.rows)]
        return out

    def read(self, part: _Rows) -> Iterator[pa.RecordBatch]:
        depth = np.asarray(_opened(part.path)[part.first : part.last], np.float64)
        y, x = (g.ravel() for g in np.mgrid[part.first : part.first + depth.shape[0], 0 : depth.shape[1]])
        flat = depth.ravel()
        bad = ~(np.isfinite(flat) & (flat > 0))
        yield pa.RecordBatch.from_arrays(
            [pa.array([part.frame] * len(flat), pa.string()), pa.array(y.astype(np.int32)), pa.array(x.astype(np.int32)), pa.array(flat, pa.float64(), mask=bad)], names=["frame_id", "y", "x", "depth"]
        )
