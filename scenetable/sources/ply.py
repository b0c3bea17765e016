"""PLY point and mesh tables as a Spark data source: format("ply")."""

from __future__ import annotations

import struct
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

#: Scalar types of the format: struct code and whether whole numbers.
SCALARS = {"char": ("b", True), "int8": ("b", True), "uchar": ("B", True), "uint8": ("B", True), "short": ("h", True), "int16": ("h", True), "ushort": ("H", True), "uint16": ("H", True), "int": ("i", True), "int32": ("i", True), "uint": ("I", True), "uint32": ("I", True), "float": ("f", False), "float32": ("f", False), "double": ("d", False), "float64": ("d", False)}


def parse_header(raw: bytes) -> tuple[str, list[tuple[str, int, list[tuple[str, str]]]], int]:
    """Format, elements (name, count, properties) and where the data begins. List properties have type "list a b"."""
    end = raw.find(b"end_header")
    if not raw.startswith(b"ply") or end < 0:
        raise ValueError("no PLY header")
    kind, elements = "", []
    for line in raw[:end].decode("ascii").splitlines()[1:]:
        words = line.split()
        if words[:1] == ["format"]:
            kind = words[1]
        elif words[:1] == ["element"]:
            elements.append((words[1], int(words[2]), []))
        elif words[:1] == ["property"]:
            elements[-1][2].append((words[-1], " ".join(words[1:-1])))
    return kind, elements, raw.index(b"\n", end) + 1


class _Range(InputPartition):
    def __init__(self, first: int, last: int):
        super().__init__((first, last))
        self.first, self.last = first, last


class PlyDataSource(DataSource):
    """Vertices or triangles of one PLY file, read by ranges of fixed-size rows.

    Options: path, rows_per_partition, and element: vertex (the default; point_id and the file's columns) or face (fid, v0, v1, v2).
    Faces must be triangles in one list property; a binary file must end with their last row.
    """

    @classmethod
    def name(cls) -> str:
        return "ply"

    def _header(self):
        with open(self.options["path"], "rb") as f:
            return parse_header(f.read(1 << 16))

    def schema(self) -> StructType:
        _, elements, _ = self._header()
        name, _, columns = elements[0]
        if name != "vertex" or any(t.startswith("list") for _, t in columns):
            raise ValueError("the first element must be vertices of scalars")
        if self.options.get("element", "vertex") == "face":
            if len(elements) < 2 or elements[1][0] != "face" or len(elements[1][2]) != 1 or not elements[1][2][0][1].startswith("list"):
                raise ValueError("the second element must be faces with one list property")
            return StructType([StructField(c, LongType()) for c in ("fid", "v0", "v1", "v2")])
        return StructType([StructField("point_id", LongType()), *(StructField(c, LongType() if SCALARS[t][1] else DoubleType()) for c, t in columns)])

    def reader(self, schema: StructType) -> DataSourceReader:
        kind = _FaceReader if self.options.get("element", "vertex") == "face" else _PlyReader
        return kind(self.options["path"], int(self.options.get("rows_per_partition", "1000000")))


class _PlyReader(DataSourceReader):
    def __init__(self, path: str, rows: int):
        self.path, self.rows = path, rows
        with open(path, "rb") as f:
            self.kind, elements, self.start = parse_header(f.read(1 << 16))
        self.count, self.columns = elements[0][1], elements[0][2]

    def partitions(self) -> list[InputPartition]:
        step = self.count if self.kind == "ascii" else self.rows
        return [_Range(a, min(a + step, self.count)) for a in range(0, self.count, max(step, 1))]

    def read(self, part: _Range) -> Iterator[tuple]:
        with open(self.path, "rb") as f:
            f.seek(self.start)
            if self.kind == "ascii":
                for i in range(part.last):
                    words = f.readline().split()
                    if i >= part.first:
                        yield (i, *(int(w) if SCALARS[t][1] else float(w) for w, (_, t) in zip(words, self.columns, strict=False)))
                return
            row = struct.Struct(("<" if "little" in self.kind else ">") + "".join(SCALARS[t][0] for _, t in self.columns))
            f.seek(self.start + row.size * part.first)
            for i, values in enumerate(row.iter_unpack(f.read(row.size * (part.last - part.first))), part.first):
                yield (i, *values)


class _FaceReader(_PlyReader):
    """Triangles: rows of a count and three vertex numbers, which are of one size, so ranges can be read."""

    def __init__(self, path: str, rows: int):
        super().__init__(path, rows)
        with open(path, "rb") as f:
            _, elements, _ = parse_header(f.read(1 << 16))
            size = f.seek(0, 2)
        order = "<" if "little" in self.kind else ">"
        self.before, self.count = self.count, elements[1][1]
        count, index = elements[1][2][0][1].split()[1:]
        self.row = f"{order}{SCALARS[count][0]}3{SCALARS[index][0]}"
        if self.kind != "ascii":
            self.start += self.before * struct.calcsize(order + "".join(SCALARS[t][0] for _, t in self.columns))
            if len(elements) == 2 and self.start + self.count * struct.calcsize(self.row) != size:
                raise ValueError("the file does not end with its last triangle")

    def read(self, part: _Range) -> Iterator[tuple]:
        with open(self.path, "rb") as f:
            f.seek(self.start)
            if self.kind == "ascii":
                for _ in range(self.before + part.first):
                    f.readline()
                rows = (tuple(map(int, f.readline().split())) for _ in range(part.last - part.first))
            else:
                size = struct.calcsize(self.row)
                f.seek(size * part.first, 1)
                rows = struct.iter_unpack(self.row, f.read(size * (part.last - part.first)))
            for fid, row in enumerate(rows, part.first):
                if len(row) != 4 or row[0] != 3:
                    raise ValueError(f"face {fid} is no triangle")
                yield (fid, *row[1:])
