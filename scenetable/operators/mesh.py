"""Triangle meshes: audits, carving by boxes, compaction and silhouettes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import NEAR, camera_axis
from .common import checkpointed, small

AXES = ("x", "y", "z")
CORNERS = ("v0", "v1", "v2")
#: Vertices whose new numbers are worked out in one task.
NUMBERED = 1 << 16


def with_corners(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """Faces (mesh_id, fid, v0, v1, v2) with the positions of their corners (x0 .. z2; null for a missing vertex): three joins by (mesh_id, vid)."""
    rows = faces.select("mesh_id", "fid", *CORNERS)
    for k, v in enumerate(CORNERS):
        own = vertices.select("mesh_id", F.col("vid").alias(v), *(F.col(a).cast("double").alias(f"{a}{k}") for a in AXES))
        rows = rows.join(own, ["mesh_id", v], "left")
    return rows


def _finite(*columns: Column) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))
    return out


def mesh_audit(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """What is wrong with each mesh: vertices, faces, finite_vertices, valid_indices, degenerate_faces, boundary_edges, crowded_edges, unused_vertices.

    Indices must name vertices of the mesh. A face is degenerate if its doubled area is at most max(1e-12 of the largest extent's
    square, 1e-18); that is counted where vertices are finite and indices valid. An edge of one face is boundary, one of more than two crowded.
    """
    xyz = [F.col(a).cast("double") for a in AXES]
    extent = lambda a: F.max(F.col(a).cast("double")) - F.min(F.col(a).cast("double"))
    points = vertices.groupBy("mesh_id").agg(F.count("*").alias("vertices"), F.bool_and(_finite(*xyz)).alias("finite_vertices"), F.greatest(*(extent(a) for a in AXES), F.lit(1e-9)).alias("extent"))
    p, q = ([F.col(f"{a}{k}") - F.col(f"{a}0") for a in AXES] for k in (1, 2))
    cross = [p[1] * q[2] - p[2] * q[1], p[2] * q[0] - p[0] * q[2], p[0] * q[1] - p[1] * q[0]]
    placed = with_corners(vertices, faces).join(points.select("mesh_id", "extent"), "mesh_id", "left")
    valid = F.col("x0").isNotNull() & F.col("x1").isNotNull() & F.col("x2").isNotNull()
    flat = F.sqrt(cross[0] * cross[0] + cross[1] * cross[1] + cross[2] * cross[2]) <= F.greatest(F.col("extent") * F.col("extent") * 1e-12, F.lit(1e-18))
    triangles = placed.groupBy("mesh_id").agg(F.count("*").alias("faces"), F.bool_and(valid).alias("valid_indices"), F.count_if(valid & flat).alias("flat"))
    pair = lambda a, b: F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    edges = faces.select("mesh_id", F.explode(F.array(*(pair(CORNERS[k], CORNERS[(k + 1) % 3]) for k in range(3)))).alias("e")).groupBy("mesh_id", "e.a", "e.b").count()
    lines = edges.groupBy("mesh_id").agg(F.count_if(F.col("count") == 1).alias("boundary_edges"), F.count_if(F.col("count") > 2).alias("crowded_edges"))
    used = faces.select("mesh_id", F.explode(F.array(*CORNERS)).alias("vid")).distinct()
    unused = vertices.join(used, ["mesh_id", "vid"], "left_anti").groupBy("mesh_id").agg(F.count("*").alias("unused_vertices"))
    out = points.join(triangles, "mesh_id", "full").join(lines, "mesh_id", "left").join(unused, "mesh_id", "left")
    ready = F.coalesce("finite_vertices", F.lit(False)) & F.coalesce("valid_indices", F.lit(False))
    count = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select(
        "mesh_id", count("vertices"), count("faces"), F.coalesce("finite_vertices", F.lit(False)).alias("finite_vertices"), F.coalesce("valid_indices", F.lit(False)).alias("valid_indices"),
        F.when(ready, F.col("flat")).otherwise(0).alias("degenerate_faces"), count("boundary_edges"), count("crowded_edges"), count("unused_vertices"),
    )


def _cells(axis: str, low: str, high: str, cell: float) -> Column:
    return F.explode(F.sequence(F.floor(F.col(low) / cell), F.floor(F.col(high) / cell))).alias(f"c{axis}")


def carve_faces(vertices: DataFrame, faces: DataFrame, bounds: DataFrame, cell: float = 1.0) -> DataFrame:
    """Which box (object_id, ord, x0 .. z1) removes each face: faces and object_id, null for faces that stay; the first box by ord.

    A face goes if its own box meets the object's (touching counts). Faces and boxes meet in grid cells of `cell`, then exactly.
    A face that names a missing vertex raises, as the mesh is broken.
    """
    rows = checkpointed(with_corners(vertices, faces))
    if rows.where(F.col("x0").isNull() | F.col("x1").isNull() | F.col("x2").isNull()).limit(1).count():
        raise ValueError("a face names a vertex that is not there")
    ends = {f"{e}{a}": f(*(F.col(f"{a}{k}") for k in range(3))) for a in AXES for e, f in (("l", F.least), ("h", F.greatest))}
    own = rows.select("mesh_id", "fid", *(c.alias(n) for n, c in ends.items()))
    for a in AXES:
        own = own.select("*", _cells(a, f"l{a}", f"h{a}", cell))
    boxes = bounds
    for a in AXES:
        boxes = boxes.select("*", _cells(a, f"{a}0", f"{a}1", cell))
    near = own.join(boxes, [f"c{a}" for a in AXES])
    for a in AXES:
        near = near.where((F.col(f"l{a}") <= F.col(f"{a}1")) & (F.col(f"h{a}") >= F.col(f"{a}0")))
    first = near.groupBy("mesh_id", "fid").agg(F.min_by("object_id", "ord").alias("object_id"))
    return faces.select("mesh_id", "fid", *CORNERS).join(first, ["mesh_id", "fid"], "left")


def compact_mesh(vertices: DataFrame, faces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The vertices that faces use, numbered anew from 0 by old number (old in old_vid), and the faces over the new numbers.

    Numbers come from counts of blocks of NUMBERED old ones and a running sum in each block, so no task sees a whole mesh.
    """
    used = faces.select("mesh_id", F.explode(F.array(*CORNERS)).alias("vid")).distinct()
    kept = vertices.join(used, ["mesh_id", "vid"], "left_semi").withColumn("_b", F.floor(F.col("vid") / NUMBERED))
    kept = checkpointed(kept)
    blocks = kept.groupBy("mesh_id", "_b").agg(F.count("*").alias("_n"))
    before = blocks.select("mesh_id", "_b", (F.sum("_n").over(Window.partitionBy("mesh_id").orderBy("_b")) - F.col("_n")).alias("_s"))
    inside = F.row_number().over(Window.partitionBy("mesh_id", "_b").orderBy("vid")) - 1
    new = checkpointed(kept.join(before, ["mesh_id", "_b"]).withColumn("_new", inside + F.col("_s")))
    names = new.select("mesh_id", F.col("vid").alias("old"), "_new")
    out = faces.select("mesh_id", "fid", *CORNERS)
    for v in CORNERS:
        out = out.join(names.withColumnsRenamed({"old": v, "_new": f"_{v}"}), ["mesh_id", v])
    columns = [c for c in vertices.columns if c not in ("mesh_id", "vid")]
    return new.select("mesh_id", F.col("_new").alias("vid"), F.col("vid").alias("old_vid"), *columns), out.select("mesh_id", "fid", *(F.col(f"_{v}").alias(v) for v in CORNERS))


def inside_triangle(px: np.ndarray, py: np.ndarray, corners: list[np.ndarray]) -> np.ndarray:
    """Whether pixel centres are in or on triangles (x0, y0, x1, y1, x2, y2), of either turn, and within their boxes."""
    x0, y0, x1, y1, x2, y2 = corners
    turns = [(bx - ax) * (py - ay) - (by - ay) * (px - ax) for ax, ay, bx, by in ((x0, y0, x1, y1), (x1, y1, x2, y2), (x2, y2, x0, y0))]
    one = (turns[0] >= 0) & (turns[1] >= 0) & (turns[2] >= 0) | (turns[0] <= 0) & (turns[1] <= 0) & (turns[2] <= 0)
    low = lambda *v: np.minimum(np.minimum(v[0], v[1]), v[2])
    high = lambda *v: np.maximum(np.maximum(v[0], v[1]), v[2])
    return one & (px >= low(x0, x1, x2)) & (px <= high(x0, x1, x2)) & (py >= low(y0, y1, y2)) & (py <= high(y0, y1, y2))


CORNER_COLUMNS = ("x0", "y0", "x1", "y1", "x2", "y2")


def raster_triangles(triangles: DataFrame, tile: int = 16) -> DataFrame:
    """The pixels of triangles in images (frame_id, w, h, x0, y0, x1, y1, x2, y2): frame_id, y, x, each once.

    A triangle goes to the tiles that its box touches, so a large one is worked on in many rows, which may lie in many tasks; a batch of
    rows tests all pixels of their tiles at once. Pixels are dropped to distinct ones in each batch, and then all over.
    """
    low, high = {}, {}
    for a, size in (("x", "w"), ("y", "h")):
        cs = [F.col(f"{a}{k}") for k in range(3)]
        low[a], high[a] = F.greatest(F.ceil(F.least(*cs)), F.lit(0)), F.least(F.floor(F.greatest(*cs)), F.col(size) - 1)
    rows = triangles.where(_finite(*(F.col(c) for c in CORNER_COLUMNS))).where((F.abs(F.least("x0", "x1", "x2")) < 1e9) & (F.abs(F.greatest("x0", "x1", "x2")) < 1e9) & (F.abs(F.least("y0", "y1", "y2")) < 1e9) & (F.abs(F.greatest("y0", "y1", "y2")) < 1e9))
    rows = rows.withColumns({f"_{e}{a}": (low if e == "l" else high)[a] for a in "xy" for e in "lh"}).where((F.col("_lx") <= F.col("_hx")) & (F.col("_ly") <= F.col("_hy")))
    cells = lambda a: F.explode(F.sequence(F.floor(F.col(f"_l{a}") / tile), F.floor(F.col(f"_h{a}") / tile)))
    rows = rows.withColumn("ty", cells("y")).withColumn("tx", cells("x")).select("frame_id", "w", "h", *CORNER_COLUMNS, "ty", "tx")

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yy, xx = (g.ravel() for g in np.mgrid[0:tile, 0:tile])
        step = max(1, (1 << 20) // (tile * tile))
        for batch in batches:
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                get = {c: part.column(c).to_numpy(zero_copy_only=False)[:, None] for c in (*CORNER_COLUMNS, "w", "h", "ty", "tx")}
                py, px = get["ty"] * tile + yy, get["tx"] * tile + xx
                hit = inside_triangle(px, py, [get[c] for c in CORNER_COLUMNS]) & (px < get["w"]) & (py < get["h"])
                row, cell = np.nonzero(hit)
                found = pa.table([part.column("frame_id").take(pa.array(row)), pa.array(py[row, cell].astype(np.int32)), pa.array(px[row, cell].astype(np.int32))], names=["frame_id", "y", "x"])
                yield from found.group_by(["frame_id", "y", "x"]).aggregate([]).to_batches()

    kind = dict(triangles.dtypes)["frame_id"]
    return rows.mapInArrow(drawn, f"frame_id {kind}, y int, x int").distinct()


def mesh_silhouette(vertices: DataFrame, faces: DataFrame, cameras: DataFrame, tile: int = 16) -> DataFrame:
    """The pixels of each camera (mesh_id, frame_id, ...) that its mesh covers: frame_id, y, x. Faces with a corner behind the camera are left out."""
    rows = with_corners(vertices, faces).join(small(cameras.select("mesh_id", "frame_id", "fx", "fy", "cx", "cy", "w", "h", "r", "t")), "mesh_id")
    rows = rows.select("frame_id", "fx", "fy", "cx", "cy", "w", "h", *(camera_axis(i, F.col(f"x{k}"), F.col(f"y{k}"), F.col(f"z{k}")).alias(f"{a}{k}") for k in range(3) for i, a in enumerate("abd")))
    rows = rows.where((F.col("d0") > NEAR) & (F.col("d1") > NEAR) & (F.col("d2") > NEAR))
    places = [c for k in range(3) for c in ((F.col("fx") * F.col(f"a{k}") / F.col(f"d{k}") + F.col("cx")).alias(f"x{k}"), (F.col("fy") * F.col(f"b{k}") / F.col(f"d{k}") + F.col("cy")).alias(f"y{k}"))]
    return raster_triangles(rows.select("frame_id", "w", "h", *places), tile)
