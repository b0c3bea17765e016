"""Column expressions of the scene geometry: projection, boxes, rays, colours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Points at or below this depth are behind the camera.
NEAR = 1e-6


def camera_axis(row: int, x: Column, y: Column, z: Column) -> Column:
    """One coordinate of a world point in the frame of a camera with columns r (row-major) and t."""
    r, t = F.col("r"), F.col("t")
    return r[3 * row] * x + r[3 * row + 1] * y + r[3 * row + 2] * z + t[row]


def world_axis(axis: int, cx: Column, cy: Column, cz: Column) -> Column:
    """One world coordinate of a point given in a camera's frame: R^T (c - t)."""
    r, t = F.col("r"), F.col("t")
    return r[axis] * (cx - t[0]) + r[axis + 3] * (cy - t[1]) + r[axis + 6] * (cz - t[2])


def camera_center() -> Column:
    """Where a camera with columns r and t stands: -R^T t."""
    r, t = F.col("r"), F.col("t")
    return F.array(*(-(r[a] * t[0] + r[a + 3] * t[1] + r[a + 6] * t[2]) for a in range(3)))


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(sum((a[i] - b[i]) * (a[i] - b[i]) for i in range(3)))


def angle_degrees(a: Column, b: Column) -> Column:
    """Between two directions; null if one has no length."""
    dot = sum(a[i] * b[i] for i in range(3))
    size = F.sqrt(sum(a[i] * a[i] for i in range(3))) * F.sqrt(sum(b[i] * b[i] for i in range(3)))
    return F.when(size > 0, F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot / size)))))


def bbox_iou(a: Column, b: Column) -> Column:
    """Intersection over union of two boxes struct<x0,y0,x1,y1>, half-open; 0 if both are empty."""
    w = F.greatest(F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]), F.lit(0.0))
    h = F.greatest(F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]), F.lit(0.0))
    area = lambda s: (s["x1"] - s["x0"]) * (s["y1"] - s["y0"])
    union = area(a) + area(b) - w * h
    return F.when(union > 0, w * h / union).otherwise(0.0)


def smoothstep(x: Column) -> Column:
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    return t * t * (3 - 2 * t)


def luma(r: Column, g: Column, b: Column) -> Column:
    return 0.2126 * r + 0.7152 * g + 0.0722 * b


def srgb_to_linear(c: Column) -> Column:
    return F.when(c <= 0.04045, c / 12.92).otherwise(F.pow((c + 0.055) / 1.055, 2.4))


def linear_to_srgb(c: Column) -> Column:
    return F.when(c <= 0.0031308, c * 12.92).otherwise(1.055 * F.pow(c, 1 / 2.4) - 0.055)


def inside_bounds(x: Column, y: Column, z: Column, low: Column, high: Column) -> Column:
    return x.between(low[0], high[0]) & y.between(low[1], high[1]) & z.between(low[2], high[2])


def transform_point(matrix: list[list[float]], x: Column, y: Column, z: Column) -> list[Column]:
    """A point under a fixed 4 x 4 matrix (rows), divided by its fourth coordinate; null where that is 0."""
    out = [sum((F.lit(float(m)) * c for m, c in zip(row, (x, y, z), strict=False)), F.lit(float(row[3]))) for row in matrix]
    return [c / F.nullif(out[3], F.lit(0.0)) for c in out[:3]]
