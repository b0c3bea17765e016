"""The library's functions for SQL: register(spark) adds scalar functions, which Spark inlines as expressions, and two table functions."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

#: Scalar functions: their arguments and results, and the expression.
FUNCTIONS = {
    "scene_smoothstep": ("x DOUBLE", "DOUBLE", "greatest(0.0D, least(1.0D, x)) * greatest(0.0D, least(1.0D, x)) * (3 - 2 * greatest(0.0D, least(1.0D, x)))"),
    "scene_luma": ("r DOUBLE, g DOUBLE, b DOUBLE", "DOUBLE", "0.2126D * r + 0.7152D * g + 0.0722D * b"),
    "scene_srgb_to_linear": ("c DOUBLE", "DOUBLE", "CASE WHEN c <= 0.04045D THEN c / 12.92D ELSE pow((c + 0.055D) / 1.055D, 2.4D) END"),
    "scene_linear_to_srgb": ("c DOUBLE", "DOUBLE", "CASE WHEN c <= 0.0031308D THEN c * 12.92D ELSE 1.055D * pow(c, 1 / 2.4D) - 0.055D END"),
    "scene_bbox_iou": (
        "ax0 DOUBLE, ay0 DOUBLE, ax1 DOUBLE, ay1 DOUBLE, bx0 DOUBLE, by0 DOUBLE, bx1 DOUBLE, by1 DOUBLE",
        "DOUBLE",
        "coalesce(greatest(least(ax1, bx1) - greatest(ax0, bx0), 0D) * greatest(least(ay1, by1) - greatest(ay0, by0), 0D) / nullif((ax1 - ax0) * (ay1 - ay0) + (bx1 - bx0) * (by1 - by0)"
        " - greatest(least(ax1, bx1) - greatest(ax0, bx0), 0D) * greatest(least(ay1, by1) - greatest(ay0, by0), 0D), 0D), 0D)",
    ),
    "scene_camera_axis": ("i INT, x DOUBLE, y DOUBLE, z DOUBLE, r ARRAY<DOUBLE>, t ARRAY<DOUBLE>", "DOUBLE", "r[3 * i] * x + r[3 * i + 1] * y + r[3 * i + 2] * z + t[i]"),
    "scene_project_u": ("x DOUBLE, y DOUBLE, z DOUBLE, f DOUBLE, c DOUBLE, r ARRAY<DOUBLE>, t ARRAY<DOUBLE>", "DOUBLE", "f * (r[0] * x + r[1] * y + r[2] * z + t[0]) / nullif(r[6] * x + r[7] * y + r[8] * z + t[2], 0D) + c"),
    "scene_project_v": ("x DOUBLE, y DOUBLE, z DOUBLE, f DOUBLE, c DOUBLE, r ARRAY<DOUBLE>, t ARRAY<DOUBLE>", "DOUBLE", "f * (r[3] * x + r[4] * y + r[5] * z + t[1]) / nullif(r[6] * x + r[7] * y + r[8] * z + t[2], 0D) + c"),
    "scene_view_center": ("r ARRAY<DOUBLE>, t ARRAY<DOUBLE>", "ARRAY<DOUBLE>", "array(-(r[0] * t[0] + r[3] * t[1] + r[6] * t[2]), -(r[1] * t[0] + r[4] * t[1] + r[7] * t[2]), -(r[2] * t[0] + r[5] * t[1] + r[8] * t[2]))"),
}


@udtf(returnType="y int, x int", useArrow=False)
class RasterTriangle:
    """scene_raster_triangle(x0, y0, x1, y1, x2, y2, w, h): the pixels of a triangle in a w x h image, row by row."""

    def eval(self, x0: float, y0: float, x1: float, y1: float, x2: float, y2: float, w: int, h: int) -> Iterator[tuple[int, int]]:
        import math

        import numpy as np

        from scenetable.operators.mesh import inside_triangle

        corners = [x0, y0, x1, y1, x2, y2]
        if any(c is None or not math.isfinite(c) for c in corners):
            return
        left, right = max(math.ceil(min(x0, x1, x2)), 0), min(math.floor(max(x0, x1, x2)), w - 1)
        top, bottom = max(math.ceil(min(y0, y1, y2)), 0), min(math.floor(max(y0, y1, y2)), h - 1)
        if left > right:
            return
        across = np.arange(left, right + 1)
        step = max(1, (1 << 16) // len(across))  # rows tested at a time
        for y in range(top, bottom + 1, step):
            down = np.arange(y, min(y + step, bottom + 1))
            yy, xx = np.nonzero(inside_triangle(across[None, :], down[:, None], corners))
            yield from zip((yy + y).tolist(), (xx + left).tolist(), strict=True)


@udtf(returnType="y int, x int", useArrow=False)
class ExpandRuns:
    """scene_expand_runs(runs, h): the pixels of a column-major run-length mask, which begins with a run of zeros."""

    def eval(self, runs: list[int], h: int) -> Iterator[tuple[int, int]]:
        at, inside = 0, False
        for n in runs or ():
            if inside:
                for i in range(at, at + n):
                    yield i % h, i // h
            at, inside = at + n, not inside


def register(spark: SparkSession) -> None:
    """Add all functions to the session."""
    for name, (arguments, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {kind} RETURN {body}")
    spark.udtf.register("scene_raster_triangle", RasterTriangle)
    spark.udtf.register("scene_expand_runs", ExpandRuns)
