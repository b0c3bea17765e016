"""Every scene query with its oracle SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import association, checks, clouds, comparisons, evidence, filling, grids, imaging, meshes, naming, planning, sequences, structure, surfaces, views

_MODULES = (views, imaging, evidence, comparisons, filling, structure, grids, meshes, surfaces, sequences, association, naming, checks, clouds, planning)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for module in _MODULES for name, fn in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
