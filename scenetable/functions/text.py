"""Column expressions over stored text: times and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zoned_timestamp(text: Column) -> Column:
    """The instant of an ISO time that ends in Z or an offset; null for one without a zone, or not a time."""
    zoned = text.rlike(r"[T ][0-9:.]+(Z|[+-][0-9]{2}:?[0-9]{2})$")
    return F.when(zoned, F.try_to_timestamp(text))


def rebase_path(path: Column, old: str, new: str) -> Column:
    """`path` with the leading folder `old` replaced by `new`; other paths, and folders that only begin alike, stay."""
    old, new = old.rstrip("/"), new.rstrip("/")
    return F.when((path == old) | path.startswith(old + "/"), F.concat(F.lit(new), F.substring(path, len(old) + 1, 1 << 30))).otherwise(path)
