"""Vector column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm(v: Column) -> Column:
    """Length; missing components count as none."""
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + F.coalesce(x.cast("double") * x.cast("double"), F.lit(0.0))))


def normalize(v: Column, zero: float | None = None) -> Column:
    """Unit length; a zero vector stays as it is, or has ``zero`` for every component."""
    length = norm(v)
    kept = lambda x: x.cast("double") if zero is None else F.when(x.isNotNull(), F.lit(zero))
    return F.when(length == 0, F.transform(v, kept)).otherwise(
        F.transform(v, lambda x: x.cast("double") / length)
    )
