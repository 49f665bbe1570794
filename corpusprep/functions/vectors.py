"""Vector columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """0 where a vector is zero."""
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size == 0, 0.0).otherwise(dot(a, b) / size)


def cosine_distance(a: Column, b: Column) -> Column:
    return 1 - cosine(a, b)
