"""Vector columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda s, x: s + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine similarity, between 0 and 2; null for a zero vector."""
    return F.lit(1.0) - F.try_divide(dot(a, b), norm(a) * norm(b))


def unit(a: Column) -> Column:
    n = norm(a)
    return F.transform(a, lambda x: F.try_divide(x.cast("double"), n))
