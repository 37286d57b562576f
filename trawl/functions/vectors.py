"""Vector expressions over ``array<float>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, p: s + p)


def norm(a: Column) -> Column:
    """Euclidean length in double precision."""
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine_similarity(a: Column, b: Column) -> Column:
    """1 - cosine distance; NULL for a zero vector or a missing one."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))
