"""Vector expressions on ``array<float>`` columns, accumulated in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_similarity(a: Column, b: Column) -> Column:
    """Cosine of the angle; NULL when either vector has no direction."""
    length = norm(a) * norm(b)
    return F.when(length > 0, dot(a, b) / length)


def l2_distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(
        a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))
    )
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))
