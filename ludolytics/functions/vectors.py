"""Vector expressions over array<float> columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_similarity(a: Column, b: Column) -> Column:
    """NULL when either vector has length zero or the sizes differ."""
    scale = norm(a) * norm(b)
    return F.when((F.size(a) == F.size(b)) & (scale > 0), dot(a, b) / scale)


def cosine_distance(a: Column, b: Column) -> Column:
    return 1 - cosine_similarity(a, b)


def vector_literal(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def has_size(a: Column | str, size: int) -> Column:
    return F.size(a) == size
