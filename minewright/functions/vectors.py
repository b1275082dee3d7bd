"""Vector arithmetic as Column expressions, in double precision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def squared_distance(a: Column, b: Column) -> Column:
    """Sum of squared differences of two equally long vectors."""
    squares = F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x)


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(squared_distance(a, b))


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def constant_vector(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])
