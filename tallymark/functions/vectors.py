"""Vector arithmetic on array<double> columns."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 1e-12


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it inside `body`, also within other lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2_normalize(vector: Column) -> Column:
    """Unit-length vector; a zero vector stays zero."""
    vector = vector.cast("array<double>")
    squares = F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x * x)
    norm = F.sqrt(F.greatest(squares, F.lit(EPSILON)))
    return let(norm, lambda n: F.transform(vector, lambda x: x / n))


def matvec(rows: Column, vector: Column) -> Column:
    """Dot product of every row of `rows` (array of arrays) with `vector`."""
    return F.transform(rows, lambda row: dot(row, vector))


def mean_per_dimension(vector: Column, size: int) -> list[Column]:
    """One avg() per dimension.

    Numbers combine map-side, so a shuffle carries one partial row per group instead of one row
    per group member and dimension.
    """
    return [F.avg(F.get(vector, F.lit(i))).alias(f"_dim{i}") for i in range(size)]


def dimensions(size: int) -> Column:
    """The columns of `mean_per_dimension` as one array; groups without members give zeros."""
    return F.array(*[F.coalesce(F.col(f"_dim{i}"), F.lit(0.0)) for i in range(size)])
