"""Arithmetic on array<double> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))


def safe_norm(a: Column) -> Column:
    n = norm(a)
    return F.when(n == 0, 1.0).otherwise(n)


def unit(a: Column) -> Column:
    """Divide by the norm; a zero vector stays zero."""
    n = safe_norm(a)
    return F.transform(a, lambda x: x / n)
