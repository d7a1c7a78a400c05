"""Number handling: clipping, exact sums, reference-style rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(c: Column, lo, hi) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), c))


def calibrate(c: Column, scale: float, shift: float, lo, hi) -> Column:
    """Affine map to business units, held inside a range."""
    return clip(c * scale + shift, float(lo), float(hi))


def exact_sum(c, precision: int = 38, scale: int = 6) -> Column:
    """Sum of doubles through decimals: the same value in any row order."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast(f"decimal({min(precision, 28)},{scale})")).cast("double")


def share(cond: Column) -> Column:
    """Percentage of rows for which the condition holds."""
    return F.avg(F.when(cond, 1.0).otherwise(0.0)) * 100
