"""Feature scaling with parameters fitted on one table and applied to others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_standard(df: DataFrame, features) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per feature; one row reaches the driver."""
    row = df.agg(
        *[F.avg(F.col(f).cast("double")).alias(f"m_{f}") for f in features],
        *[F.stddev_pop(f).alias(f"s_{f}") for f in features],
    ).first()
    return {f: (row[f"m_{f}"], row[f"s_{f}"] or 1.0) for f in features}


def apply_standard(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({f: (F.col(f).cast("double") - m) / s for f, (m, s) in params.items()})


def fit_minmax(df: DataFrame, features) -> dict[str, tuple[float, float]]:
    row = df.agg(
        *[F.min(F.col(f).cast("double")).alias(f"lo_{f}") for f in features],
        *[F.max(F.col(f).cast("double")).alias(f"hi_{f}") for f in features],
    ).first()
    return {f: (row[f"lo_{f}"], row[f"hi_{f}"]) for f in features}


def apply_minmax(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    """To [0, 1]; a constant feature becomes 0."""
    return df.withColumns(
        {
            f: F.lit(0.0) if hi == lo else (F.col(f).cast("double") - lo) / (hi - lo)
            for f, (lo, hi) in params.items()
        }
    )


def log_scale(df: DataFrame, features) -> DataFrame:
    """log(1 + x) for skewed amounts; negative amounts count as 0."""
    return df.withColumns({f: F.log1p(F.greatest(F.col(f).cast("double"), F.lit(0.0))) for f in features})
