"""A lookup join that stays even when a few keys hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

SKEW_JOIN = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")


def lookup_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join to a table with unique keys; each side is read once.

    A key with a third of all rows makes one large partition of `left`. Spark's skew join, which
    must be on (its default), cuts such a partition by the tasks that wrote it and gives each piece the
    partition's rows of `right`, at most one per key. The limit is a partition's size, so keys just below it
    are no load either. Rows with a NULL key match nothing and are cut alike.
    """
    spark = left.sparkSession
    off = [c for c in SKEW_JOIN if spark.conf.get(c, "true").lower() != "true"]
    if off:
        raise ValueError(f"lookup_join needs {' and '.join(off)}")
    return left.join(right, key, "left")
