"""Reproducible pseudo-randomness from md5, independent of partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_key(seed: int, key) -> Column:
    """32 hex digits for a row key; uniform, so its prefixes are even buckets."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def md5_uniform(seed: int, key, n: int) -> Column:
    """An integer in [0, n) from the first 8 hex digits."""
    return F.conv(F.substring(md5_key(seed, key), 1, 8), 16, 10).cast("bigint") % n
