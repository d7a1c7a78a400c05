"""Global running sums and exact quantiles without a single-task window."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.session import materialize


def prefix_sums(
    hist: DataFrame, by: str, sums, groups=(), descending: bool = False, parts: int | None = None
) -> DataFrame:
    """Running and total sums over a histogram, per group and in order of `by`.

    `hist` has one row per (group, by). It is range-partitioned on both, written once
    with its range number, and summed in two levels: inside a range by a window, and
    over the per-range totals (at most one row per range and group). No task holds
    more than one range, even when there is one group or one group has most values.
    Adds `cum_<c>` (inclusive) and `tot_<c>` for each summed column.
    """
    spark = hist.sparkSession
    groups = list(groups)
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.col(by).desc() if descending else F.col(by).asc()
    ranged = materialize(
        hist.repartitionByRange(n, *groups, order).withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    totals = ranged.groupBy(*groups, "_range").agg(*[F.sum(c).alias(c) for c in sums])
    upto = Window.partitionBy(*groups).orderBy("_range")
    whole = Window.partitionBy(*groups)
    offsets = totals.select(
        *groups,
        "_range",
        *[(F.sum(c).over(upto) - F.col(c)).alias(f"_off_{c}") for c in sums],
        *[F.sum(c).over(whole).alias(f"tot_{c}") for c in sums],
    )
    inside = Window.partitionBy(*groups, "_range").orderBy(order)
    # The window needs rows hashed by group and range anyway; the join shares that.
    joined = ranged.join(offsets if groups else F.broadcast(offsets), [*groups, "_range"])
    running = {f"cum_{c}": F.col(f"_off_{c}") + F.sum(c).over(inside) for c in sums}
    return joined.withColumns(running).drop("_range", *[f"_off_{c}" for c in sums])


def value_histogram(long: DataFrame, value: str, groups=(), counts: dict | None = None) -> DataFrame:
    """Distinct values with their counts; later steps work on this smaller table."""
    counts = counts or {"n": F.count(F.lit(1))}
    return long.filter(F.col(value).isNotNull()).groupBy(*groups, value).agg(
        *[c.alias(name) for name, c in counts.items()]
    )


def quantiles_from(cumulated: DataFrame, value: str, probs, groups=(), count: str = "n") -> DataFrame:
    """Exact discrete quantiles: the smallest value whose share reaches p."""
    total = F.col(f"tot_{count}").cast("decimal(20,0)")
    cols = [
        F.min(
            # decimal product, so that 100 x 0.55 is 55 and not a little more
            F.when(F.col(f"cum_{count}") >= F.ceil(total * F.lit(Decimal(str(p)))), F.col(value))
        ).alias(f"q{i}")
        for i, p in enumerate(probs)
    ]
    return cumulated.filter(F.col(count) > 0).groupBy(*groups).agg(*cols)


def exact_quantiles(long: DataFrame, value: str, probs, groups=()) -> DataFrame:
    """Columns q0, q1, ... per group, one for each probability."""
    hist = value_histogram(long, value, groups)
    return quantiles_from(prefix_sums(hist, value, ["n"], groups), value, probs, groups)


def exact_medians(long: DataFrame, value: str, groups=()) -> DataFrame:
    """Column `median` per group: the middle value, or the mean of the two middle ones."""
    cum = prefix_sums(value_histogram(long, value, groups), value, ["n"], groups)
    n, reached = F.col("tot_n"), F.col("cum_n")
    low = F.min(F.when(reached >= F.ceil(n / F.lit(2)), F.col(value)))
    high = F.min(F.when(reached >= F.floor(n / F.lit(2)) + 1, F.col(value)))
    return cum.groupBy(*groups).agg(((low + high) / 2).alias("median"))
