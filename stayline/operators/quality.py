"""Data quality and drift checks on value histograms and conditional aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.operators.ranks import prefix_sums, quantiles_from, value_histogram
from stayline.session import local_table

PSI_FLOOR = 1e-4

# Fixed values: (metric, direction, goal, alert) of the quality and clustering metrics.
LIMITS = (
    ("completeness_pct", "high", 80.0, 60.0),
    ("outlier_pct", "low", 5.0, 15.0),
    ("feature_coverage_pct", "high", 100.0, 100.0),
    ("freshness_days", "low", 30.0, 90.0),
    ("profile_coverage_pct", "high", 95.0, 95.0),
    ("psi", "low", 0.1, 0.25),
    ("silhouette", "high", 0.40, 0.25),
    ("cluster_stability_ari", "high", 0.85, 0.85),
    ("recall_at_5", "high", 0.80, 0.80),
    ("context_precision", "high", 0.75, 0.75),
    ("churn_pct", "high", 5.0, 5.0),
)


def to_long(df: DataFrame, features, keep=()) -> DataFrame:
    doubles = df.select(*keep, *[F.col(f).cast("double").alias(f) for f in features])
    return doubles.unpivot(list(keep), list(features), "feature", "value")


def compared_histogram(df: DataFrame, features, is_reference) -> DataFrame:
    """Cumulated counts of reference and current rows per feature and distinct value."""
    long = to_long(df.withColumn("_ref", is_reference), features, keep=["_ref"])
    hist = value_histogram(
        long, "value", ["feature"], {"n_ref": F.count_if("_ref"), "n_cur": F.count_if(~F.col("_ref"))}
    )
    return prefix_sums(hist, "value", ["n_ref", "n_cur"], ["feature"])


def population_stability(cum: DataFrame, bins: int = 10, floor: float = PSI_FLOOR) -> DataFrame:
    """PSI per feature with bins cut at the quantiles of the reference."""
    probs = [i / bins for i in range(1, bins)]
    cuts = quantiles_from(cum, "value", probs, ["feature"], "n_ref").select(
        "feature", F.array(*[F.col(f"q{i}") for i in range(len(probs))]).alias("_cuts")
    )
    # one row per feature of the list given by the caller
    binned = cum.join(F.broadcast(cuts), "feature").withColumn(
        "bin", F.size(F.filter("_cuts", lambda c: c < F.col("value")))
    )
    counts = binned.groupBy("feature", "bin", "tot_n_ref", "tot_n_cur").agg(
        F.sum("n_ref").alias("r"), F.sum("n_cur").alias("c")
    )
    p = F.greatest(F.col("r") / F.col("tot_n_ref"), F.lit(floor))
    q = F.greatest(F.col("c") / F.col("tot_n_cur"), F.lit(floor))
    return counts.groupBy("feature").agg(F.sum((p - q) * F.log(p / q)).alias("psi"))


def kolmogorov_smirnov(cum: DataFrame) -> DataFrame:
    """Largest gap between the two empirical distributions, per feature."""
    gap = F.abs(F.col("cum_n_ref") / F.col("tot_n_ref") - F.col("cum_n_cur") / F.col("tot_n_cur"))
    return cum.groupBy("feature").agg(F.max(gap).alias("ks"))


def chi_square(df: DataFrame, category: str, is_reference) -> DataFrame:
    """Pearson statistic and degrees of freedom of category x period.

    With two periods the total per category is enough, so one aggregate by category and
    one over categories do it.
    """
    cells = df.withColumn("_ref", is_reference).groupBy(category).agg(
        F.count_if("_ref").alias("_n_ref"), F.count_if(~F.col("_ref")).alias("_n_cur")
    )
    # sum over cells of (o - e)^2 / e, with e = row total x column total / n
    both = F.col("_n_ref") + F.col("_n_cur")
    sums = cells.agg(
        F.sum("_n_ref").cast("double").alias("_sum_ref"),
        F.sum("_n_cur").cast("double").alias("_sum_cur"),
        F.sum(F.col("_n_ref") * (F.col("_n_ref") / both)).alias("_sq_ref"),
        F.sum(F.col("_n_cur") * (F.col("_n_cur") / both)).alias("_sq_cur"),
        (F.count(F.lit(1)) - 1).alias("dof"),
    )
    n = F.col("_sum_ref") + F.col("_sum_cur")
    parts = F.try_divide("_sq_ref", F.col("_sum_ref")) + F.try_divide("_sq_cur", F.col("_sum_cur"))
    return sums.select((n * (parts - 1)).alias("chi2"), "dof")


def feature_stats(df: DataFrame, features, probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """Count, null share, mean, deviation, min, max and exact quantiles per feature."""
    long = to_long(df, features)
    basic = long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(F.col("value").isNull().cast("double")).alias("null_rate"),
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    hist = value_histogram(long, "value", ["feature"])
    cuts = quantiles_from(prefix_sums(hist, "value", ["n"], ["feature"]), "value", probs, ["feature"])
    named = cuts.select("feature", *[F.col(f"q{i}").alias(f"p{round(p * 100)}") for i, p in enumerate(probs)])
    return basic.join(F.broadcast(named), "feature", "left")


def compare_stats(current: DataFrame, reference: DataFrame, columns=("mean", "std", "null_rate")) -> DataFrame:
    """Full outer join of two snapshots with differences."""
    cur = current.select("feature", *[F.col(c).alias(f"cur_{c}") for c in columns])
    ref = reference.select("feature", *[F.col(c).alias(f"ref_{c}") for c in columns])
    return cur.join(ref, "feature", "full_outer").withColumns(
        {f"diff_{c}": F.col(f"cur_{c}") - F.col(f"ref_{c}") for c in columns}
    )


def completeness(df: DataFrame, features, group: str) -> DataFrame:
    """Mean share of filled fields per row, in percent."""
    filled = sum((F.col(f).isNotNull().cast("int") for f in features), F.lit(0))
    return df.groupBy(group).agg((F.avg(filled / len(features)) * 100).alias("completeness_pct"))


def outlier_rate(df: DataFrame, features, rule: str = "iqr", width: float | None = None) -> DataFrame:
    """Share of values outside quartiles +- 1.5 IQR, or mean +- 3 deviations, per feature."""
    hist = value_histogram(to_long(df, features), "value", ["feature"])
    if rule == "iqr":
        w = 1.5 if width is None else width
        cum = prefix_sums(hist, "value", ["n"], ["feature"])
        q = quantiles_from(cum, "value", [0.25, 0.75], ["feature"])
        iqr = F.col("q1") - F.col("q0")
        bounds = q.select("feature", (F.col("q0") - w * iqr).alias("lo"), (F.col("q1") + w * iqr).alias("hi"))
        counted = cum
    else:
        w = 3.0 if width is None else width
        long = to_long(df, features)
        m = long.groupBy("feature").agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("s"))
        bounds = m.select("feature", (F.col("m") - w * F.col("s")).alias("lo"), (F.col("m") + w * F.col("s")).alias("hi"))
        counted = hist
    out = (F.col("value") < F.col("lo")) | (F.col("value") > F.col("hi"))
    return (
        counted.join(F.broadcast(bounds), "feature")
        .groupBy("feature")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(out, F.col("n")).otherwise(0)).alias("outliers"),
        )
        .withColumn("outlier_pct", F.col("outliers") / F.col("n") * 100)
    )


def schema_table(df: DataFrame) -> DataFrame:
    return local_table(df.sparkSession, df.dtypes, "feature string, type string")


def schema_drift(current: DataFrame, expected: DataFrame) -> DataFrame:
    """feature, expected and current type, status: same / changed / added / removed."""
    e = expected.select("feature", F.col("type").alias("expected_type"))
    c = current.select("feature", F.col("type").alias("current_type"))
    status = (
        F.when(F.col("expected_type").isNull(), "added")
        .when(F.col("current_type").isNull(), "removed")
        .when(F.col("expected_type") != F.col("current_type"), "changed")
        .otherwise("same")
    )
    return e.join(c, "feature", "full_outer").withColumn("status", status)


def freshness(df: DataFrame, key: str, ts: str, as_of) -> DataFrame:
    """Mean age in days of the newest record per key."""
    newest = df.groupBy(key).agg(F.max(ts).alias("_t"))
    return newest.agg(F.avg(F.date_diff(F.lit(as_of), F.col("_t"))).alias("freshness_days"))


def coverage(df: DataFrame, assigned: str, group: str) -> DataFrame:
    """Percent of rows with an assigned profile."""
    return df.groupBy(group).agg(
        (F.avg(F.col(assigned).isNotNull().cast("double")) * 100).alias("profile_coverage_pct")
    )


def compare_parts(df: DataFrame, features, is_reference) -> DataFrame:
    """Per feature: mean, std and null_rate of the rows outside and inside the reference part, and
    their differences (mean and std to 5 decimals)."""
    long = to_long(df.withColumn("_ref", is_reference), features, ["_ref"])
    aggs = []
    for name, part in (("cur", ~F.col("_ref")), ("ref", F.col("_ref"))):
        v = F.when(part, F.col("value"))
        aggs += [
            F.avg(v).alias(f"{name}_mean"),
            F.stddev_pop(v).alias(f"{name}_std"),
            F.avg(F.when(part, F.col("value").isNull().cast("double"))).alias(f"{name}_null_rate"),
        ]
    both = long.groupBy("feature").agg(*aggs)
    gap = lambda c: F.col(f"cur_{c}") - F.col(f"ref_{c}")
    return both.withColumns(
        {"diff_mean": F.round(gap("mean"), 5), "diff_std": F.round(gap("std"), 5), "diff_null_rate": gap("null_rate")}
    )


def status_rows(metrics: DataFrame, limits=LIMITS) -> DataFrame:
    """metric, value -> ok / warn / alert and whether to retrain."""
    table = local_table(
        metrics.sparkSession, limits, "metric string, direction string, goal double, alert double"
    )
    v, goal, alert = F.col("value"), F.col("goal"), F.col("alert")
    high = F.when(v >= goal, "ok").when(v < alert, "alert").otherwise("warn")
    low = F.when(v <= goal, "ok").when(v > alert, "alert").otherwise("warn")
    status = F.when(F.col("direction") == "high", high).otherwise(low)
    return metrics.join(F.broadcast(table), "metric").select(
        "metric", "value", status.alias("status"), (status == "alert").cast("int").alias("retrain")
    )


def windowed_rate(df: DataFrame, ts: str, value, width: str, step: str | None = None) -> DataFrame:
    """Mean of an indicator per time window."""
    w = F.window(ts, width, step) if step else F.window(ts, width)
    return df.groupBy(w.alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value.cast("double")).alias("rate")
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "rate")


def prediction_drift(df: DataFrame, ts: str, value, baseline, width: str, step: str | None = None) -> DataFrame:
    """Windowed rate minus the baseline rate (a one-row aggregate or a number)."""
    base = baseline if not isinstance(baseline, DataFrame) else baseline.scalar()
    return windowed_rate(df, ts, value, width, step).withColumn("drift", F.col("rate") - base)
