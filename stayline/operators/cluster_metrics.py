"""Nearest centroid and clustering metrics in closed form, O(rows x clusters).

Centroids and per-cluster moments are k rows; they come to the driver, as a fitted
model does, and go into code-generated column expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.operators.ranks import exact_quantiles


def fit_centroids(df: DataFrame, features, group: str) -> dict[int, list[float]]:
    """Mean vector per group, numbered in the order of the group values."""
    rows = (
        df.groupBy(group)
        .agg(*[F.avg(F.col(f).cast("double")).alias(f) for f in features])
        .orderBy(group)
        .collect()
    )
    return {i: [r[f] for f in features] for i, r in enumerate(rows)}


def squared_distance(features, point) -> Column:
    total = F.lit(0.0)
    for f, p in zip(features, point):
        d = F.col(f) - F.lit(float(p))
        total = total + d * d
    return total


def assign_nearest(
    df: DataFrame, features, centroids: dict[int, list[float]], cluster: str = "cluster_id"
) -> DataFrame:
    """Adds the nearest cluster and its squared distance; ties go to the smaller id."""
    candidates = F.array(
        *[
            F.struct(squared_distance(features, c).alias("d"), F.lit(cid).alias("c"))
            for cid, c in sorted(centroids.items())
        ]
    )
    best = df.withColumn("_best", F.array_min(candidates))
    return best.withColumns({cluster: F.col("_best.c"), "sq_distance": F.col("_best.d")}).drop("_best")


def inertia(assigned: DataFrame) -> DataFrame:
    return assigned.agg(F.sum("sq_distance").alias("inertia"))


def cluster_moments(df: DataFrame, features, cluster: str = "cluster_id") -> dict:
    """Per cluster: n, sum vector and sum of squared norms."""
    sq = sum((F.col(f) * F.col(f) for f in features), F.lit(0.0))
    rows = (
        df.filter(F.col(cluster).isNotNull())
        .groupBy(cluster)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(sq).alias("q"), *[F.sum(f).alias(f) for f in features])
        .collect()
    )
    return {r[cluster]: (r["n"], [r[f] for f in features], r["q"]) for r in rows}


def _mean_sq_to(features, moment) -> Column:
    """Mean squared distance from a row to all members of a cluster."""
    n, s, q = moment
    own = sum((F.col(f) * F.col(f) for f in features), F.lit(0.0))
    cross = sum((F.col(f) * F.lit(v / n) for f, v in zip(features, s)), F.lit(0.0))
    return F.greatest(own - 2 * cross + F.lit(q / n), F.lit(0.0))


def silhouette_samples(df: DataFrame, features, cluster: str = "cluster_id", moments=None) -> DataFrame:
    """Adds `silhouette_sq`, the silhouette with squared Euclidean distances.

    A cluster of one point scores 0. With squared distances the mean over a cluster
    follows from its moments, so no pair of rows is ever formed.
    """
    moments = moments or cluster_moments(df, features, cluster)
    own, other = None, None
    for cid, m in sorted(moments.items()):
        here = F.col(cluster) == cid
        n = m[0]
        a = _mean_sq_to(features, m) * (n / (n - 1)) if n > 1 else F.lit(None).cast("double")
        rest = [_mean_sq_to(features, v) for c, v in sorted(moments.items()) if c != cid]
        b = F.least(*rest) if len(rest) > 1 else rest[0] if rest else F.lit(None).cast("double")
        own = F.when(here, a) if own is None else own.when(here, a)
        other = F.when(here, b) if other is None else other.when(here, b)
    a, b = F.col("_a"), F.col("_b")
    s = F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0))
    return df.withColumns({"_a": own, "_b": other}).withColumn("silhouette_sq", s).drop("_a", "_b")


def internal_metrics(df: DataFrame, features, cluster: str = "cluster_id") -> DataFrame:
    """Silhouette (squared), Davies-Bouldin, Calinski-Harabasz and inertia in one row.

    Two passes: the moments, then one aggregate. Distances between centroids are
    between k points and are computed as constants.
    """
    moments = cluster_moments(df, features, cluster)
    ids, n = sorted(moments), sum(m[0] for m in moments.values())
    k, dims = len(ids), range(len(features))
    centre = {c: [v / moments[c][0] for v in moments[c][1]] for c in ids}
    grand = [sum(moments[c][1][i] for c in ids) / n for i in dims]
    between = sum(moments[c][0] * sum((centre[c][i] - grand[i]) ** 2 for i in dims) for c in ids)
    gap = {(i, j): math.dist(centre[i], centre[j]) for i in ids for j in ids if i != j}

    scored = silhouette_samples(df, features, cluster, moments)
    own_sq = None
    for c in ids:
        d = squared_distance(features, centre[c])
        own_sq = F.when(F.col(cluster) == c, d) if own_sq is None else own_sq.when(F.col(cluster) == c, d)
    scored = scored.withColumn("_own_sq", own_sq)
    agg = scored.agg(
        F.avg("silhouette_sq").alias("silhouette_sq"),
        F.sum("_own_sq").alias("inertia"),
        *[F.avg(F.when(F.col(cluster) == c, F.sqrt("_own_sq"))).alias(f"_s{i}") for i, c in enumerate(ids)],
    )
    spread = {c: F.col(f"_s{i}") for i, c in enumerate(ids)}
    worst = []
    for i in ids:
        ratios = [
            F.try_divide(spread[i] + spread[j], F.lit(gap[(i, j)])) for j in ids if j != i
        ]
        worst.append(F.greatest(*ratios) if len(ratios) > 1 else ratios[0] if ratios else F.lit(0.0))
    db = sum(worst, F.lit(0.0)) / k
    ch = F.try_divide(F.lit(between / (k - 1)) if k > 1 else F.lit(None).cast("double"),
                      F.col("inertia") / F.lit(float(n - k)))
    return agg.select(
        "silhouette_sq", db.alias("davies_bouldin"), ch.alias("calinski_harabasz"), "inertia"
    )


def silhouette_centroids(df: DataFrame, features, centroids: dict[int, list[float]], cluster: str = "cluster_id") -> DataFrame:
    """Adds `silhouette`, with Euclidean distances to the own and the nearest other centroid.

    Linear in the rows, over all of them. With one centroid, or both distances 0, it is 0.
    """
    far = {c: F.sqrt(squared_distance(features, p)) for c, p in sorted(centroids.items())}
    own = F.array_min(F.array(*[F.when(F.col(cluster) == c, d) for c, d in far.items()]))
    other = F.array_min(F.array(*[F.when(F.col(cluster) != c, d) for c, d in far.items()]))
    df = df.withColumns({"_a": own, "_b": other})
    s = F.coalesce(F.try_divide(F.col("_b") - F.col("_a"), F.greatest("_a", "_b")), F.lit(0.0))
    return df.withColumn("silhouette", s).drop("_a", "_b")


def contingency(df: DataFrame, label: str, cluster: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(cluster).alias("cluster")).agg(
        F.count(F.lit(1)).alias("n")
    )


def external_metrics(df: DataFrame, label: str, cluster: str) -> DataFrame:
    """Adjusted Rand index, homogeneity, completeness and V-measure in one row.

    The data is reduced to the label x cluster table first; its cells, margins and
    total come from grouping sets over that table.
    """
    cells = contingency(df, label, cluster)
    lab, clu = F.col("label"), F.col("cluster")
    level = (
        cells.groupingSets([[lab, clu], [lab], [clu], []], lab, clu)
        .agg(F.grouping_id().alias("_g"), F.sum("n").cast("double").alias("m"))
    )
    # grouping_id: 0 cell, 1 label margin, 2 cluster margin, 3 total
    m, g = F.col("m"), F.col("_g")
    pairs, mlogm = m * (m - 1) / 2, m * F.log(m)

    def over(i, expr):
        return F.sum(F.when(g == i, expr).otherwise(0.0))

    sums = level.agg(
        *[over(i, pairs).alias(f"p{i}") for i in range(4)],
        *[over(i, mlogm).alias(f"l{i}") for i in range(3)],
        over(3, m).alias("n"),
    )
    c, n = F.col, F.col("n")
    expected = F.try_divide(c("p1") * c("p2"), c("p3"))
    top, bottom = c("p0") - expected, (c("p1") + c("p2")) / 2 - expected
    ari = F.when(bottom == 0, 1.0).otherwise(F.try_divide(top, bottom))
    entropy = [F.log(n) - c(f"l{i}") / n for i in range(3)]
    mutual = entropy[1] + entropy[2] - entropy[0]
    tiny = F.lit(1e-12)
    hom = F.when(entropy[1] <= tiny, 1.0).otherwise(mutual / entropy[1])
    com = F.when(entropy[2] <= tiny, 1.0).otherwise(mutual / entropy[2])
    return sums.select(ari.alias("adjusted_rand"), hom.alias("homogeneity"), com.alias("completeness")).withColumn(
        "v_measure",
        F.coalesce(
            F.try_divide(2 * c("homogeneity") * c("completeness"), c("homogeneity") + c("completeness")),
            F.lit(0.0),
        ),
    )


def out_of_profile(assigned: DataFrame, percentile: float = 0.95, cluster: str = "cluster_id") -> DataFrame:
    """Adds `out_of_profile`: farther from the own centroid than the given share of its cluster."""
    limits = exact_quantiles(assigned.select(cluster, "sq_distance"), "sq_distance", [percentile], [cluster])
    # one row per cluster of a fitted model
    return (
        assigned.join(F.broadcast(limits.withColumnRenamed("q0", "_limit")), cluster)
        .withColumn("out_of_profile", (F.col("sq_distance") > F.col("_limit")).cast("int"))
        .drop("_limit")
    )


def strictly_decreasing(table: DataFrame, order: str, value: str) -> DataFrame:
    """Adds `decreases` against the previous row (the first row passes). Model-sized input."""
    from pyspark.sql import Window

    previous = F.lag(value).over(Window.orderBy(order))
    return table.withColumn("decreases", F.coalesce(F.col(value) < previous, F.lit(True)).cast("int"))
