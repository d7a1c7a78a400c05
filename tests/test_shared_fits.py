"""K-means fits that share their passes: each must end where Spark's own fit of the same seed and rows ends."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from stayline.operators import cluster


@pytest.fixture(scope="module")
def points(spark):
    rnd = np.random.default_rng(3)
    mat = rnd.standard_normal((300, 4)) + rnd.integers(0, 3, (300, 1)) * 4
    rows = [(Vectors.dense(v), int(i % 3 > 0) | (int(i % 2) << 1)) for i, v in enumerate(mat)]
    return spark.createDataFrame(rows, ["features", "parts"])


def test_shared_passes_end_where_single_fits_end(points):
    fits = [cluster.Fit(2, 1), cluster.Fit(3, 1), cluster.Fit(3, 2, 0), cluster.Fit(2, 5, 1)]
    done = cluster.fit_centers(points, fits)
    for fit, (centers, cost) in zip(fits, done):
        own = points if fit.part is None else points.filter(F.col("parts").bitwiseAND(F.lit(1 << fit.part)) != 0)
        mat = np.array([r["features"].toArray() for r in own.collect()])
        gaps = ((mat[:, None] - centers[None]) ** 2).sum(axis=2)
        near = gaps.argmin(axis=1)
        assert cost == pytest.approx(gaps.min(axis=1).sum(), rel=1e-6)
        for j in range(fit.k):  # a fixed point of the iteration
            assert np.allclose(mat[near == j].mean(axis=0), centers[j], atol=1e-3)
        theirs = KMeans(k=fit.k, seed=fit.seed, maxIter=300, initMode="k-means||").fit(own.repartition(1).select("features"))
        assert cost <= theirs.summary.trainingCost * 1.5


def test_best_model_has_the_centres_and_cost_of_its_fit(points):
    (model, cost), (other, _) = cluster.best_fits(points, [(3, None), (2, 1)], restarts=3, seed=1)
    fits = cluster.fit_centers(points, [cluster.Fit(3, s) for s in (1, 2, 3)])
    centers, least = min(fits, key=lambda f: f[1])
    assert cost == pytest.approx(least)
    assert np.allclose(sorted(map(list, model.clusterCenters())), sorted(map(list, centers)))
    assert len(other.clusterCenters()) == 2


def _jobs(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_first_centres_of_more_fits_take_no_more_jobs(spark, points):
    few, many = ([cluster.Fit(2 + s % 3, s, s % 2) for s in range(n)] for n in (1, 12))
    assert _jobs(spark, "many", lambda: cluster.fit_centers(points, many, 1)) == _jobs(spark, "few", lambda: cluster.fit_centers(points, few, 1))


def test_first_centres_are_drawn_from_the_rows_of_their_fit_and_again_the_same(spark):
    rows = [(Vectors.dense([float(i % 2), 10.0 * (i % 4)]), i % 2) for i in range(64)]  # 4 distinct points, 2 of them in part 0
    packed = spark.createDataFrame(rows, ["v", "parts"]).selectExpr("v", "cast(parts as bigint) parts")
    packed = packed.withColumn("v", cluster.vector_to_array("v")).mapInArrow(cluster._pack, "place bigint, points binary, parts binary")
    fits = [cluster.Fit(2, 7), cluster.Fit(2, 7, 0), cluster.Fit(3, 1, 0)]
    first, again = cluster.first_centers(packed, fits, 2), cluster.first_centers(packed, fits, 2)
    assert all(np.array_equal(a, b) for a, b in zip(first, again))
    assert [len(c) for c in first] == [2, 2, 2]  # no more centres than distinct points
    assert sorted(map(tuple, first[2])) == [(1.0, 10.0), (1.0, 30.0)]
    with pytest.raises(ValueError):
        cluster.first_centers(packed, [cluster.Fit(2, 1, 5)], 2)
