"""K-means and related models with pyspark.ml."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions.hashing import md5_uniform
from stayline.operators.cluster_metrics import external_metrics
from stayline.operators.quality import to_long
from stayline.operators.ranks import exact_quantiles
from stayline.operators.scaling import fit_standard
from stayline.schema import FEATURES_8
from stayline.session import local_table, materialize


INIT_STEPS = 2  # rounds in which candidates for the first centres are drawn, as in Spark's KMeans
LOCAL_ITERATIONS = 30  # of a fit over its candidates
PASS_ROWS = 25_000  # points of a task in a pass, about
STEP = 1024  # points whose distances are held at a time


@dataclass
class Segmentation:
    """Scaler parameters and K-means model; both are needed at scoring time."""

    scaler: dict
    kmeans: KMeansModel
    features: tuple

    def assign(self, df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
        vectors = to_vectors(df, self.features, self.scaler)
        out = self.kmeans.transform(vectors)
        return out.withColumn(cluster, F.col("prediction").cast("int")).drop("features", "prediction")


def to_vectors(df: DataFrame, features=FEATURES_8, scaler: dict | None = None) -> DataFrame:
    """Adds the vector column `features`, scaled when parameters are given."""
    names = [f"_z_{f}" for f in features]
    cols = {}
    for f, z in zip(features, names):
        mean, std = (scaler or {}).get(f, (0.0, 1.0))
        cols[z] = (F.col(f).cast("double") - mean) / std
    out = VectorAssembler(inputCols=names, outputCol="features").transform(df.withColumns(cols))
    return out.drop(*names)


@dataclass(frozen=True)
class Fit:
    """One K-means fit to do: `part` is the bit of the rows it learns from, None for all rows."""

    k: int
    seed: int
    part: int | None = None


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch of points as one row: its place (partition, number), its matrix and the parts its rows belong to."""
    own = TaskContext.get().partitionId()
    for n, b in enumerate(b for b in batches if b.num_rows):
        points = b.column(0).flatten().to_numpy(zero_copy_only=False).astype("float64").tobytes()
        parts = b.column(1).to_numpy(zero_copy_only=False).astype("int64").tobytes()
        cols = [pa.array([own << 32 | n], pa.int64()), pa.array([points], pa.binary()), pa.array([parts], pa.binary())]
        yield pa.RecordBatch.from_arrays(cols, ["place", "points", "parts"])


def _gaps(x: np.ndarray, norm: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of points with squared norms `norm` to centres."""
    return np.maximum(norm[:, None] - 2 * (x @ centers.T) + (centers * centers).sum(axis=1), 0)


def _fold(fits: list[Fit], dims: int, salt: int, fold):
    """One pass in which each fit folds its own points, a step at a time: `fold(i, state, rnd, x, norm)` returns the state.

    The random numbers depend on the fit's seed, `salt` and the place of the points, not on the attempt. A task forwards (fit, stats).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = [None] * len(fits)
        for b in batches:
            for place, raw, tags in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                points = np.frombuffer(raw.as_buffer()).reshape(-1, dims)
                parts = np.frombuffer(tags.as_buffer(), dtype="int64")
                rnds = [np.random.default_rng([fit.seed % (1 << 32), salt, place]) for fit in fits]
                for at in range(0, len(points), STEP):
                    x, tag = points[at : at + STEP], parts[at : at + STEP]
                    norm = (x * x).sum(axis=1)
                    own = {None: (x, norm)}
                    for bit in {fit.part for fit in fits} - {None}:
                        inside = np.flatnonzero(tag >> bit & 1)
                        own[bit] = x[inside], norm[inside]
                    for i, fit in enumerate(fits):
                        if len(own[fit.part][0]):
                            states[i] = fold(i, states[i], rnds[i], *own[fit.part])
        some = [i for i, state in enumerate(states) if state is not None]
        flat = [np.asarray(states[i], dtype="float64").tobytes() for i in some]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(flat, pa.binary())], ["fit", "stats"])

    return run


def first_centers(packed: DataFrame, fits: list[Fit], dims: int) -> list[np.ndarray]:
    """First centres of each fit by k-means||, as Spark's KMeans chooses them; the fits share each of the passes.

    A random point, then INIT_STEPS rounds that draw each point with 2 k times its share of the cost, so 2 k candidates
    a round on average; each candidate weighs the points next to it, and k-means++ over the candidates gives the k centres.
    """

    def scan(salt: int, fold) -> list[list[np.ndarray]]:
        found: list[list[np.ndarray]] = [[] for _ in fits]
        for r in packed.mapInArrow(_fold(fits, dims, salt, fold), "fit bigint, stats binary").collect():
            found[r["fit"]].append(np.frombuffer(r["stats"]))
        return found

    def pick(i, state, rnd, x, norm):
        u = rnd.random(len(x))
        best = int(u.argmin())
        return np.append(u[best], x[best]) if state is None or u[best] < state[0] else state

    spots = scan(0, pick)
    if not all(spots):
        raise ValueError("a fit has no rows to learn from")
    centers = [min(own, key=lambda s: s[0])[None, 1:] for own in spots]
    for step in range(INIT_STEPS):
        now = centers

        def cost(i, state, rnd, x, norm):
            return (state or 0.0) + _gaps(x, norm, now[i]).min(axis=1).sum()

        totals = [float(sum(t[0] for t in own)) for own in scan(0, cost)]

        def draw(i, state, rnd, x, norm):
            far = rnd.random(len(x)) * totals[i] < 2.0 * fits[i].k * _gaps(x, norm, now[i]).min(axis=1)
            return x[far].ravel() if state is None else np.concatenate([state, x[far].ravel()])

        drawn = scan(step + 1, draw)
        centers = [np.unique(np.vstack([c, np.concatenate(own).reshape(-1, dims)]), axis=0) for c, own in zip(centers, drawn)]

    def weigh(i, state, rnd, x, norm):
        n = np.bincount(_gaps(x, norm, centers[i]).argmin(axis=1), minlength=len(centers[i]))
        return n if state is None else state + n

    weights = [sum(own) for own in scan(0, weigh)]
    return [c if len(c) <= fit.k else _plus_plus(c, w, fit) for c, w, fit in zip(centers, weights, fits)]


def _plus_plus(points: np.ndarray, weights: np.ndarray, fit: Fit) -> np.ndarray:
    """k-means++ and a weighted K-means over few points."""
    rnd = np.random.default_rng(fit.seed % (1 << 32))
    norm = (points * points).sum(axis=1)
    centers = points[[rnd.choice(len(points), p=weights / weights.sum())]]
    while len(centers) < fit.k:
        share = weights * _gaps(points, norm, centers).min(axis=1)
        if not share.sum():
            break
        centers = np.vstack([centers, points[rnd.choice(len(points), p=share / share.sum())]])
    for _ in range(LOCAL_ITERATIONS):
        near = _gaps(points, norm, centers).argmin(axis=1)
        mass = np.bincount(near, weights, len(centers))
        sums = np.stack([np.bincount(near, weights * points[:, d], len(centers)) for d in range(points.shape[1])], axis=1)
        new = np.where(mass[:, None] > 0, sums / np.where(mass > 0, mass, 1)[:, None], centers)
        if np.array_equal(new, centers):
            break
        centers = new
    return centers


def _pass(centers: list[np.ndarray], bits: list[int | None]):
    """One pass over the points for all fits: per fit and cluster the sum of its points and their number, and the cost.

    Fits of one k are taken together; a step holds the distances of STEP points to all centres.
    """
    by_k: dict[int, list[int]] = {}
    for i, c in enumerate(centers):
        by_k.setdefault(len(c), []).append(i)
    dims = centers[0].shape[1]
    groups = [(k, np.stack([centers[i] for i in own]), [bits[i] for i in own]) for k, own in sorted(by_k.items())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((k, len(c), dims + 1)) for k, c, _ in groups]
        cost = [np.zeros(len(c)) for _, c, _ in groups]
        for b in batches:
            for raw, tags in zip(b.column(0), b.column(1)):
                points = np.frombuffer(raw.as_buffer()).reshape(-1, dims)
                parts = np.frombuffer(tags.as_buffer(), dtype="int64")
                for at in range(0, len(points), STEP):
                    x, tag = points[at : at + STEP], parts[at : at + STEP]
                    with_one, norm = np.hstack([x, np.ones((len(x), 1))]), (x * x).sum(axis=1)
                    for g, (k, c, own) in enumerate(groups):
                        gaps = ((c * c).sum(axis=2)[:, :, None] - 2 * (c.reshape(-1, dims) @ x.T).reshape(len(c), k, -1)) + norm
                        best, near = gaps[:, 0].copy(), np.zeros((len(c), len(x)), dtype="int8" if k < 128 else "int64")
                        for j in range(1, k):
                            closer = gaps[:, j] < best
                            np.copyto(best, gaps[:, j], where=closer)
                            np.putmask(near, closer, j)
                        np.maximum(best, 0, out=best)
                        inside = None
                        if any(bit is not None for bit in own):
                            inside = np.stack([np.ones(len(x)) if bit is None else (tag >> bit & 1).astype("float64") for bit in own])
                            best *= inside
                        cost[g] += best.sum(axis=1)
                        for j in range(k):
                            member = (near == j).astype("float64")
                            sums[g][j] += (member if inside is None else member * inside) @ with_one
        flat = np.concatenate([a.ravel() for a in (*sums, *cost)])
        yield pa.RecordBatch.from_arrays([pa.array([flat.tobytes()], pa.binary())], ["stats"])

    def unpack(total: np.ndarray) -> Iterator[tuple[int, np.ndarray, float]]:
        at, end = 0, len(total) - len(centers)
        for k, c, _ in groups:
            size = k * len(c) * (dims + 1)
            sums, cost = total[at : at + size].reshape(k, len(c), dims + 1), total[end : end + len(c)]
            at, end = at + size, end + len(c)
            for r, i in enumerate(by_k[k]):
                yield i, sums[:, r], float(cost[r])

    return run, unpack


def fit_centers(points: DataFrame, fits: list[Fit], max_iter: int = 300, tol: float = 1e-4) -> list[tuple[np.ndarray, float]]:
    """Centres and training cost of each fit; `points` has `features` and `parts`, whose bits say which rows a fit learns from.

    The first centres are chosen by k-means||. The iterations of all fits that have not converged share one pass over
    the points, so their number grows with the slowest fit and not with the sum.
    A pass forwards one short row per task: a sum per centre. A fit ends as Spark's does: no centre moved farther
    than `tol`, or after `max_iter` iterations; the cost is that of its last pass.
    """
    count = points.count()
    few = points.repartition(max(1, -(-count // PASS_ROWS))).select(vector_to_array("features").alias("v"), "parts")
    packed = few.mapInArrow(_pack, "place bigint, points binary, parts binary").persist()
    try:
        centers = first_centers(packed, fits, len(points.select("features").first()[0]))
        costs, active = [0.0] * len(fits), list(range(len(fits)))
        for _ in range(max_iter):
            run, unpack = _pass([centers[i] for i in active], [fits[i].part for i in active])
            # one row of sums per task
            total = sum(np.frombuffer(r["stats"]) for r in packed.select("points", "parts").mapInArrow(run, "stats binary").collect())
            moving = []
            for at, sums, cost in unpack(total):
                i = active[at]
                n = sums[:, -1:]
                new = np.where(n > 0, sums[:, :-1] / np.where(n > 0, n, 1), centers[i])
                if (((new - centers[i]) ** 2).sum(axis=1) > tol * tol).any():
                    moving.append(i)
                centers[i], costs[i] = new, cost
            active = sorted(moving)
            if not active:
                break
    finally:
        packed.unpersist()
    return list(zip(centers, costs))


def _model(spark, centers: np.ndarray, seed: int) -> KMeansModel:
    """The model with these centres: each is the mean of itself."""
    rows = spark.createDataFrame([(Vectors.dense(c),) for c in centers], ["features"])
    return KMeans(k=len(centers), seed=seed, maxIter=1, initMode="random").fit(rows)


def best_fits(points: DataFrame, wanted: list[tuple[int, int | None]], restarts: int, seed: int, max_iter: int = 300) -> list[tuple[KMeansModel, float]]:
    """For each (k, part), the model of several seeds with the least training cost (the first of equal ones), and that cost."""
    if "parts" not in points.columns:
        points = points.withColumn("parts", F.lit(0).cast("bigint"))
    fits = [Fit(k, seed + i, part) for k, part in wanted for i in range(restarts)]
    done = fit_centers(points.select("features", "parts"), fits, max_iter)
    best = [min(done[at : at + restarts], key=lambda d: d[1]) for at in range(0, len(done), restarts)]
    return [(_model(points.sparkSession, centers, seed), cost) for centers, cost in best]


def fit_kmeans(vectors: DataFrame, k: int, restarts: int = 10, seed: int = 42, max_iter: int = 300) -> KMeansModel:
    """Best of several seeds by training cost (Spark has no restart parameter); the restarts share their passes."""
    return best_fits(vectors.select("features"), [(k, None)], restarts, seed, max_iter)[0][0]


def fit_segmentation(df: DataFrame, features=FEATURES_8, k: int = 2, restarts: int = 10, seed: int = 42) -> Segmentation:
    scaler = fit_standard(df, features)
    vectors = materialize(to_vectors(df, features, scaler).select("features"), "vectors")
    return Segmentation(scaler, fit_kmeans(vectors, k, restarts, seed), tuple(features))


def davies_bouldin(assigned: DataFrame, centers) -> float:
    """From the mean distance of each cluster's rows to its centre: k rows reach the driver."""
    gaps = F.zip_with(vector_to_array("features"), F.get(F.lit([list(map(float, c)) for c in centers]), F.col("prediction")), lambda x, c: (x - c) * (x - c))
    far = F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda t, x: t + x))
    spread = {r["prediction"]: r["s"] for r in assigned.groupBy("prediction").agg(F.avg(far).alias("s")).collect()}
    worst = [
        max((spread[i] + spread[j]) / (math.dist(centers[i], centers[j]) or math.inf) for j in spread if j != i)
        for i in spread
        if len(spread) > 1
    ]
    return sum(worst) / len(worst) if worst else 0.0


def elbow(vectors: DataFrame, ks=range(2, 9), restarts: int = 10, seed: int = 42) -> DataFrame:
    """k, inertia (two decimals), squared silhouette and Davies-Bouldin; all fits share their passes over the vectors."""
    rows = []
    fitted = best_fits(vectors.select("features"), [(k, None) for k in ks], restarts, seed)
    for k, (model, cost) in zip(ks, fitted):
        scored = model.transform(vectors)
        index = davies_bouldin(scored, model.clusterCenters())
        rows.append((k, round(cost, 2), ClusteringEvaluator().evaluate(scored), index))
    ddl = "k int, inertia double, silhouette_sq double, davies_bouldin double"
    return local_table(vectors.sparkSession, rows, ddl)


def fit_bisecting(vectors: DataFrame, k: int = 2, seed: int = 42):
    return BisectingKMeans(k=k, seed=seed).fit(vectors)


def mixture_scores(vectors: DataFrame, ks, dims: int, seed: int = 42) -> DataFrame:
    """Log-likelihood, AIC and BIC of Gaussian mixtures per number of components."""
    n = vectors.count()
    rows = []
    for k in ks:
        ll = GaussianMixture(k=k, seed=seed).fit(vectors).summary.logLikelihood
        free = (k - 1) + k * dims + k * dims * (dims + 1) // 2
        rows.append((k, float(ll), 2 * free - 2 * ll, free * math.log(n) - 2 * ll))
    return local_table(vectors.sparkSession, rows, "k int, log_likelihood double, aic double, bic double")


def pca_2d(vectors: DataFrame, keep=()) -> tuple[DataFrame, list[float]]:
    """Two principal components of centred vectors and their explained variance ratio."""
    model = PCA(k=2, inputCol="features", outputCol="_pc").fit(vectors)
    pc = vector_to_array("_pc")
    points = model.transform(vectors).select(*keep, pc[0].alias("pc1"), pc[1].alias("pc2"))
    return points, list(model.explainedVariance)


def robust_scaled(df: DataFrame, features) -> DataFrame:
    """Columns scaled by exact median and quartile distance, for features with outliers.

    One row per feature reaches the driver. A quartile distance of 0 scales by 1.
    """
    marks = exact_quantiles(to_long(df, features), "value", (0.25, 0.5, 0.75), ["feature"]).collect()
    by = {r["feature"]: (r["q1"], (r["q2"] - r["q0"]) or 1.0) for r in marks}
    return df.withColumns({f: (F.col(f).cast("double") - by[f][0]) / by[f][1] for f in features if f in by})


def stability(
    vectors: DataFrame, key: str, k: int = 2, runs: int = 10, share: int = 80, seed: int = 42, restarts: int = 10
) -> DataFrame:
    """ARI of each bootstrap run (a stable share of the rows) against a fit on all rows.

    A row holds a bit per run it is in (63 runs at most), and the fits of all runs share their passes over the rows.
    """
    if runs > 63:
        raise ValueError("at most 63 runs: a row's runs are the bits of a long")
    in_run = [F.when(md5_uniform(seed + 1000 + run, key, 100) < share, F.lit(1 << run)).otherwise(F.lit(0)).cast("bigint") for run in range(runs)]
    tagged = materialize(vectors.select(key, "features", reduce(Column.bitwiseOR, in_run, F.lit(0).cast("bigint")).alias("parts")), "tagged")
    fitted = best_fits(tagged, [(k, None), *[(k, run) for run in range(runs)]], restarts, seed)
    base, *models = [model for model, _ in fitted]
    labelled = materialize(base.setPredictionCol("_base").transform(tagged).select("features", "_base"), "base-labels")
    result = None
    for run, model in enumerate(models):
        ari = external_metrics(model.setPredictionCol("_run").transform(labelled), "_base", "_run").select(
            F.lit(run).alias("run"), "adjusted_rand"
        )
        result = ari if result is None else result.unionByName(ari)
    return result
