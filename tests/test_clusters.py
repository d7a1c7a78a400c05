import math

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import functions as F

from stayline.operators import cluster, segment
from stayline.operators import cluster_metrics as cm
from stayline.operators.scaling import apply_minmax, apply_standard, fit_minmax, fit_standard
from stayline.schema import FEATURES_8
from stayline.sources.synthetic import two_profiles

COLS = ["x", "y"]


def points(spark, n=60, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(i, float(v[0]), float(v[1]), i % 3) for i, v in enumerate(rng.normal(size=(n, 2)) + np.arange(n)[:, None] % 3)]
    return spark.createDataFrame(rows, "id long, x double, y double, c int"), rows


def brute_silhouette(rows, squared):
    out = {}
    for i, x, y, c in rows:
        by = {}
        for j, x2, y2, c2 in rows:
            if i != j:
                d = (x - x2) ** 2 + (y - y2) ** 2
                by.setdefault(c2, []).append(d if squared else math.sqrt(d))
        if c not in by:
            out[i] = 0.0
            continue
        a, b = np.mean(by[c]), min(np.mean(v) for k, v in by.items() if k != c)
        out[i] = (b - a) / max(a, b)
    return out


def test_silhouette_closed_form(spark):
    df, rows = points(spark)
    got = {r["id"]: r["silhouette_sq"] for r in cm.silhouette_samples(df, COLS, "c").collect()}
    want = brute_silhouette(rows, True)
    assert all(got[i] == pytest.approx(want[i], abs=1e-9) for i in want)
    vec = cluster.to_vectors(df, COLS).withColumn("prediction", F.col("c"))
    assert np.mean(list(got.values())) == pytest.approx(ClusteringEvaluator().evaluate(vec))


def test_centroid_silhouette_and_davies_bouldin(spark):
    df, rows = points(spark)
    cents = cm.fit_centroids(df, COLS, "c")
    got = {r["id"]: r["silhouette"] for r in cm.silhouette_centroids(df, COLS, cents, "c").collect()}
    for i, x, y, c in rows:
        far = {k: math.dist((x, y), p) for k, p in cents.items()}
        a, b = far.pop(c), min(far.values())
        assert got[i] == pytest.approx((b - a) / max(a, b))
    vec = cluster.to_vectors(df, COLS).withColumn("prediction", F.col("c"))
    index = cluster.davies_bouldin(vec, [cents[k] for k in sorted(cents)])
    assert index == pytest.approx(cm.internal_metrics(df, COLS, "c").first()["davies_bouldin"])
    one = cm.silhouette_centroids(df, COLS, {0: [0.0, 0.0]}, "c").agg(F.max("silhouette")).first()[0]
    assert one == 0.0


def test_robust_scaling_is_exact(spark):
    df = spark.createDataFrame([(float(i), 7.0) for i in range(101)], "a double, b double")
    got = sorted((r["a"], r["b"]) for r in cluster.robust_scaled(df, ("a", "b")).collect())
    assert got[0][0] == -1.0 and got[-1][0] == 1.0 and {b for _, b in got} == {0.0}


def test_cluster_of_one_point_scores_zero(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0, 0), (2, 1.0, 1.0, 1), (3, 1.0, 2.0, 1)], "id long, x double, y double, c int")
    got = {r["id"]: r["silhouette_sq"] for r in cm.silhouette_samples(df, COLS, "c").collect()}
    assert got[1] == 0.0


def test_internal_metrics_equal_numpy(spark):
    df, rows = points(spark)
    m = cm.internal_metrics(df, COLS, "c").first()
    x, c = np.array([r[1:3] for r in rows]), np.array([r[3] for r in rows])
    cent = np.array([x[c == k].mean(0) for k in range(3)])
    s = [np.linalg.norm(x[c == k] - cent[k], axis=1).mean() for k in range(3)]
    db = np.mean([max((s[i] + s[j]) / np.linalg.norm(cent[i] - cent[j]) for j in range(3) if j != i) for i in range(3)])
    within = sum(((x[c == k] - cent[k]) ** 2).sum() for k in range(3))
    between = sum((c == k).sum() * ((cent[k] - x.mean(0)) ** 2).sum() for k in range(3))
    assert m["davies_bouldin"] == pytest.approx(db) and m["inertia"] == pytest.approx(within)
    assert m["calinski_harabasz"] == pytest.approx((between / 2) / (within / 57))


def test_external_metrics(spark):
    same = spark.createDataFrame([(0, 5), (0, 5), (1, 6), (1, 6)], "y int, c int")
    r = cm.external_metrics(same, "y", "c").first()
    assert tuple(r) == pytest.approx((1.0, 1.0, 1.0, 1.0))
    one = spark.createDataFrame([(0, 1), (1, 1), (0, 1)], "y int, c int")
    r = cm.external_metrics(one, "y", "c").first()
    assert r["adjusted_rand"] == pytest.approx(0.0) and r["homogeneity"] == pytest.approx(0.0)
    assert r["completeness"] == 1.0 and r["v_measure"] == pytest.approx(0.0)
    mixed = spark.createDataFrame([(0, 0), (0, 0), (0, 1), (1, 1), (1, 2), (1, 2)], "y int, c int")
    assert cm.external_metrics(mixed, "y", "c").first()["adjusted_rand"] == pytest.approx(0.24242424, abs=1e-6)


def test_nearest_takes_smaller_id_on_ties(spark):
    df = spark.createDataFrame([(0.0, 0.0), (3.0, 0.0)], "x double, y double")
    got = [r["cluster_id"] for r in cm.assign_nearest(df, COLS, {0: [-1.0, 0.0], 1: [1.0, 0.0]}).collect()]
    assert got == [0, 1]


def test_out_of_profile_per_cluster(spark):
    rows = [(i, float(i), 0) for i in range(100)] + [(200 + i, float(i * 10), 1) for i in range(10)]
    df = spark.createDataFrame(rows, "id long, sq_distance double, cluster_id int")
    far = {r["id"] for r in cm.out_of_profile(df, 0.9).filter("out_of_profile = 1").collect()}
    assert far == set(range(90, 100)) | {209}


def test_scalers(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, y double")
    z = apply_standard(df, fit_standard(df, COLS)).collect()
    assert [tuple(r) for r in z] == [(-1.0, 0.0), (1.0, 0.0)]
    m = apply_minmax(df, fit_minmax(df, COLS)).collect()
    assert [tuple(r) for r in m] == [(0.0, 0.0), (1.0, 0.0)]


def clustered(spark):
    df = segment.add_segment(two_profiles(spark, 1000))
    return cluster.fit_segmentation(df, k=2, restarts=3).assign(df)


def test_two_profiles_are_found(spark):
    df = clustered(spark)
    assert cm.external_metrics(df, "churn", "cluster_id").first()["v_measure"] > 0.9
    profiles = segment.profile_clusters(df).collect()
    assert {r["risk_label"] for r in profiles} == {"ALTO RISCO", "BAIXO RISCO"}
    assert sum(r["n_samples"] for r in profiles) == 1000
    assert all(0 <= r["churn_rate"] <= 1 for r in profiles)


def test_cards_have_all_fields(spark):
    cards = segment.profile_cards(segment.segment_profiles(clustered(spark)))
    rows = segment.card_text(cards).collect()
    assert cards.columns == [
        "cluster_id", "segmento", "perfil_label", "risk_level", "churn_rate", "cobertura_pct", "n_amostras",
        "description", "feature_means", "action_recommendation", "gargalos", "rag_tags",
    ]
    for r in rows:
        assert len(r["rag_tags"]) == 5 and r["gargalos"] is not None and r["text"].startswith(r["perfil_label"])
        assert r["segmento"] in r["description"]
    assert any("BU_WAIT_DAYS" in g for r in rows for g in r["gargalos"])


def test_elbow_decreases_and_pca_ratio(spark):
    df = two_profiles(spark, 400)
    v = cluster.to_vectors(df, FEATURES_8, fit_standard(df, FEATURES_8)).select("customer_id", "features").cache()
    rows = cm.strictly_decreasing(cluster.elbow(v, ks=(2, 3, 4), restarts=2), "k", "inertia").collect()
    assert all(r["decreases"] == 1 for r in rows)
    pts, ratio = cluster.pca_2d(v, ["customer_id"])
    assert pts.count() == 400 and ratio[0] > ratio[1] and sum(ratio) <= 1.0
    assert abs(pts.agg(F.avg("pc1")).first()[0]) < 1e-9
    aris = [r["adjusted_rand"] for r in cluster.stability(v, "customer_id", runs=2, restarts=1).collect()]
    assert len(aris) == 2 and all(a > 0.85 for a in aris)
