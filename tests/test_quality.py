import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from stayline.operators import quality


def two_periods(spark, n=400):
    rnd = random.Random(2)
    rows = [(i % 2 == 0, rnd.gauss(0, 1) + (0 if i % 2 == 0 else 0.7), float(rnd.randint(0, 4))) for i in range(n)]
    return spark.createDataFrame(rows, "ref boolean, x double, y double"), rows


def test_ks_and_psi_equal_brute_force(spark):
    df, rows = two_periods(spark)
    cum = quality.compared_histogram(df, ["x", "y"], F.col("ref"))
    ks = {r["feature"]: r["ks"] for r in quality.kolmogorov_smirnov(cum).collect()}
    psi = {r["feature"]: r["psi"] for r in quality.population_stability(cum).collect()}
    for name, pos in (("x", 1), ("y", 2)):
        a, b = sorted(r[pos] for r in rows if r[0]), sorted(r[pos] for r in rows if not r[0])
        gap = max(abs(sum(v <= t for v in a) / len(a) - sum(v <= t for v in b) / len(b)) for t in set(a + b))
        assert ks[name] == pytest.approx(gap)
        cuts = [a[math.ceil(len(a) * i / 10) - 1] for i in range(1, 10)]
        bins = lambda v: sum(c < v for c in cuts)
        total = 0.0
        for j in {bins(v) for v in a + b}:
            p = max(sum(bins(v) == j for v in a) / len(a), quality.PSI_FLOOR)
            q = max(sum(bins(v) == j for v in b) / len(b), quality.PSI_FLOOR)
            total += (p - q) * math.log(p / q)
        assert psi[name] == pytest.approx(total)


def test_same_distribution_has_no_drift(spark):
    df = spark.createDataFrame([(i % 2 == 0, float(i // 2)) for i in range(200)], "ref boolean, x double")
    cum = quality.compared_histogram(df, ["x"], F.col("ref"))
    assert quality.population_stability(cum).first()["psi"] == pytest.approx(0.0)
    assert quality.kolmogorov_smirnov(cum).first()["ks"] == 0.0


def test_chi_square(spark):
    rows = [("a", True)] * 10 + [("a", False)] * 20 + [("b", True)] * 20 + [("b", False)] * 10
    df = spark.createDataFrame(rows, "c string, ref boolean")
    r = quality.chi_square(df, "c", F.col("ref")).first()
    assert r["chi2"] == pytest.approx(6.6667, abs=1e-3) and r["dof"] == 1


def test_stats_and_comparison(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "x double")
    r = quality.feature_stats(df, ["x"]).first()
    assert (r["n_rows"], r["null_rate"], r["mean"], r["p50"]) == (4, 0.25, 2.0, 2.0)
    other = quality.feature_stats(spark.createDataFrame([(4.0, 1.0)], "x double, z double"), ["x", "z"])
    got = {r["feature"]: r["diff_mean"] for r in quality.compare_stats(quality.feature_stats(df, ["x"]), other).collect()}
    assert got == {"x": -2.0, "z": None}


def test_all_null_feature_keeps_its_row(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "x double, y double")
    got = {r["feature"]: (r["null_rate"], r["p50"]) for r in quality.feature_stats(df, ["x", "y"]).collect()}
    assert got["x"] == (1.0, None) and got["y"][0] == 0.0


@pytest.mark.parametrize("rule", ["iqr", "sigma"])
def test_outliers(spark, rule):
    df = spark.createDataFrame([(float(i % 10),) for i in range(200)] + [(1000.0,)], "x double")
    r = quality.outlier_rate(df, ["x"], rule).first()
    assert (r["n"], r["outliers"]) == (201, 1)


def test_completeness_coverage_freshness(spark):
    df = spark.createDataFrame(
        [("a", 1, None, 0, dt.datetime(2024, 1, 1)), ("a", 1, 2, None, dt.datetime(2024, 1, 11))],
        "g string, x int, y int, c int, t timestamp",
    )
    assert quality.completeness(df, ["x", "y"], "g").first()["completeness_pct"] == 75.0
    assert quality.coverage(df, "c", "g").first()["profile_coverage_pct"] == 50.0
    assert quality.freshness(df, "x", "t", dt.date(2024, 1, 21)).first()["freshness_days"] == 10.0


def test_schema_drift(spark):
    want = spark.createDataFrame([], "a int, b string, c double")
    have = spark.createDataFrame([], "a long, b string, d double")
    got = {r["feature"]: r["status"] for r in quality.schema_drift(quality.schema_table(have), quality.schema_table(want)).collect()}
    assert got == {"a": "changed", "b": "same", "c": "removed", "d": "added"}


def test_status_limits(spark):
    rows = [("completeness_pct", 80.0), ("outlier_pct", 10.0), ("freshness_days", 91.0), ("churn_pct", 4.9)]
    got = {r["metric"]: (r["status"], r["retrain"]) for r in quality.status_rows(spark.createDataFrame(rows, "metric string, value double")).collect()}
    assert got == {"completeness_pct": ("ok", 0), "outlier_pct": ("warn", 0), "freshness_days": ("alert", 1), "churn_pct": ("alert", 1)}


def test_prediction_drift_by_week(spark):
    rows = [(dt.datetime(2024, 1, 4) + dt.timedelta(days=d), d >= 7) for d in range(14)]
    df = spark.createDataFrame(rows, "ts timestamp, hit boolean")
    got = [r["drift"] for r in quality.prediction_drift(df, "ts", F.col("hit"), 0.25, "7 days").orderBy("window_start").collect()]
    assert got == [-0.25, 0.75]
