import json
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from stayline.operators import metrics
from stayline.sources.registry import registry_rows


def scored(spark, rows):
    return spark.createDataFrame(rows, "y int, s double")


def auc(rows):
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def average_precision(rows):
    total, hit, seen, out = sum(y for y, _ in rows), 0, 0, 0.0
    for s in sorted({s for _, s in rows}, reverse=True):
        here = [y for y, v in rows if v == s]
        hit, seen = hit + sum(here), seen + len(here)
        out += sum(here) / total * hit / seen
    return out


def test_auc_and_ap_equal_brute_force(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 1), round(rnd.random(), 2)) for _ in range(500)]
    df = scored(spark, rows)
    r = metrics.ranking_metrics(df, "y", "s").first()
    assert r["roc_auc"] == pytest.approx(auc(rows)) and r["average_precision"] == pytest.approx(average_precision(rows))
    built_in = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0).evaluate(df)
    assert r["roc_auc"] == pytest.approx(built_in)


def test_auc_edges(spark):
    assert metrics.ranking_metrics(scored(spark, [(0, 0.5), (1, 0.5)]), "y", "s").first()["roc_auc"] == 0.5
    one = metrics.ranking_metrics(scored(spark, [(1, 0.5), (1, 0.6)]), "y", "s").first()
    assert one["roc_auc"] is None and one["average_precision"] == 1.0


def test_groups_are_separate(spark):
    df = spark.createDataFrame([("a", 1, 0.9), ("a", 0, 0.1), ("b", 1, 0.1), ("b", 0, 0.9)], "g string, y int, s double")
    got = {r["g"]: r["roc_auc"] for r in metrics.ranking_metrics(df, "y", "s", ["g"]).collect()}
    assert got == {"a": 1.0, "b": 0.0}


def test_report_and_f1(spark):
    rows = [(0, 0)] * 6 + [(0, 1)] * 2 + [(1, 0)] * 1 + [(1, 1)] * 3
    df = spark.createDataFrame(rows, "y int, p int")
    rep = {r["class"]: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert rep["1"]["precision"] == pytest.approx(0.6) and rep["1"]["recall"] == pytest.approx(0.75)
    assert rep["0"]["support"] == 8 and rep["accuracy"]["f1"] == pytest.approx(9 / 12)
    assert rep["macro avg"]["recall"] == pytest.approx(0.75)
    assert rep["weighted avg"]["precision"] == pytest.approx((6 / 7 * 8 + 0.6 * 4) / 12)
    assert metrics.f1_score(df, "y", "p").first()["f1"] == pytest.approx(6 / 9)


def test_nothing_predicted_gives_zero(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int")
    assert metrics.f1_score(df, "y", "p").first()["f1"] == 0.0


def test_report_json_shape(spark):
    df = spark.createDataFrame([(1, 0.9, 1), (0, 0.2, 0), (0, 0.95, 1)], "y int, s double, p int")
    text = metrics.evaluation_report(metrics.ranking_metrics(df, "y", "s"), metrics.f1_score(df, "y", "p")).toJSON().first()
    body = json.loads(text)["binary_classification_metrics"]
    assert set(body) == {"roc_auc", "average_precision", "f1"} and body["roc_auc"]["value"] == 0.5


def test_gates_are_inclusive(spark):
    values = spark.createDataFrame([("auc", 0.75), ("db", 1.5), ("none", None)], "metric string, value double")
    gates = [("auc", ">=", 0.75), ("auc", ">", 0.75), ("db", "<", 1.5), ("none", ">=", 0.0)]
    got = {(r["metric"], r["op"]): r["pass"] for r in metrics.apply_gates(values, gates).collect()}
    assert got == {("auc", ">="): 1, ("auc", ">"): 0, ("db", "<"): 0, ("none", ">="): 0}


def test_registration_and_champion(spark):
    ev = spark.createDataFrame([("v1", 0.74), ("v2", 0.75), ("v3", 0.75)], "model_version string, roc_auc double")
    assert {r["model_version"] for r in registry_rows(ev, 0.75, "g").collect()} == {"v2", "v3"}
    assert metrics.champion(ev).first()["champion"] == "v3"
