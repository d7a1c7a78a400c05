import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stayline.operators import model, score, segment, split
from stayline.operators.metrics import ranking_metrics
from stayline.schema import CUSTOMER_SCHEMA, FEATURES_8
from stayline.session import local_table
from stayline.sources import readers, registry, synthetic, writers


def test_csv_quarantine_in_nested_folders(spark, tmp_path):
    head = ",".join(f.name for f in CUSTOMER_SCHEMA.fields)
    (tmp_path / "d1" / "d2").mkdir(parents=True)
    (tmp_path / "d1" / "a.csv").write_text(head + '\n"c1",12,100.5,500,2,1,0,30,5.5,0,2024-01-01 00:00:00\n')
    (tmp_path / "d1" / "d2" / "b.csv").write_text(head + "\nc2,doze,100.5,500,2,1,0,30,5.5,1,2024-01-01 00:00:00\n")
    good, bad = readers.read_customers_csv(spark, str(tmp_path))
    assert [r["customer_id"] for r in good.collect()] == ["c1"]
    assert good.select("age").count() == 1  # also when the bad field is not selected
    r = bad.first()
    assert r["errors"] == ["tenure_months"] and "doze" in r["record"]
    (tmp_path / "short.csv").write_text(head + "\nc3,12\n")
    _, bad = readers.read_customers_csv(spark, str(tmp_path))
    assert {r["customer_id"]: r["errors"] for r in bad.collect()}["c3"] == ["_corrupt_record"]


def test_load_folder_prefers_parquet(spark, tmp_path):
    df = spark.range(3).withColumnRenamed("id", "tenure_months")
    df.write.parquet(str(tmp_path / "p"))
    assert readers.load_folder(spark, str(tmp_path / "p")).count() == 3
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "x.csv").write_text("customer_id,tenure_months\na,1\n")
    assert readers.load_folder(spark, str(tmp_path / "c")).count() == 1
    (tmp_path / "e").mkdir()
    with pytest.raises(FileNotFoundError):
        readers.load_folder(spark, str(tmp_path / "e"))


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("churn,tenure_months,customer_id\n1,12,a\n0,x,b\n")
    (tmp_path / "b.csv").write_text('\ufeff"customer_id", extra ,churn,churn\nc,9,0,7\nd,8,1,7,surplus\n')
    (tmp_path / "empty.csv").write_text("customer_id,churn\n")
    good, bad = readers.read_customers_csv(spark, str(tmp_path))
    assert {(r.customer_id, r.churn, r.tenure_months, r.age if "age" in good.columns else None) for r in good.collect()} == {
        ("a", 1, 12, None), ("c", 0, None, None),
    }
    assert {(r.customer_id, tuple(r.errors)) for r in bad.collect()} == {("b", ("tenure_months",)), ("d", ("_corrupt_record",))}
    assert good.columns == [f.name for f in readers.CUSTOMER_SCHEMA.fields]
    heads = {tuple(readers.header_names(r.header)): len(r.files) for r in readers.csv_headers(spark, str(tmp_path)).collect()}
    assert heads == {("churn", "tenure_months", "customer_id"): 1, ("customer_id", "extra", "churn", "churn"): 1, ("customer_id", "churn"): 1}


def test_split_and_label_sinks(spark, tmp_path):
    df = split.bucket_split(synthetic.noisy_classes(spark, 200))
    writers.write_splits(df, str(tmp_path / "s"))
    assert readers.load_folder(spark, writers.write_label(df, str(tmp_path), "train")).count() == 200
    assert spark.read.parquet(str(tmp_path / "s")).groupBy("split").count().count() == 2


def test_month_sink_replaces_only_its_partitions(spark, tmp_path):
    rows = [(1, dt.datetime(2024, 1, 5)), (2, dt.datetime(2024, 2, 5))]
    writers.write_by_month(spark.createDataFrame(rows, "id int, event_date timestamp"), str(tmp_path))
    writers.write_by_month(spark.createDataFrame([(3, dt.datetime(2024, 2, 6))], "id int, event_date timestamp"), str(tmp_path))
    assert {r["id"] for r in spark.read.parquet(str(tmp_path)).collect()} == {1, 3}


def cards(spark):
    df = segment.add_segment(synthetic.two_profiles(spark, 200)).withColumn("cluster_id", F.col("churn"))
    return segment.profile_cards(segment.segment_profiles(df))


def test_cards_survive_the_json_form(spark, tmp_path):
    flat = cards(spark)
    writers.write_cards(flat, str(tmp_path / "cards"))
    back = readers.read_cards_json(spark, str(tmp_path / "cards"))
    key = lambda r: (r["segmento"], r["cluster_id"])
    assert sorted((r.asDict() for r in flat.collect()), key=key) == sorted(
        (r.asDict() for r in back.drop("cluster_key").collect()), key=key
    )


def test_card_documents(spark, tmp_path):
    writers.write_card_documents(segment.card_text(cards(spark)), str(tmp_path / "docs"))
    assert spark.read.text(str(tmp_path / "docs")).count() == cards(spark).count()


def test_feature_store_appends_versions(spark, tmp_path):
    for v in ("v1", "v2"):
        writers.append_features(spark.range(2), str(tmp_path), v)
    assert spark.read.parquet(str(tmp_path)).groupBy("feature_version").count().count() == 2


def test_metadata_report_and_registry(spark, tmp_path):
    meta = registry.model_metadata(spark, "GBTClassifier", FEATURES_8, dt.datetime(2024, 1, 1), {"roc_auc": 0.8}, {"trees": 5})
    writers.write_report(meta, str(tmp_path / "meta"))
    text = next(Path(tmp_path / "meta").glob("part-*.json")).read_text()
    body = json.loads(text)
    assert body["features"] == list(FEATURES_8) and body["n_features"] == 8
    ev = spark.createDataFrame([("v1", 0.8), ("v2", 0.6)], "model_version string, roc_auc double")
    registry.register(ev, str(tmp_path / "reg"), 0.75)
    registry.register(ev, str(tmp_path / "reg"), 0.5)
    rows = spark.read.parquet(str(tmp_path / "reg")).collect()
    assert len(rows) == 3 and {r["approval_status"] for r in rows} == {"PendingManualApproval"}


def test_generators_stay_in_range(spark):
    df = synthetic.noisy_classes(spark, 2000)
    r = df.agg(F.min("age"), F.max("age"), F.min("satisfaction_score"), F.max("satisfaction_score"), F.avg("churn")).first()
    assert 18 <= r[0] and r[1] <= 80 and 0 <= r[2] and r[3] <= 10 and 0.2 < r[4] < 0.32
    two = synthetic.two_profiles(spark, 1000).groupBy("churn").count().collect()
    assert sorted(tuple(x) for x in two) == [(0, 500), (1, 500)]


def test_local_table_is_a_local_relation(spark):
    df = local_table(spark, [("a", 1.5)], "k string, v double")
    assert "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def trained(spark):
    df = split.exact_split(synthetic.noisy_classes(spark, 1500)).cache()
    fitted = model.train(df.filter("split = 'train'"), params=model.GbtParams(trees=5, learning_rate=0.3))
    return df.filter("split = 'test'"), fitted


def test_model_learns_and_reports(spark, trained):
    test, fitted = trained
    m = model.evaluate(test, fitted).first()["binary_classification_metrics"]
    assert 0.7 < m["roc_auc"]["value"] <= 1 and m["average_precision"]["value"] > 0.4


def test_scores_are_probabilities_and_repeatable(spark, trained, tmp_path):
    test, fitted = trained
    first = {r["customer_id"]: (r["probability"], r["churn_prediction"]) for r in model.score(test, fitted).collect()}
    assert all(0 <= p <= 1 and c == (p >= 0.5) for p, c in first.values())
    model.save(fitted, str(tmp_path / "m"))
    again = {r["customer_id"]: (r["probability"], r["churn_prediction"]) for r in model.score(test, model.load(str(tmp_path / "m"))).collect()}
    assert first == again


def test_cross_validation_over_given_folds(spark):
    df = split.assign_folds(synthetic.noisy_classes(spark, 600), folds=3)
    grid = [{"depth": 1}, {"depth": 3}]
    scores = model.cross_validate(df, params=model.GbtParams(trees=2, learning_rate=0.3), folds=3, grid=grid)
    assert scores.count() == 2 * df.count() and scores.select("candidate", "customer_id").distinct().count() == 2 * df.count()
    assert scores.select("customer_id", "fold").distinct().join(df, ["customer_id", "fold"]).count() == df.count()
    rows = ranking_metrics(scores, "churn", "probability", ("candidate", "fold")).collect()
    assert len(rows) == 6 and all(0.5 < r["roc_auc"] <= 1 for r in rows)


def test_medians_come_from_training_rows_only(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "x double")
    assert model.fit_medians(df, ["x"]) == {"x": 2.0}


@pytest.mark.parametrize("p, band", [(0.0, "BAIXO"), (0.29999, "BAIXO"), (0.3, "MÉDIO"), (0.59999, "MÉDIO"), (0.6, "ALTO")])
def test_bands_use_the_unrounded_probability(spark, p, band):
    df = spark.createDataFrame([(1, p, 0, None, "PF")], "customer_id int, probability double, cluster_id int, perfil_label string, segmento string")
    r = score.respond(df).first()
    assert r["risk_level"] == band and r["model_version"] == "unknown"


def test_card_lookup_keeps_unmatched_rows(spark):
    df = spark.createDataFrame([(1, "PF", 0), (2, "PJ", 9)], "customer_id int, segmento string, cluster_id int")
    known = spark.createDataFrame([("PF", 0, "x")], "segmento string, cluster_id int, perfil_label string")
    got = {r["customer_id"]: r["perfil_label"] for r in score.lookup_cards(df, known).collect()}
    assert got == {1: "x", 2: None}


def test_json_instances(spark):
    df = spark.createDataFrame([('{"instances": [[1, 2.5], [3, 4]]}',)], "body string")
    rows = score.parse_instances(df, ["a", "b"]).orderBy("instance").collect()
    assert [(r["a"], r["b"]) for r in rows] == [(1.0, 2.5), (3.0, 4.0)]
