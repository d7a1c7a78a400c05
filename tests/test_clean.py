import datetime as dt

import pytest
from pyspark.sql import functions as F

from stayline.operators import clean, validate
from stayline.schema import CUSTOMER_SCHEMA, FEATURES_11
from stayline.sources.readers import cast_columns

D = dt.datetime
RAW = "customer_id string, tenure_months int, monthly_charges double, total_charges double, num_products int, support_calls int, payment_delay_days int, age int, satisfaction_score double, churn int, event_date timestamp, record_id int"


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW)


def row(cid="a", tenure=12, monthly=100.0, products=2, calls=3, age=30, score=5.0, churn=0, date=D(2024, 1, 1), rid=1):
    return (cid, tenure, monthly, 500.0, products, calls, 0, age, score, churn, date, rid)


def run(spark, *rows):
    out = clean.transform_customers(raw(spark, *rows), D(2024, 5, 1), "job", "record_id")
    return {r["customer_id"]: r for r in out.collect()}


def test_latest_row_wins_with_tiebreak_and_null_dates_lose(spark):
    got = run(
        spark,
        row("a", tenure=1, date=D(2024, 1, 1), rid=9),
        row("a", tenure=2, date=D(2024, 1, 2), rid=1),
        row("a", tenure=3, date=D(2024, 1, 2), rid=2),
        row("a", tenure=4, date=None, rid=10),
        row("b", tenure=5, date=None, rid=1),
    )
    assert got["a"]["tenure_months"] == 3 and got["b"]["tenure_months"] == 5


def test_label_of_latest_row_decides_and_null_label_is_dropped(spark):
    got = run(spark, row("a", churn=1, date=D(2023, 1, 1)), row("a", churn=None, date=D(2024, 1, 1)), row("b"))
    assert set(got) == {"b"}


def test_nulls_filled_before_the_range_gate(spark):
    got = run(spark, row("a", tenure=None, monthly=None, products=None, calls=None, age=None, score=None))
    r = got["a"]
    assert (r["tenure_months"], r["monthly_charges"], r["num_products"], r["age"]) == (24, 150.0, 2, 40)
    assert r["data_quality_flag"] == "OK" and r["avg_revenue_per_product"] == 75.0


@pytest.mark.parametrize(
    "change, flag",
    [
        ({"tenure": 72}, "OK"), ({"tenure": 73}, "INVALID_RANGE"), ({"tenure": 0}, "INVALID_RANGE"),
        ({"monthly": 50.0}, "OK"), ({"monthly": 500.01}, "INVALID_RANGE"),
        ({"age": 18}, "OK"), ({"age": 81}, "INVALID_RANGE"), ({"score": -0.1}, "INVALID_RANGE"),
    ],
)
def test_range_gate_is_closed_and_keeps_rows(spark, change, flag):
    assert run(spark, row("a", **change))["a"]["data_quality_flag"] == flag


def test_derived_features(spark):
    r = run(spark, row("a", tenure=0, monthly=100.0, products=3, calls=2))["a"]
    assert (r["avg_revenue_per_product"], r["support_call_rate"], r["is_new_customer"]) == (33.33, 2.0, 1)
    zero = run(spark, row("z", products=0))["z"]
    assert zero["avg_revenue_per_product"] is None
    assert zero["etl_job_name"] == "job" and zero["etl_processed_at"] == D(2024, 5, 1)


def test_stage_counts_match_the_steps(spark):
    df = raw(spark, row("a", rid=1), row("a", rid=2, churn=None), row("b"), row("c", churn=None))
    r = clean.stage_counts(df).first()
    assert (r["raw_rows"], r["deduplicated_rows"], r["labelled_rows"]) == (4, 3, 1)


def test_feature_contract(spark):
    df, have, missing = clean.prepare_features(raw(spark, row()), FEATURES_11)
    assert missing == list(FEATURES_11[8:]) and df.columns == [*have, "churn"]


def test_latest_per_key_limits_before_the_shuffle(spark):
    plan = clean.latest_per_key(raw(spark, row()), "customer_id", "event_date", "record_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2


REQ = "tenure_months string, monthly_charges string, total_charges string, num_products string, support_calls string, payment_delay_days string, age string, satisfaction_score string, segmento string"
LOW_RISK = ("60", "120.0", "7200.0", "5", "0", "0", "55", "9.5", "PF")


def errors_of(spark, **change):
    names = [p.split()[0] for p in REQ.split(", ")]
    values = dict(zip(names, LOW_RISK)) | change
    df = spark.createDataFrame([tuple(values[n] for n in names)], REQ)
    return validate.validate_requests(df).first()


def test_request_errors(spark):
    assert errors_of(spark)["errors"] == []
    assert errors_of(spark, tenure_months="doze")["errors"] == ["tenure_months:type"]
    assert errors_of(spark, tenure_months="9999")["errors"] == ["tenure_months:range"]
    assert errors_of(spark, age=None, segmento="XX")["errors"] == ["age:missing", "segmento:enum"]


def test_request_defaults_and_rounding(spark):
    r = errors_of(spark, segmento=None, satisfaction_score="6.25")
    assert r["segmento"] == "PF" and r["satisfaction_score"] == 6.2 and r["tenure_months"] == 60


def test_split_valid_parts_are_complete(spark):
    df = spark.createDataFrame([LOW_RISK, ("x", *LOW_RISK[1:])], REQ)
    good, bad = validate.split_valid(validate.validate_requests(df))
    assert good.count() == 1 and bad.count() == 1


def test_search_request_limits(spark):
    rows = [("ab", None, None), ("abc", "PF", 10), ("x" * 501, None, 3), ("abc", "QQ", 11), (None, None, None)]
    df = spark.createDataFrame(rows, "query string, segmento string, top_k int")
    got = [(r["top_k"], r["errors"]) for r in validate.validate_searches(df).collect()]
    assert got == [
        (3, ["query:length"]), (10, []), (3, ["query:length"]),
        (11, ["segmento:enum", "top_k:range"]), (3, ["query:length"]),
    ]


def test_cast_columns_gives_null_not_error(spark):
    df = spark.createDataFrame([("1", "doze", "2.5")], "customer_id string, tenure_months string, monthly_charges string")
    r = cast_columns(df, CUSTOMER_SCHEMA).first()
    assert r["tenure_months"] is None and r["monthly_charges"] == 2.5


def test_key_contract_lists_absent_keys(spark):
    have = spark.createDataFrame([("a",), ("b",)], "k string")
    need = spark.createDataFrame([("b",), ("c",)], "k string")
    assert [r["k"] for r in validate.key_contract(have, need, "k").collect()] == ["c"]


def test_segment_rule(spark):
    from stayline.operators.segment import segment

    df = spark.createDataFrame([(250.0, 3), (250.1, 3), (400.0, 2)], "monthly_charges double, num_products int")
    assert [r[0] for r in df.select(segment()).collect()] == ["PF", "PJ", "PF"]


def test_summary(spark):
    df = raw(spark, row("a"), row("b", churn=1, age=99)).transform(clean.flag_ranges).withColumn("split", F.lit("train"))
    r = clean.job_summary(df).first()
    assert (r["total_processed"], r["churn_pct"], r["invalid_pct"], r["train_rows"]) == (2, 50.0, 50.0, 2)
