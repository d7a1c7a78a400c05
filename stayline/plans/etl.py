"""Cleaning, validation and typed-read queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.operators import clean, split, validate
from stayline.operators.segment import segment_share as op_segment_share
from stayline.plans.base import (
    CLEAN,
    CUST,
    DERIVED_SQL,
    FEED,
    FLAG_SQL,
    JOB_NAME,
    PROCESSED_AT,
    SCORED,
    clean_customers,
    customer_feed,
    customers,
    fill_sql,
    md5_mod,
    query,
    scored_customers,
    table,
)
from stayline.schema import CUSTOMER_SCHEMA, FEATURES_8, FEATURES_11, NON_FEATURES
from stayline.session import local_table, materialize
from stayline.sources.readers import cast_columns
from stayline.sources.synthetic import CALIBRATION, calibrated

PROCESSED_COLUMNS = (
    "customer_id, tenure_months, monthly_charges, total_charges, num_products, support_calls, "
    "payment_delay_days, age, satisfaction_score, churn, event_date, record_id, data_quality_flag, "
    "avg_revenue_per_product, support_call_rate, is_new_customer"
)
LATEST = (
    FEED
    + f""",
latest AS (
  SELECT * FROM feed
  QUALIFY row_number() OVER (PARTITION BY customer_id
      ORDER BY event_date DESC NULLS LAST, record_id DESC NULLS LAST) = 1),
lfill AS ({fill_sql('latest')}),
processed AS (
  SELECT *, {FLAG_SQL} AS data_quality_flag, {DERIVED_SQL} FROM lfill WHERE churn IS NOT NULL)"""
)


@query(f"WITH {CUST} SELECT * FROM cust")
def customer_view(spark, sf) -> DataFrame:
    return customers(spark, sf)


@query(
    """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""
)
def latest_order_per_customer(spark, sf) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return clean.latest_per_key(orders, "o_custkey", "o_orderdate", "o_orderkey")


def processed(spark, sf) -> DataFrame:
    return clean.transform_customers(customer_feed(spark, sf), PROCESSED_AT, JOB_NAME, tiebreak="record_id")


@query(
    f"""WITH {LATEST} SELECT {PROCESSED_COLUMNS}, TIMESTAMP '2024-01-01' AS etl_processed_at,
    '{JOB_NAME}' AS etl_job_name FROM processed"""
)
def etl_processed(spark, sf) -> DataFrame:
    return processed(spark, sf)


@query(
    f"""WITH {LATEST}, s AS (SELECT *, CASE WHEN {md5_mod(42, 'customer_id', 100)} < 80
        THEN 'train' ELSE 'test' END AS split FROM processed)
    SELECT count(*) AS total_processed,
           avg(CASE WHEN churn = 1 THEN 1e0 ELSE 0e0 END) * 100 AS churn_pct,
           avg(CASE WHEN data_quality_flag = 'INVALID_RANGE' THEN 1e0 ELSE 0e0 END) * 100 AS invalid_pct,
           count(*) FILTER (data_quality_flag = 'INVALID_RANGE') AS invalid_rows,
           count(*) FILTER (split = 'train') AS train_rows,
           count(*) FILTER (split = 'test') AS test_rows
    FROM s"""
)
def etl_summary(spark, sf) -> DataFrame:
    return clean.job_summary(split.bucket_split(processed(spark, sf)))


@query(
    f"""WITH {LATEST} SELECT (SELECT count(*) FROM feed) AS raw_rows,
    (SELECT count(*) FROM latest) AS deduplicated_rows,
    (SELECT count(*) FROM processed) AS labelled_rows"""
)
def etl_stage_counts(spark, sf) -> DataFrame:
    return clean.stage_counts(customer_feed(spark, sf))


@query(
    f"""WITH {LATEST} SELECT (SELECT count(*) FROM feed) AS raw_rows,
    (SELECT count(*) FROM latest) AS deduplicated_rows,
    (SELECT count(*) FROM processed) AS labelled_rows"""
)
def etl_observed_counts(spark, sf) -> DataFrame:
    """The same counts, observed while the processed table is written."""
    done, seen = clean.transform_observed(customer_feed(spark, sf), dt.datetime(2024, 1, 1), "etl", "record_id")
    materialize(done, "processed")
    return local_table(spark, [[seen[c].get[c] for c in seen]], ", ".join(f"{c} bigint" for c in seen))


@query(
    f"""WITH {CLEAN} SELECT data_quality_flag, churn, count(*) AS n,
    round(avg(avg_revenue_per_product), 6) AS mean_revenue, count(*) FILTER (is_new_customer = 1) AS new_customers
    FROM clean GROUP BY ALL"""
)
def quality_flag_summary(spark, sf) -> DataFrame:
    return clean_customers(spark, sf).groupBy("data_quality_flag", "churn").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("avg_revenue_per_product"), 6).alias("mean_revenue"),
        F.count_if(F.col("is_new_customer") == 1).alias("new_customers"),
    )


_RANGE_CASES = {
    "tenure_months": (1, 72),
    "monthly_charges": (50, 500),
    "satisfaction_score": (0, 10),
    "age": (18, 80),
}


@query(
    f"WITH {CLEAN} "
    + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, count(*) FILTER ({f} < {lo} OR {f} > {hi}) AS n FROM clean"
        for f, (lo, hi) in _RANGE_CASES.items()
    )
)
def range_violations(spark, sf) -> DataFrame:
    """Rows outside each ETL rule, one pass for all rules."""
    wide = clean_customers(spark, sf).agg(
        *[F.count_if((F.col(f) < lo) | (F.col(f) > hi)).alias(f) for f, (lo, hi) in _RANGE_CASES.items()]
    )
    return wide.unpivot([], list(_RANGE_CASES), "feature", "n")


# Records as text, the way a delimited file delivers them; negative balances arrive as
# words, customers without events leave the calls empty.
TEXT_FIELDS = [f for f in FEATURES_8]


def text_requests(spark, sf) -> DataFrame:
    df = customers(spark, sf)
    cols = [F.col(f).cast("string").alias(f) for f in TEXT_FIELDS if f != "satisfaction_score"]
    score = F.when(F.col("satisfaction_score") < 0, "negativo").otherwise(
        F.col("satisfaction_score").cast("string")
    )
    segment = F.when(F.col("num_products") >= 3, "PJ").when(F.col("num_products") == 1, "XX")
    return df.select("customer_id", *cols, score.alias("satisfaction_score"), segment.alias("segmento"))


_TEXT = (
    CUST
    + """,
req AS (
  SELECT * REPLACE (CASE WHEN satisfaction_score < 0 THEN NULL ELSE satisfaction_score END AS satisfaction_score),
         satisfaction_score < 0 AS bad_score,
         CASE WHEN num_products >= 3 THEN 'PJ' WHEN num_products = 1 THEN 'XX' ELSE 'PF' END AS segmento
  FROM cust),
checked AS (
  SELECT *, list_filter([
    CASE WHEN tenure_months IS NULL THEN 'tenure_months:missing' WHEN tenure_months < 1 OR tenure_months > 72 THEN 'tenure_months:range' END,
    CASE WHEN monthly_charges IS NULL THEN 'monthly_charges:missing' WHEN monthly_charges < 50 OR monthly_charges > 500 THEN 'monthly_charges:range' END,
    CASE WHEN total_charges IS NULL THEN 'total_charges:missing' WHEN total_charges < 100 OR total_charges > 20000 THEN 'total_charges:range' END,
    CASE WHEN num_products IS NULL THEN 'num_products:missing' WHEN num_products < 1 OR num_products > 6 THEN 'num_products:range' END,
    CASE WHEN support_calls IS NULL THEN 'support_calls:missing' WHEN support_calls < 0 OR support_calls > 15 THEN 'support_calls:range' END,
    CASE WHEN payment_delay_days < 0 OR payment_delay_days > 30 THEN 'payment_delay_days:range' END,
    CASE WHEN age < 18 OR age > 80 THEN 'age:range' END,
    CASE WHEN bad_score THEN 'satisfaction_score:type' WHEN satisfaction_score > 10 THEN 'satisfaction_score:range' END,
    CASE WHEN segmento NOT IN ('PF', 'PJ') THEN 'segmento:enum' END
  ], lambda x: x IS NOT NULL) AS errors FROM req)"""
)


@query(
    f"""WITH {_TEXT} SELECT customer_id, tenure_months, monthly_charges, num_products, support_calls, age,
    round_even(satisfaction_score, 1) AS satisfaction_score, segmento,
    array_to_string(errors, ',') AS errors, CASE WHEN len(errors) = 0 THEN 1 ELSE 0 END AS valid FROM checked"""
)
def request_validation(spark, sf) -> DataFrame:
    checked = validate.validate_requests(text_requests(spark, sf))
    return checked.select(
        "customer_id",
        "tenure_months",
        "monthly_charges",
        "num_products",
        "support_calls",
        "age",
        "satisfaction_score",
        "segmento",
        F.array_join("errors", ",").alias("errors"),
        (F.size("errors") == 0).cast("int").alias("valid"),
    )


@query(f"WITH {_TEXT} SELECT error, count(*) AS n FROM (SELECT unnest(errors) AS error FROM checked) GROUP BY error")
def request_error_counts(spark, sf) -> DataFrame:
    return validate.error_counts(validate.validate_requests(text_requests(spark, sf)))


@query(
    """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS tenure_months,
       TRY_CAST(CASE WHEN event_type = 'error' THEN event_type ELSE '12' END AS INTEGER) AS age
    FROM events"""
)
def typed_cast(spark, sf) -> DataFrame:
    """Schema applied to text columns: what does not parse is NULL, not an exception."""
    text = table(spark, sf, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").alias("tenure_months"),
        F.when(F.col("event_type") == "error", F.col("event_type")).otherwise("12").alias("age"),
    )
    schema = T.StructType(
        [T.StructField("event_id", T.LongType()), CUSTOMER_SCHEMA["tenure_months"], CUSTOMER_SCHEMA["age"]]
    )
    return cast_columns(text, schema)


@query(f"WITH {CLEAN} SELECT {', '.join(FEATURES_11)}, churn FROM clean")
def ordered_features(spark, sf) -> DataFrame:
    features, _, _ = clean.prepare_features(clean_customers(spark, sf), FEATURES_11)
    return features


@query(
    f"""WITH {CUST} SELECT e.feature, CAST(e.pos AS INTEGER) AS position, e.feature NOT IN
      ('avg_revenue_per_product', 'support_call_rate', 'is_new_customer') AS present,
      (SELECT count(*) FROM cust) AS n_rows
    FROM (SELECT unnest({list(FEATURES_11)!r}) AS feature, unnest(range({len(FEATURES_11)})) AS pos) e"""
)
def feature_contract(spark, sf) -> DataFrame:
    df = customers(spark, sf)
    n = df.agg(F.count(F.lit(1))).scalar()
    return clean.feature_contract(df, FEATURES_11).withColumn("n_rows", n)


@query(f"WITH {CLEAN} SELECT {', '.join(FEATURES_8)}, {', '.join(FEATURES_11[8:])}, segmento FROM clean")
def drop_list_projection(spark, sf) -> DataFrame:
    return clean_customers(spark, sf).drop(*NON_FEATURES)


@query(
    f"""WITH {CLEAN} SELECT count(*) AS n,
    avg(CASE WHEN segmento = 'PF' THEN 1e0 ELSE 0e0 END) * 100 AS pf_pct,
    avg(CASE WHEN segmento = 'PJ' THEN 1e0 ELSE 0e0 END) * 100 AS pj_pct FROM clean"""
)
def segment_share(spark, sf) -> DataFrame:
    return op_segment_share(clean_customers(spark, sf))


def _calibration_sql() -> str:
    out = []
    for i, (name, scale, shift, lo, hi, kind) in enumerate(CALIBRATION):
        x = f"embedding[{i + 1}]::DOUBLE * 8"
        v = f"greatest({lo}e0, least({hi}e0, {x} * {scale} + {shift}))"
        if kind == "int":
            v = f"CAST(trunc({v}) AS INTEGER)"
        else:
            v = f"round({v}, {2 if kind == 'money' else 1})"
        out.append(f"{v} AS {name}")
    return ", ".join(out)


@query(f"SELECT vec_id, {_calibration_sql()} FROM embeddings")
def calibrated_features(spark, sf) -> DataFrame:
    """Raw numeric columns (first vector components) mapped to business ranges."""
    raw = table(spark, sf, "embeddings").select(
        "vec_id", *[(F.col("embedding")[i].cast("double") * 8).alias(f"x{i}") for i in range(len(CALIBRATION))]
    )
    return calibrated(raw, [f"x{i}" for i in range(len(CALIBRATION))], keep=["vec_id"])


@query(
    f"""WITH {SCORED} SELECT customer_id, score FROM scored WHERE {md5_mod(42, 'customer_id', 100)} < 20"""
)
def prediction_capture(spark, sf) -> DataFrame:
    return split.capture_sample(scored_customers(spark, sf)).select("customer_id", "score")


_SEARCHES = """asked AS (
  SELECT item_id, text AS query, 'PF' AS segmento, CAST(item_id % 12 AS INTEGER) AS top_k FROM benchmark
  UNION ALL SELECT doc_id, text, CASE doc_id % 4 WHEN 0 THEN 'PF' WHEN 1 THEN 'PJ' WHEN 2 THEN upper(lang) END,
    CASE WHEN doc_id % 3 > 0 THEN CAST(doc_id % 12 AS INTEGER) END FROM documents)"""


@query(
    f"""WITH {_SEARCHES} SELECT item_id, query, coalesce(top_k, 3) AS top_k, array_to_string(list_filter([
      CASE WHEN NOT length(query) BETWEEN 3 AND 500 THEN 'query:length' END,
      CASE WHEN segmento NOT IN ('PF', 'PJ') THEN 'segmento:enum' END,
      CASE WHEN NOT coalesce(top_k, 3) BETWEEN 1 AND 10 THEN 'top_k:range' END], lambda x: x IS NOT NULL), ',') AS errors FROM asked"""
)
def search_request_validation(spark, sf) -> DataFrame:
    """Search requests from benchmark items and documents, with every kind of error among them."""
    asked = table(spark, sf, "benchmark").select(
        "item_id", F.col("text").alias("query"), F.lit("PF").alias("segmento"), (F.col("item_id") % 12).cast("int").alias("top_k")
    )
    turn = F.col("doc_id") % 4
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("item_id"),
        F.col("text").alias("query"),
        F.when(turn == 0, "PF").when(turn == 1, "PJ").when(turn == 2, F.upper("lang")).alias("segmento"),
        F.when(F.col("doc_id") % 3 > 0, (F.col("doc_id") % 12).cast("int")).alias("top_k"),
    )
    checked = validate.validate_searches(asked.unionByName(docs))
    return checked.select("item_id", "query", "top_k", F.array_join("errors", ",").alias("errors"))
