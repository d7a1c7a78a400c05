"""Query registry, the customer view over the given tables, and its SQL twin."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.operators.clean import derive_features, drop_unlabelled, fill_nulls, flag_ranges
from stayline.operators.cluster_metrics import assign_nearest, fit_centroids
from stayline.operators.joins import lookup_join
from stayline.operators.scaling import fit_standard
from stayline.operators.segment import add_segment
from stayline.schema import FEATURES_8, FILL_VALUES
from stayline.session import materialize

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

AS_OF = dt.date(2001, 8, 2)
CHURN_CUT = dt.datetime(2000, 7, 1)
PROCESSED_AT = dt.datetime(2024, 1, 1)
JOB_NAME = "churn-etl"


def query(sql: str | None = None, name: str | None = None):
    """Register a function as a query under its name, with the SQL that must agree."""

    def add(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- customer view -----------------------------------------------------------------


def customers(spark: SparkSession, sf: str) -> DataFrame:
    """One row per customer with the canonical columns, from customer, orders, events.

    Orders and error events are aggregated by customer before the joins, so a customer
    with very many of them is reduced on the map side.
    """
    per_order = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("_first"),
        F.max("o_orderdate").alias("_last"),
        F.count(F.lit(1)).alias("_orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("_spend"),
        F.countDistinct("o_orderpriority").alias("_priorities"),
        F.count_if(F.col("o_orderstatus") == "P").alias("_pending"),
    )
    per_user = table(spark, sf, "events").groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "error").alias("_errors")
    )
    joined = (
        table(spark, sf, "customer")
        .select("c_custkey", "c_acctbal")
        .join(per_order, F.col("c_custkey") == F.col("o_custkey"), "left")
        .join(per_user, F.col("c_custkey") == F.col("user_id"), "left")
    )
    days = F.date_diff(F.lit(AS_OF), F.col("_first"))
    return joined.select(
        F.col("c_custkey").alias("customer_id"),
        F.floor(days / 30).cast("int").alias("tenure_months"),
        (F.col("_spend") / F.col("_orders") / 1000).alias("monthly_charges"),
        (F.col("_spend") / 1000).alias("total_charges"),
        F.col("_priorities").cast("int").alias("num_products"),
        F.col("_errors").cast("int").alias("support_calls"),
        F.coalesce("_pending", F.lit(0)).cast("int").alias("payment_delay_days"),
        (F.lit(12) + (F.col("c_custkey") * 7) % 73).cast("int").alias("age"),
        (F.col("c_acctbal") / 1000).alias("satisfaction_score"),
        F.when(F.col("_last") < F.lit(CHURN_CUT).cast("timestamp_ntz"), 1)
        .when(F.col("_last").isNotNull(), 0)
        .alias("churn"),
        F.col("_last").alias("event_date"),
    )


CUST = """
cust AS (
  SELECT c.c_custkey AS customer_id,
         CAST(date_diff('day', o.first_d, TIMESTAMP '2001-08-02') // 30 AS INTEGER) AS tenure_months,
         o.spend / o.orders / 1000 AS monthly_charges,
         o.spend / 1000 AS total_charges,
         CAST(o.priorities AS INTEGER) AS num_products,
         CAST(e.errors AS INTEGER) AS support_calls,
         CAST(coalesce(o.pending, 0) AS INTEGER) AS payment_delay_days,
         CAST(12 + (c.c_custkey * 7) % 73 AS INTEGER) AS age,
         c.c_acctbal / 1000 AS satisfaction_score,
         CASE WHEN o.last_d < TIMESTAMP '2000-07-01' THEN 1 WHEN o.last_d IS NOT NULL THEN 0 END AS churn,
         o.last_d AS event_date
  FROM customer c
  LEFT JOIN (
    SELECT o_custkey, min(o_orderdate) AS first_d, max(o_orderdate) AS last_d, count(*) AS orders,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spend,
           count(DISTINCT o_orderpriority) AS priorities,
           count(*) FILTER (o_orderstatus = 'P') AS pending
    FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey
  LEFT JOIN (
    SELECT user_id, count(*) FILTER (event_type = 'error') AS errors
    FROM events GROUP BY user_id) e ON c.c_custkey = e.user_id
)"""


def customer_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Raw ETL input: one record per order of a customer, so keys repeat.

    Orders look up their customer, so a customer with very many orders is spread over
    tasks; customers without orders (they have no label) are added after.
    """
    base = materialize(customers(spark, sf).drop("monthly_charges", "event_date"), "customers")
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        (F.col("o_totalprice") / 1000).alias("monthly_charges"),
        F.col("o_orderdate").alias("event_date"),
        F.col("o_orderkey").alias("record_id"),
    )
    known = base.withColumn("_known", F.lit(True))
    with_orders = lookup_join(orders, known, "customer_id").filter("_known").drop("_known")
    without = base.filter("churn is null")
    return with_orders.unionByName(without, allowMissingColumns=True)


FEED = (
    CUST
    + """,
feed AS (
  SELECT cust.* REPLACE (o.o_totalprice / 1000 AS monthly_charges, o.o_orderdate AS event_date),
         o.o_orderkey AS record_id
  FROM cust LEFT JOIN orders o ON cust.customer_id = o.o_custkey
)"""
)


def clean_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Filled, labelled, flagged, enriched customers with their segment."""
    return (
        customers(spark, sf)
        .transform(fill_nulls)
        .transform(drop_unlabelled)
        .transform(flag_ranges)
        .transform(derive_features)
        .transform(add_segment)
    )


def clean_table(spark: SparkSession, sf: str) -> DataFrame:
    """The clean customers written once, for plans with several readers."""
    return materialize(clean_customers(spark, sf), "clean")


def fill_sql(source: str) -> str:
    filled = ", ".join(f"coalesce({c}, {v}) AS {c}" for c, v in FILL_VALUES.items())
    return f"SELECT {source}.* REPLACE ({filled}) FROM {source}"


FLAG_SQL = """CASE WHEN tenure_months < 1 OR tenure_months > 72 OR monthly_charges < 50 OR monthly_charges > 500
       OR satisfaction_score < 0 OR satisfaction_score > 10 OR age < 18 OR age > 80
       THEN 'INVALID_RANGE' ELSE 'OK' END"""
DERIVED_SQL = """round(monthly_charges / num_products, 2) AS avg_revenue_per_product,
       round(support_calls / greatest(tenure_months, 1), 4) AS support_call_rate,
       CASE WHEN tenure_months < 6 THEN 1 ELSE 0 END AS is_new_customer"""
SEGMENT_SQL = "CASE WHEN monthly_charges > 250 AND num_products >= 3 THEN 'PJ' ELSE 'PF' END"

CLEAN = (
    CUST
    + f""",
filled AS ({fill_sql('cust')}),
clean AS (
  SELECT *, {FLAG_SQL} AS data_quality_flag,
       {DERIVED_SQL},
       {SEGMENT_SQL} AS segmento
  FROM filled WHERE churn IS NOT NULL
)"""
)


# --- deterministic score, standing in for a trained model ---------------------------


def raw_score() -> Column:
    """A probability from view columns alone, so that SQL can compute it too."""
    late = F.col("payment_delay_days") + F.lit(1.0)
    return late / (late + F.col("tenure_months") / F.lit(10.0) + F.col("num_products"))


RAW_SCORE = "(payment_delay_days + 1e0) / (payment_delay_days + 1e0 + tenure_months / 10e0 + num_products)"


def fixed_score() -> Column:
    return F.round(raw_score(), 6)


def scored_customers(spark: SparkSession, sf: str) -> DataFrame:
    df = clean_customers(spark, sf).withColumn("score", fixed_score())
    return df.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


SCORED = (
    CLEAN
    + f""",
scored AS (
  SELECT *, CASE WHEN score >= 0.3 THEN 1 ELSE 0 END AS predicted FROM (
    SELECT *, round({RAW_SCORE}, 6) AS score FROM clean)
)"""
)


def md5_mod(seed: int, key: str, n: int) -> str:
    return f"(('0x' || substr(md5(concat('{seed}:', {key})), 1, 8))::BIGINT % {n})"


# --- scaled features and fixed clusters ---------------------------------------------


def z_names(features=FEATURES_8) -> list[str]:
    return [f"z_{f}" for f in features]


def scaled_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Clean customers plus z_<feature> columns (population deviation).

    Fitting and applying read the rows several times, so the clean table is written once:
    one row per customer instead of the joins over orders and events again.
    """
    df = clean_table(spark, sf)
    params = fit_standard(df, FEATURES_8)
    return df.withColumns(
        {f"z_{f}": (F.col(f).cast("double") - m) / s for f, (m, s) in params.items()}
    )


def clustered_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest of two centroids, the mean scaled vectors of the segments."""
    df = scaled_customers(spark, sf)
    return assign_nearest(df, z_names(), fit_centroids(df, z_names(), "segmento"))


_MOMENTS = ", ".join(f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}" for f in FEATURES_8)
_Z = ", ".join(
    f"(clean.{f} - m_{f}) / CASE WHEN s_{f} = 0 THEN 1 ELSE s_{f} END AS z_{f}" for f in FEATURES_8
)
SCALED = (
    CLEAN
    + f""",
moments AS (SELECT {_MOMENTS} FROM clean),
scaled AS (SELECT clean.*, {_Z} FROM clean, moments)"""
)
_AVG_Z = ", ".join(f"avg(z_{f}) AS c_{f}" for f in FEATURES_8)
DIST_SQL = " + ".join(f"(z_{f} - c_{f}) * (z_{f} - c_{f})" for f in FEATURES_8)
CLUSTERED = (
    SCALED
    + f""",
cent AS (
  SELECT CAST(row_number() OVER (ORDER BY segmento) - 1 AS INTEGER) AS cid, *
  FROM (SELECT segmento, {_AVG_Z} FROM scaled GROUP BY segmento)),
clus AS (
  SELECT s.*, n.cluster_id, n.sq_distance FROM scaled s JOIN (
    SELECT customer_id, arg_min(cid, (d, cid)) AS cluster_id, min(d) AS sq_distance
    FROM (SELECT customer_id, cid, {DIST_SQL} AS d FROM scaled, cent) GROUP BY customer_id
  ) n ON s.customer_id = n.customer_id
)"""
)
