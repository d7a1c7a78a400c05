"""Canonical schemas, feature lists and business constants."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of customers, features, and columns that are never features.
FEATURES_8 = (
    "tenure_months",
    "monthly_charges",
    "total_charges",
    "num_products",
    "support_calls",
    "payment_delay_days",
    "age",
    "satisfaction_score",
)
DERIVED_FEATURES = ("avg_revenue_per_product", "support_call_rate", "is_new_customer")
FEATURES_11 = FEATURES_8 + DERIVED_FEATURES

LABEL = "churn"
KEY = "customer_id"
NON_FEATURES = (
    "churn",
    "customer_id",
    "event_date",
    "etl_processed_at",
    "etl_job_name",
    "data_quality_flag",
)

# Types of the customer columns.
CUSTOMER_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("tenure_months", T.IntegerType()),
        T.StructField("monthly_charges", T.DoubleType()),
        T.StructField("total_charges", T.DoubleType()),
        T.StructField("num_products", T.IntegerType()),
        T.StructField("support_calls", T.IntegerType()),
        T.StructField("payment_delay_days", T.IntegerType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("satisfaction_score", T.DoubleType()),
        T.StructField("churn", T.IntegerType()),
        T.StructField("event_date", T.TimestampType()),
    ]
)

# Business medians used for null filling.
FILL_VALUES = {
    "tenure_months": 24,
    "monthly_charges": 150.0,
    "total_charges": 3600.0,
    "num_products": 2,
    "support_calls": 2,
    "payment_delay_days": 0,
    "age": 40,
    "satisfaction_score": 5.0,
}

# Closed ranges, per rule profile.
RANGE_RULES = {
    "etl": (
        ("tenure_months", 1, 72),
        ("monthly_charges", 50, 500),
        ("satisfaction_score", 0, 10),
        ("age", 18, 80),
    ),
    "api": (
        ("tenure_months", 1, 72),
        ("monthly_charges", 50, 500),
        ("total_charges", 100, 20000),
        ("num_products", 1, 6),
        ("support_calls", 0, 15),
        ("payment_delay_days", 0, 30),
        ("age", 18, 80),
        ("satisfaction_score", 0, 10),
    ),
}

# Segments, flags, risk names and their limits.
SEGMENTS = ("PF", "PJ")
DEFAULT_SEGMENT = "PF"
FLAG_OK, FLAG_INVALID = "OK", "INVALID_RANGE"
RISK_BANDS = ((0.30, "BAIXO"), (0.60, "MÉDIO"), (None, "ALTO"))
RISK_HIGH, RISK_LOW = "ALTO RISCO", "BAIXO RISCO"
RISK_CHURN_LIMIT = 0.5
DECISION_THRESHOLD = 0.5
GATE_AUC_REGISTER, GATE_AUC_TEST = 0.75, 0.70
