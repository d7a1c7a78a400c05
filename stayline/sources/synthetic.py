"""Generators for demonstration and tests, built on spark.range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.functions.hashing import md5_uniform
from stayline.functions.numeric import calibrate, clip

# Fixed values: (feature, kind, a, b, lo, hi) per profile; ints are uniform in [a, b),
# normals have mean a and deviation b, held in [lo, hi].
PROFILE_LOW = (
    ("tenure_months", "int", 24, 72, None, None),
    ("monthly_charges", "normal", 130, 25, 50, 300),
    ("total_charges", "normal", 6000, 1500, 1000, 15000),
    ("num_products", "int", 3, 7, None, None),
    ("support_calls", "int", 0, 4, None, None),
    ("payment_delay_days", "int", 0, 5, None, None),
    ("age", "int", 35, 70, None, None),
    ("satisfaction_score", "normal", 7.5, 1.0, 5, 10),
)
PROFILE_HIGH = (
    ("tenure_months", "int", 1, 12, None, None),
    ("monthly_charges", "normal", 380, 60, 150, 500),
    ("total_charges", "normal", 2000, 800, 100, 6000),
    ("num_products", "int", 1, 3, None, None),
    ("support_calls", "int", 7, 15, None, None),
    ("payment_delay_days", "int", 10, 30, None, None),
    ("age", "int", 18, 40, None, None),
    ("satisfaction_score", "normal", 2.5, 0.8, 0, 5),
)

# Fixed values: (feature, scale, shift, lo, hi, kind) from unit-variance raw features.
CALIBRATION = (
    ("tenure_months", 12, 24, 1, 72, "int"),
    ("monthly_charges", 50, 150, 50, 500, "money"),
    ("total_charges", 2000, 5000, 100, 20000, "money"),
    ("num_products", 2, 3, 1, 6, "int"),
    ("support_calls", 3, 2, 0, 15, "int"),
    ("payment_delay_days", 5, 5, 0, 30, "int"),
    ("age", 10, 40, 18, 80, "int"),
    ("satisfaction_score", 2, 5, 0, 10, "score"),
)


def _draw(spec, seed: int) -> Column:
    _, kind, a, b, lo, hi = spec
    if kind == "int":
        return F.floor(F.rand(seed) * (b - a) + a).cast("int")
    return clip(F.randn(seed) * float(b) + float(a), float(lo), float(hi))


def two_profiles(spark: SparkSession, n: int = 2000, seed: int = 42) -> DataFrame:
    """Half low-risk, half high-risk customers, with their label."""
    ids = spark.range(n).withColumn(
        "churn", (F.col("id") >= n // 2).cast("int")
    )
    cols = []
    for i, (low, high) in enumerate(zip(PROFILE_LOW, PROFILE_HIGH)):
        value = F.when(F.col("churn") == 0, _draw(low, seed + i)).otherwise(_draw(high, seed + 100 + i))
        if low[0] == "satisfaction_score":
            value = F.bround(value, 1)
        cols.append(value.alias(low[0]))
    return ids.select(F.col("id").alias("customer_id"), *cols, "churn")


def calibrated(raw: DataFrame, raw_cols, keep=()) -> DataFrame:
    """Eight raw columns mapped to the business features."""
    out = []
    for col, (name, scale, shift, lo, hi, kind) in zip(raw_cols, CALIBRATION):
        value = calibrate(F.col(col).cast("double"), scale, shift, lo, hi)
        if kind == "int":
            value = value.cast("int")
        else:
            value = F.round(value, 2 if kind == "money" else 1)
        out.append(value.alias(name))
    return raw.select(*keep, *out)


def noisy_classes(
    spark: SparkSession, n: int = 5000, churn_share: float = 0.25, flip: float = 0.03, seed: int = 42
) -> DataFrame:
    """Imbalanced classes with shifted normals per class and flipped labels."""
    base = spark.range(n).withColumn("_y", (F.rand(seed) < churn_share).cast("int"))
    raw = [f"_x{i}" for i in range(len(CALIBRATION))]
    for i, name in enumerate(raw):
        shift = (0.9 if i % 2 else -0.9) if i < 6 else 0.0
        base = base.withColumn(name, F.randn(seed + 1 + i) + F.col("_y") * shift)
    flipped = F.when(F.rand(seed + 50) < flip, 1 - F.col("_y")).otherwise(F.col("_y"))
    base = base.withColumn("churn", flipped).withColumn("customer_id", F.col("id"))
    return calibrated(base, raw, keep=("customer_id", "churn"))


def seeded_order(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    return df.orderBy(md5_uniform(seed, key, 2**32), key)
