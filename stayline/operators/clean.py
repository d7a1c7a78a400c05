"""Customer cleaning: latest row, null fill, range flag, derived features, lineage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from stayline.functions.numeric import share
from stayline.schema import FILL_VALUES, FLAG_INVALID, FLAG_OK, LABEL, RANGE_RULES
from stayline.session import local_table


def latest_per_key(df: DataFrame, key: str, ts: str, tiebreak: str) -> DataFrame:
    """Newest row per key. Ties on `ts` go to the larger `tiebreak`, NULL dates lose.

    Spark plans a group limit below the shuffle, so each task forwards at most one
    row per key, also for a key that holds much of the data.
    """
    w = Window.partitionBy(key).orderBy(F.col(ts).desc_nulls_last(), F.col(tiebreak).desc_nulls_last())
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def fill_nulls(df: DataFrame, values: dict = FILL_VALUES) -> DataFrame:
    return df.na.fill({k: v for k, v in values.items() if k in df.columns})


def drop_unlabelled(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.filter(F.col(label).isNotNull())


def out_of_range(profile: str = "etl") -> Column:
    bad = F.lit(False)
    for name, lo, hi in RANGE_RULES[profile]:
        bad = bad | (F.col(name) < lo) | (F.col(name) > hi)
    return bad


def flag_ranges(df: DataFrame, profile: str = "etl") -> DataFrame:
    """Mark rows outside the closed ranges; no row is dropped."""
    flag = F.when(out_of_range(profile), FLAG_INVALID).otherwise(FLAG_OK)
    return df.withColumn("data_quality_flag", flag)


def derive_features(df: DataFrame) -> DataFrame:
    per_product = F.try_divide("monthly_charges", F.col("num_products").cast("double"))
    call_rate = F.col("support_calls") / F.greatest("tenure_months", F.lit(1))
    return df.withColumns(
        {
            "avg_revenue_per_product": F.round(per_product, 2),
            "support_call_rate": F.round(call_rate, 4),
            "is_new_customer": F.when(F.col("tenure_months") < 6, 1).otherwise(0),
        }
    )


def add_lineage(df: DataFrame, processed_at: dt.datetime, job_name: str) -> DataFrame:
    return df.withColumns({"etl_processed_at": F.lit(processed_at), "etl_job_name": F.lit(job_name)})


def transform_customers(
    raw: DataFrame,
    processed_at: dt.datetime,
    job_name: str,
    tiebreak: str,
    key: str = "customer_id",
    ts: str = "event_date",
) -> DataFrame:
    """The whole cleaning as one lazy plan: one shuffle, then narrow steps."""
    return (
        raw.transform(latest_per_key, key, ts, tiebreak)
        .transform(fill_nulls)
        .transform(drop_unlabelled)
        .transform(flag_ranges)
        .transform(derive_features)
        .transform(add_lineage, processed_at, job_name)
    )


def transform_observed(
    raw: DataFrame, processed_at: dt.datetime, job_name: str, tiebreak: str, key: str = "customer_id", ts: str = "event_date"
) -> tuple[DataFrame, dict[str, Observation]]:
    """`transform_customers` that counts rows on the way: (processed rows, observation of each stage).

    The counts come with whatever action runs the plan first, the write for one; no further scan is made.
    """
    seen = {stage: Observation(stage) for stage in ("raw_rows", "deduplicated_rows", "labelled_rows")}

    def counted(df: DataFrame, stage: str) -> DataFrame:
        return df.observe(seen[stage], F.count(F.lit(1)).alias(stage))

    latest = counted(raw, "raw_rows").transform(latest_per_key, key, ts, tiebreak).transform(counted, "deduplicated_rows")
    labelled = latest.transform(fill_nulls).transform(drop_unlabelled).transform(counted, "labelled_rows")
    return labelled.transform(flag_ranges).transform(derive_features).transform(add_lineage, processed_at, job_name), seen


def stage_counts(raw: DataFrame, key: str = "customer_id", label: str = LABEL) -> DataFrame:
    """Raw, deduplicated and labelled counts in one pass.

    Per key only the label of its newest row matters, so one aggregate by key with
    map-side combine is enough.
    """
    per_key = raw.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.max_by(label, F.struct("event_date", "record_id")).alias("_label"),
    )
    return per_key.agg(
        F.sum("_n").alias("raw_rows"),
        F.count(F.lit(1)).alias("deduplicated_rows"),
        F.count("_label").alias("labelled_rows"),
    )


def job_summary(processed: DataFrame, split_col: str = "split", label: str = LABEL) -> DataFrame:
    """Totals, rates and split sizes with one conditional aggregate."""
    return processed.agg(
        F.count(F.lit(1)).alias("total_processed"),
        share(F.col(label) == 1).alias("churn_pct"),
        share(F.col("data_quality_flag") == FLAG_INVALID).alias("invalid_pct"),
        F.count_if(F.col("data_quality_flag") == FLAG_INVALID).alias("invalid_rows"),
        F.count_if(F.col(split_col) == "train").alias("train_rows"),
        F.count_if(F.col(split_col) == "test").alias("test_rows"),
    )


def feature_contract(df: DataFrame, expected) -> DataFrame:
    """One row per expected feature: its place, and whether the input has it."""
    rows = [(f, i, f in df.columns) for i, f in enumerate(expected)]
    return local_table(df.sparkSession, rows, "feature string, position int, present boolean")


def prepare_features(df: DataFrame, expected, label: str = LABEL):
    """(features and label, available names in order, missing names)."""
    available = [f for f in expected if f in df.columns]
    missing = [f for f in expected if f not in df.columns]
    return df.select(*available, label), available, missing
