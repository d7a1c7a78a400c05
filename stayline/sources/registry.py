"""Model and feature registries as append-only tables."""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.session import local_table

# Fixed value: status of a model version that waits for a person.
PENDING = "PendingManualApproval"

METADATA_DDL = (
    "model_type string, scaler string, features array<string>, n_features int, "
    "trained_at timestamp, environment string, hyperparameters map<string,string>, "
    "metrics map<string,double>"
)


def model_metadata(
    spark: SparkSession,
    model_type: str,
    features,
    trained_at: dt.datetime,
    metrics: dict[str, float],
    hyperparameters: dict[str, Any] | None = None,
    scaler: str = "StandardScaler",
    environment: str = "spark",
) -> DataFrame:
    """One row that describes a trained model."""
    row = (
        model_type,
        scaler,
        list(features),
        len(features),
        trained_at,
        environment,
        {k: str(v) for k, v in (hyperparameters or {}).items()},
        {k: float(v) for k, v in metrics.items()},
    )
    return spark.createDataFrame([row], METADATA_DDL)


def registry_rows(evaluations: DataFrame, threshold: float, group: str) -> DataFrame:
    """Rows to register: evaluations whose AUC reaches the (inclusive) limit."""
    return evaluations.filter(F.col("roc_auc") >= threshold).select(
        F.lit(group).alias("model_group"),
        "model_version",
        "roc_auc",
        F.lit(PENDING).alias("approval_status"),
    )


def register(evaluations: DataFrame, path: str, threshold: float, group: str = "churn") -> None:
    registry_rows(evaluations, threshold, group).write.mode("append").parquet(path)


def feature_registry(stats: DataFrame, df: DataFrame, features, version: str) -> DataFrame:
    """Schema rows joined with reference statistics, one row per feature."""
    types = dict(df.dtypes)
    rows = [(f, i, types[f], version) for i, f in enumerate(features) if f in types]
    schema_rows = local_table(
        df.sparkSession, rows, "feature string, position int, type string, feature_version string"
    )
    return schema_rows.join(stats, "feature", "left")
