"""Turning model probabilities into decisions, bands and responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.schema import DECISION_THRESHOLD, RISK_BANDS
from stayline.operators.joins import lookup_join
from stayline.session import broadcast_if_small

CARD_LIMIT = 100_000


def risk_band(p: Column) -> Column:
    """On the unrounded probability."""
    band, last = None, None
    for limit, name in RISK_BANDS:
        if limit is None:
            last = name
        else:
            band = F.when(p < limit, name) if band is None else band.when(p < limit, name)
    return band.otherwise(last)


def decide(p: Column) -> Column:
    return F.when(p >= DECISION_THRESHOLD, 1).otherwise(0)


def lookup_cards(df: DataFrame, cards: DataFrame) -> DataFrame:
    """Left join to the card of (segment, cluster); NULL label if there is none."""
    small = broadcast_if_small(cards.select("segmento", "cluster_id", "perfil_label"), CARD_LIMIT)
    return df.join(small, ["segmento", "cluster_id"], "left")


def lookup_features(requests: DataFrame, latest: DataFrame, key: str) -> DataFrame:
    """Newest stored features per request; requests without features keep NULLs."""
    return lookup_join(requests, latest, key)


def respond(
    df: DataFrame, probability: str = "probability", model_version: str | None = None, keys=("customer_id",)
) -> DataFrame:
    """Response columns, the probability with four decimals."""
    p = F.col(probability)
    return df.select(
        *keys,
        decide(p).alias("churn_prediction"),
        F.bround(p, 4).alias("churn_probability"),
        risk_band(p).alias("risk_level"),
        F.coalesce(F.lit(model_version).cast("string"), F.lit("unknown")).alias("model_version"),
        "cluster_id",
        "perfil_label",
        "segmento",
    )


def parse_instances(df: DataFrame, features, body: str = "body") -> DataFrame:
    """Rows from JSON bodies {"instances": [[...], ...]}, one row per instance."""
    parsed = F.from_json(F.col(body), "struct<instances:array<array<double>>>")
    rows = df.select(F.posexplode(parsed["instances"]).alias("instance", "_x"), *df.columns)
    return rows.select(
        *df.columns, "instance", *[F.try_element_at("_x", F.lit(i + 1)).alias(f) for i, f in enumerate(features)]
    )


def encode_predictions(df: DataFrame) -> DataFrame:
    """JSON text of each response row."""
    return df.withColumn(
        "response", F.to_json(F.struct("churn_prediction", "churn_probability"))
    )
