"""Sinks: split folders, partitioned tables, JSON reports, card documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_label(df: DataFrame, output: str, label: str) -> str:
    path = f"{output.rstrip('/')}/{label}"
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def write_splits(df: DataFrame, output: str, split_col: str = "split") -> None:
    """Train and test folders in one pass over the input: <output>/split=..."""
    df.write.mode("overwrite").option("compression", "snappy").partitionBy(split_col).parquet(output)


def write_by_month(df: DataFrame, output: str, ts: str = "event_date") -> None:
    """Year/month partitions; only the partitions present in `df` are replaced."""
    (
        df.withColumn("year", F.year(ts))
        .withColumn("month", F.month(ts))
        # rows of a month together where they are few; Spark cuts a busy month by its size
        .hint("rebalance", "year", "month")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month")
        .parquet(output)
    )


def append_features(df: DataFrame, output: str, version: str) -> None:
    """Offline feature store: append-only, one folder per feature version."""
    df.withColumn("feature_version", F.lit(version)).write.mode("append").partitionBy(
        "feature_version"
    ).parquet(output)


def write_report(df: DataFrame, path: str) -> None:
    """A one-row report of nested structs as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)


def nest_cards(cards: DataFrame) -> DataFrame:
    """One row with the JSON form: segment -> cluster key -> card.

    The input has one row per segment and cluster, a model-sized table.
    """
    names = [c for c in cards.columns if c != "cluster_key"]
    key = F.concat(F.lit("cluster_"), F.col("cluster_id").cast("string"))
    per_segment = cards.groupBy("segmento").agg(
        F.map_from_entries(
            F.collect_list(F.struct(key.alias("k"), F.struct(*names).alias("v")))
        ).alias("clusters")
    )
    return per_segment.agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("segmento", "clusters")))).alias("value")
    )


def write_cards(cards: DataFrame, path: str) -> None:
    nest_cards(cards).coalesce(1).write.mode("overwrite").text(path)


def write_card_documents(cards: DataFrame, path: str, text_col: str = "text") -> None:
    """One text folder per segment and cluster."""
    cards.select("segmento", "cluster_id", F.col(text_col).alias("value")).write.mode(
        "overwrite"
    ).partitionBy("segmento", "cluster_id").text(path)
