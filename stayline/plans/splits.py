"""Train/test splits, folds and leakage checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.operators import split
from stayline.plans.base import CLEAN, clean_customers, md5_mod, query
from stayline.session import materialize

EXACT = (
    CLEAN
    + """,
ranked AS (
  SELECT customer_id, churn, row_number() OVER (PARTITION BY churn ORDER BY md5(concat('42:', customer_id))) AS rn,
         count(*) OVER (PARTITION BY churn) AS n FROM clean),
exact AS (SELECT customer_id, churn, CASE WHEN rn <= round(0.2e0 * n) THEN 'test' ELSE 'train' END AS split FROM ranked)"""
)
_BUCKET = f"CASE WHEN {md5_mod(42, 'customer_id', 100)} < 80 THEN 'train' ELSE 'test' END"


def labels(spark, sf) -> DataFrame:
    """Keys and labels, written once since an exact split reads them three times."""
    return materialize(clean_customers(spark, sf).select("customer_id", "churn"), "labels")


@query(f"WITH {EXACT} SELECT * FROM exact")
def exact_stratified_split(spark, sf) -> DataFrame:
    return split.exact_split(labels(spark, sf)).select("customer_id", "churn", "split")


@query(f"WITH {CLEAN} SELECT customer_id, churn, {_BUCKET} AS split FROM clean")
def bucket_split(spark, sf) -> DataFrame:
    return split.bucket_split(clean_customers(spark, sf)).select("customer_id", "churn", "split")


@query(
    f"""WITH {CLEAN} SELECT split, churn, count(*) AS n FROM (
        SELECT churn, {_BUCKET} AS split FROM clean) GROUP BY ALL"""
)
def split_class_counts(spark, sf) -> DataFrame:
    return split.bucket_split(clean_customers(spark, sf)).groupBy("split", "churn").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    f"""WITH {CLEAN} SELECT customer_id, churn, CAST((row_number() OVER (PARTITION BY churn
        ORDER BY md5(concat('42:', customer_id))) - 1) % 5 AS INTEGER) AS fold FROM clean"""
)
def stratified_folds(spark, sf) -> DataFrame:
    return split.assign_folds(labels(spark, sf)).select("customer_id", "churn", "fold")


@query(
    f"""WITH {EXACT} SELECT
      (SELECT count(*) FROM (SELECT customer_id FROM exact WHERE split = 'train'
        INTERSECT SELECT customer_id FROM exact WHERE split = 'test')) AS leaked,
      (SELECT count(*) FROM exact) AS n_rows"""
)
def split_leakage(spark, sf) -> DataFrame:
    parts = materialize(split.exact_split(labels(spark, sf)).select("customer_id", "split"), "split")
    leaked = split.leaked_keys(parts.filter("split = 'train'"), parts.filter("split = 'test'"))
    return leaked.agg(F.count(F.lit(1)).alias("leaked")).withColumn(
        "n_rows", parts.agg(F.count(F.lit(1))).scalar()
    )


@query(
    f"""WITH {EXACT} SELECT customer_id, churn FROM exact WHERE split = 'train' AND churn = 1
    UNION ALL SELECT customer_id, churn FROM exact WHERE split = 'train' AND churn = 0"""
)
def union_class_splits(spark, sf) -> DataFrame:
    """Class parts put together again; the class is a predicate on one split, not a rescan."""
    parts = materialize(split.exact_split(labels(spark, sf)), "split")
    train = parts.filter("split = 'train'").select("customer_id", "churn")
    return train.filter("churn = 1").unionByName(train.filter("churn = 0"))


@query(
    f"""WITH {CLEAN} SELECT customer_id, ('0x' || substr(md5(concat('42:', customer_id)), 1, 8))::BIGINT AS position_key
    FROM clean"""
)
def seeded_shuffle(spark, sf) -> DataFrame:
    """Rows in a reproducible pseudo-random order."""
    from stayline.functions.hashing import md5_uniform

    return (
        clean_customers(spark, sf)
        .select("customer_id", md5_uniform(42, "customer_id", 2**32).alias("position_key"))
        .orderBy("position_key", "customer_id")
    )
