"""Sources and sinks: written to the shared folder, read back, compared with the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.operators import segment, split
from stayline.plans.base import CLEAN, CUST, clean_customers, clean_table, customers, md5_mod, query, table
from stayline.plans.segmentation import CARDS, cards
from stayline.schema import CUSTOMER_SCHEMA, FEATURES_8
from stayline.session import new_path
from stayline.sources import readers, writers


def csv_folder(spark, sf) -> str:
    """Customers as delimited text; negative scores arrive as a word."""
    df = customers(spark, sf)
    score = F.when(F.col("satisfaction_score") < 0, "negativo").otherwise(F.col("satisfaction_score").cast("string"))
    text = df.withColumn("satisfaction_score", score).select(
        *[F.col(f.name).cast("string").alias(f.name) for f in CUSTOMER_SCHEMA.fields]
    )
    path = new_path(spark, "csv")
    text.write.option("header", True).csv(path)
    return path


_OUT = ", ".join((*FEATURES_8, "churn"))


@query(f"WITH {CUST} SELECT CAST(customer_id AS VARCHAR) AS customer_id, {_OUT} FROM cust WHERE satisfaction_score >= 0")
def csv_scan(spark, sf) -> DataFrame:
    good, _ = readers.read_customers_csv(spark, csv_folder(spark, sf))
    return good.select("customer_id", *FEATURES_8, "churn")


@query(
    f"""WITH {CUST} SELECT CAST(customer_id AS VARCHAR) AS customer_id, 'satisfaction_score' AS errors
    FROM cust WHERE satisfaction_score < 0"""
)
def csv_quarantine(spark, sf) -> DataFrame:
    _, bad = readers.read_customers_csv(spark, csv_folder(spark, sf))
    return bad.select("customer_id", F.array_join("errors", ",").alias("errors"))


@query(
    f"""WITH {CUST}, c AS (SELECT *, customer_id % 3 AS part FROM cust WHERE satisfaction_score >= 0)
    SELECT CAST(customer_id AS VARCHAR) AS customer_id, churn, tenure_months,
      CASE WHEN part < 2 THEN support_calls END AS support_calls, CASE WHEN part < 2 THEN satisfaction_score END AS satisfaction_score
    FROM c"""
)
def csv_by_name(spark, sf) -> DataFrame:
    """One folder of files that have their columns in different orders, some with columns missing, some with more."""
    rows = customers(spark, sf).filter("satisfaction_score >= 0").withColumn("_part", F.col("customer_id") % 3)
    names = [f.name for f in CUSTOMER_SCHEMA.fields]
    orders = (names[::-1], [*names[2:], "note", *names[:2]], ["churn", "tenure_months", "customer_id"])
    path = new_path(spark, "csv")
    for k, order in enumerate(orders):
        part = rows.filter(F.col("_part") == k).withColumn("note", F.lit("a, b"))
        part.select(*[F.col(c).cast("string") for c in order]).write.option("header", True).csv(f"{path}/{k}")
    good, _ = readers.read_customers_csv(spark, path)
    return good.select("customer_id", "churn", "tenure_months", "support_calls", "satisfaction_score")


@query(
    f"""WITH {CUST} SELECT CAST(customer_id AS VARCHAR) AS customer_id, CASE WHEN satisfaction_score < 0 THEN 1 ELSE 0 END AS quarantined FROM cust
    WHERE satisfaction_score IS NOT NULL"""
)
def csv_folder_load(spark, sf) -> DataFrame:
    """The folder loader on a CSV folder: typed rows and quarantined ones, none lost."""
    good, bad = readers.load_folder_checked(spark, csv_folder(spark, sf))
    kept = good.select("customer_id", F.lit(0).alias("quarantined"))
    return kept.unionByName(bad.select("customer_id", F.lit(1).alias("quarantined")))


@query(
    f"""WITH {CLEAN}, s AS (SELECT *, CASE WHEN {md5_mod(42, 'customer_id', 100)} < 80 THEN 'train' ELSE 'test' END AS split FROM clean)
    SELECT split, data_quality_flag, count(*) AS n, CAST(sum(churn) AS BIGINT) AS churned FROM s GROUP BY ALL"""
)
def split_sink(spark, sf) -> DataFrame:
    """Train and test folders written in one pass and loaded again."""
    path = new_path(spark, "splits")
    writers.write_splits(split.bucket_split(clean_customers(spark, sf)), path)
    return spark.read.parquet(path).groupBy("split", "data_quality_flag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("churn").alias("churned")
    )


@query(
    f"""WITH {CLEAN} SELECT customer_id, churn, segmento FROM clean WHERE {md5_mod(42, 'customer_id', 100)} >= 80"""
)
def label_sink(spark, sf) -> DataFrame:
    """The test part written to its own folder and read by the folder loader."""
    parts = split.bucket_split(clean_customers(spark, sf)).filter("split = 'test'").drop("split")
    path = writers.write_label(parts, new_path(spark, "processed"), "test")
    return readers.load_folder(spark, path).select("customer_id", "churn", "segmento")


@query(
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS n,
    sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS spend FROM orders GROUP BY ALL"""
)
def month_sink(spark, sf) -> DataFrame:
    """Orders in year and month folders, read back by folder."""
    path = new_path(spark, "months")
    writers.write_by_month(table(spark, sf, "orders"), path, "o_orderdate")
    return spark.read.parquet(path).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("spend"),
    )


@query(
    f"""WITH {CLEAN} SELECT 'v1' AS feature_version, count(*) AS n FROM clean
    UNION ALL SELECT 'v2', count(*) FROM clean WHERE data_quality_flag = 'OK'"""
)
def feature_store(spark, sf) -> DataFrame:
    """Two feature versions appended to the offline store."""
    df, path = clean_table(spark, sf), new_path(spark, "features")
    writers.append_features(df, path, "v1")
    writers.append_features(df.filter("data_quality_flag = 'OK'"), path, "v2")
    return spark.read.parquet(path).groupBy("feature_version").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {CARDS} SELECT segmento, CAST(cluster_id AS INTEGER) AS cluster_id, text AS value FROM texts")
def card_documents(spark, sf) -> DataFrame:
    """One text document per segment and cluster."""
    path = new_path(spark, "card-documents")
    writers.write_card_documents(segment.card_text(cards(spark, sf)), path)
    return spark.read.text(path).select("segmento", "cluster_id", "value")
