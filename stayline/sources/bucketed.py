"""Feature tables stored in buckets of their key, which joins on the key read without a shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET_ROWS = 2_000_000  # rows of a bucket, about


def bucket_count(spark: SparkSession, rows: int) -> int:
    """Buckets by size, and no fewer than shuffle partitions, since Spark would shuffle a table with fewer once more."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // BUCKET_ROWS))


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Write rows with unique keys as a table of `buckets` sorted buckets at `path`, one file each, and read it.

    The table is external and has a name of its own; `forget` takes the name out of the catalog, files stay.
    """
    spark = df.sparkSession
    name = f"stayline_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def forget(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")


def bucketed_lookup(requests: DataFrame, features: DataFrame, key: str, buckets: int) -> DataFrame:
    """Left join of requests to a bucketed table with unique keys; the table is not shuffled.

    Spark's skew join cannot cut a bucket, so keys with more than half a bucket's share of the requests (at most
    2 * `buckets` of them) are looked up by a broadcast of their few features instead. Requests with a NULL
    key match nothing and are not joined.
    """
    known = requests.filter(F.col(key).isNotNull())
    counts = known.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    rows = known.count()
    hot = F.broadcast(counts.filter(F.col("n") > max(rows / (2 * buckets), 1000)).select(key))
    rest = known.join(hot, key, "left_anti").join(features.hint("merge"), key, "left")
    few = F.broadcast(features.join(hot, key, "left_semi"))
    often = known.join(hot, key, "left_semi").join(few, key, "left")
    without = requests.filter(F.col(key).isNull())
    return rest.unionByName(often).unionByName(without, allowMissingColumns=True)
