"""Reproducible splits and folds from md5 of the key; equal under any partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.hashing import md5_key, md5_uniform
from stayline.schema import KEY, LABEL

HEX_DIGITS = 4  # 65,536 even md5 buckets


def _class_buckets(tagged: DataFrame, label: str) -> DataFrame:
    """Per class and md5 bucket: rows, running rows, rows of the class.

    At most (number of classes) x 65,536 rows, whatever the input size.
    """
    upto = Window.partitionBy(label).orderBy("_b")
    counts = tagged.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    return counts.withColumns(
        {
            "_before": F.sum("_n").over(upto) - F.col("_n"),
            "_class_n": F.sum("_n").over(Window.partitionBy(label)),
        }
    )


def _tag(df: DataFrame, key: str, label: str, seed: int, classes) -> DataFrame:
    h = md5_key(seed, key)
    return df.filter(F.col(label).isin(*classes)).withColumns(
        {"_h": h, "_b": F.substring(h, 1, HEX_DIGITS)}
    )


def exact_split(
    df: DataFrame,
    test_ratio: float = 0.2,
    key: str = KEY,
    label: str = LABEL,
    seed: int = 42,
    classes=(0, 1),
) -> DataFrame:
    """Adds `split`: the first round(ratio * n) keys of each class in md5 order are test.

    Only the bucket that holds the cut is sorted; every other row is decided by
    comparing its hash with the cut of its class (one row per class, broadcast).
    `key` must be unique. Rows whose class is not listed are left out.
    """
    tagged = _tag(df, key, label, seed, classes)
    target = F.round(F.lit(test_ratio) * F.col("_class_n")).cast("bigint")
    cut_bucket = (
        _class_buckets(tagged, label)
        .withColumn("_need", target - F.col("_before"))
        .filter("_need > 0 and _need <= _n")
        .select(label, "_b", "_need")
    )
    in_bucket = Window.partitionBy(label).orderBy("_h")
    cuts = (
        tagged.select(label, "_h", "_b")
        .join(F.broadcast(cut_bucket), [label, "_b"])
        .withColumn("_rn", F.row_number().over(in_bucket))
        .filter("_rn = _need")
        .select(label, F.col("_h").alias("_cut"))
    )
    is_test = F.coalesce(F.col("_h") <= F.col("_cut"), F.lit(False))
    return (
        tagged.join(F.broadcast(cuts), label, "left")
        .withColumn("split", F.when(is_test, "test").otherwise("train"))
        .select(*df.columns, "split")
    )


def bucket_split(df: DataFrame, train_ratio: float = 0.8, key: str = KEY, seed: int = 42) -> DataFrame:
    """Approximate split per row and without a shuffle: md5 bucket of 100."""
    in_train = md5_uniform(seed, key, 100) < round(train_ratio * 100)
    return df.withColumn("split", F.when(in_train, "train").otherwise("test"))


def assign_folds(
    df: DataFrame,
    folds: int = 5,
    key: str = KEY,
    label: str = LABEL,
    seed: int = 42,
    classes=(0, 1),
) -> DataFrame:
    """Adds `fold`: round-robin over md5 order inside each class.

    The rank is bucket offset + position in the bucket, so the sort runs in even md5
    buckets instead of one task per class.
    """
    tagged = _tag(df, key, label, seed, classes)
    offsets = _class_buckets(tagged, label).select(label, "_b", "_before")
    in_bucket = Window.partitionBy(label, "_b").orderBy("_h")
    return (
        tagged.join(F.broadcast(offsets), [label, "_b"])
        .withColumn("_rank", F.col("_before") + F.row_number().over(in_bucket) - 1)
        .withColumn("fold", F.pmod("_rank", F.lit(folds)).cast("int"))
        .select(*df.columns, "fold")
    )


def leaked_keys(train: DataFrame, test: DataFrame, key: str = KEY) -> DataFrame:
    """Keys on both sides; must be empty."""
    return train.select(key).intersect(test.select(key))


def capture_sample(df: DataFrame, percent: int = 20, key: str = KEY, seed: int = 42) -> DataFrame:
    """A stable percentage of rows for the prediction log."""
    return df.filter(md5_uniform(seed, key, 100) < percent)


def assign_variant(df: DataFrame, shares: dict[str, int], key: str = KEY, seed: int = 7) -> DataFrame:
    """Traffic split in percent, e.g. {"champion": 90, "challenger": 10}."""
    bucket, upto, variant = md5_uniform(seed, key, 100), 0, None
    for name, pct in shares.items():
        upto += pct
        cond = bucket < upto
        variant = F.when(cond, name) if variant is None else variant.when(cond, name)
    return df.withColumn("variant", variant)
