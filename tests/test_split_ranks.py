import hashlib
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from stayline.operators import joins, ranks, split


def labelled(spark, n=1000, parts=8):
    return spark.range(0, n, 1, parts).select(
        F.col("id").alias("customer_id"), F.when(F.col("id") % 5 == 0, 1).otherwise(0).alias("churn")
    )


def expected_order(n, seed=42):
    by = {0: [], 1: []}
    for i in range(n):
        by[1 if i % 5 == 0 else 0].append((hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))
    return {c: [i for _, i in sorted(v)] for c, v in by.items()}


def test_exact_split_equals_brute_force(spark):
    got = {r["customer_id"] for r in split.exact_split(labelled(spark)).filter("split = 'test'").collect()}
    order = expected_order(1000)
    assert got == set(order[1][:40]) | set(order[0][:160])


@pytest.mark.parametrize("fn", [split.exact_split, split.bucket_split, split.assign_folds])
def test_split_does_not_depend_on_partitioning(spark, fn):
    a = sorted(map(tuple, fn(labelled(spark).repartition(3)).collect()))
    b = sorted(map(tuple, fn(labelled(spark).repartition(8)).collect()))
    assert a == b


def test_folds_are_balanced_and_in_md5_order(spark):
    rows = split.assign_folds(labelled(spark)).collect()
    order = expected_order(1000)
    want = {i: p % 5 for c in order for p, i in enumerate(order[c])}
    assert {r["customer_id"]: r["fold"] for r in rows} == want


def test_tiny_classes(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "customer_id long, churn int")
    rows = {r["customer_id"]: r["split"] for r in split.exact_split(df, 0.2).collect()}
    assert set(rows) == {1, 2, 3} and set(rows.values()) == {"train"}


def test_no_leak_between_parts(spark):
    parts = split.exact_split(labelled(spark))
    assert split.leaked_keys(parts.filter("split='train'"), parts.filter("split='test'")).count() == 0


def test_capture_and_variants_cover_all_rows(spark):
    df = labelled(spark, 5000)
    assert 800 < split.capture_sample(df).count() < 1200
    counts = {r["variant"]: r["n"] for r in split.assign_variant(df, {"a": 90, "b": 10}).groupBy("variant").agg(F.count("*").alias("n")).collect()}
    assert sum(counts.values()) == 5000 and 350 < counts["b"] < 650


@pytest.mark.parametrize("descending", [False, True])
def test_prefix_sums_with_one_dominant_group(spark, descending):
    rnd = random.Random(1)
    rows = [("big", float(v), rnd.randint(0, 5), rnd.randint(0, 5)) for v in rnd.sample(range(10000), 600)]
    rows += [(f"g{i}", float(j), 1, 2) for i in range(20) for j in range(10)]
    df = spark.createDataFrame(rows, "g string, v double, a long, b long")
    got = ranks.prefix_sums(df, "v", ["a", "b"], ["g"], descending, parts=7).toPandas()
    want = pd.DataFrame(rows, columns=["g", "v", "a", "b"]).sort_values(["g", "v"], ascending=[True, not descending])
    for c in "ab":
        want[f"cum_{c}"] = want.groupby("g")[c].cumsum()
        want[f"tot_{c}"] = want.groupby("g")[c].transform("sum")
    key = ["g", "v"]
    got, want = got.sort_values(key).reset_index(drop=True), want.sort_values(key).reset_index(drop=True)
    assert (got[want.columns] == want).all().all()


def test_quantiles_and_medians(spark):
    values = [5.0, 1.0, 1.0, 7.0, 9.0, 9.0, 2.0, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    q = ranks.exact_quantiles(df, "v", [0.25, 0.5, 1.0]).first()
    assert (q["q0"], q["q1"], q["q2"]) == (1.0, 5.0, 9.0)
    assert ranks.exact_medians(df, "v").first()["median"] == 5.0
    even = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (9.0,)], "v double")
    assert ranks.exact_medians(even, "v").first()["median"] == 3.0


def test_lookup_join_with_hot_null_and_missing_keys(spark):
    rows = [(i, 7 if i % 3 == 0 else None if i % 11 == 0 else i % 97) for i in range(3000)]
    left = spark.createDataFrame(rows, "id long, k long")
    right = spark.createDataFrame([(k, k * 10) for k in range(0, 97, 2)] + [(7, 70)], "k long, x long")
    got = {r["id"]: (r["k"], r["x"]) for r in joins.lookup_join(left, right, "k").collect()}
    known = set(range(0, 97, 2)) | {7}
    assert got == {i: (k, k * 10 if k in known else None) for i, k in rows}
