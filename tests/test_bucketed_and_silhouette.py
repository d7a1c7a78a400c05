import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stayline.operators import silhouette
from stayline.operators.silhouette import silhouette_pairwise
from stayline.sources import bucketed


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan, plan.count("Exchange hashpartitioning")


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    left = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("a"))
    right = spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 3).alias("b"))
    x = bucketed.write_bucketed(left, str(tmp_path / "x"), "k", 8)
    y = bucketed.write_bucketed(right, str(tmp_path / "y"), "k", 8)
    joined = x.join(y.hint("merge"), "k", "left")
    assert exchanges(joined)[1] == 0
    assert joined.count() == 500 and joined.filter("b = 3 * k").count() == 300


def test_lookup_shuffles_the_requests_only_and_splits_hot_keys(spark, tmp_path):
    features = spark.range(200).select(F.col("id").alias("k"), (F.col("id") * 10).alias("f"))
    stored = bucketed.write_bucketed(features, str(tmp_path / "f"), "k", 8)
    n = 30_000
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, None).otherwise(F.col("id") % 300)
    requests = spark.range(n).select(F.col("id").alias("r"), key.cast("long").alias("k"))
    got = bucketed.bucketed_lookup(requests, stored, "k", 8)
    plan, _ = exchanges(got)
    lines = plan[plan.index("SortMergeJoin"):].splitlines()
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    above = lines[scan - 3 : scan]  # from the table up to the join's sort
    assert any("Sort " in line for line in above) and not any("Exchange" in line for line in above)
    want = requests.join(features, "k", "left")
    same = got.select("r", "k", "f").exceptAll(want.select("r", "k", "f"))
    assert got.count() == n and same.count() == 0


def brute(points, labels):
    gap = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    out = []
    for i, own in enumerate(labels):
        mine = labels == own
        others = [gap[i][labels == c].mean() for c in set(labels) if c != own]
        if mine.sum() == 1 or not others:
            out.append(0.0)
            continue
        a, b = gap[i][mine].sum() / (mine.sum() - 1), min(others)
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return out


@pytest.mark.parametrize("block", [17, 4096])
def test_silhouette_over_pairs_equals_brute_force(spark, block):
    rnd = np.random.default_rng(5)
    points = rnd.standard_normal((90, 3))
    labels = rnd.integers(0, 3, 90)
    labels[0] = 9  # alone in its cluster
    points[1:4] = points[1]
    rows = [(i, int(c), *map(float, p)) for i, (p, c) in enumerate(zip(points, labels))] + [(500, None, 0.0, 0.0, 0.0), (501, 1, None, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "id long, cluster_id int, x double, y double, z double")
    got = {r["id"]: r["silhouette"] for r in silhouette_pairwise(df, ["x", "y", "z"], "id", block=block).collect()}
    want = brute(points, labels)
    assert len(got) == 90 and all(abs(got[i] - want[i]) < 1e-9 for i in got)


def test_silhouette_of_one_cluster_and_of_nothing(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (2, 0, 2.0)], "id long, cluster_id int, x double")
    assert [r["silhouette"] for r in silhouette_pairwise(df, ["x"], "id").collect()] == [0.0, 0.0]
    assert silhouette_pairwise(df.limit(0), ["x"], "id").count() == 0


def test_silhouette_sends_each_row_once_per_block(spark):
    """A pair of blocks is taken once, for both directions, and its distances hold where the product cancels."""
    rnd = np.random.default_rng(8)
    points = 1e4 + np.repeat(rnd.standard_normal((40, 2)), 3, axis=0)
    points[::3] += 1e-6
    labels = rnd.integers(0, 2, 120)
    df = spark.createDataFrame([(i, int(c), *map(float, p)) for i, (p, c) in enumerate(zip(points, labels))], "id long, cluster_id int, x double, y double")
    out = silhouette_pairwise(df, ["x", "y"], "id", block=40)
    want = brute(points, labels)
    assert all(abs(r["silhouette"] - want[r["id"]]) < 1e-9 for r in out.collect())
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(0, 2)" not in plan and "sequence(_i" in plan


@pytest.mark.parametrize("same", [True, False])
def test_silhouette_makes_each_distance_of_a_block_once(monkeypatch, same):
    """A block paired with itself makes half its ordered pairs, and sums hold over pieces, clusters and near copies."""
    rnd = np.random.default_rng(11)
    points, made, gaps = 50 + rnd.standard_normal((2000, 3)), [], silhouette._gaps
    points[1000:1100] = points[:100]
    points[1100:1200] = points[:100] + 1e-7
    labels = np.where(rnd.random(2000) < 0.9, rnd.integers(0, 2, 2000), rnd.integers(2, 60, 2000))
    rows = pd.DataFrame({"id": np.arange(2000), "cluster_id": labels, "x": points[:, 0], "y": points[:, 1], "z": points[:, 2], "_i": 0, "_j": 0})
    left, right = (rows, rows.sample(frac=1, random_state=1)) if same else (rows[:900], rows[900:].assign(_i=0, _j=1))
    monkeypatch.setattr(silhouette, "_gaps", lambda *args: made.append(gaps(*args)) or made[-1])
    got = silhouette._sums("id", ["x", "y", "z"], "cluster_id")(left, right).set_index(["id", "_other"])
    gap = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    if not same:
        gap[:900, :900] = gap[900:, 900:] = 0
    names = np.unique(labels)
    want = gap @ (labels[:, None] == names).astype(float)
    place = got.index.get_level_values(0), np.searchsorted(names, got.index.get_level_values(1))
    assert np.abs(got["_sum"].to_numpy() - want[place]).max() < 1e-8 and abs(got["_sum"].sum() - want.sum()) < 1e-5
    assert (got["cluster_id"].to_numpy() == labels[place[0]]).all() and not got.index.has_duplicates
    pairs = sum(g.size for g in made)
    assert pairs < 0.65 * 2000**2 if same else pairs == 900 * 1100


def test_silhouette_takes_smaller_blocks_of_many_clusters(spark):
    """A step holds a sum per row and cluster, so their product is bounded, not the rows alone."""
    for clusters, blocks in ((2, 16), (200, 39)):
        df = spark.range(200_000).select("id", (F.col("id") % clusters).alias("cluster_id"), F.col("id").cast("double").alias("x"))
        plan = silhouette_pairwise(df, ["x"], "id")._jdf.queryExecution().optimizedPlan().toString()
        assert re.search(rf"sequence\(_i#\d+, {blocks - 1}[,)]", plan)
