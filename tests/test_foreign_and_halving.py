"""Exported trees against the fitted pipeline; halving against a ranking of its written scores by hand."""

import pytest
from pyspark.sql import functions as F

from stayline.operators import foreign, halving, model, split
from stayline.operators.metrics import ranking_metrics
from stayline.schema import FEATURES_8
from stayline.session import materialize
from stayline.sources import synthetic


@pytest.fixture(scope="module")
def rows(spark):
    return materialize(split.assign_folds(synthetic.noisy_classes(spark, 500)), "rows")


def test_exported_trees_score_as_the_pipeline(spark, rows):
    fitted = model.train(rows, params=model.GbtParams(trees=4, depth=3, learning_rate=0.3))
    scales, nodes = foreign.export(spark, fitted)
    assert nodes.select("tree").distinct().count() == 4 and scales.count() == len(FEATURES_8)
    odd = rows.limit(5).withColumns({"customer_id": F.col("customer_id") + 1_000_000, FEATURES_8[0]: F.lit(None).cast(rows.schema[FEATURES_8[0]].dataType)})
    test = rows.unionByName(odd).withColumn("threshold", F.lit("a column of the export"))
    got = {r["customer_id"]: r["staged"] for r in foreign.score(test, scales, nodes, [1, 4]).collect()}
    want = {r["customer_id"]: r["probability"] for r in model.score(test, fitted).collect()}
    assert len(got) == 505 and all(abs(got[k][1] - want[k]) <= 1e-12 for k in want)
    one = {r["customer_id"]: r["staged"] for r in foreign.score(rows, scales, nodes.filter("tree = 0")).collect()}
    assert all(abs(got[k][0] - one[k][0]) <= 1e-12 for k in one)
    assert foreign.score(rows.limit(0), scales, nodes).count() == 0


def test_a_split_that_is_not_numeric_is_refused():
    with pytest.raises(ValueError, match="numeric"):
        foreign._nodes("model\n  If (feature 0 in {1.0})\n   Predict: 0.0\n  Else (feature 0 not in {1.0})\n   Predict: 1.0")


def by_hand(pairs) -> float:
    ones, zeros = [p for y, p in pairs if y], [p for y, p in pairs if not y]
    return sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / (len(ones) * len(zeros))


def test_halving_keeps_the_better_half(spark, rows):
    grid = [{"depth": 1, "learning_rate": 0.1}, {"depth": 3, "learning_rate": 0.1}, {"depth": 3, "learning_rate": 0.5}]
    table, written = halving.search(rows, grid, [[1, 3], [4]])
    got = table.collect()
    assert {(r["rung"], r["trees"]) for r in got} == {(1, 1), (1, 3), (2, 4)} and len(got) == 8
    for rung, scores in enumerate(written, 1):
        pairs: dict = {}
        for r in scores.collect():
            pairs.setdefault((r["candidate"], r["trees"]), []).append((r["churn"], r["probability"]))
        auc = {k: by_hand(v) for k, v in pairs.items()}
        mine = [r for r in got if r["rung"] == rung]
        assert all(abs(r["roc_auc"] - auc[r["candidate"], r["trees"]]) < 1e-9 for r in mine)
        best = {c: max(a for (d, _), a in auc.items() if d == c) for c, _ in auc}
        order = sorted(best, key=lambda c: (-round(best[c], 12), c))
        assert {r["candidate"] for r in mine if r["kept"]} == set(order[: -(-len(order) // 2)])
    first = {r["candidate"] for r in got if r["rung"] == 1 and r["kept"]}
    assert {r["candidate"] for r in got if r["rung"] == 2} == first


def test_staged_scores_equal_a_smaller_fit(spark, rows):
    big = model.train(rows, params=model.GbtParams(trees=5, depth=2))
    small = model.train(rows, params=model.GbtParams(trees=2, depth=2))
    staged = foreign.score(rows, *foreign.export(spark, big), [2]).select("customer_id", F.col("staged")[0].alias("p"))
    both = staged.join(model.score(rows, small), "customer_id")
    assert both.filter(F.abs(F.col("p") - F.col("probability")) > 1e-9).count() == 0
    assert ranking_metrics(model.score(rows, small), "churn", "probability").first()["roc_auc"] > 0.5
