"""Successive halving: many candidates with few trees, the better half with more, until one is left."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.operators import foreign, model
from stayline.operators.metrics import ranking_metrics
from stayline.schema import FEATURES_8, LABEL
from stayline.session import materialize, scratch_dir

RESULT = ("rung", "candidate", "depth", "rate", "trees", "positives", "negatives", "roc_auc", "place", "kept")


def _rung(train: DataFrame, valid: DataFrame, features, label: str, key: str, candidates: dict, cuts: list[int]) -> DataFrame:
    """Scores of the validation rows after each cut, for each candidate: one fit serves all its tree counts."""

    def fit(task) -> DataFrame:
        i, params = task
        fitted = model.train(train, features, replace(params, trees=max(cuts)), label)
        # Boosting may end before its last tree, when nothing is left to gain.
        have = fitted.stages[-1].getNumTrees
        scored = foreign.score(valid, *foreign.export(train.sparkSession, fitted, features), [min(c, have) for c in cuts])
        stages = F.posexplode("staged").alias("_cut", "probability")
        return scored.select(key, label, stages).select(
            F.lit(i).alias("candidate"), F.get(F.lit(cuts), F.col("_cut")).alias("trees"), key, label, "probability"
        )

    with ThreadPool(len(candidates)) as pool:
        parts = pool.map(inheritable_thread_target(train.sparkSession)(fit), candidates.items(), chunksize=1)
    return materialize(reduce(DataFrame.unionByName, parts), "rung-scores")


def search(
    df: DataFrame,
    grid: list[dict],
    rungs: list[list[int]],
    features=FEATURES_8,
    base: model.GbtParams | None = None,
    held_out: str = "fold = 0",
    key: str = "customer_id",
    label: str = LABEL,
) -> tuple[DataFrame, list[DataFrame]]:
    """One row per rung, candidate and tree count with the AUC on the held-out rows; and the scores of every rung.

    Every rung fits its candidates at its largest tree count and reads the smaller ones off the same fit. A
    candidate's place goes by its best AUC (ties: earlier in the grid); the better half, rounded up, goes on.
    Only the AUC of each (candidate, tree count) reaches the driver.
    """
    spark = df.sparkSession
    scratch_dir(spark)
    base = base or model.GbtParams()
    rows = df.select(key, label, *features, F.expr(held_out).alias("_held"))
    rows = rows.coalesce(max(1, -(-rows.count() // model.FIT_ROWS))).checkpoint()
    train, valid = rows.filter("not _held").drop("_held"), rows.filter("_held").drop("_held")
    alive = {i: replace(base, **changes) for i, changes in enumerate(grid)}
    tables, written = [], []
    for number, cuts in enumerate(rungs, 1):
        scores = _rung(train, valid, features, label, key, alive, cuts)
        written.append(scores)
        by = ("candidate", "trees")
        names = ("positives", "negatives", "roc_auc")
        auc = ranking_metrics(scores, label, "probability", by).select(*by, *names)
        best = auc.withColumn("_best", F.max("roc_auc").over(Window.partitionBy("candidate")))
        place = F.dense_rank().over(Window.orderBy(F.col("_best").desc_nulls_last(), "candidate"))  # as many rows as candidates
        keep = -(-len(alive) // 2)
        settings = F.create_map(*[x for i, p in alive.items() for x in (F.lit(i), F.struct(F.lit(p.depth).alias("depth"), F.lit(p.learning_rate).alias("rate")))])
        table = materialize(
            best.withColumns({"place": place, "_set": settings[F.col("candidate")], "rung": F.lit(number)})
            .withColumn("kept", F.col("place") <= keep)
            .select("rung", "candidate", "_set.depth", "_set.rate", "trees", *names, "place", "kept"),
            "rung",
        )
        tables.append(table.select(*RESULT))
        stay = {r["candidate"] for r in table.filter("kept").select("candidate").distinct().collect()}
        alive = {i: p for i, p in alive.items() if i in stay}
    return reduce(DataFrame.unionByName, tables), written
