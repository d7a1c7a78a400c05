"""Batch inference with a model that has left the JVM: its trees as a table of plain numbers."""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.schema import FEATURES_8
from stayline.session import local_table

NODES = "tree int, node int, feature int, threshold double, left int, right int, value double"
SCALES = "feature int, name string, mean double, factor double"
BATCH = 4096


def _nodes(text: str) -> list[tuple]:
    """Nodes of one tree from its printed form, which lists a split, its left side, the split again, its right side."""
    lines = [line.strip() for line in text.strip().split("\n")[1:]]
    nodes: list = []

    def read(at: int) -> int:
        me = len(nodes)
        nodes.append(None)
        if lines[at].startswith("Predict:"):
            nodes[me] = (me, -1, 0.0, me, me, float(lines[at].removeprefix("Predict:")))
            return at + 1
        word, feature, sign, threshold = lines[at].removeprefix("If (").removesuffix(")").split(" ", 3)
        if (word, sign) != ("feature", "<="):
            raise ValueError(f"only numeric splits can be exported, not {lines[at]!r}")
        left = len(nodes)
        at = read(at + 1)
        right = len(nodes)
        at = read(at + 1)  # past the line that starts the other side
        nodes[me] = (me, int(feature), float(threshold), left, right, 0.0)
        return at

    read(0)
    return nodes


def export(spark, fitted: PipelineModel, features=FEATURES_8) -> tuple[DataFrame, DataFrame]:
    """Scales and nodes of a fitted churn pipeline. Both are as large as the model, whatever it was trained on.

    A tree's weight goes into the values of its leaves. A node that is its own child is a leaf.
    """
    scaler, trees = fitted.stages[-2], fitted.stages[-1]
    scales = [
        (i, name, float(m), 1.0 / s if s else 0.0)
        for i, (name, m, s) in enumerate(zip(features, scaler.mean.toArray(), scaler.std.toArray(), strict=True))
    ]
    rows = [
        (t, node, feature, threshold, left, right, value * weight)
        for t, (tree, weight) in enumerate(zip(trees.trees, trees.treeWeights, strict=True))
        for node, feature, threshold, left, right, value in _nodes(tree.toDebugString)
    ]
    return local_table(spark, scales, SCALES), local_table(spark, rows, NODES)


def _margins(x: np.ndarray, scales: dict, nodes: dict, cuts: list[int]) -> np.ndarray:
    """Sums of the leaf values of the first `cut` trees, for each cut. A missing value goes right."""
    x = (x - scales["mean"]) * scales["factor"]
    t = np.arange(nodes["feature"].shape[0])
    rows = np.arange(len(x))[:, None]
    at = np.zeros((len(x), len(t)), dtype=np.int64)
    while True:
        feature = nodes["feature"][t, at]
        if (feature < 0).all():
            break
        left = x[rows, np.maximum(feature, 0)] <= nodes["threshold"][t, at]
        at = np.where(left, nodes["left"][t, at], nodes["right"][t, at])
    return nodes["value"][t, at].cumsum(axis=1)[:, [c - 1 for c in cuts]]


def score(df: DataFrame, scales: DataFrame, nodes: DataFrame, cuts: list[int] | None = None) -> DataFrame:
    """Adds `staged`: the probability after the first `cut` trees, for each cut (default: after all).

    The exported model is broadcast once and opened once per Python worker; rows come in Arrow batches.
    Columns that are NULL count as missing.
    """
    spark = df.sparkSession
    s = scales.orderBy("feature").toPandas()
    n = nodes.toPandas()
    shape = (int(n["tree"].max()) + 1, int(n["node"].max()) + 1)
    arrays = {c: np.full(shape, -1 if c == "feature" else 0, dtype=n[c].to_numpy().dtype) for c in ("feature", "threshold", "left", "right", "value")}
    for c, a in arrays.items():
        a[n["tree"], n["node"]] = n[c]
    cuts = cuts or [shape[0]]
    sent = spark.sparkContext.broadcast(({c: s[c].to_numpy() for c in ("mean", "factor")}, arrays))

    def opened():
        scales, nodes = sent.value

        def predict(x: np.ndarray) -> np.ndarray:
            return 1.0 / (1.0 + np.exp(-2.0 * _margins(x.astype("float64"), scales, nodes, cuts)))

        return predict

    predict = predict_batch_udf(
        opened, return_type=T.ArrayType(T.DoubleType()), batch_size=BATCH, input_tensor_shapes=[[len(s)]]
    )
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in s["name"]])
    return df.withColumn("staged", predict(x))
