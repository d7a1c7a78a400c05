"""Exact inner-product search over dense vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.vectors import safe_norm, unit

QUERY_BLOCK = 4096  # queries of a block, about
SHARD_ROWS = 16_384  # documents of a shard, about
STEP = 256  # queries multiplied at a time


def unit_vectors(df: DataFrame, vector: str) -> DataFrame:
    """Vectors of length 1 (a zero vector stays zero) and their norms."""
    v = F.col(vector).cast("array<double>")
    return df.withColumns({"norm": safe_norm(v), "unit": unit(v)})


def _tile(key: str, qkey: str, vector: str, k: int, decimals: int):
    """Best k documents of a shard for each query of a block, by one matrix product per step."""

    def run(docs: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({qkey: [], key: [], "score": []}).astype({qkey: "int64", key: "int64"})
        if not len(docs) or not len(queries):
            return empty
        docs = docs.sort_values(key, ascending=False)  # ties favour the larger key
        ids, mat = docs[key].to_numpy(), np.stack(docs[vector].to_numpy()).astype("float64")
        parts = []
        for at in range(0, len(queries), STEP):
            some = queries.iloc[at : at + STEP]
            scores = np.round(np.stack(some[vector].to_numpy()).astype("float64") @ mat.T, decimals)
            take = min(k, len(ids))
            kth = -np.partition(-scores, take - 1, axis=1)[:, take - 1]
            row, col = np.nonzero(scores >= kth[:, None])  # the k best and their ties
            order = np.lexsort((col, -scores[row, col], row))
            row, col = row[order], col[order]
            best = np.arange(len(row)) - np.searchsorted(row, row) < take
            row, col = row[best], col[best]
            parts.append(pd.DataFrame({qkey: some[qkey].to_numpy()[row], key: ids[col], "score": scores[row, col]}))
        return pd.concat(parts)

    return run


def search_dense(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 3,
    key: str = "doc_id",
    vector: str = "unit",
    qkey: str = "query_id",
    decimals: int = 6,
    block: int = QUERY_BLOCK,
    shard: int = SHARD_ROWS,
) -> DataFrame:
    """Top k documents per query; ties favour the larger key.

    Documents are dealt by hash to shards and queries to blocks of bounded size; every pair of a shard and
    a block is one task, which forwards k rows per query. Neither side passes through the driver.
    """

    def dealt(df: DataFrame, name: str, rows: int, id_: str) -> tuple[DataFrame, int]:
        parts = -(-df.count() // rows) or 1
        kept = df.select(F.col(id_).cast("bigint").alias(id_), vector)
        return kept.withColumn(name, F.pmod(F.xxhash64(id_), F.lit(parts)).cast("int")), parts

    doc_rows, shards = dealt(docs, "_shard", shard, key)
    query_rows, blocks = dealt(queries, "_block", block, qkey)
    doc_rows = doc_rows.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    query_rows = query_rows.withColumn("_shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    tiles = doc_rows.groupBy("_shard", "_block").cogroup(query_rows.groupBy("_shard", "_block"))
    found = tiles.applyInPandas(_tile(key, qkey, vector, k, decimals), f"{qkey} bigint, {key} bigint, score double")
    w = Window.partitionBy(qkey).orderBy(F.col("score").desc(), F.col(key).desc())
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def group_centroids(df: DataFrame, group: str, vector: str, dims: int) -> DataFrame:
    """Mean vector per group as an array; one average per dimension, combined map-side."""
    v = F.col(vector)
    means = [F.avg(v[i].cast("double")) for i in range(dims)]
    return df.groupBy(group).agg(F.array(*means).alias("centroid"))
