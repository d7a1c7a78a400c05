"""Exact top-k search by inner product: MaxScore over shards of integer vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SHARD_ROWS = 16_384  # candidates of a shard, about
BLOCK_ROWS = 2_048  # queries of a block, about
STEP = 2_048  # candidates of a shard that are scored between two updates of the thresholds
FIRST = 256
PROBE = 8  # non-essential terms probed at a time
SLACK = 0.25  # non-essential terms may add up to this share of the threshold


def integer_vector(vector: str, scale: float = 64.0) -> Column:
    """floor(scale * x) of every component; NULL if the vector or a component is NULL or not finite."""
    v = F.col(vector).cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(good, F.transform(v, lambda x: F.floor(x * scale)))


def _matrix(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids in ascending order and their vectors, short ones filled with 0; a repeated id counts once,
    with the smallest of its vectors."""
    ids = table.column("id").combine_chunks().to_numpy(zero_copy_only=False)
    lists = table.column("v").combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    m = np.zeros((len(ids), width))
    m[np.arange(width)[None, :] < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    order = np.argsort(ids, kind="stable")
    if len(np.unique(ids)) < len(ids):
        order = np.lexsort((*m.T[::-1], ids))
        order = order[np.concatenate([[True], ids[order][1:] != ids[order][:-1]])]
    return ids[order], m[order]


def maxscore(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, docs: np.ndarray, k: int):
    """(query row, id, score) of the k best candidates per query; candidates in ascending id.

    A term is a dimension, its postings are the shard's values in it, its bound for a query is the
    most that any candidate can get from it. Terms are sorted by bound; the last ones, whose bounds
    together stay within SLACK of the query's threshold (its k-th best score so far), are
    non-essential. The essential postings are traversed for all candidates of a step, as one
    product for all queries. Only pairs that could still pass the threshold probe the other terms, a
    few at a time, and are dropped as soon as they cannot. A later candidate with the threshold's
    score has a larger id and loses, so pruning is by <=. Without k scores there is no threshold and
    all terms are essential.
    """
    n_q, width = q.shape
    high, low = docs.max(0), docs.min(0)
    bound = np.maximum(q * high, q * low)
    order = np.argsort(-bound, axis=1, kind="stable")
    place = np.argsort(order, axis=1)
    sorted_bound = np.take_along_axis(bound, order, 1)
    after = np.concatenate([np.cumsum(sorted_bound[:, ::-1], 1)[:, ::-1], np.zeros((n_q, 1))], 1)
    best = np.zeros((0, 3))
    threshold = np.full(n_q, -np.inf)
    at = 0
    while at < len(ids):
        stop = min(len(ids), at + (STEP if at else FIRST))
        part = docs[at:stop]
        limit = np.where(np.isfinite(threshold), np.maximum(0, threshold) * SLACK, -np.inf)
        fits = after <= limit[:, None]
        fits[:, width] = True  # with no term left out
        split = np.argmax(fits, axis=1)  # essential terms are the first ones in order
        partial = np.where(place < split[:, None], q, 0.0) @ part.T
        row, col = np.nonzero(partial + after[np.arange(n_q), split][:, None] > threshold[:, None])
        score = partial[row, col]
        done = split[row]
        while len(row) and (done < width).any():
            for _ in range(PROBE):
                more = np.flatnonzero(done < width)
                term = order[row[more], done[more]]
                score[more] += q[row[more], term] * part[col[more], term]
                done[more] += 1
            alive = score + after[row, done] > threshold[row]
            row, col, score, done = row[alive], col[alive], score[alive], done[alive]
        keep = (score > threshold[row]) & (ids[at:stop][col] != q_ids[row])
        new = np.stack([row[keep], at + col[keep], score[keep]], axis=1)
        best = np.concatenate([best, new])
        best = best[np.lexsort((best[:, 1], -best[:, 2], best[:, 0]))]
        first = np.searchsorted(best[:, 0], np.arange(n_q + 1))
        rank = np.arange(len(best)) - first[best[:, 0].astype(int)]
        best = best[rank < k]
        kth = np.searchsorted(best[:, 0], np.arange(n_q + 1))
        full = np.diff(kth) == k
        threshold[full] = best[kth[1:][full] - 1, 2]
        at = stop
    return best[:, 0].astype(int), ids[best[:, 1].astype(int)], best[:, 2]


def search(
    candidates: DataFrame,
    queries: DataFrame,
    k: int = 20,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The k candidates with the highest inner product for each query, ties to the smaller id.

    Both tables have `id` and `v`, an array of integers as `integer_vector` makes it; terms past a
    vector's end are 0. Rows with a NULL id or vector take no part; a repeated id counts once, with
    the smallest of its vectors; other columns are not read. A candidate with the query's id is left
    out. Without queries or candidates the result is empty.

    Candidates are dealt by hash to shards of even size, queries to blocks. Each pair of a shard and
    a block is one task of bounded size that forwards k rows per query; a window merges the shards.
    Scores are exact while they stay below 2 ** 53.
    """

    def numbered(df: DataFrame, rows: int, name: str) -> tuple[DataFrame, int]:
        df = df.filter("id is not null and v is not null")
        df = df.select(F.col("id").cast("bigint"), F.col("v").cast("array<bigint>"))
        n = df.count()
        parts = -(-n // rows) or 1
        return df.withColumn(name, F.pmod(F.xxhash64("id", F.lit(name)), F.lit(parts)).cast("int")), parts

    cand, shards = numbered(candidates, shard_rows, "shard")
    ask, blocks = numbered(queries, block_rows, "block")
    cand = cand.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    ask = ask.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        out = ([], [], [])
        if left.num_rows and right.num_rows:
            width = max(_width(left), _width(right))
            ids, docs = _matrix(left, width)
            q_ids, q = _matrix(right, width)
            row, found, score = maxscore(q_ids, q, ids, docs, k)
            out = (q_ids[row], found, score.astype(np.int64))
        kinds = (pa.int64(), pa.int64(), pa.int64())
        cols = [pa.array(c, t) for c, t in zip(out, kinds)]
        return pa.Table.from_arrays(cols, names=["query_id", "vec_id", "score"])

    tiles = cand.groupBy("shard", "block").cogroup(ask.groupBy("shard", "block"))
    found = tiles.applyInArrow(tile, "query_id bigint, vec_id bigint, score bigint")
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _width(table: pa.Table) -> int:
    return int(table.column("v").combine_chunks().value_lengths().to_numpy(zero_copy_only=False).max())
