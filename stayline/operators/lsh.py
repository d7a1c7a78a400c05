"""Approximate inner-product search over unit vectors by random-projection buckets.

Every vector is stored once per table, in the bucket that the signs of its projections name; the stored
table is sorted by bucket, so a batch of queries reads only the row groups of the buckets it probes. A query
probes its own bucket and those that differ in the projections it is least sure of, in order of
the squared distance to the planes between. How many is learned on a bounded number of the batch's own queries,
whose exact neighbours come from one pass over all vectors; candidates are scored exactly.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayline.operators.dense import search_dense
from stayline.session import broadcast_if_small, fits, local_table, materialize

TABLES = 4
BUCKET_ROWS = 128  # vectors of a bucket, about
MAX_BITS = 40
MAX_PROBES = 4096  # buckets of a table that one query may probe; beyond it the exact search answers
LEARN_QUERIES = 64  # queries whose exact neighbours decide the number of probes
TARGET = 0.97  # share of those neighbours that the probes must reach
GROUP_BITS = 7  # 128 buckets of a table are compared together
SHARD_ROWS = 16_384  # vectors of a part of a group, about
QUERY_BLOCK = 4096  # queries of a block, about
STEP = 256  # queries multiplied at a time
BROADCAST_ROWS = 1_000_000
MAX_PUSHED = 1000  # buckets of a batch that are pushed to the scan as a list


@dataclass(frozen=True)
class LshIndex:
    """A stored index: everything but the buckets fits its manifest, so `open_index` needs the path alone."""

    path: str
    key: str
    dims: int
    bits: int
    rows: int
    seed: int
    centre: tuple[float, ...]

    def planes(self) -> np.ndarray:
        """Directions, (TABLES * bits) x dims; the same for a seed."""
        return np.random.default_rng(self.seed).standard_normal((TABLES * self.bits, self.dims))

    def buckets(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/buckets")


def _matrix(column, dims: int) -> np.ndarray:
    """The vectors of a batch; rows of another width or with NULLs were left out before."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(-1, dims)


def usable(vector: str, dims: int):
    """True for vectors of the index's width without NULL, NaN or infinite components."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) == dims) & ~odd, F.lit(False))


def _margins(mat: np.ndarray, planes: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return ((mat - centre) @ planes.T).reshape(len(mat), TABLES, -1)


def _codes(margins: np.ndarray) -> np.ndarray:
    """Slot of each vector in each table: the table's number, then one bit per projection."""
    bits = margins.shape[2]
    code = ((margins > 0) * (1 << np.arange(bits, dtype="int64"))).sum(axis=2)
    return code + (np.arange(TABLES, dtype="int64") << bits)


def probe_order(margin: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """Sets of bits to flip (as masks), cheapest first, and their costs; at most `probes` of them.

    Bits are taken one by one; the cheapest sets with a bit are cheapest sets without it,
    so keeping `probes` of them at each step loses none.
    """
    cost, mask = np.zeros(1), np.zeros(1, dtype="int64")
    for i in np.argsort(margin**2, kind="stable"):
        cost = np.concatenate([cost, cost + margin[i] ** 2])
        mask = np.concatenate([mask, mask | (1 << int(i))])
        best = np.lexsort((mask, cost))[:probes]
        cost, mask = cost[best], mask[best]
    return mask, cost


def build_index(df: DataFrame, path: str, key: str, vector: str, seed: int = 42) -> LshIndex:
    """Write the buckets of all unit vectors of `df` below `path`, with a manifest; needs unique keys.

    The width is that of the longest vector; NULL vectors, other widths and vectors with components that
    are not finite are not indexed. The number of projections follows the number of rows.
    """
    spark = df.sparkSession
    dims = df.agg(F.max(F.size(vector))).first()[0] or 1
    good = df.filter(usable(vector, dims)).select(F.col(key).cast("bigint").alias(key), F.col(vector).cast("array<double>").alias("v"))
    n, *centre = good.agg(F.count(F.lit(1)), *[F.coalesce(F.avg(F.col("v")[i]), F.lit(0.0)) for i in range(dims)]).first()
    bits = min(MAX_BITS, max(1, int(np.ceil(np.log2(max(n, 2) / BUCKET_ROWS)))))
    index = LshIndex(path, key, dims, bits, n, seed, tuple(centre))
    planes, middle = index.planes(), np.array(centre)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                mat = _matrix(b.column(1), dims)
                slots = _codes(_margins(mat, planes, middle))
                at = np.repeat(np.arange(len(mat)), TABLES)
                yield pa.RecordBatch.from_arrays([pa.array(slots.ravel()), b.column(0).take(at), b.column(1).take(at)], ["slot", key, "v"])

    placed = good.mapInArrow(place, f"slot bigint, {key} bigint, v array<double>")
    # Ranges over (slot, key) cut a bucket that holds most vectors as well.
    placed.repartitionByRange("slot", key).sortWithinPartitions("slot", key).write.mode("overwrite").option(
        "parquet.block.size", 8 << 20
    ).parquet(f"{path}/buckets")
    manifest = [(json.dumps(asdict(index)),)]
    local_table(spark, manifest, "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    return index


def open_index(spark: SparkSession, path: str) -> LshIndex:
    """The index that was written below `path`, by this or another application."""
    found = json.loads(spark.read.text(f"{path}/manifest").first()[0])
    return LshIndex(**{**found, "path": path, "centre": tuple(found["centre"])})


def probes_needed(index: LshIndex, queries: np.ndarray, hits: list[tuple[int, np.ndarray]], target: float) -> int | None:
    """Buckets a query must probe in each table for `target` of the known (query row, neighbour) pairs; None if beyond the limit."""
    if not hits:
        return 1
    planes, centre = index.planes(), np.array(index.centre)
    q = _margins(queries, planes, centre)
    d = _codes(_margins(np.stack([v for _, v in hits]), planes, centre)) & ((1 << index.bits) - 1)
    own = _codes(q) & ((1 << index.bits) - 1)
    first = np.full(len(hits), MAX_PROBES, dtype="int64")
    for at in range(len(queries)):
        mine = [i for i, (row, _) in enumerate(hits) if row == at]
        for t in range(TABLES):
            mask, _ = probe_order(q[at, t], MAX_PROBES)
            place = {int(m): i for i, m in enumerate(mask)}
            for i in mine:
                first[i] = min(first[i], place.get(int(own[at, t] ^ d[i, t]), MAX_PROBES))
    need = int(np.sort(first)[int(np.ceil(target * len(first))) - 1]) + 1
    return need if need <= MAX_PROBES else None


def learn_probes(index: LshIndex, queries: DataFrame, vector: str, qkey: str, k: int, target: float = TARGET) -> int | None:
    """Number of probes for a batch of queries, from at most LEARN_QUERIES of them, picked by hash."""
    spark = queries.sparkSession
    some = materialize(queries.orderBy(F.xxhash64(qkey), qkey).limit(LEARN_QUERIES).select(qkey, vector), "learn-queries")
    one = index.buckets(spark).filter(F.col("slot") < (1 << index.bits)).select(index.key, F.col("v").alias(vector))
    found = materialize(search_dense(one, some, k, index.key, vector, qkey), "learn-hits")
    near = one.join(F.broadcast(found.select(qkey, index.key)), index.key).collect()  # at most LEARN_QUERIES * k rows
    rows = some.collect()
    place = {r[qkey]: i for i, r in enumerate(rows)}
    mat = np.array([r[vector] for r in rows], dtype="float64").reshape(-1, index.dims)
    return probes_needed(index, _unit(mat), [(place[r[qkey]], np.array(r[vector])) for r in near], target)


def _unit(mat: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(mat, axis=1, keepdims=True)
    return mat / np.where(norm == 0, 1, norm)


def _group_bits(index: LshIndex) -> int:
    """A group of buckets is one table's that differ in these bits only."""
    return min(GROUP_BITS, index.bits)


def _probe_rows(index: LshIndex, queries: DataFrame, probes: int, qkey: str) -> DataFrame:
    """A row per query and group of buckets: the query's key and vector, and the buckets it probes there."""
    planes, centre, dims, low = index.planes(), np.array(index.centre), index.dims, _group_bits(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            margins = _margins(_unit(_matrix(b.column(1), dims)), planes, centre)
            own = _codes(margins)
            for at in range(b.num_rows):  # one query's probes at a time: memory is bounded by MAX_PROBES
                slots = np.sort(np.concatenate([own[at, t] ^ probe_order(margins[at, t], probes)[0] for t in range(TABLES)]))
                group, first = np.unique(slots >> low, return_index=True)
                row = np.full(len(group), at)
                lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(slots)).astype("int32")), pa.array(slots))
                yield pa.RecordBatch.from_arrays([b.column(0).take(row), b.column(1).take(row), pa.array(group), lists], [qkey, "q", "_group", "slots"])

    return queries.mapInArrow(run, f"{qkey} bigint, q array<double>, _group bigint, slots array<bigint>")


def _tile(dims: int, low: int, k: int, key: str, qkey: str, decimals: int):
    """Best k vectors for each query of a block among the buckets it probes in a part of a group, by one product per step."""

    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        parts = [pa.table({qkey: pa.array([], pa.int64()), key: pa.array([], pa.int64()), "score": pa.array([], pa.float64())})]
        rows = rows.sort_by([(key, "descending")])  # ties favour the larger key
        ids, slot = rows.column(key).to_numpy(), rows.column("slot").to_numpy() & ((1 << low) - 1)
        mat = _matrix(rows.column("v"), dims)
        take = min(k, len(ids))
        for at in range(0, asked.num_rows if take else 0, STEP):
            some = asked.slice(at, STEP)
            lists = some.column("slots").combine_chunks()
            wanted = np.zeros((some.num_rows, 1 << low), dtype=bool)
            wanted[lists.value_parent_indices().to_numpy(), lists.flatten().to_numpy() & ((1 << low) - 1)] = True
            scores = np.where(wanted[:, slot], np.round(_matrix(some.column("q"), dims) @ mat.T, decimals), -np.inf)
            kth = -np.partition(-scores, take - 1, axis=1)[:, take - 1]
            row, col = np.nonzero((scores >= kth[:, None]) & (scores > -np.inf))  # the k best and their ties
            order = np.lexsort((col, -scores[row, col], row))
            row, col = row[order], col[order]
            best = np.arange(len(row)) - np.searchsorted(row, row) < take
            row, col = row[best], col[best]
            parts.append(pa.table({qkey: some.column(qkey).to_numpy()[row], key: ids[col], "score": scores[row, col]}))
        return pa.concat_tables(parts)

    return run


def _best_of_tiles(index: LshIndex, buckets: DataFrame, probed: DataFrame, queries: int, k: int, qkey: str, decimals: int) -> DataFrame:
    """query, key, score: the best k of each part of a group of buckets.

    A group is cut by key into parts of about SHARD_ROWS vectors, however many one bucket holds, and the queries into blocks; a pair of
    a part and a block is one group of rows. So a query's vector moves once per part, not with every bucket, and no pair of vectors is a row.
    """
    key, low, blocks = index.key, _group_bits(index), -(-queries // QUERY_BLOCK) or 1
    rows = buckets.withColumn("_group", F.shiftright("slot", low))
    parts = F.ceil(F.count(F.lit(1)) / SHARD_ROWS).alias("_parts")
    sizes = broadcast_if_small(materialize(rows.groupBy("_group").agg(parts), "lsh-sizes"), BROADCAST_ROWS)
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block")
    rows = rows.join(sizes, "_group").select("_group", F.pmod(F.xxhash64(key), F.col("_parts")).alias("_part"), every, "slot", key, "v")
    of_part = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1)).alias("_part")
    block = F.pmod(F.xxhash64(qkey), F.lit(blocks)).cast("int").alias("_block")
    asked = probed.join(sizes, "_group").select("_group", of_part, block, qkey, "q", "slots")
    at = ["_group", "_part", "_block"]
    run = _tile(index.dims, low, k, key, qkey, decimals)
    tiles = rows.groupBy(*at).cogroup(asked.groupBy(*at))
    return tiles.applyInArrow(run, f"{qkey} bigint, {key} bigint, score double")


def search_lsh(
    index: LshIndex, queries: DataFrame, k: int = 3, vector: str = "unit", qkey: str = "query_id", probes: int | None = None, decimals: int = 6
) -> DataFrame:
    """Top k vectors per query among its probed buckets: query, key, score, rank; ties favour the larger key.

    Query keys are unique; queries of another width or with components that are not finite get no rows. `probes`
    buckets per table, else as many as `learn_probes` finds. Where MAX_PROBES do not reach the target, the
    batch is answered by the exact search.
    """
    spark = queries.sparkSession
    kept = queries.filter(usable(vector, index.dims)).select(
        F.col(qkey).cast("bigint").alias(qkey), F.col(vector).cast("array<double>").alias("q")
    )
    kept = materialize(kept, "lsh-queries")
    buckets = index.buckets(spark)
    probes = probes or learn_probes(index, kept, "q", qkey, k)
    if probes is None:
        one = buckets.filter(F.col("slot") < (1 << index.bits)).select(index.key, F.col("v").alias("q"))
        return search_dense(one, kept, k, index.key, "q", qkey, decimals).select(qkey, index.key, "score", "rank")
    probed = materialize(_probe_rows(index, kept, probes, qkey), "lsh-probes")
    slots = probed.select(F.explode("slots").alias("slot")).distinct()
    if fits(slots, MAX_PUSHED):  # a short list prunes row groups; a long one would meet most of them
        buckets = buckets.filter(F.col("slot").isin([r[0] for r in slots.collect()]))
    key = index.key
    scored = _best_of_tiles(index, buckets, probed, kept.count(), k, qkey, decimals)
    best = Window.partitionBy(qkey).orderBy(F.col("score").desc(), F.col(key).desc())
    # A vector turns up at most once per table, so k of them are among the first k * TABLES rows.
    few = scored.withColumn("_at", F.row_number().over(best)).filter(F.col("_at") <= k * TABLES)
    once = few.withColumn("_again", F.lag(key).over(best)).filter(~F.col("_again").eqNullSafe(F.col(key)))
    return once.select(qkey, key, "score", F.row_number().over(best).alias("rank")).filter(F.col("rank") <= k)
