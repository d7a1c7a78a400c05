"""Links between texts by exact Jaccard of shingle sets, and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.wordbytes import SLICE_BYTES, Words, distinct_sets, shingles
from stayline.session import materialize, outer_scratch, scratch_scope

CAP = 256  # texts compared with each other in one group
FLUSH = 1 << 20  # edges a task holds before it reduces them


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges (a, b) and the smallest node that each of them reaches."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inverse[: len(a)], inverse[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while not np.array_equal(jump := new[new], new):
            new = jump
        if np.array_equal(new, root):
            return nodes, nodes[root]
        root = new


def _reduced(batches):
    """Edges of a partition as stars, which keeps what they connect."""

    def stars(a, b):
        nodes, roots = local_roots(np.concatenate(a), np.concatenate(b))
        keep = nodes != roots
        return nodes[keep], roots[keep]

    a, b, held = [], [], 0
    for batch in batches:
        a.append(batch.column(0).to_numpy())
        b.append(batch.column(1).to_numpy())
        held += batch.num_rows
        if held >= FLUSH:
            x, y = stars(a, b)
            a, b, held = [x], [y], len(x) // 2
    if a:
        x, y = stars(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of each node of `edges` (a, b) that reaches a smaller one; component is the
    smallest id that it reaches. Nodes not returned are the smallest of their component.

    Each partition first reduces its edges to stars. Then large-star and small-star rounds (each
    node hands its larger neighbours, then its smaller ones, to the smallest) run until the edges stay the
    same, which takes a number of rounds logarithmic in the longest path. Edges are written to
    the shared folder after each round; links of one node are split over tasks by Spark's skew join.
    """
    pairs = edges.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).filter("a <> b")
    stars = materialize(pairs.mapInArrow(_reduced, "u bigint, v bigint").distinct(), "stars")
    mark = F.struct(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")))
    last = stars.agg(mark).first()[0]
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct(), "large-stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
        state = stars.agg(mark).first()[0]
        if state == last:
            return stars.select(F.col("u").alias("id"), F.col("v").alias("component"))
        last = state


def _ranges(at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Places of the elements of `rows`, whose offsets are `at`, one row after another."""
    size = at[rows + 1] - at[rows]
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(at[rows] - (ends - size), size)


def _by_block(block: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Small numbers that stand for (block, value)."""
    _, dense = np.unique(values, return_inverse=True)
    return np.unique(block * (int(dense.max(initial=0)) + 1) + dense, return_inverse=True)[1]


def link_blocks(blocks, at, hashes, group, probe, ratio=(80, 100)) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of a block that join groups: den * |intersection| >= num * |union|, one of them a probe.

    `blocks` are the row offsets of the blocks, `at` the offsets of the rows' `hashes`; rows of different blocks never meet.
    Each row meets the later rows that are not yet in its group; so every pair is either compared on its whole sets or
    already connected. Step i compares row i of every block with its later rows, so there are as many steps as the largest block has rows.
    """
    num, den = ratio
    size = np.diff(at)
    block = np.repeat(np.arange(len(blocks) - 1), np.diff(blocks))
    dense = _by_block(np.repeat(block, size), hashes)
    flag = np.zeros(len(dense), dtype=bool)
    group = _by_block(block, group)
    alias = np.arange(len(group))
    rows = np.arange(len(group))
    out = []
    for i in range(int(np.diff(blocks).max(initial=0)) - 1):
        pivot = blocks[block[rows]] + i
        rows, pivot = rows[rows > pivot], pivot[rows > pivot]
        a, b = size[pivot], size[rows]
        # Sets of too different sizes cannot be that alike.
        other = (group[rows] != group[pivot]) & (probe[rows] | probe[pivot])
        other &= (den * np.minimum(a, b) >= num * np.maximum(a, b)) & (b > 0)
        own, rest = pivot[other], rows[other]
        if not len(rest):
            continue
        mine = dense[_ranges(at, np.unique(own))]
        flag[mine] = True
        hit = np.concatenate([[0], np.cumsum(flag[dense[_ranges(at, rest)]])])
        flag[mine] = False
        ends = np.concatenate([[0], np.cumsum(size[rest])])
        both = hit[ends[1:]] - hit[ends[:-1]]
        like = np.flatnonzero(den * both >= num * (size[own] + size[rest] - both))
        if len(like):
            joined, first = np.unique(group[rest[like]], return_index=True)
            like = like[first]
            alias[joined] = group[own[like]]
            group = alias[group]
            out.append((own[like], rest[like]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches sorted by `block` as tables that cut no block."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        block = batch.column("block").to_numpy()
        cut = int(np.searchsorted(block, block[-1]))
        if held and (cut or last != block[-1]):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held, batch = [], batch.slice(cut)
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
            batch = batch.slice(cut)
        held, last = [*held, batch], block[-1]
    if held:
        yield pa.Table.from_batches(held)


def _verify(rows: DataFrame, n_words: int, ratio) -> DataFrame:
    """Edges found in each block of `rows` (block, id, component, probe, text).

    Most blocks are small, so those of a slice of texts are compared together.
    """

    def run(batches):
        for table in _whole_blocks(batches):
            block, ids, probe = (table.column(c).to_numpy() for c in ("block", "id", "probe"))
            order = np.lexsort((ids, block))
            new = np.ones(len(order), dtype=bool)
            new[1:] = (np.diff(block[order]) != 0) | (np.diff(ids[order]) != 0)
            probe = np.logical_or.reduceat(probe[order], np.flatnonzero(new))
            order = order[new]  # an id once a block
            block, ids, component = block[order], ids[order], table.column("component").to_numpy()[order]
            length = pc.fill_null(pc.binary_length(table.column("text")), 0).to_numpy()[order]
            edges = np.append(np.flatnonzero(np.diff(block, prepend=block[0] - 1)), len(block))
            ends = np.concatenate([[0], np.cumsum(length, dtype=np.int64)])[edges]
            at = 0
            while at < len(edges) - 1:
                stop = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE_BYTES, side="right")) - 1)
                low, high = edges[at], edges[stop]
                texts = table.column("text").take(pa.array(order[low:high])).combine_chunks()
                texts = pa.concat_arrays(texts.chunks) if isinstance(texts, pa.ChunkedArray) else texts
                sets = distinct_sets(*shingles(Words(texts), n_words), high - low)
                a, b = link_blocks(edges[at : stop + 1] - low, *sets, component[low:high], probe[low:high], ratio)
                if len(a):
                    own = ids[low:high]
                    yield pa.RecordBatch.from_arrays([pa.array(own[a]), pa.array(own[b])], names=["a", "b"])
                at = stop

    cols = rows.select("block", "id", "component", "probe", "text")
    return cols.repartition("block").sortWithinPartitions("block").mapInArrow(run, "a bigint, b bigint")


def _grouped(rows: DataFrame, found: DataFrame) -> DataFrame:
    return rows.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))


def resolve(blocks: DataFrame, texts: DataFrame, n_words: int, ratio=(80, 100), cap: int = CAP) -> DataFrame:
    """Components of candidates that share a block or a region, confirmed on whole shingle sets.

    `blocks` (id, block, region, wide): a block has about 2 * cap ids at most; a region with more of them
    is `wide` and has several blocks. Of several `texts` (id, text) of an id the
    smallest counts. Three rounds, so that
    a text moves only where its place is still open:
    1. each id with the others of its fullest block;
    2. all blocks that still hold more than one component;
    3. wide regions that do: ids outside the region's largest component with all others, in tiles.
    After them every two ids of one region are connected or compared. Returns (id, component) as
    `components` does.
    """
    with scratch_scope(blocks.sparkSession):
        found = _resolved(blocks, texts, n_words, ratio, cap)
        with outer_scratch():
            return materialize(found, "components")


def _resolved(blocks: DataFrame, texts: DataFrame, n_words: int, ratio, cap: int) -> DataFrame:
    blocks = materialize(blocks, "blocks")
    full = blocks.groupBy("block").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    home = blocks.join(full, "block").groupBy("id").agg(F.max(F.struct("n", "block")).alias("_h"))
    # A wide region may be cut into blocks of one id each; these ids are compared in round 3.
    regions = blocks.filter("wide").select("region").distinct()
    spread = materialize(blocks.select("id", "region").distinct().join(regions, "region", "left_semi"), "spread")
    near = spread.select("id").union(home.select("id")).distinct()
    texts = texts.join(near, "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))
    texts = materialize(texts, "near-texts")

    first = home.select(F.col("_h.block").alias("block"), "id", F.col("id").alias("component"), F.lit(True).alias("probe"))
    edges = materialize(_verify(first.join(texts, "id"), n_words, ratio), "links-1")
    found = components(edges)

    members = _grouped(blocks, found)
    known = (F.bit_xor(F.xxhash64("id")), F.bit_xor(F.xxhash64("id", F.lit(1))), F.count(F.lit(1)), F.min("id"), F.max("id"))
    open_ = members.groupBy("block").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.struct(*known).alias("ids")
    )
    # Texts that are a little alike share several bands: of blocks with the same ids one is compared.
    open_ = open_.filter("lo <> hi").groupBy("ids").agg(F.min("block").alias("block"))
    second = members.join(open_.select("block"), "block").withColumn("probe", F.lit(True))
    edges = edges.unionByName(materialize(_verify(second.join(texts, "id"), n_words, ratio), "links-2"))
    found = components(edges)

    wide = materialize(_grouped(spread, found), "wide")
    parts = wide.groupBy("region", "component").agg(F.count(F.lit(1)).alias("n"))
    most = parts.groupBy("region").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("top")
    )
    most = most.filter("parts > 1").select(
        "region",
        F.col("top.component").alias("top"),
        F.ceil(F.col("n") / cap).cast("int").alias("tiles"),
        F.ceil((F.col("n") - F.col("top.n")) / cap).cast("int").alias("asks"),
    )
    rows = wide.join(most, "region").withColumns(
        {
            "probe": F.col("component") != F.col("top"),
            "tile": F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"),
            "ask": F.pmod(F.xxhash64("id", F.lit(1)), F.col("asks")).cast("int"),
        }
    )
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = rows.filter("probe").withColumn("tile", every("tiles"))
    held = rows.withColumns({"ask": every("asks"), "probe": F.lit(False)})
    third = asked.unionByName(held).withColumn("block", F.xxhash64("region", "tile", "ask"))
    edges = edges.unionByName(materialize(_verify(third.join(texts, "id"), n_words, ratio), "links-3"))
    return components(edges)
