"""Embedding near-duplicates by an inverted multi-index: codebooks on both halves of the vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.linking import components, local_roots
from stayline.session import materialize

SAMPLE = 16_384  # vectors that the codebooks are fitted on, about
CELL_ROWS = 32  # vectors of a cell, about
MAX_CODES = 256  # codewords of a half at most
RECALL = 0.999  # of neighbours at the threshold whose cell is visited
TILE = 2_048  # vectors of a group that meet at a time, about
STEP = 512


def halves(width: int) -> tuple[slice, slice]:
    return slice(0, width // 2), slice(width // 2, width)


def kmeans(rows: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """k centroids of a sample; an empty one keeps its place."""
    rng = np.random.default_rng(seed)
    centers = rows[rng.choice(len(rows), k, replace=False)].copy()
    for _ in range(rounds):
        near = np.argmin((centers**2).sum(1) - 2 * rows @ centers.T, axis=1)
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, rows)
        centers[n > 0] = sums[n > 0] / n[n > 0, None]
    return centers


class Index:
    """Two codebooks and the number of cells that a vector visits."""

    def __init__(self, sample: np.ndarray, codes: int, threshold: float, recall: float = RECALL, seed: int = 6):
        k = max(1, min(codes, len(sample)))
        self.books = [kmeans(sample[:, h], k, seed + i) for i, h in enumerate(halves(sample.shape[1]))]
        self.codes = k
        self.visits = k * k
        self.visits = self._visits(sample[:1024], threshold, recall, seed)

    def distances(self, rows: np.ndarray) -> list[np.ndarray]:
        out = []
        for h, book in zip(halves(rows.shape[1]), self.books):
            part = rows[:, h]
            out.append((part**2).sum(1)[:, None] - 2 * part @ book.T + (book**2).sum(1)[None, :])
        return out

    def cells(self, rows: np.ndarray) -> np.ndarray:
        a, b = self.distances(rows)
        return a.argmin(1) * self.codes + b.argmin(1)

    def traverse(self, rows: np.ndarray, visits: int | None = None) -> np.ndarray:
        """The nearest cells of each row by the sum of both halves' distances, nearest first.

        In the sequences of codewords by distance, cell (i, j) comes after all (i', j') with i' <= i
        and j' <= j, so only cells with (i + 1) (j + 1) <= visits can be among the first ones.
        """
        visits = min(visits or self.visits, self.codes**2)
        a, b = self.distances(rows)
        first, second = np.argsort(a, 1), np.argsort(b, 1)
        a, b = np.take_along_axis(a, first, 1), np.take_along_axis(b, second, 1)
        i, j = np.divmod(np.arange(self.codes**2), self.codes)
        can = (i + 1) * (j + 1) <= visits
        i, j = i[can], j[can]
        best = np.argsort(a[:, i] + b[:, j], axis=1, kind="stable")[:, :visits]
        rows_at = np.arange(len(rows))[:, None]
        return first[rows_at, i[best]] * self.codes + second[rows_at, j[best]]

    def _visits(self, sample: np.ndarray, threshold: float, recall: float, seed: int) -> int:
        """Cells to visit so that the target share of neighbours at the threshold is met.

        Neighbours are made at exactly the threshold's angle, in directions spread over all
        components, over one half, or over a few components; the hardest kind counts.
        """
        rng = np.random.default_rng(seed)
        width, most = sample.shape[1], 1
        for kind in range(4):
            turn = rng.normal(size=sample.shape)
            if kind in (1, 2):
                turn[:, halves(width)[kind - 1]] = 0
            elif kind == 3:
                turn *= rng.random(turn.shape) < 4 / width
            turn -= (turn * sample).sum(1)[:, None] * sample
            length = np.linalg.norm(turn, axis=1)
            good = length > 1e-9
            turn = turn[good] / length[good, None]
            near = threshold * sample[good] + np.sqrt(1 - threshold**2) * turn
            if not len(near):
                continue
            order = self.traverse(near, self.codes**2)
            place = np.argmax(order == self.cells(sample[good])[:, None], axis=1) + 1
            most = max(most, int(np.quantile(place, recall, method="higher")))
        return most


def usable(vector: str, label: str):
    """Rows that can have links: a label, and a vector with finite components that are not all 0."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(label).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def _vectors(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)  # no overflow in the squares
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def fit(classes: DataFrame, threshold: float, sample: int = SAMPLE, recall: float = RECALL) -> Index | None:
    """An index fitted on about `sample` vectors picked by a seeded hash; None without vectors."""
    n = classes.count()
    if not n:
        return None
    picked = classes if n <= sample else classes.filter(
        F.shiftrightunsigned(F.xxhash64(F.lit(6), "id"), 1) < int(sample / n * 2**63)
    )
    rows = picked.select("v").toArrow()  # about `sample` rows
    codes = int(min(MAX_CODES, max(4, round((n / CELL_ROWS) ** 0.5))))
    return Index(_unit(_vectors(rows.column("v"))), codes, threshold, recall)


def _tile(index: Index, threshold: float):
    """Links in one group: members of the cells of one first codeword, and vectors that visit some."""

    def run(table: pa.Table) -> pa.Table:
        role = table.column("probe").to_numpy(zero_copy_only=False)
        vec = _unit(_vectors(table.column("v")))
        ids, times = table.column("id").to_numpy(), table.column("times").to_numpy()
        home = table.column("home").to_numpy()
        visited = table.column("visits").combine_chunks()
        n_cells, k = index.codes**2, index.codes
        m, p = np.flatnonzero(~role), np.flatnonzero(role)
        count = np.zeros(len(ids), dtype=np.int64)
        ends = ([], [])
        lists = _lists(visited)
        of_row = np.repeat(np.arange(len(ids)), np.diff(lists[0]))
        all_visits = np.sort(of_row * n_cells + lists[1])
        for at in range(0, len(p) if len(m) else 0, STEP):
            part = p[at : at + STEP]
            seen = np.zeros((len(part), k), dtype=bool)
            own = home[m[0]] // k  # all members share their first codeword
            for r, row in enumerate(part):
                cells = lists[1][lists[0][row] : lists[0][row + 1]]
                seen[r, cells[cells // k == own] % k] = True
            hit = (vec[part] @ vec[m].T >= threshold) & seen[:, home[m] % k] & (ids[part][:, None] != ids[m])
            a, b = np.nonzero(hit)
            a, b = part[a], m[b]
            # A pair is met once from each side that visits the other's cell; if the member does
            # not visit back, this meeting counts for both.
            wanted = b * n_cells + home[a]
            place = np.minimum(np.searchsorted(all_visits, wanted), len(all_visits) - 1)
            back = all_visits[place] == wanted
            np.add.at(count, a, times[b])
            np.add.at(count, b[~back], times[a[~back]])
            if len(a):
                nodes, roots = local_roots(ids[a], ids[b])
                ends[0].append(nodes)
                ends[1].append(roots)
        rows = np.flatnonzero(count)
        a, b = (np.concatenate(e) if e else np.zeros(0, np.int64) for e in ends)
        if len(a):
            a, b = local_roots(a, b)
        cols = [np.concatenate([ids[rows], a]), np.concatenate([count[rows], np.zeros(len(a), np.int64)]),
                np.concatenate([ids[rows], b])]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["id", "n", "root"])

    return run


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return np.concatenate([[0], np.cumsum(lengths)]), column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def near_duplicates(
    rows: DataFrame,
    threshold: float = 0.93,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    tile: int = TILE,
    recall: float = RECALL,
) -> DataFrame:
    """Per row: key, n_links, component_id, kept. Links join vectors of one label by cosine >= threshold.

    Equal vectors of a label are one class, known by its smallest key. Every class lies in one cell of
    the product grid of two codebooks and visits its nearest cells in multi-sequence order, as many
    as meet the recall target for neighbours at the threshold; a pair is found if either visits the
    other's cell, and every pair found is verified in double precision. Groups by label and first
    codeword are cut into tiles of bounded size, whatever share of the rows one of them has.

    Vectors that are NULL, zero, empty, or hold NULL or non-finite components, and rows without a label
    link with nothing: n_links 0, component_id their own key. Rows with a NULL key take no part
    (component_id NULL, kept TRUE). Repeated rows count as one vector. Vectors must have one width.
    """
    base = rows.select(F.col(key).cast("bigint").alias(key), F.col(vector).alias("v"), F.col(label).alias("label"))
    base = base.withColumn("v", F.when(usable("v", "label"), F.transform("v", lambda x: x + F.lit(0.0).cast("float"))))
    some = base.filter(F.col(key).isNotNull() & F.col("v").isNotNull() & F.col("label").isNotNull())
    classes = (
        some.distinct()
        .groupBy("label", "v")
        .agg(F.min(key).alias("id"), F.count(F.lit(1)).alias("times"))
    )
    classes = materialize(classes, "vector-classes")
    index = fit(classes, threshold, recall=recall)
    if index is None:
        found = classes.select("id", F.lit(0).cast("bigint").alias("n"))
        named = found.select("id", F.col("id").alias("component")).limit(0)
    else:
        n, named = _links(classes, index, threshold, tile)
        found = n
    linked = (
        classes.join(found, "id", "left")
        .join(named, "id", "left")
        .select("label", "v", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"),
                F.coalesce("component", "id").alias("component"))
    )
    component = F.when(F.col(key).isNotNull(), F.coalesce("component", key))
    return (
        base.join(linked, ["label", "v"], "left")
        .select(key, F.when(F.col(key).isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("bigint").alias("n_links"),
                component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))
    )


def _links(classes: DataFrame, index: Index, threshold: float, tile: int) -> tuple[DataFrame, DataFrame]:
    shared = classes.sparkSession.sparkContext.broadcast(index)  # two small codebooks

    def place(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                vec = _unit(_vectors(part.column("v")))
                visits = shared.value.traverse(vec)
                cols = [*part.columns, pa.array(shared.value.cells(vec).astype(np.int32)), pa.array(visits.astype(np.int32).tolist(), pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(cols, names=[*part.schema.names, "home", "visits"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    placed = materialize(classes.mapInArrow(place, kinds + ", home int, visits array<int>"), "cells")
    k = index.codes
    members = placed.withColumns({"code": F.expr(f"home div {k}"), "probe": F.lit(False)})
    codes = F.array_distinct(F.transform("visits", lambda c: F.floor(c / k)))
    probes = placed.withColumns({"code": F.explode(codes), "probe": F.lit(True)})
    size = lambda df, name: df.groupBy("label", "code").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias(name))
    sizes = size(members, "parts").join(size(probes, "asks"), ["label", "code"])
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    ask = F.pmod(F.xxhash64("id", F.lit(1)), F.col("asks")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    held = members.join(sizes, ["label", "code"]).withColumn("part", part).withColumn("ask", every("asks"))
    asked = probes.join(sizes, ["label", "code"]).withColumn("ask", ask).withColumn("part", every("parts"))
    tiles = held.unionByName(asked).groupBy("label", "code", "part", "ask")
    links = materialize(
        tiles.applyInArrow(_tile(index, threshold), "id bigint, n bigint, root bigint"), "vector-links"
    )
    counts = links.groupBy("id").agg(F.sum("n").alias("n"))
    return counts, components(links.select(F.col("id").alias("a"), F.col("root").alias("b")))
