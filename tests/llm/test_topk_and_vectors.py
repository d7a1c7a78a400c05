import math

import numpy as np
import pytest

from stayline.llm import multiindex, topk

DDL = "vec_id long, embedding array<float>, label int"


def vectors(n, seed=1, width=16):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, width))
    return (rows / np.linalg.norm(rows, axis=1)[:, None]).astype(np.float32)


def searched(df, k, **kw):
    rows = df.selectExpr("vec_id as id", "*").withColumn("v", topk.integer_vector("embedding")).select("id", "v")
    found = topk.search(rows, rows.filter("id % 5 = 0"), k, **kw)
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect())


def brute(pairs, k):
    whole = {i: [math.floor(64 * float(x)) for x in v] for i, v in pairs}
    out = []
    for q, a in whole.items():
        if q % 5 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole.items() if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("shard,block", [(10_000, 10_000), (37, 11)])
def test_maxscore_equals_brute_force(spark, shard, block):
    rows = vectors(700)
    rows[300:340] = rows[7]  # ties by the dozen
    pairs = [(int(i), v.tolist()) for i, v in enumerate(rows)]
    df = spark.createDataFrame([(i, v, 0) for i, v in pairs], DDL)
    assert searched(df, 20, shard_rows=shard, block_rows=block) == brute(pairs, 20)


def test_maxscore_with_nulls_short_vectors_repeats_and_few_rows(spark):
    rows = [
        (0, [0.5, -0.25], 0), (0, [0.5, -0.25], 0), (5, [1.0, 1.0], 0), (6, None, 0), (7, [None, 1.0], 0),
        (8, [float("nan"), 1.0], 0), (9, [float("inf"), 1.0], 0), (None, [1.0, 1.0], 0), (10, [1.0], 0), (11, [], 0),
    ]
    df = spark.createDataFrame(rows, DDL)
    good = [(0, [0.5, -0.25]), (5, [1.0, 1.0]), (10, [1.0, 0.0]), (11, [0.0, 0.0])]
    assert searched(df, 20) == brute(good, 20)
    assert searched(df.limit(0), 20) == []


def test_pruning_leaves_pairs_out():
    rows = np.floor(64 * vectors(3000, width=32).astype(float))
    ids = np.arange(3000)
    row, found, score = topk.maxscore(ids[:8], rows[:8], ids, rows, 20)
    full = rows[:8] @ rows.T
    for q in range(8):
        want = sorted((-full[q, i], i) for i in ids if i != q)[:20]
        assert [(-s, i) for s, i in want] == list(zip(score[row == q], found[row == q]))


def links(pairs, threshold):
    """Brute force: (n_links, component) by id for {id: (vector, label)}."""
    ids = list(pairs)
    near = {i: set() for i in ids}
    for a in ids:
        for b in ids:
            (x, p), (y, q) = pairs[a], pairs[b]
            if a < b and p is not None and p == q and x is not None and y is not None:
                if x @ y >= threshold * np.linalg.norm(x) * np.linalg.norm(y):
                    near[a].add(b)
                    near[b].add(a)
    comp = {}
    for i in sorted(ids):
        todo = [i] if i not in comp else []
        while todo:
            k = todo.pop()
            if k not in comp:
                comp[k] = i
                todo += near[k]
    return {i: (len(near[i]), comp[i], comp[i] == i) for i in ids}


def indexed(df, **kw):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in multiindex.near_duplicates(df, **kw).collect()}


@pytest.mark.parametrize("tile", [2048, 23])
def test_multi_index_finds_the_links_of_brute_force(spark, tile):
    rng = np.random.default_rng(5)
    base = vectors(500, 3, 32).astype(np.float64)
    for i in range(0, 200, 4):  # neighbours on both sides of the threshold, one large group, copies
        turn = rng.normal(size=32)
        turn -= (turn @ base[i]) * base[i]
        turn /= np.linalg.norm(turn)
        c = rng.uniform(0.9, 0.96)
        base[i + 1] = c * base[i] + math.sqrt(1 - c * c) * turn
    base[300:360] = base[299] + 0.02 * rng.normal(size=(60, 32))
    base[400:410] = base[401]
    rows = [(i, v.astype(np.float32).tolist(), i % 3 if i < 200 else 1) for i, v in enumerate(base)]
    rows = [(i, v, rows[i - i % 2][2]) for i, v, _ in rows]
    df = spark.createDataFrame(rows, DDL)
    got = indexed(df, tile=tile)
    want = links({i: (np.array(v, dtype=np.float32).astype(float), k) for i, v, k in rows}, 0.93)
    found = sum(n for n, _, _ in got.values())
    assert found <= sum(n for n, _, _ in want.values())
    assert found >= 0.99 * sum(n for n, _, _ in want.values())
    assert sum(got[i] == want[i] for i in want) >= 0.98 * len(want)
    assert got[400] == want[400]


def test_multi_index_odd_rows(spark):
    v = [1.0, 0.0, 0.0, 0.0]
    rows = [
        (1, v, 0), (2, v, 0), (2, v, 0), (3, v, None), (4, None, 0), (5, [0.0] * 4, 0),
        (6, [float("nan"), 0.0, 0.0, 1.0], 0), (7, [None, 0.0, 0.0, 1.0], 0), (None, v, 0), (8, v, 1), (9, [-0.0, 1.0, 0.0, 0.0], 0),
        (10, [0.0, 1.0, 0.0, 0.0], 0),
    ]
    df = spark.createDataFrame(rows, DDL).withColumnRenamed("label", "label")
    got = sorted(
        ((r.vec_id is None, r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in multiindex.near_duplicates(df).collect())
    )
    alone = [(False, i, 0, i, True) for i in (3, 4, 5, 6, 7, 8)]
    want = [(False, 1, 1, 1, True), (False, 2, 1, 1, False), (False, 2, 1, 1, False), *alone,
            (False, 9, 1, 9, True), (False, 10, 1, 9, False), (True, 0, 0, None, True)]
    assert got == sorted(want, key=lambda r: r[:3])
    assert multiindex.near_duplicates(df.limit(0)).count() == 0


def test_traversal_is_in_order_of_distance():
    index = multiindex.Index(vectors(400, 9, 16).astype(float), 8, 0.93)
    rows = vectors(20, 10, 16).astype(float)
    a, b = index.distances(rows)
    whole = (a[:, :, None] + b[:, None, :]).reshape(20, -1)
    got = index.traverse(rows, 15)
    assert np.allclose(np.take_along_axis(whole, got, 1), np.sort(whole, 1)[:, :15])
    assert 1 <= index.visits <= 64
