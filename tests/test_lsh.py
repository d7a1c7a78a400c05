import numpy as np
import pytest

from stayline.operators import lsh


def vectors(n, dims=16, seed=3, centres=12):
    rnd = np.random.default_rng(seed)
    mat = rnd.standard_normal((centres, dims))[rnd.integers(0, centres, n)] + 0.4 * rnd.standard_normal((n, dims))
    return mat / np.linalg.norm(mat, axis=1, keepdims=True)


def frame(spark, mat, key="vec_id"):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(mat)], f"{key} long, unit array<double>")


def brute(mat, q, k):
    s = np.round(mat @ q, 6)
    return sorted(range(len(mat)), key=lambda i: (-s[i], -i))[:k]


def test_probe_order_is_every_set_by_cost():
    margin = np.array([0.5, -1.2, 0.1, 0.9])
    mask, cost = lsh.probe_order(margin, 100)
    full = sorted((sum(margin[i] ** 2 for i in range(4) if m >> i & 1), m) for m in range(16))
    assert np.allclose(cost, [c for c, _ in full]) and set(mask.tolist()) == set(range(16))
    assert np.allclose(lsh.probe_order(margin, 5)[1], [c for c, _ in full[:5]])


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    mat = vectors(3000)
    path = str(tmp_path_factory.mktemp("lsh"))
    index = lsh.build_index(frame(spark, mat), path, "vec_id", "unit")
    return mat, index, path


def test_reload_gives_the_same_index(spark, built):
    mat, index, path = built
    assert lsh.open_index(spark, path) == index
    assert index.rows == len(mat) and index.buckets(spark).count() == lsh.TABLES * len(mat)


def test_recall_with_learned_probes(spark, built):
    mat, index, _ = built
    qs = vectors(60, seed=9)
    probes = lsh.learn_probes(index, frame(spark, qs, "query_id"), "unit", "query_id", 5)
    assert probes < 2**index.bits
    got = {}
    for r in lsh.search_lsh(index, frame(spark, qs, "query_id"), k=5, probes=probes).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    right = 0
    for i, q in enumerate(qs):
        rows = sorted(got[i])
        assert [r for r, *_ in rows] == [1, 2, 3, 4, 5] and len({v for _, v, _ in rows}) == 5
        assert all(abs(s - mat[v] @ q) < 1e-5 for _, v, s in rows)
        right += len(set(brute(mat, q, 5)) & {v for _, v, _ in rows})
    assert right >= 0.9 * 300


def test_all_buckets_give_the_exact_result(spark, built):
    mat, index, _ = built
    qs = vectors(5, seed=11)
    rows = lsh.search_lsh(index, frame(spark, qs, "query_id"), k=4, probes=2**index.bits).collect()
    for i, q in enumerate(qs):
        assert [r["vec_id"] for r in sorted((r for r in rows if r["query_id"] == i), key=lambda r: r["rank"])] == brute(mat, q, 4)


def test_few_probes_read_few_row_groups(spark, built):
    _, index, _ = built
    found = lsh.search_lsh(index, frame(spark, vectors(2, seed=5), "query_id"), k=3, probes=2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "In(slot" in plan or "slot IN" in plan


def test_beyond_the_probe_limit_the_exact_search_answers(spark, built, monkeypatch):
    mat, index, _ = built
    monkeypatch.setattr(lsh, "learn_probes", lambda *a, **k: None)
    qs = vectors(3, seed=13)
    rows = lsh.search_lsh(index, frame(spark, qs, "query_id"), k=3).collect()
    for i, q in enumerate(qs):
        assert {r["vec_id"] for r in rows if r["query_id"] == i} == set(brute(mat, q, 3))


def test_odd_vectors_equal_vectors_and_empty_tables(spark, tmp_path):
    one = [1.0, 0.0]
    rows = [(i, one) for i in range(300)] + [(900, None), (901, [1.0]), (902, [float("nan"), 0.0]), (903, [None, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, unit array<double>")
    index = lsh.build_index(df, str(tmp_path / "a"), "vec_id", "unit")
    qs = spark.createDataFrame([(1, one), (2, None), (3, [0.0])], "query_id long, unit array<double>")
    got = lsh.search_lsh(index, qs, k=2).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [(1, 1, 299), (1, 2, 298)]
    empty = lsh.build_index(df.limit(0), str(tmp_path / "b"), "vec_id", "unit")
    assert lsh.search_lsh(empty, qs, k=2).count() == 0


@pytest.mark.parametrize("shard, block", [(16_384, 4096), (40, 7)])
def test_no_pair_of_vectors_is_a_row_however_full_a_bucket(spark, built, monkeypatch, shard, block):
    """A query moves once per part of a group of buckets; results are those of the probed buckets alone."""
    mat, index, path = built
    monkeypatch.setattr(lsh, "SHARD_ROWS", shard)
    monkeypatch.setattr(lsh, "QUERY_BLOCK", block)
    qs = vectors(30, seed=21)
    found = lsh.search_lsh(index, frame(spark, qs, "query_id"), k=4, probes=3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "MapInArrow score" not in plan and "SortMergeJoin [slot" not in plan
    held = {}
    for r in index.buckets(spark).select("slot", "vec_id").collect():
        held.setdefault(r["slot"], set()).add(r["vec_id"])
    margins = lsh._margins(qs, index.planes(), np.array(index.centre))
    own, rows = lsh._codes(margins), found.collect()
    for i, q in enumerate(qs):
        near = set().union(*[held.get(s, set()) for t in range(lsh.TABLES) for s in (own[i, t] ^ lsh.probe_order(margins[i, t], 3)[0]).tolist()])
        want = [v for v in brute(mat, q, len(mat)) if v in near][:4]
        assert [r["vec_id"] for r in sorted((r for r in rows if r["query_id"] == i), key=lambda r: r["rank"])] == want
