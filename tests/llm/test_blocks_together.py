"""Many small blocks are compared in one go: the pairs must connect what comparing all pairs of each block connects."""

import numpy as np
import pyarrow as pa
import pytest

from stayline.llm import linking, passages


def _closed(groups, pairs):
    groups = list(groups)
    for a, b in pairs:
        groups = [groups[a] if g == groups[b] else g for g in groups]
    return [groups.index(g) for g in groups]


@pytest.mark.parametrize("seed", range(40))
def test_blocks_together_equal_all_pairs(seed):
    rnd = np.random.default_rng(seed)
    blocks = np.concatenate([[0], np.cumsum(rnd.integers(1, 9, 7))])
    n = int(blocks[-1])
    sets = [sorted(rnd.choice(13, rnd.integers(0, 12), replace=False).tolist()) for _ in range(n)]
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    group, probe = rnd.integers(0, 6, n), rnd.random(n) < 0.7
    found = list(zip(*linking.link_blocks(blocks, at, np.array(sum(sets, []), dtype=np.uint64), group, probe, (60, 100))))
    for low, high in zip(blocks, blocks[1:]):
        alike = [
            (i - low, j - low)
            for i in range(low, high)
            for j in range(i + 1, high)
            if (probe[i] or probe[j]) and sets[i] and 100 * len({*sets[i]} & {*sets[j]}) >= 60 * len({*sets[i]} | {*sets[j]})
        ]
        got = [(a - low, b - low) for a, b in found if low <= a < high]
        assert all(low <= b < high for a, b in found if low <= a < high)
        assert _closed(group[low:high], got) == _closed(group[low:high], alike)


def test_no_batch_cuts_a_block():
    block = [1, 1, 2, 3, 3, 3, 3, 4, 5, 5]
    for size in range(1, 11):
        batches = [pa.RecordBatch.from_pydict({"block": block[k : k + size]}) for k in range(0, 10, size)]
        tables = [t.column("block").to_pylist() for t in linking._whole_blocks(iter(batches))]
        assert sum(tables, []) == block
        assert all(a[-1] != b[0] for a, b in zip(tables, tables[1:]))


def test_a_task_compares_blocks_of_a_slice_in_one_call(spark):
    """The plan no longer calls Python once a group."""
    rows = spark.createDataFrame([(b, 2 * b + k, 0, True, "a b c d e f") for b in range(20) for k in range(2)], "block bigint, id bigint, component bigint, probe boolean, text string")
    edges = linking._verify(rows.withColumn("component", rows.id), 5, (80, 100))
    assert "FlatMapGroupsInArrow" not in edges._jdf.queryExecution().toString()
    assert sorted(map(tuple, edges.collect())) == [(2 * b, 2 * b + 1) for b in range(20)]


def test_spans_that_overlap_or_touch_are_joined():
    code = [[(s << 32) | e for s, e in row] if row is not None else None for row in ([(5, 9), (1, 3), (3, 4), (20, 30), (22, 25), (26, 31)], None, [], [(0, 2), (3, 5)])]
    joined = passages._joined(pa.array(code, pa.list_(pa.int64())))
    assert [[(s["start"], s["end"]) for s in row] for row in joined] == [[(1, 4), (5, 9), (20, 31)], [], [], [(0, 2), (3, 5)]]
