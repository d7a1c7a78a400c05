"""MinHash near-duplicates by an LSH forest: sorted signature orders with adaptive depth."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.linking import CAP, resolve
from stayline.llm.wordbytes import Words, distinct_sets, mix, shingles, slices
from stayline.session import materialize

TREES = 16
DEPTH = 4  # hashes that two texts must share at least to meet in a tree
DEEPER = 8  # further hashes of a tree's order
HASHES = TREES * DEPTH
ROW_BYTES, PART_BYTES = 64, 32 << 20  # size of a row in an order, and of a sorted range
_FACTORS = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)


def minhashes(at: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """32-bit MinHash values, one row per set of at least one hash."""
    out = np.empty((len(at) - 1, HASHES), dtype=np.uint32)
    for k in range(HASHES):
        out[:, k] = np.minimum.reduceat(hashes * _FACTORS[k], at[:-1]) >> np.uint64(32)
    return out


def signatures(docs: DataFrame, n_words: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles, the set as two 64-bit sums (set_a, set_b), and its MinHash signature.

    Texts without words have n_shingles 0 and NULL for the rest.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                at, hashes = distinct_sets(*shingles(Words(part.column(text)), n_words), part.num_rows)
                size = np.diff(at)
                some = size > 0
                starts = at[:-1][some]
                empty = pa.array(~some)
                cols = [part.column(key), pa.array(size.astype(np.int64))]
                for k in (1, 2):
                    sums = np.zeros(part.num_rows, dtype=np.uint64)
                    if some.any():
                        sums[some] = np.add.reduceat(mix(hashes + np.uint64(k)), starts)
                    cols.append(pa.array(sums.view(np.int64), mask=~some))
                sig = iter(minhashes(np.append(starts, at[-1]), hashes)) if some.any() else iter(())
                cols.append(pa.array([next(sig).tobytes() if s else None for s in some], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=[key, "n_shingles", "set_a", "set_b", "sig"])

    return docs.select(f"`{key}`", f"`{text}`").mapInArrow(
        run, f"`{key}` bigint, n_shingles bigint, set_a bigint, set_b bigint, sig binary"
    )


def _orders(batches):
    """A row per text and tree: the tree's first hashes as `region`, the next ones as `deep`."""
    turns = np.arange(TREES)[:, None] * DEPTH + np.arange(DEPTH + DEEPER)[None, :]
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint32).reshape(n, HASHES)
        view = sig[:, turns % HASHES].astype(np.uint64)  # texts x trees x hashes
        region = np.broadcast_to(mix(np.arange(TREES, dtype=np.uint64) + np.uint64(77)), (n, TREES))
        for k in range(DEPTH):
            region = mix(region * np.uint64(31) + view[:, :, k])
        deep = (view[:, :, DEPTH:] & np.uint64(0xFFFF)).astype(">u2").reshape(n * TREES, DEEPER)
        size = 2 * DEEPER
        flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), len(deep), [None, pa.py_buffer(deep.tobytes())])
        ids = np.repeat(batch.column(0).to_numpy(), TREES)
        cols = [pa.array(region.reshape(-1).view(np.int64)), flat.cast(pa.binary()), pa.array(ids)]
        yield pa.RecordBatch.from_arrays(cols, names=["region", "deep", "id"])


def _runs(cap: int):
    """Blocks of neighbours in a sorted range of an order.

    A run of texts with the same region is a block if it has at most `cap` texts. A longer run is
    cut where the common prefix ends, one hash deeper at a time and only as deep as it needs;
    texts that share the whole order are cut into blocks of `cap`. A region that a range ends in goes on in
    the next one under the same names, so its blocks have at most twice as many texts.
    """

    def cut(region, deep, lo, hi, depth, name, out, wide):
        if hi - lo <= cap:
            out.append((lo, hi, name, wide))
        elif depth == DEEPER:
            for k, a in enumerate(range(lo, hi, cap)):
                own = mix(np.array([name + np.uint64(k)], dtype=np.uint64))[0] if k else name
                out.append((a, min(hi, a + cap), own, True))
        else:
            column = deep[lo:hi, depth]
            edges = np.flatnonzero(column[1:] != column[:-1]) + lo + 1
            for a, b in zip([lo, *edges], [*edges, hi]):
                own = mix(np.array([name ^ np.uint64((depth + 1) << 20 | int(column[a - lo]))], dtype=np.uint64))[0]
                cut(region, deep, a, b, depth + 1, own, out, True)

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()  # one range, about PART_BYTES
        region = table.column("region").to_numpy().view(np.uint64)
        raw = b"".join(table.column("deep").to_pylist())
        deep = np.frombuffer(raw, dtype=">u2").reshape(len(region), DEEPER)
        ids = table.column("id").to_numpy()
        edges = np.flatnonzero(region[1:] != region[:-1]) + 1
        starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(region)]])
        out = []
        for a, b in zip(starts, ends):
            if b - a > 1 or a == 0 or b == len(region):  # alone in the middle: alone everywhere
                cut(region, deep, a, b, 0, region[a], out, False)
        n = np.array([o[1] - o[0] for o in out], dtype=np.int64)
        rows = np.concatenate([np.arange(o[0], o[1]) for o in out]) if out else np.zeros(0, np.int64)
        block = np.repeat(np.array([o[2] for o in out], dtype=np.uint64), n)
        wide = np.repeat(np.array([o[3] for o in out], dtype=bool), n)
        cols = [ids[rows], block.view(np.int64), region[rows].view(np.int64), wide]
        names = ["id", "block", "region", "wide"]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=names)

    return run


def blocks(reps: DataFrame, cap: int = CAP) -> DataFrame:
    """Candidate blocks of `reps` (id, sig), all orders sorted in one go."""
    n = reps.count() * TREES
    parts = max(int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions")), n * ROW_BYTES // PART_BYTES)
    rows = reps.mapInArrow(_orders, "region bigint, deep binary, id bigint")
    ranged = rows.repartitionByRange(parts, "region", "deep").sortWithinPartitions("region", "deep", "id")
    return ranged.mapInArrow(_runs(cap), "id bigint, block bigint, region bigint, wide boolean")


def near_duplicates(
    docs: DataFrame,
    n_words: int = 5,
    ratio=(80, 100),
    key: str = "doc_id",
    text: str = "text",
    cap: int = CAP,
) -> DataFrame:
    """Per row of `docs`: key, n_shingles, component_id (smallest key reachable by links), kept.

    Two texts are linked if den * |intersection| >= num * |union| of their sets of distinct shingles of
    n_words words (A-Z in lower case; a text with fewer words is one shingle). Equal sets are one
    class, known by its smallest key, and only classes go on. The forest has TREES orders; texts
    that share DEPTH hashes of one of them are candidates, so a pair at Jaccard 0.8 is missed with a
    probability of (1 - 0.8 ** 4) ** 16, or 1 in 4,600, and closer pairs far less. Runs of more than
    `cap` texts are cut deeper; what the cuts separate is compared in the last round of `resolve`.

    NULL, empty and blank texts have an empty set and link with nothing, nor do rows with a NULL key
    (component_id NULL, kept TRUE). The key is the identity of a text: rows that repeat a key with
    the same text are in the same component, each with its own row; where one key has several texts,
    one of them stands for it in links. Other columns are not read.
    """
    sets = materialize(signatures(docs, n_words, key, text), "signatures")
    known = sets.filter(F.col("sig").isNotNull() & F.col(key).isNotNull())
    classes = known.groupBy("set_a", "set_b").agg(F.min(F.struct(key, "sig")).alias("_r"))
    classes = classes.select("set_a", "set_b", F.col(f"_r.{key}").alias("id"), F.col("_r.sig").alias("sig"))
    classes = materialize(classes, "classes")
    texts = docs.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))
    found = resolve(blocks(classes.select("id", "sig"), cap), texts, n_words, ratio, cap)
    named = classes.select("set_a", "set_b", "id").join(found, "id", "left")
    named = named.select("set_a", "set_b", F.coalesce("component", "id").alias("component"))
    component = F.when(F.col(key).isNotNull(), F.coalesce("component", key))
    return (
        sets.drop("sig")
        .join(named, ["set_a", "set_b"], "left")
        .select(key, "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))
    )
