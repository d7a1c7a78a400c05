"""Conversation prefix trie: grouped by digests of blocks of turns first, refined by turns where siblings part."""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.session import materialize

BLOCK = 4  # turns of a block
MOST_HEAD = 9  # `regraft` takes fewer turns than this from another conversation
FAMILY = 5  # conversations whose ids share a multiple of this are grafted on the one that has it
NODE = ["depth", "k1", "k2"]


def turns_of(table: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, depth, a, b, bytes): the turns of each conversation, numbered from 1, known by 128 bits of
    their role and text; bytes is the text's size in UTF-8.

    Turns stand in the order of `order`, NULL first; turns that share a place are ordered by role and digest.
    NULL roles and texts are empty; rows with a NULL conversation are left out. Texts do not leave their
    task. A conversation is numbered in one sorted stream, which spills and holds no turns.
    """
    who, said = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = table.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("conv_id"),
        F.col(order).alias("_at"),
        who.alias("_role"),
        F.xxhash64(F.lit(1), who, said).alias("a"),
        F.xxhash64(F.lit(2), said, who).alias("b"),
        F.octet_length(said).cast("bigint").alias("bytes"),
    )
    sort = Window.partitionBy("conv_id").orderBy(F.col("_at").asc_nulls_first(), "_role", "a", "b")
    return rows.withColumn("depth", F.row_number().over(sort).cast("bigint")).select("conv_id", "depth", "a", "b", "bytes")


def regraft(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt as (turns, conversations (conv_id, n)): the first h turns of conversation c are
    those of c - c % FAMILY (all, if fewer; none, if absent), then come its own after its first h, where h is
    crc32 of c as text, mod MOST_HEAD. A conversation may come out without turns."""
    own = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_HEAD
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    convs = own.withColumns({"_h": head, "_base": base})
    stems = own.filter(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("_base"), F.col("_n").alias("_m"))
    convs = convs.join(stems, "_base", "left").withColumn("_head", F.least("_h", F.coalesce("_m", F.lit(0))))
    convs = convs.withColumn("n", F.col("_head") + F.greatest(F.col("_n") - F.col("_h"), F.lit(0)))
    convs = materialize(convs.select("conv_id", "_base", "_h", "_head", "n"), "conversations")
    # A stem gives MOST_HEAD - 1 turns at most, to FAMILY conversations at most.
    stem = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("depth") < MOST_HEAD)).withColumnRenamed("conv_id", "_base")
    cols = ["conv_id", "n", "depth", "a", "b", "bytes"]
    grafted = convs.join(stem, "_base").filter("depth <= _h").select(cols)
    rest = turns.join(convs, "conv_id").filter("depth > _h").withColumn("depth", F.col("_head") + F.col("depth") - F.col("_h"))
    return grafted.unionByName(rest.select(cols)), convs.select("conv_id", "n")


def _xor(column: str, over) -> Column:
    return F.bit_xor(column).over(over)


def _segments(turns: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """(turns with their block and marks, (conv_id, n, block, s1, s2, last, e1, e2)): a row per conversation and block,
    with the digests of all turns before the block and up to its last turn.

    A digest is the xor of a hash of each turn and its place, so digests of blocks add up in any order.
    """
    marked = turns.withColumns(
        {
            "block": F.floor((F.col("depth") - 1) / block),
            "x1": F.xxhash64("a", "b", "depth"),
            "x2": F.xxhash64("depth", "b", "a", F.lit(3)),
        }
    )
    marked = materialize(marked.select("conv_id", "n", "block", "depth", "x1", "x2", "bytes"), "turns")
    parts = marked.groupBy("conv_id", "block").agg(
        F.max("n").alias("n"), F.max("depth").alias("last"), F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2")
    )
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = parts.withColumns({"e1": _xor("x1", before), "e2": _xor("x2", before)})
    ends = ends.withColumns({"s1": F.col("e1").bitwiseXOR(F.col("x1")), "s2": F.col("e2").bitwiseXOR(F.col("x2"))})
    return marked, ends.select("conv_id", "n", "block", "s1", "s2", "last", "e1", "e2")


def _nodes(marked: DataFrame, segments: DataFrame) -> DataFrame:
    """(depth, k1, k2, path, n_convs, conv_id, bytes) of all nodes but the root; `path` has the digests
    from the block's start down to the node.

    Conversations with an equal block on equal ones form a class, which only its smallest member stands for.
    A class without siblings has the same members at each of its turns; siblings are grouped turn by turn.
    """
    by = ["block", "s1", "s2"]
    classes = segments.groupBy(*by, "last", "e1", "e2").agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"))
    classes = materialize(classes, "blocks")
    parted = classes.groupBy(*by).agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1").select(*by)
    kept = classes.select("conv_id", *by, "n_convs")
    # The classes that share a start with many others lie in one hash range: Spark's skew join deals them out.
    kept = kept.join(parted.withColumn("parted", F.lit(True)), by, "left")
    rows = marked.drop("n").join(kept, ["conv_id", "block"])
    down = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns(
        {"k1": F.col("s1").bitwiseXOR(_xor("x1", down)), "k2": F.col("s2").bitwiseXOR(_xor("x2", down))}
    ).withColumn("_keys", F.collect_list(F.struct(*NODE)).over(down))
    first = F.struct((F.get("_keys", F.lit(0))["depth"] - 1).alias("depth"), F.col("s1").alias("k1"), F.col("s2").alias("k2"))
    rows = rows.withColumn("path", F.concat(F.array(first), "_keys"))
    rows = materialize(rows.select(*NODE, "block", "path", "n_convs", "conv_id", "bytes", "parted"), "turn-nodes")
    cols = [*NODE, "block", "path", "n_convs", "conv_id", "bytes"]
    refined = rows.filter("parted").groupBy(*NODE).agg(
        F.any_value("block").alias("block"),
        F.min("path").alias("path"),
        F.sum("n_convs").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.max("bytes").alias("bytes"),
    )
    return rows.filter("parted is null").select(cols).unionByName(refined.select(cols))


def _subtrees(nodes: DataFrame, block: int) -> list[tuple[int, DataFrame]]:
    """Sums of leaves and saved over the subtrees of nodes with several members: per block, from the deepest
    up, (depth of its start, (depth, k1, k2, leaves, saved)).

    `nodes` has what a node brings itself. A node adds to the nodes of its path, and what reaches the
    block's start goes on in the round above; one round per block of the deepest shared turn.
    """
    shared = nodes.filter("n_convs > 1 and depth > 0").select(*NODE, "block", "path", "leaves", "saved")
    levels = [r["block"] for r in shared.select("block").distinct().orderBy(F.desc("block")).collect()]  # one per BLOCK turns
    up, done = None, []
    for level in levels:
        own = shared.filter(F.col("block") == level).select(*NODE, "path", "leaves", "saved")
        if up is not None:
            below = up.select(*NODE, F.col("leaves").alias("_l"), F.col("saved").alias("_s"))
            own = own.join(below, NODE, "left").withColumns(
                {"leaves": F.col("leaves") + F.coalesce("_l", F.lit(0)), "saved": F.col("saved") + F.coalesce("_s", F.lit(0))}
            )
        summed = own.select(F.explode("path").alias("_p"), "leaves", "saved").groupBy(*[F.col(f"_p.{c}").alias(c) for c in NODE])
        up = materialize(summed.agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "subtrees")
        done.append((level * block, up))
    return done


def _ends(segments: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of the nodes in which conversations end.

    Ids of a node are put in order by ranges over all nodes and joined to pieces there; the pieces, far fewer,
    are hashed in their order one after the other and never held together.
    """
    ends = segments.filter("last = n").select("conv_id", F.col("last").alias("depth"), F.col("e1").alias("k1"), F.col("e2").alias("k2"))
    none = convs.filter("n = 0").select("conv_id", F.lit(0).cast("bigint").alias("depth"), *[F.lit(0).cast("bigint").alias(c) for c in ("k1", "k2")])
    ends = materialize(ends.unionByName(none), "ends")
    counts = ends.groupBy(*NODE).agg(F.count(F.lit(1)).alias("_n"), F.min("conv_id").alias("_one"))
    counts = materialize(counts, "end-counts")
    one = counts.filter("_n = 1").select(*NODE, F.sha2(F.col("_one").cast("string"), 256).alias("ends_sha256"))
    many = ends.join(counts.filter("_n > 1").select(*NODE), NODE)
    many = many.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id").select(*NODE, "conv_id")
    pieces = many.mapInArrow(_pieces, "depth bigint, k1 bigint, k2 bigint, first bigint, piece string")
    pieces = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return one.unionByName(pieces.mapInArrow(_hashes, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string"))


def _pieces(batches):
    """Decimal ids of neighbours that share a node, joined by commas."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(k).to_numpy() for k in range(3)]
        change = (keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1]) | (keys[2][1:] != keys[2][:-1])
        starts = [0, *(change.nonzero()[0] + 1).tolist()]
        ids = pc.cast(batch.column(3), pa.string())
        lists = pa.ListArray.from_arrays(pa.array([*starts, batch.num_rows], pa.int32()), ids)
        at = pa.array(starts)
        cols = [*[batch.column(k).take(at) for k in range(4)], pc.binary_join(lists, ",")]
        yield pa.RecordBatch.from_arrays(cols, names=[*NODE, "first", "piece"])


def _hashes(batches):
    """SHA-256 over each node's pieces, in order."""
    node, state = None, None

    def result():
        values = [*node, state.hexdigest()]
        types = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=[*NODE, "ends_sha256"])

    for batch in batches:
        for *key, _, piece in zip(*[batch.column(k).to_pylist() for k in range(5)]):
            if key != node:
                if node is not None:
                    yield result()
                node, state = key, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
    if node is not None:
        yield result()


def trie(turns: DataFrame, convs: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """A row per distinct sequence of first turns (`turns` as of `turns_of`; `convs` with conv_id and n, where
    some may have no turns): conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    Members of a node are the conversations that begin with its turns; the root has them all. n_leaves counts the
    nodes without children in its subtree, saved_tokens sums (n_convs - 1) x bytes of the last text there, and
    ends_sha256 is the hash of the ids that end in it, in order, joined by commas. Sequences are known by 128
    bits. Copies collapse to a class per block before anything else, so a conversation that a third of
    all rows repeat is one row from there on. A node with one member has one leaf and saves nothing, so only
    nodes with several are summed. Without conversations the result is empty.
    """
    if convs is None:
        convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
        turns = turns.join(convs, "conv_id")
    marked, segments = _segments(turns, block)
    segments = materialize(segments, "segments")
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0")
    zero = F.lit(0).cast("bigint")
    nothing = F.lit(None).cast("array<struct<depth:bigint,k1:bigint,k2:bigint>>")
    root = root.select(*[zero.alias(c) for c in NODE], zero.alias("block"), nothing.alias("path"), "n_convs", "conv_id", zero.alias("bytes"))
    nodes = materialize(_nodes(marked, segments).unionByName(root), "nodes")

    parent = F.element_at("path", -2)
    named = nodes.select(F.struct(*[parent[c].alias(c) for c in NODE]).alias("_p"), "n_convs").filter("_p.depth is not null")
    children = named.groupBy(*[F.col(f"_p.{c}").alias(c) for c in NODE]).agg(
        F.count(F.lit(1)).alias("n_children"), F.count(F.when(F.col("n_convs") == 1, 1)).alias("_alone")
    )
    own = nodes.join(children, NODE, "left").fillna(0, ["n_children", "_alone"])
    own = own.withColumns(
        {
            "leaves": F.when(F.col("n_children") == 0, 1).otherwise(F.col("_alone")).cast("bigint"),
            "saved": (F.col("n_convs") - 1) * F.col("bytes"),
        }
    )
    own = materialize(own.drop("_alone"), "own-nodes")
    # Below its start a block's sums are whole; at the start only those of the last round are, the root's.
    total = own.filter("false").select(*NODE, "leaves", "saved")
    for start, sums in _subtrees(own, block):
        total = total.unionByName(sums.filter((F.col("depth") > start) | (F.col("depth") == 0)))
    result = own.join(total.select(*NODE, F.col("leaves").alias("_l"), F.col("saved").alias("_s")), NODE, "left")
    at_root = F.col("depth") == 0
    result = result.withColumns(
        {
            "n_leaves": F.when(at_root, F.coalesce("_l", F.lit(0)) + F.col("leaves")).otherwise(F.coalesce("_l", F.lit(1))),
            "saved_tokens": F.coalesce("_s", F.lit(0)),
        }
    )
    above = nodes.select(*[F.col(c).alias(f"_{c}") for c in NODE], F.col("conv_id").alias("parent_conv_id"))
    on = [parent[c] == F.col(f"_{c}") for c in NODE]
    result = result.join(above, on, "left").join(_ends(segments, convs), NODE, "left")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return result.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.col("n_children").cast("bigint").alias("n_children"),
        F.col("n_leaves").cast("bigint").alias("n_leaves"),
        F.col("saved_tokens").cast("bigint").alias("saved_tokens"),
        F.coalesce("ends_sha256", empty).alias("ends_sha256"),
    )
