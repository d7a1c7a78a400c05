"""Subword lattice language model: the marginal probability of a text over all its segmentations."""

from __future__ import annotations

import functools
import math
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.wordbytes import Words, slices
from stayline.session import materialize

MODEL = "piece_bpe_32k.model"
MARK = "▁".encode()  # stands before a word
GATHER = 16  # slices whose word counts are put together before they leave a task
COMMON = 1 << 17  # words whose probabilities every task holds
GROUPS = 8  # kinds of text told apart at most; more labels share them
ROUNDS = 3  # re-estimations of the piece probabilities
LONG = 64  # bytes; longer words are worked on one at a time
CHUNK = 20_000
END = ""  # the end of a text, counted as a word


def read_pieces(path: str | None = None) -> list[tuple[bytes, float]]:
    """Pieces of a vocabulary with their log probabilities before any re-estimation.

    The file's scores order the pieces (0, -1, -2, ...), so a piece of score -r gets a probability in
    proportion to 1 / (r + 10). Single bytes are pieces too, which makes every text possible.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(MODEL))
    weight: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
            piece = model.id_to_piece(i).encode()
            weight[piece] = 1 / (10 - model.get_score(i))
    for b in range(256):
        weight.setdefault(bytes([b]), 1 / (10 + len(weight)))
    total = sum(weight.values())
    return [(p, math.log(w / total)) for p, w in weight.items()]


def trie_arcs(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """A trie of pieces over bytes in one row of slots: where each node's slots begin (its arc of a byte is that many
    slots on), the node each slot belongs to, the node it leads to, the piece that ends in each node (-1: none), and
    the longest piece's length. Nodes' slots interlock, so a vocabulary of 32,000 takes about a MB."""
    nodes: dict[tuple[int, int], int] = {}
    ends = []
    for piece in pieces:
        at = 0
        for b in piece:
            at = nodes.setdefault((at, b), len(nodes) + 1)
        ends.append(at)
    arcs: dict[int, list[int]] = {}
    for node, b in nodes:
        arcs.setdefault(node, []).append(b)
    base, taken, low, floor = np.zeros(len(nodes) + 1, dtype=np.int32), 0, 0, 0
    for node in sorted(arcs, key=lambda n: -len(arcs[n])):
        first = min(arcs[node])
        want = sum(1 << (b - first) for b in arcs[node])
        if want == 1:
            at = low = _first_gap(taken, low)
        else:
            at, tries = _first_gap(taken, floor), 0
            while taken >> at & want:
                at, tries = _first_gap(taken, at + 1), tries + 1
                if tries == 40:  # so full that later nodes need not look here; single arcs fill the gaps
                    floor = at
        taken |= want << at
        base[node] = at - first
    owner = np.full(int(base.max(initial=0)) + 512, -1, dtype=np.int32)
    to = np.zeros(len(owner), dtype=np.int32)
    for (node, b), end in nodes.items():
        owner[base[node] + b + 256], to[base[node] + b + 256] = node, end
    ending = np.full(len(nodes) + 1, -1, dtype=np.int32)
    ending[ends] = np.arange(len(pieces))
    return base + 256, owner, to, ending, max(map(len, pieces))


def _first_gap(taken: int, at: int) -> int:
    """The first bit from `at` on that is not set."""
    rest = ~(taken >> at)
    return at + (rest & -rest).bit_length() - 1


class Lattice:
    """Pieces with log probabilities; their trie is walked for many words of one length at a time."""

    def __init__(self, trie, logp: np.ndarray):
        self.base, self.owner, self.to, self.piece, self.longest = trie
        self.logp = np.append(logp, -np.inf)  # the last one for nodes that end no piece

    def _step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The nodes that bytes lead to; -1: none."""
        slot = self.base[node] + byte
        return np.where(self.owner[slot] == node, self.to[slot], -1)

    def _arcs(self, text: np.ndarray):
        """Arcs of words of one length (rows of bytes): (start, end, row, piece), by start and end."""
        n, length = text.shape
        for start in range(length):
            row = np.arange(n)
            node = np.zeros(n, dtype=np.int64)
            for end in range(start, min(length, start + self.longest)):
                node = self._step(node, text[row, end])
                live = node >= 0
                row, node = row[live], node[live]
                if not len(row):
                    break
                piece = self.piece[node]
                known = piece >= 0
                if known.any():
                    yield start, end + 1, row[known], piece[known]

    def forward(self, text: np.ndarray, arcs=None) -> np.ndarray:
        """Log probability of every prefix: log-space sums over all segmentations."""
        alpha = np.full((text.shape[1] + 1, text.shape[0]), -np.inf)
        alpha[0] = 0
        for start, end, row, piece in self._arcs(text) if arcs is None else arcs:
            alpha[end, row] = np.logaddexp(alpha[end, row], alpha[start, row] + self.logp[piece])
        return alpha

    def expected(self, text: np.ndarray, counts: np.ndarray) -> None:
        """Adds to `counts` how often each piece is expected in the words' segmentations."""
        arcs = list(self._arcs(text))
        alpha = self.forward(text, arcs)
        beta = np.full_like(alpha, -np.inf)
        beta[-1] = 0
        for start, end, row, piece in reversed(arcs):
            beta[start, row] = np.logaddexp(beta[start, row], beta[end, row] + self.logp[piece])
        for start, end, row, piece in arcs:
            share = np.exp(alpha[start, row] + self.logp[piece] + beta[end, row] - alpha[-1, row])
            np.add.at(counts, piece, share)

    def _long(self, word: bytes):
        """The same for one long word: its arcs by start, and the log sums before each byte."""
        letters = np.frombuffer(word, np.uint8)
        start = np.arange(len(word))
        node = np.zeros(len(word), dtype=np.int64)
        found = []
        for step in range(min(len(word), self.longest)):
            inside = start + step < len(word)
            start, node = start[inside], node[inside]
            node = self._step(node, letters[start + step])
            start, node = start[node >= 0], node[node >= 0]
            piece = self.piece[node]
            known = piece >= 0
            found.append((start[known], np.full(int(known.sum()), step + 1), piece[known]))
        start, size, piece = (np.concatenate(c) for c in zip(*found))
        order = np.argsort(start, kind="stable")
        arcs = list(zip(start[order].tolist(), size[order].tolist(), piece[order].tolist()))
        alpha = [-math.inf] * (len(word) + 1)
        alpha[0] = 0.0
        for a, n, k in arcs:
            alpha[a + n] = _log_add(alpha[a + n], alpha[a] + self.logp[k])
        return arcs, alpha

    def grouped(self, words: list[bytes]):
        """(positions, matrix of bytes) of marked words of the same length, and None for long ones."""
        marked = [MARK + w for w in words]
        length = np.array([len(w) for w in marked], dtype=np.int64)
        order = np.argsort(length, kind="stable")
        at = 0
        while at < len(order):
            n = length[order[at]]
            if n > LONG:
                yield order[at], None
                at += 1
                continue
            stop = min(at + CHUNK, int(np.searchsorted(length[order], n, side="right")))
            part = order[at:stop]
            yield part, np.frombuffer(b"".join([marked[k] for k in part]), np.uint8).reshape(len(part), n)
            at = stop

    def log_probability(self, words: list[bytes], *others: Lattice) -> np.ndarray:
        """Log of the sum over all segmentations, for each word; with other lattices on the same trie, a row for each."""
        every = (self, *others)
        out = np.empty((len(every), len(words)))
        for at, text in self.grouped(words):
            arcs = None if text is None else list(self._arcs(text))
            for k, lattice in enumerate(every):
                out[k, at] = lattice._long(MARK + words[at])[1][-1] if text is None else lattice.forward(text, arcs)[-1]
        return out if others else out[0]

    def piece_counts(self, words: list[bytes], counts: np.ndarray) -> None:
        """Adds the expected pieces of each word to `counts`."""
        for at, text in self.grouped(words):
            if text is not None:
                self.expected(text, counts)
                continue
            arcs, alpha = self._long(MARK + words[at])
            beta = [-math.inf] * len(alpha)
            beta[-1] = 0.0
            for a, n, k in reversed(arcs):
                beta[a] = _log_add(beta[a], beta[a + n] + self.logp[k])
                counts[k] += math.exp(alpha[a] + self.logp[k] + beta[a + n] - alpha[-1])


def _log_add(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high if low == -math.inf else high + math.log1p(math.exp(low - high))


def learns(key: str = "doc_id"):
    """Rows that the model learns from: crc32 of the id as text, mod 5, is not 1; not rows with a NULL id."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 != 1, F.lit(False))


def _uniques(words: Words, slot: np.ndarray, n_slots: int):
    """Distinct words of a slice and how often each stands in texts of each slot (-1: not counted)."""
    h, first, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
    of = slot[words.row_of()]
    use = of >= 0
    n = np.bincount(inverse[use] * n_slots + of[use], minlength=len(h) * n_slots)
    return h, _take(words, first), n.reshape(len(h), n_slots)


def _take(words: Words, at: np.ndarray) -> pa.Array:
    length = words.end[at] - words.start[at]
    edges = np.concatenate([[0], np.cumsum(length)])
    flat = words.data[np.repeat(words.start[at] - edges[:-1], length) + np.arange(edges[-1])]
    return pa.Array.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(flat.tobytes())]
    )


def learned_groups(docs: DataFrame, key: str, group: str | None) -> tuple[DataFrame | None, int]:
    """((value of `group`, slot), number of slots): all values in the rows to learn from are dealt in turn, the
    most frequent first, to GROUPS slots at most."""
    if group is None:
        return None, 1
    values = docs.filter(learns(key) & F.col(group).isNotNull()).groupBy(F.col(group).alias("_value")).count()
    place = F.row_number().over(Window.orderBy(F.desc("count"), "_value")) - 1  # a row per value, not per text
    values = materialize(values.select("_value", (place % GROUPS).cast("bigint").alias("slot")), "groups")
    return values, max(1, min(GROUPS, values.count()))


def word_counts(
    docs: DataFrame, groups: DataFrame | None = None, slots: int = 1, key: str = "doc_id", text: str = "text", group: str | None = None
) -> DataFrame:
    """(word, c, c0, c1, ...): every word of `docs`, the end included, with its count in the rows to learn
    from, in all and by slot of their group; rows without a group are in the last one."""
    names = [f"c{k}" for k in range(slots)]

    def run(batches):
        held = []

        def flush():
            h, word, n = (list(x) for x in zip(*held))
            _, first, inverse = np.unique(np.concatenate(h), return_index=True, return_inverse=True)
            total = np.zeros((len(first), slots), dtype=np.int64)
            np.add.at(total, inverse, np.concatenate(n))
            word = pa.concat_arrays(word).take(pa.array(first)).cast(pa.binary())
            return pa.RecordBatch.from_arrays([word, *map(pa.array, total.T.copy())], names=["word", *names])

        for batch in batches:
            for part in slices(batch, text):
                held.append(_uniques(Words(part.column(text)), part.column("slot").to_numpy(), slots))
                if len(held) == GATHER:
                    yield flush()
                    held.clear()
        if held:
            yield flush()

    if groups is None:
        rows = docs.select(F.col(f"`{text}`"), learns(key).alias("_l"), F.lit(slots - 1).cast("bigint").alias("slot"))
    else:
        rows = docs.select(F.col(f"`{text}`"), learns(key).alias("_l"), F.col(group).alias("_value")).join(groups, "_value", "left")
    slot = F.when(F.col("_l"), F.coalesce("slot", F.lit(slots - 1))).otherwise(-1)
    rows = rows.select(text, slot.cast("bigint").alias("slot"))
    words = rows.mapInArrow(run, ", ".join(["word binary", *[f"{c} bigint" for c in names]]))
    ends = rows.select(
        F.lit(END).cast("binary").alias("word"),
        *[(F.col("slot") == k).cast("bigint").alias(c) for k, c in enumerate(names)],
    )
    counts = words.unionByName(ends).groupBy("word").agg(*[F.sum(c).alias(c) for c in names])
    return counts.withColumn("c", F.expr(" + ".join(names)))


def fit_pieces(words: DataFrame, trie, logp: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Log probabilities of the pieces, re-estimated on all distinct words that were learned.

    Each round spreads every word over its segmentations by the present probabilities (forward and
    backward) and counts the pieces. Words count once each, as the lattice has to answer for those that
    are rare or new. The counts have a row per piece at most, whatever the input.
    """
    known = words.filter((F.col("c") > 0) & (F.length("word") > 0)).select("word")
    for _ in range(rounds):
        shared = words.sparkSession.sparkContext.broadcast(logp)

        def run(batches, shared=shared):
            lattice = Lattice(trie.value, shared.value)
            counts = np.zeros(len(lattice.logp) - 1)
            for batch in batches:
                lattice.piece_counts(batch.column(0).to_pylist(), counts)
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["piece", "n"])

        rows = known.mapInArrow(run, "piece bigint, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        counts = np.full(len(logp), 0.01)
        for r in rows:
            counts[r["piece"]] += r["n"]
        logp = np.log(counts / counts.sum())
    return logp


def word_scores(words: DataFrame, slots: int, path: str | None = None) -> tuple[DataFrame, dict]:
    """`words` with `base`, `plain` and, for each group, the log10 probability of the word (m0, m1, ...).

    `plain` is the word's marginal over all segmentations by the vocabulary's own scores.
    In a group a word keeps its count less a discount (absolute discounting, from how many words were
    seen once and twice); what the discounts leave goes to all strings by their lattice probability.
    """
    names = [f"c{k}" for k in range(slots)]
    made = [f"m{k}" for k in range(slots)]
    stats = words.agg(
        F.sum("c").alias("n"),
        F.count(F.when(F.col("c") > 0, 1)).alias("v"),
        F.count(F.when(F.col("c") == 1, 1)).alias("once"),
        F.count(F.when(F.col("c") == 2, 1)).alias("twice"),
        *[F.sum(c).alias(f"n_{c}") for c in names],
        *[F.count(F.when(F.col(c) > 0, 1)).alias(f"v_{c}") for c in names],
        *[F.max(F.when(F.length("word") == 0, F.col(c))).alias(f"e_{c}") for c in ["c", *names]],
    ).first()
    n, v = stats["n"] or 0, stats["v"]
    discount = min(0.95, max(0.05, stats["once"] / max(1, stats["once"] + 2 * stats["twice"])))
    size = np.array([stats[f"n_{c}"] or 0 for c in names], dtype=np.float64)
    left = (discount * np.array([stats[f"v_{c}"] for c in names]) + 1) / (size + 1)
    pieces = read_pieces(path)
    context = words.sparkSession.sparkContext
    trie = context.broadcast(trie_arcs([p for p, _ in pieces]))
    start = np.array([s for _, s in pieces])
    shared = context.broadcast((start, fit_pieces(words, trie, start)))

    def run(batches):
        plain, lattice = (Lattice(trie.value, logp) for logp in shared.value)
        for batch in batches:
            spelled, given = lattice.log_probability(batch.column(0).to_pylist(), plain)
            total = batch.column(1).to_numpy()
            base = np.log10((total + 0.5) / (n + 0.5 * (v + 1)))
            cols = [batch.column(0), batch.column(1), pa.array(base), pa.array(given / math.log(10))]
            for k in range(slots):
                kept = np.maximum(batch.column(2 + k).to_numpy() - discount, 0) / (size[k] + 1)
                with np.errstate(divide="ignore"):
                    both = np.logaddexp(np.log(kept), math.log(left[k]) + spelled)
                cols.append(pa.array(both / math.log(10)))
            yield pa.RecordBatch.from_arrays(cols, names=["word", "c", "base", "plain", *made])

    ddl = ", ".join(["word binary, c bigint, base double, plain double", *[f"{m} double" for m in made]])
    scored = words.select("word", "c", *names).mapInArrow(run, ddl)
    ends = np.array([stats[f"e_{c}"] or 0 for c in names], dtype=np.float64)
    end = {
        "base": math.log10(((stats["e_c"] or 0) + 0.5) / (n + 0.5 * (v + 1))),
        "model": np.log10(np.maximum(ends - discount, 0.5) / (size + 1)).tolist(),
        "known": int((stats["e_c"] or 0) > 0),
    }
    prior = np.log10((ends + 0.5) / (ends + 0.5).sum()).tolist()  # share of the texts learned
    return scored, {"train_tokens": int(n), "end": end, "prior": prior}


def score(
    docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text", group: str | None = None
) -> DataFrame:
    """Per row: key, held_out, n_tokens, n_known, train_tokens, base_score, lattice_score, score.

    Words are runs other than white space, A-Z in lower case, and one end per text. base_score is the
    unigram score of the learned counts; score is log10 of the marginal probability of the text: over all
    segmentations of its words, and over the groups (values of `group`, such as the language) that the
    text may belong to, by their share of the texts learned. lattice_score is the marginal of the words by the
    vocabulary's own scores alone, without the end. The group is read from rows that are learned,
    never from a row that is scored. All counts cover all rows; every word is scored once, wherever it stands.

    The COMMON most frequent words go to every task with their scores (a table of fixed size), the other
    words of a text meet theirs in a join, in which no word is frequent.

    NULL and empty texts have their end as the only token. A row with a NULL key is not learned from and
    is not held out. Repeated rows are scored alike, each on its own; other columns are not read. An
    empty table gives an empty result, and if nothing is learned all words are unknown.
    """
    groups, slots = learned_groups(docs, key, group)
    kinds = [f"m{k}" for k in range(slots)]
    made = ["plain", *kinds]
    words, totals = word_scores(materialize(word_counts(docs, groups, slots, key, text, group), "words"), slots, path)
    words = materialize(words.filter(F.length("word") > 0), "word-scores")
    docs = docs.select(F.monotonically_increasing_id().alias("print"), F.col(f"`{key}`"), F.col(f"`{text}`"))
    table = _most_common(words).select("word", "base", *made).toPandas()  # COMMON rows at most
    blob = b"\n".join(bytes(w) for w in table["word"])
    numbers = table[["base", *made]].to_numpy("float64").T.tobytes()
    shared = docs.sparkSession.sparkContext.broadcast((blob, numbers))
    end = totals["end"]
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        common = _common(*shared.value)
        for batch in batches:
            for part in slices(batch, text):
                yield from _split(part, common, key, text, end)

    cast = F.col(key).cast("string").cast("binary")
    held_out = F.coalesce(F.crc32(cast) % 5 == 1, F.lit(False))
    parts = docs.withColumn("held_out", held_out).mapInArrow(
        run,
        f"`{key}` {kind}, held_out boolean, print bigint, word binary, times bigint, n_tokens bigint, "
        + ", ".join(["n_known bigint, base double", *[f"{m} double" for m in made]]),
    )
    found = words.select("word", "c", *[F.col(c).alias(f"w_{c}") for c in ["base", *made]])
    joined = parts.join(found, "word", "left")
    rare_known = F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0))
    return (
        joined.groupBy(key, "held_out", "print")
        .agg(
            F.max("n_tokens").alias("n_tokens"),
            (F.max("n_known") + rare_known).alias("n_known"),
            F.lit(totals["train_tokens"]).cast("bigint").alias("train_tokens"),
            *[F.sum(F.coalesce(F.col(f"w_{c}") * F.col("times"), F.col(c))).alias(c) for c in ["base", *made]],
        )
        .withColumns({m: F.col(m) + F.lit(p) for m, p in zip(kinds, totals["prior"])})
        .withColumn("_top", F.greatest(*kinds, *kinds[:1]))
        .withColumn("score", F.col("_top") + F.log10(sum(F.pow(F.lit(10.0), F.col(m) - F.col("_top")) for m in kinds)))
        .withColumnsRenamed({"base": "base_score", "plain": "lattice_score"})
        .drop("print", "_top", *kinds)
    )


def _most_common(words: DataFrame) -> DataFrame:
    """The words from a count on, the least count for which they are COMMON at most.

    Counts are binned in steps of about 1 % (a few thousand bins, whatever the input).
    """
    level = F.floor(F.log2("c") * 64)
    known = words.filter("c > 0").withColumn("_level", level)
    bins = sorted(known.groupBy("_level").count().collect(), reverse=True)
    sums = np.cumsum([b["count"] for b in bins])
    fit = [b["_level"] for b, n in zip(bins, sums) if n <= COMMON]
    return known.filter(F.col("_level") >= (fit[-1] if fit else 1 << 20))


@functools.lru_cache(maxsize=1)
def _common(blob: bytes, numbers: bytes):
    hashes = Words(pa.array([blob], pa.large_binary())).hash
    order = np.argsort(hashes)
    values = np.frombuffer(numbers).reshape(-1, len(hashes)) if len(hashes) else np.zeros((0, 0))
    return hashes[order], values[:, order] if len(hashes) else values


def _split(part: pa.RecordBatch, common, key: str, text: str, end: dict):
    """A row per text with the sums of its end and common words, and a row per text and other word.

    The first ones get a word of their own that no text has (0xFF is not UTF-8, then the row's
    number), so that they go through the join without meeting one another.
    """
    words = Words(part.column(text))
    n = part.num_rows
    row = words.row_of()
    unique, first, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
    hashes, values = common
    at = np.minimum(np.searchsorted(hashes, unique), max(0, len(hashes) - 1))
    is_common = hashes[at] == unique if len(hashes) else np.zeros(len(unique), dtype=bool)
    token = is_common[inverse]
    r, w = row[token], at[inverse[token]]
    ends = [end["base"], 0.0, *end["model"]]
    sums = [np.bincount(r, values[k][w], n) + e if len(r) else np.full(n, e) for k, e in enumerate(ends)]
    own = [b"\xff" + int(p).to_bytes(8, "little", signed=True) for p in part.column("print").to_pylist()]
    made = ["plain", *[f"m{k}" for k in range(len(end["model"]))]]
    names = [key, "held_out", "print", "word", "times", "n_tokens", "n_known", "base", *made]
    heads = [part.column(c) for c in names[:3]]
    yield pa.RecordBatch.from_arrays(
        [
            *heads,
            pa.array(own, pa.binary()),
            pa.nulls(n, pa.int64()),
            pa.array(words.counts + 1),
            pa.array(np.bincount(r, minlength=n) + end["known"]),
            *map(pa.array, sums),
        ],
        names=names,
    )
    pairs, times = np.unique(row[~token] * len(unique) + inverse[~token], return_counts=True)
    if len(pairs):
        rows, other = np.divmod(pairs, len(unique))
        keys = pa.array(rows)
        yield pa.RecordBatch.from_arrays(
            [
                *[c.take(keys) for c in heads],
                _take(words, first[other]).cast(pa.binary()),
                pa.array(times.astype(np.int64)),
                *[pa.nulls(len(pairs), pa.int64())] * 2,
                *[pa.nulls(len(pairs), pa.float64())] * len(sums),
            ],
            names=names,
        )
