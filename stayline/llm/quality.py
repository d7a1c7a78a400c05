"""Quality classifier: hashed word n-grams, logistic regression by FTRL, sparse dot products."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.wordbytes import WORD_OR_SIGNS, Words, mix, slices
from stayline.session import materialize

BITS = 18  # 2 ** BITS weights
MAX_ROWS = 20_000  # labelled rows that a fit takes at most, about; scoring covers all rows
SHARDS = 8  # at most so many fits run side by side, of SHARD_ROWS rows or more, and are averaged
SHARD_ROWS = 500
EPOCHS = 3


def ngram_slots(column: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Row offsets and feature slots of all texts: words, pairs of neighbours, and outlines of both.

    Words are runs of letters and digits or of other signs, as written (case counts). The outline
    of a word is its kinds of signs at both ends and its length up to 12; that of a pair (neighbours,
    or words with one between) is that both are the same word.
    """
    w = Words(column, lower=False, kinds=WORD_OR_SIGNS)
    shift = np.uint64(64 - bits)
    row = w.row_of()
    pair = mix(w.hash[:-1] * np.uint64(3) + w.hash[1:]) if len(w.hash) else w.hash
    same = row[:-1] == row[1:]
    kind = _OUTLINE[w.data].astype(np.uint64)
    length = np.minimum(w.end - w.start, 12).astype(np.uint64)
    if len(w.hash):
        outline = mix(kind[w.start] * np.uint64(1009) + kind[w.end - 1] * np.uint64(31) + length * np.uint64(65537))
    else:
        outline = w.hash
    rows, hashes = [row, row[:-1][same], row], [w.hash, pair[same], outline]
    for gap in (1, 2):
        again = (w.hash[gap:] == w.hash[:-gap]) & (row[gap:] == row[:-gap])
        rows.append(row[gap:][again])
        hashes.append(np.full(int(again.sum()), mix(np.array([gap], dtype=np.uint64))[0]))
    rows, slot = np.concatenate(rows), (np.concatenate(hashes) >> shift).astype(np.int64)
    order = np.argsort(rows, kind="stable")
    return np.searchsorted(rows[order], np.arange(len(w.row))), slot[order]


# Kind of a byte for outlines: digit, capital, small letter, above ASCII, or the sign itself.
_OUTLINE = np.arange(256, dtype=np.uint8)
_OUTLINE[0x30:0x3A] = 1
_OUTLINE[0x41:0x5B] = 2
_OUTLINE[0x61:0x7B] = 3
_OUTLINE[0x80:] = 4


class Ftrl:
    """Logistic regression by follow-the-regularised-leader updates, one row at a time."""

    def __init__(self, size: int, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.1, l2: float = 0.1):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)  # the last slot is the bias
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        step = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / step)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
        before = self.n[at]
        self.n[at] = before + g * g
        self.z[at] += g - (np.sqrt(before + g * g) - np.sqrt(before)) / self.alpha * w


def _row(slots: np.ndarray, bias: int) -> tuple[np.ndarray, np.ndarray]:
    at, count = np.unique(slots, return_counts=True)
    return np.append(at, bias), np.append(count / np.sqrt(max(1, len(slots))), 1.0)


def fit(labelled: DataFrame, text: str = "text", label: str = "label", order: str = "order", bits: int = BITS) -> np.ndarray:
    """Weights (2 ** bits, then the bias) from rows with a 0/1 label.

    `labelled` must be bounded (`bounded_sample`); `order` is a seeded number that deals the rows to
    at most SHARDS tasks and sorts them there. Each task makes EPOCHS passes of FTRL over its rows; the
    weights are averaged. Without rows all weights are 0.
    """
    size = 1 << bits

    def run(key, pdf):
        pdf = pdf.sort_values(order)
        texts = pa.RecordBatch.from_arrays([pa.array(pdf[text], pa.string())], names=[text])
        rows = []
        for part in slices(texts, text):
            at, slots = ngram_slots(part.column(text), bits)
            rows += [_row(slots[a:b], size) for a, b in zip(at, at[1:])]
        model = Ftrl(size)
        for _ in range(EPOCHS):
            for (idx, x), y in zip(rows, pdf[label]):
                model.learn(idx, x, int(y))
        weights = model.weights().astype(np.float32).tobytes()
        return type(pdf)({"rows": [len(rows)], "weights": [weights]})

    n = max(1, min(SHARDS, labelled.count() // SHARD_ROWS))
    shards = (
        labelled.withColumn("_shard", F.pmod(F.col(order), F.lit(n)))
        .groupBy("_shard")
        .applyInPandas(run, "rows bigint, weights binary")
        .collect()  # SHARDS rows of fixed size
    )
    total = np.zeros(size + 1)
    for r in shards:
        total += np.frombuffer(r["weights"], dtype=np.float32) * r["rows"]
    return (total / max(1, sum(r["rows"] for r in shards))).astype(np.float32)


def bounded_sample(labels: DataFrame, key: str = "doc_id", max_rows: int = MAX_ROWS, seed: int = 2) -> DataFrame:
    """About `max_rows` rows of `labels`, chosen by a seeded hash of the key; all, if there are no more."""
    n = labels.count()
    h = F.xxhash64(F.lit(seed), F.col(key))
    picked = labels.withColumn("order", F.shiftrightunsigned(h, 1))
    if n <= max_rows:
        return picked
    return picked.filter(F.col("order") < int(max_rows / n * 2**63))


def score(
    docs: DataFrame, weights: np.ndarray, text: str = "text", threshold: float = 0.3, keep_text: bool = False
) -> DataFrame:
    """All columns of `docs` (the text on demand), with score and predicted: one dot product per row.

    Every text is read whole. NULL and empty texts get the score of the bias alone.
    """
    bits = (len(weights) - 1).bit_length() - 1
    shared = docs.sparkSession.sparkContext.broadcast(weights.tobytes())  # 2 ** bits floats
    made = ["score", "predicted"]
    rest = [c for c in docs.columns if (keep_text or c != text) and c not in made]

    def run(batches):
        w = np.frombuffer(shared.value, dtype=np.float32).astype(np.float64)
        for batch in batches:
            for part in slices(batch, text):
                at, slots = ngram_slots(part.column(text), bits)
                sums = np.concatenate([[0], np.cumsum(w[slots])])
                n = np.maximum(1, np.diff(at))
                dots = (sums[at[1:]] - sums[at[:-1]]) / np.sqrt(n) + w[-1]
                p = 1 / (1 + np.exp(-np.clip(dots, -35, 35)))
                cols = [part.column(c) for c in rest]
                cols += [pa.array(p), pa.array((p >= threshold).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(cols, names=[*rest, *made])

    ddl = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in rest]
    return docs.select(*[f"`{c}`" for c in dict.fromkeys([*rest, text])]).mapInArrow(
        run, ", ".join([*ddl, "score double", "predicted int"])
    )


def held_out(key: str = "doc_id"):
    """Rows whose labels are never learned: crc32 of the id as text, mod 5, is 0. FALSE for a NULL id."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> np.ndarray:
    """Fit on the labelled texts that are not held out. NULL labels and labels without a text are left
    out; a key with several rows on either side counts once per pair of rows."""
    known = labels.select(F.col(key), F.col("quality").cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & F.col(key).isNotNull() & ~held_out(key)
    )
    chosen = bounded_sample(known, key)
    # About MAX_ROWS ids at most, whatever the input.
    return fit(materialize(docs.select(key, text).join(F.broadcast(chosen), key), "labelled"))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` without the text, scored; scores come from the texts alone."""
    return score(docs, train(docs, labels, key, text), text)
