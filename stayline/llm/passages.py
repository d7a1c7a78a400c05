"""Substring dedup: near-equal paragraphs by MinHash banding, and long passages inside paragraphs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.linking import CAP, resolve
from stayline.llm.wordbytes import Words, mix, raw_bytes, sequence_ids, shingles, slices
from stayline.session import materialize, outer_scratch, scratch_scope

BLOCK_WORDS = 6  # of several lines; five one-word lines, a list of equal items say, make one shingle only
WINDOW = 24  # words of a passage inside paragraphs
SPAN = 14  # of so many neighbouring windows one is looked up at least
MAX_HASHES = 32
_STEP = np.uint64(0xD1342543DE82EF95)


def tune_bands(similarity: float = 0.8, recall: float = 0.999, hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band, so the fewest collisions, that still reach the recall."""
    for rows in range(hashes, 0, -1):
        for bands in range(1, hashes // rows + 1):
            if 1 - (1 - similarity**rows) ** bands >= recall:
                return bands, rows
    return hashes, 1


def _lines(part: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(row, start, end in bytes of the row, text) of every line."""
    data, offsets = raw_bytes(part.column(text))
    cuts = np.flatnonzero(data == 0x0A)
    starts = np.unique(np.concatenate([offsets[:-1], cuts + 1]))
    starts = starts[starts < len(data)]
    row = np.searchsorted(offsets, starts, side="right") - 1
    stop = np.append(starts[1:], len(data))
    stop = np.minimum(stop, offsets[row + 1])
    edges = np.append(starts, len(data)).astype(np.int64)
    lines = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(data.tobytes())]
    )
    return row, starts - offsets[row], stop - offsets[row], lines


def _texts(data: pa.Array, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes of ascending ranges of the bytes behind `data` that do not overlap."""
    edges = np.stack([start, end], axis=1).reshape(-1).astype(np.int64)
    both = pa.Array.from_buffers(pa.large_binary(), max(0, len(edges) - 1), [None, pa.py_buffer(edges), data.buffers()[2]])
    return both.take(pa.array(np.arange(0, max(0, len(edges) - 1), 2)))


def _paragraphs(part, text: str, least: int):
    """(row, start, end, block, texts, words) of the lines of at least `least` words, and of the blocks of several
    lines between blank ones."""
    row, start, end, lines = _lines(part, text)
    words = Words(lines)
    base = words.offsets
    full = words.counts > 0
    long = np.flatnonzero(words.counts >= least)
    # A block begins at a line with words that follows a blank one or another text.
    joined = full[1:] & full[:-1] & (row[1:] == row[:-1])
    head = np.flatnonzero(full & ~np.append(False, joined)[: len(full)])
    tail = np.flatnonzero(full & ~np.append(joined, False)[: len(full)])
    some = (tail > head) & (words.row[tail + 1] - words.row[head] >= max(least, BLOCK_WORDS))
    head, tail = head[some], tail[some]
    first, last = np.concatenate([long, head]), np.concatenate([long, tail])
    texts = pa.concat_arrays([_texts(lines, base[a], base[b + 1]) for a, b in ((long, long), (head, tail))])
    block = np.arange(len(first)) >= len(long)
    return row[first], start[first], end[last], block, texts, words.spans(first, last + 1)


def paragraphs(docs: DataFrame, key: str, text: str, least: int, n_words: int, bands: int, rows: int) -> DataFrame:
    """(key, _hash, start, end, block, id, bands) of every paragraph (line or block) of at least `least` words; id stands
    for its words, _hash is that of `docs`. Of equal paragraphs of a slice the first has the bands."""
    factors = mix(np.arange(1, bands * rows + 1, dtype=np.uint64)) | np.uint64(1)

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                row, start, end, block, _, words = _paragraphs(part, text, least)
                if not len(row):
                    continue
                ids = sequence_ids(words)
                first = np.unique(ids, return_index=True)[1]
                some = words.spans(first, first + 1)
                of, hashes = shingles(some, n_words)  # in row order: no paragraph is shorter than a shingle
                at = np.searchsorted(of, np.arange(len(first)))
                band = np.empty((len(first), bands), dtype=np.uint64)
                for b in range(bands):
                    x = np.full(len(first), b + 1, dtype=np.uint64)
                    for k in range(rows):
                        x = mix(x * np.uint64(31) + np.minimum.reduceat(hashes * factors[b * rows + k], at))
                    band[:, b] = x
                n = np.zeros(len(row), dtype=np.int32)
                n[first] = bands
                edges = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                rows_of = pa.array(row)
                band = band[np.argsort(first)]  # in the order of the rows that have them
                cols = [
                    part.column(key).take(rows_of),
                    part.column("_hash").take(rows_of),
                    pa.array(start.astype(np.int32)),
                    pa.array(end.astype(np.int32)),
                    pa.array(block),
                    pa.array(ids.view(np.int64)),
                    pa.ListArray.from_arrays(edges, band.reshape(-1).view(np.int64)),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=[key, "_hash", "start", "end", "block", "id", "bands"])

    return docs.mapInArrow(
        run, f"`{key}` bigint, _hash bigint, start int, end int, block boolean, id bigint, bands array<bigint>"
    )


def paragraph_texts(docs: DataFrame, text: str, least: int) -> DataFrame:
    """(id, text) of the same paragraphs, each distinct one of a slice once."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                row, _, _, _, texts, words = _paragraphs(part, text, least)
                if len(row):
                    ids, first = np.unique(sequence_ids(words), return_index=True)
                    texts = texts.take(pa.array(first)).cast(pa.large_string()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(ids.view(np.int64)), texts], names=["id", "text"])

    return docs.select(f"`{text}`").mapInArrow(run, "id bigint, text string")


def band_blocks(bands: DataFrame, cap: int = CAP) -> DataFrame:
    """Candidates of `bands` (id, region), as `resolve` takes them; full bands are dealt to several blocks.

    Bands of one id, which are most, go first: their least and greatest id are the same.
    """
    shared = bands.groupBy("region").agg(F.min("id").alias("_lo"), F.max("id").alias("_hi"))
    shared = shared.filter("_lo < _hi").select("region")
    met = materialize(bands.join(shared, "region").distinct(), "met-bands")
    full = met.groupBy("region").agg(F.count(F.lit(1)).alias("n"))
    met = met.join(full, "region")
    salt = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / cap))
    wide = F.col("n") > 2 * cap
    block = F.when(wide, F.xxhash64("region", salt)).otherwise(F.col("region"))
    return met.select("id", block.alias("block"), "region", wide.alias("wide"))


def _marks(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every window of `size` words that lies in one text."""
    n = len(words.hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    power = np.full(len(words.hash), _STEP, dtype=np.uint64)
    back = np.full(len(words.hash), pow(int(_STEP), -1, 1 << 64), dtype=np.uint64)
    power[0] = back[0] = 1
    power, back = np.cumprod(power), np.cumprod(back)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.hash * power)])
    mark = mix((sums[size:] - sums[:-size]) * back[:n])
    row = words.row_of()
    inside = np.flatnonzero(row[:n] == row[size - 1 :])
    return inside, mark[inside]


def windows(docs: DataFrame, key: str, text: str, size: int = WINDOW, span: int = SPAN) -> DataFrame:
    """(key, _hash, at, mark): windows of `size` words of each text, `at` their first word, with a hash of their words.

    Of any `span` neighbouring windows the one with the least hash is taken, wherever they stand; so
    two texts that share a run of size + span - 1 words take the same window of it.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                words = Words(part.column(text))
                inside, mark = _marks(words, size)
                if not len(inside):
                    continue
                row = words.row_of()[inside]
                # Texts are kept apart by gaps, so that a choice depends on one text only.
                spot = np.arange(len(inside)) + (np.cumsum(np.diff(row, prepend=row[0]) > 0) + 1) * span
                line = np.full(spot[-1] + span, np.uint64(0xFFFFFFFFFFFFFFFF))
                line[spot] = mark
                view = np.lib.stride_tricks.sliding_window_view(line, span)
                picked = np.unique(view.argmin(axis=1) + np.arange(len(view)))
                at = np.flatnonzero(np.isin(spot, picked))
                cols = [
                    part.column(key).take(pa.array(row[at])),
                    part.column("_hash").take(pa.array(row[at])),
                    pa.array((inside[at] - words.row[row[at]]).astype(np.int32)),
                    pa.array(mark[at].view(np.int64)),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=[key, "_hash", "at", "mark"])

    return docs.mapInArrow(run, f"`{key}` bigint, _hash bigint, at int, mark bigint")


def windows_near(docs: DataFrame, key: str, text: str, size: int = WINDOW, span: int = SPAN) -> DataFrame:
    """(key, _hash, start, end, mark): all windows of `size` words that begin less than `span` words from one of `hits`
    (array of first words) of their text."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                words = Words(part.column(text))
                inside, mark = _marks(words, size)
                hits = part.column("hits")
                n = hits.value_lengths().to_numpy(zero_copy_only=False)
                low, high = np.repeat(words.row[:-1], n), np.repeat(words.row[1:], n)  # a hit reaches into no other text
                hit = low + hits.flatten().to_numpy(zero_copy_only=False)
                edge = np.zeros(len(words.hash) + 1, dtype=np.int64)
                np.add.at(edge, np.clip(hit - span + 1, low, high), 1)
                np.add.at(edge, np.clip(hit + span, low, high), -1)
                row = words.row_of()
                keep = np.cumsum(edge)[inside] > 0
                at = inside[keep]
                if not len(at):
                    continue
                cols = [
                    part.column(key).take(pa.array(row[at])),
                    part.column("_hash").take(pa.array(row[at])),
                    pa.array((words.start[at] - words.offsets[row[at]]).astype(np.int32)),
                    pa.array((words.end[at + size - 1] - words.offsets[row[at]]).astype(np.int32)),
                    pa.array(mark[keep].view(np.int64)),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=[key, "_hash", "start", "end", "mark"])

    return docs.mapInArrow(run, f"`{key}` bigint, _hash bigint, start int, end int, mark bigint")


def shared_marks(marks: DataFrame, key: str) -> DataFrame:
    """(mark, first) of the marks of several texts, with their smallest key."""
    shared = marks.groupBy("mark").agg(F.min(key).alias("first"), F.max(key).alias("last"))
    return shared.filter("first < last").select("mark", "first")


def repeats(docs: DataFrame, n_words: int = 5, ratio=(80, 100), key: str = "doc_id", text: str = "text", least: int = 0) -> DataFrame:
    """(key, _hash, start, end, first): byte spans of the text with this key and hash (xxhash64) that repeat a passage
    of the text with the smaller key `first`.

    Paragraphs are lines, and blocks of several lines between blank ones. All that have a shingle (n_words words; blocks
    BLOCK_WORDS) and at least `least` words are compared as sets of n_words-word shingles: bands tuned for a recall of 0.999 at Jaccard 0.8 give candidates, exact Jaccard decides, and each component
    stays in the text with its smallest key only. Runs of words that stand in paragraphs of
    other texts are found by windows of WINDOW words, equal word for word; a run of 37 words or more
    (WINDOW + SPAN - 1) that two texts share is found as a whole, to its first and last word, wherever it stands in them.
    """
    docs = docs.select(F.col(f"`{key}`").cast("bigint").alias(key), F.col(f"`{text}`").alias(text))
    docs = docs.filter(F.col(key).isNotNull()).withColumn("_hash", F.xxhash64(text))
    with scratch_scope(docs.sparkSession):  # what is written on the way goes when the spans are written
        near = _near_paragraphs(docs, n_words, ratio, key, text, max(least, n_words))
        equal = _equal_windows(docs, key, text)
        with outer_scratch():
            return materialize(near.unionByName(equal), "spans")


def _near_paragraphs(docs: DataFrame, n_words: int, ratio, key: str, text: str, least: int) -> DataFrame:
    bands, rows = tune_bands(ratio[0] / ratio[1])
    with scratch_scope(docs.sparkSession):
        spans = materialize(paragraphs(docs, key, text, least, n_words, bands, rows), "paragraphs")
        found = resolve(band_blocks(spans.select("id", F.explode("bands").alias("region"))), paragraph_texts(docs, text, least), n_words, ratio)
        # A paragraph without a component is alone of its words' kind or has equal ones only.
        named = spans.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
        least_key = named.groupBy("component").agg(F.min(key).alias("first"), F.max(key).alias("_last")).filter("first < _last")
        near = named.join(least_key.drop("_last"), "component").filter(F.col(key) > F.col("first"))
        with outer_scratch():
            near = materialize(near.select(key, "_hash", "start", "end", "block", "component", "first"), "near")
    # A block that is like others for one of its lines goes with that line only; its other lines are its own.
    line = near.filter("not block").select(key, "_hash", "component", F.col("start").alias("_s"), F.col("end").alias("_e"))
    inner = (F.col("_s") >= F.col("start")) & (F.col("_e") <= F.col("end"))
    same = [F.col(f"b.{c}") == F.col(f"l.{c}") for c in (key, "_hash", "component")]
    near = near.alias("b").join(line.alias("l"), [*same, inner & F.col("block")], "left_anti")
    return near.select(key, "_hash", "start", "end", "first")


def _equal_windows(docs: DataFrame, key: str, text: str) -> DataFrame:
    # Texts that share a run of WINDOW + SPAN - 1 words pick a common window less than SPAN words from either end of it;
    # so all windows about the picked ones that several texts have, looked up once more, cover the whole run.
    by = [key, "_hash"]
    with scratch_scope(docs.sparkSession):
        marks = materialize(windows(docs, key, text), "marks")
        hits = marks.join(shared_marks(marks, key).select("mark"), "mark").groupBy(by).agg(F.collect_set("at").alias("hits"))
        with outer_scratch():
            close = materialize(windows_near(docs.join(hits, by), key, text), "windows")
    return close.join(shared_marks(close, key), "mark").filter(F.col(key) > F.col("first")).select(*by, "start", "end", "first")


def remove_repeats(docs: DataFrame, n_words: int = 5, ratio=(80, 100), key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of `docs`, the text without the spans that `repeats` finds, and n_removed (spans after
    joining those that touch), removed_bytes, first_docs (keys of the texts that keep the passages).

    Removed lines go with their line end. NULL and empty texts, texts without repeats and rows with a NULL
    key stay as they are (n_removed 0). Rows that repeat a key are copies of one document to this operator: each
    is cut by the spans found in its own text, and none for what it shares with the others of its key only.
    Columns with these names are replaced.
    """
    made = ["n_removed", "removed_bytes", "first_docs"]
    base = docs.drop(*made)
    found = repeats(base, n_words, ratio, key, text)
    found = found.groupBy(F.col(key).alias("_k"), "_hash").agg(
        F.collect_set(F.shiftleft(F.col("start").cast("bigint"), 32).bitwiseOR(F.col("end"))).alias("_spans"), F.array_sort(F.collect_set("first")).alias("first_docs")
    )
    own = (base[key].cast("bigint") == F.col("_k")) & (F.xxhash64(base[text]) == F.col("_hash"))
    joined = base.join(found, own, "left").drop("_k")
    rest = [c for c in base.columns if c != text]
    kinds = {f.name: f.dataType.simpleString() for f in base.schema}

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                out, n_cut, size = [], [], []
                for words, cuts in zip(part.column(text).to_pylist(), _joined(part.column("_spans"))):
                    new, n, gone = cut(words, cuts)
                    out.append(new)
                    n_cut.append(n)
                    size.append(gone)
                first = part.column("first_docs")
                cols = [part.column(c) for c in rest]
                cols += [pa.array(out, pa.string()), pa.array(n_cut, pa.int64()), pa.array(size, pa.int64()), first]
                yield pa.RecordBatch.from_arrays(cols, names=[*rest, text, *made])

    ddl = ", ".join(f"`{c}` {kinds[c]}" for c in [*rest, text])
    done = joined.select(*[f"`{c}`" for c in [*rest, text]], "_spans", "first_docs").mapInArrow(
        run, f"{ddl}, n_removed bigint, removed_bytes bigint, first_docs array<bigint>"
    )
    return done.select(*[f"`{c}`" for c in base.columns], *made)


def _joined(spans: pa.Array) -> list[list[dict]]:
    """The spans (start << 32 | end) of each row, those that overlap or touch as one."""
    n = pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False)
    out = [[] for _ in n]
    code = spans.flatten().to_numpy(zero_copy_only=False)
    if not len(code):
        return out
    row = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((code, row))
    row, start, end = row[order], code[order] >> 32, code[order] & 0xFFFFFFFF
    reach = np.maximum.accumulate(end + (row << 32))  # a later row begins beyond all ends of the ones before
    first = np.flatnonzero(np.append(True, start[1:] + (row[1:] << 32) > reach[:-1]))
    last = np.append(first[1:], len(code)) - 1
    for r, s, e in zip(row[first].tolist(), start[first].tolist(), (reach[last] & 0xFFFFFFFF).tolist()):
        out[r].append({"start": s, "end": e})
    return out


def cut(text: str | None, spans) -> tuple[str | None, int, int]:
    """The text without byte spans, the number of separate cuts, and the bytes that went."""
    if not text or not spans:
        return text, 0, 0
    raw = text.encode()
    merged = []
    for start, end in sorted((s["start"], min(s["end"], len(raw))) for s in spans):
        if start >= len(raw):
            continue
        if merged and (start <= merged[-1][1] or not raw[merged[-1][1] : start].strip()):
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    kept, at = [], 0
    for start, end in merged:
        kept.append(raw[at:start])
        at = end
    kept.append(raw[at:])
    new = b"".join(kept).decode()
    return new if new.strip() else "", len(merged), sum(e - s for s, e in merged)
