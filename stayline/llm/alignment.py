"""Alignment of two tokenizers' tokens by byte ranges: fragments of chunks, composed by an associative product."""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
import re
from array import array
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm.bytebpe import byte_characters, ragged
from stayline.llm.wordbytes import slices
from stayline.session import materialize

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK = 32 << 10  # bytes of a chunk; longer texts are dealt to several tasks
SLICE = 256 << 10  # bytes of short texts worked on at a time
FAN = 16  # fragments that a task composes in a round
PIECE = 4 << 10  # characters of the listing of groups that travel as one row, about
HELD = 1 << 21  # pairs whose counts a task holds before it hands them on
COMMON = 1 << 17  # pairs whose counts every task holds; the others meet theirs in a join
SPACE = "▁"
WORDS = re.compile(r"(?<=\S) (?=\S)")
WORDS_HELD, CHARS_HELD = 200_000, 4_000_000  # words that a task remembers the ids of


class Aligner:
    """Both tokenizers, with each entry's bytes. Token ends are byte offsets into space + text."""

    def __init__(self, file_a: bytes, file_b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_buffer(file_a)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=file_b)
        back = {c: b for b, c in enumerate(byte_characters())}
        pieces = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            pieces[i] = bytes([back[c] for c in token]) if all(c in back for c in token) else token.encode()
        self.bytes_a = self._table(pieces)
        pieces = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            pieces.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode())
        self.bytes_b = self._table(pieces)
        self.digits = self._table([b"%d," % i for i in range(max(self.a.get_vocab_size(), len(pieces)))])
        self._forget()

    @staticmethod
    def _table(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(rows), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in rows])])

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.fine, self.chars = bytearray(), 0
        self.sides = [(array("i"), array("q", [0])) for _ in "ab"]  # ids, and where each word's ids end

    def _learn(self, words: list[str]) -> None:
        """Encodes words that are not known yet; which ones come back as they were is kept beside their ids.

        Words without white space at their ends are encoded as one text; if that comes back changed, one by one.
        """
        joins = [w for w in words if not (w[0].isspace() or w[-1].isspace() or SPACE in w)]
        alone = sorted(set(words).difference(joins))
        if joins:
            raw = (" " + " ".join(joins)).encode()
            ends = np.cumsum([1 + len(w.encode()) for w in joins])
            sides = []
            for (ids, _), table in zip(self._both([" ".join(joins)]), (self.bytes_a, self.bytes_b)):
                upto = np.cumsum(np.diff(table[1])[ids])
                at = np.searchsorted(upto, ends) + 1
                if ragged(*table, ids).tobytes() != raw or not np.array_equal(upto[at - 1], ends):
                    alone, joins = words, []
                    break
                sides.append((ids, at))
            else:
                self._keep(joins, sides, np.ones(len(joins), dtype=bool))
        if alone:
            fine = np.ones(len(alone), dtype=bool)
            sides = self._both(alone)
            for (ids, at), table in zip(sides, (self.bytes_a, self.bytes_b)):
                joined = ragged(*table, ids).tobytes()
                upto = np.concatenate([[0], np.cumsum(np.diff(table[1])[ids])])[np.concatenate([[0], at])].tolist()
                fine &= np.array([joined[x:y] == (" " + w).encode() for w, x, y in zip(alone, upto, upto[1:])])
            self._keep(alone, sides, fine)

    def _both(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of A and B: ids of all texts side by side, and where each text's ids end."""
        found_a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        out = []
        for found in (found_a, self.b.encode(texts, num_threads=1)):
            at = np.cumsum([len(f) for f in found])
            out.append((np.fromiter(itertools.chain.from_iterable(found), np.int32, at[-1]), at))
        return out

    def _keep(self, words: list[str], sides, fine: np.ndarray) -> None:
        for (new, at), (ids, ends) in zip(sides, self.sides):
            ends.frombytes((at.astype(np.int64) + len(ids)).tobytes())
            ids.frombytes(new.tobytes())
        self.known.update(zip(words, range(len(self.fine), len(self.fine) + len(words))))
        self.fine += fine.tobytes()
        self.chars += sum(map(len, words))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, Tokens, np.ndarray]:
        """(whether both tokenizers give the bytes of space + text back, the tokens of those that do, where each text ends).

        The texts stand side by side; one that is empty or comes back changed has no bytes and no tokens. No
        token crosses a single space between two signs, so a text's tokens are those of its words, and a
        word is encoded once as long as it is remembered; what is remembered has a size limit and changes no result.
        """
        words = [WORDS.split(t) if t else [] for t in texts]
        new = set(itertools.chain.from_iterable(words)).difference(self.known)
        if len(self.known) + len(new) > WORDS_HELD or self.chars > CHARS_HELD:
            self._forget()
            new = set(itertools.chain.from_iterable(words))
        if new:
            self._learn(sorted(new))
        n = [len(w) for w in words]
        rows = np.fromiter(map(self.known.__getitem__, itertools.chain.from_iterable(words)), np.int64, sum(n))
        of = np.repeat(np.arange(len(texts)), n)
        ok = np.array(n) > 0
        ok[of[np.frombuffer(bytes(self.fine), dtype=bool)[rows] == 0]] = False
        size = np.array([1 + len(t.encode()) if o else 0 for t, o in zip(texts, ok)], dtype=np.int64)
        rows = rows[ok[of]]
        out = []
        for (ids, ends), table in zip(self.sides, (self.bytes_a, self.bytes_b)):
            some = ragged(np.array(ids, dtype=np.int32), np.array(ends, dtype=np.int64), rows).astype(np.int64)
            out += [some, np.cumsum(np.diff(table[1])[some])]
        return ok, Tokens(*out), np.cumsum(size)


class Tokens(NamedTuple):
    """Ids and byte ends of both tokenizers' tokens, in order."""

    a: np.ndarray
    ends_a: np.ndarray
    b: np.ndarray
    ends_b: np.ndarray

    @classmethod
    def none(cls) -> Tokens:
        return cls(*[np.zeros(0, np.int64)] * 4)

    def within(self, low: int, high: int) -> Tokens:
        """The tokens that end behind `low` and at `high` at the latest."""
        out = []
        for ids, ends in ((self.a, self.ends_a), (self.b, self.ends_b)):
            lo, hi = np.searchsorted(ends, [low, high], side="right")
            out += [ids[lo:hi], ends[lo:hi]]
        return Tokens(*out)

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*map(np.concatenate, zip(self, other)))

    def cuts(self) -> np.ndarray:
        """Where tokens of both end."""
        return np.intersect1d(self.ends_a, self.ends_b, assume_unique=True)

    def links(self, n_b: int) -> tuple[np.ndarray, np.ndarray]:
        """(end, pair) of every two tokens whose byte ranges overlap; pair is id of a * n_b + id of b.

        Two ranges overlap in one run of bytes without a token's end inside, and each run lies in one of each.
        """
        ends = np.union1d(self.ends_a, self.ends_b)
        a = self.a[np.searchsorted(self.ends_a, ends)]
        return ends, a * n_b + self.b[np.searchsorted(self.ends_b, ends)]

    def listing(self, digits) -> tuple[bytes, np.ndarray]:
        """Groups as `a1,a2|b1;a3|b2,b3;` and how many characters each takes; the tokens are whole groups."""
        cuts = self.cuts()
        of_a, of_b = np.searchsorted(cuts, self.ends_a), np.searchsorted(cuts, self.ends_b)
        n_a, n_b = np.bincount(of_a, minlength=len(cuts)), np.bincount(of_b, minlength=len(cuts))
        before_a, before_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        order = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        order[np.arange(len(self.a)) + before_b[of_a]] = self.a
        order[np.arange(len(self.b)) + (before_a + n_a)[of_b]] = self.b
        stop = np.cumsum(np.diff(digits[1])[order])
        text = ragged(*digits, order).copy()
        last_b = np.cumsum(n_a + n_b)
        text[stop[last_b - n_b - 1] - 1] = ord("|")
        text[stop[last_b - 1] - 1] = ord(";")
        return text.tobytes(), np.diff(np.concatenate([[0], stop[last_b - 1]]))


class Fragment(NamedTuple):
    """A byte range of a text: tokens up to its first cut, closed groups, and tokens behind its last cut.

    `open` ranges have no cut, all their tokens are the prefix. A text's first range begins at a cut and so has
    an empty prefix and is never open. `joints` are the groups that composing has closed: (number of the range
    that holds the group's end, its tokens).
    """

    ok: bool
    open: bool
    n_a: int
    n_b: int
    n_groups: int
    prefix: Tokens
    suffix: Tokens
    joints: tuple = ()

    def then(self, right: Fragment, number: int) -> Fragment:
        """The range of both, `right` (that begins with range `number`) directly behind this one. Associative."""
        ok, n_a, n_b = self.ok and right.ok, self.n_a + right.n_a, self.n_b + right.n_b
        n, joints = self.n_groups + right.n_groups, self.joints + right.joints
        if not ok:
            return Fragment(False, False, n_a, n_b, 0, Tokens.none(), Tokens.none())
        if self.open:
            return Fragment(ok, right.open, n_a, n_b, n, self.prefix + right.prefix, right.suffix, joints)
        if right.open:
            return Fragment(ok, False, n_a, n_b, n, self.prefix, self.suffix + right.prefix, joints)
        middle = self.suffix + right.prefix
        if len(middle.a):
            n, joints = n + 1, self.joints + ((number, middle),) + right.joints
        return Fragment(ok, False, n_a, n_b, n, self.prefix, right.suffix, joints)


def fragment(tokens: Tokens, ok: bool, first: bool) -> tuple[Fragment, Tokens]:
    """The fragment of a range's tokens, and the tokens of its closed groups."""
    if not ok:
        return Fragment(False, False, 0, 0, 0, Tokens.none(), Tokens.none()), Tokens.none()
    cuts, far = tokens.cuts(), 1 << 62
    n_a, n_b = len(tokens.a), len(tokens.b)
    if not len(cuts):
        some = (Tokens.none(), tokens) if first else (tokens, Tokens.none())
        return Fragment(True, not first, n_a, n_b, 0, *some), Tokens.none()
    low = -1 if first else cuts[0]
    closed = tokens.within(low, cuts[-1])
    return Fragment(True, False, n_a, n_b, len(cuts) - (not first), tokens.within(-1, low), tokens.within(cuts[-1], far)), closed


@functools.lru_cache(maxsize=1)
def _aligner(file_a: bytes, file_b: bytes) -> Aligner:
    return Aligner(file_a, file_b)


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def safe_points(raw: np.ndarray) -> np.ndarray:
    """Places in a text (its bytes) that no token of either tokenizer crosses: 0, and single spaces between
    two signs that are surely no white space (some signs near Unicode's white space are left out as well)."""
    if len(raw) < 3:
        return np.zeros(1, dtype=np.int64)
    middle = np.flatnonzero(raw[1:-1] == 0x20) + 1
    before, after = raw[middle - 1], raw[middle + 1]
    blank = lambda x: (x <= 0x20) | (x == 0x7F)
    wide = (0xE1, 0xE2, 0xE3)
    odd = blank(before) | blank(after) | np.isin(after, (0xC2, *wide))
    odd |= (before >= 0x80) & ((raw[middle - 2] == 0xC2) | np.isin(raw[np.maximum(middle - 3, 0)], wide))
    return np.concatenate([[0], middle[~odd]])


def chunk_ranges(raw: np.ndarray, size: int) -> list[tuple[int, int, int, int]]:
    """(low, high, from, to) of ranges of about `size` bytes, cut anywhere, and the stretch between safe points that
    has to be encoded to know the range's tokens. A range has a safe point, so stretches reach into neighbours only."""
    safe, n = safe_points(raw), len(raw)
    edges = [0]
    for edge in range(size, n, size):
        if np.searchsorted(safe, edge) > np.searchsorted(safe, edges[-1]):
            edges.append(edge)
    out = []
    for low, high in zip(edges, [*edges[1:], n]):
        start = int(safe[np.searchsorted(safe, low, side="right") - 1])
        stop = int(np.searchsorted(safe, high))
        out.append((low, high, start, int(safe[stop]) if stop < len(safe) else n))
    return out


def _chunks(key: str, text: str, size: int, key_type):
    """A row per range of a long text (space + text): _row, key, seq, low, high, start, part."""

    def run(batches):
        names = ["_row", key, "seq", "low", "high", "start", "part"]
        for batch in batches:
            for k in range(batch.num_rows):
                raw = (" " + batch.column(text)[k].as_py()).encode()
                ranges = chunk_ranges(np.frombuffer(raw, dtype=np.uint8), size)
                for at in range(0, len(ranges), 64):
                    some = ranges[at : at + 64]
                    low, high, start, stop = (pa.array(x, pa.int64()) for x in zip(*some))
                    parts = pa.array([raw[a:b].decode() for *_, a, b in some], pa.string())
                    seq = pa.array(range(at, at + len(some)), pa.int64())
                    one = batch.column("_row")[k].as_py(), batch.column(key)[k].as_py()
                    heads = [pa.array([v] * len(some), batch.column(c).type) for v, c in zip(one, ("_row", key))]
                    yield pa.RecordBatch.from_arrays([*heads, seq, low, high, start, parts], names=names)

    return run


def _lists(rows: list[np.ndarray], kind=pa.int64()) -> pa.Array:
    edges = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(edges), pa.array(flat).cast(kind))


def _runs(rows: list[Tokens]) -> pa.Array:
    return pa.StructArray.from_arrays([_lists([getattr(t, f) for t in rows]) for f in Tokens._fields], names=list(Tokens._fields))


RUN = "struct<a:array<bigint>,ends_a:array<bigint>,b:array<bigint>,ends_b:array<bigint>>"
COUNTED = "pairs array<bigint>, times array<int>"
FRAGMENT = f"_row bigint, seq bigint, ok boolean, open boolean, n_a bigint, n_b bigint, n_groups bigint, prefix {RUN}, suffix {RUN}"


def _short(files, key: str, text: str):
    """Results of texts that are worked on whole, with their distinct pairs and how often each is linked."""

    def run(batches):
        aligner = _aligner(*files.value)
        n_b = aligner.b.get_piece_size()
        for batch in batches:
            for part in slices(batch, text, SLICE):
                n = part.num_rows
                ok, tokens, ends = aligner.encode(part.column(text).fill_null("").to_pylist())
                edges = np.concatenate([[0], ends])
                of = lambda x: np.diff(np.searchsorted(x, edges, side="right"))
                cuts = tokens.cuts()
                link_end, pair = tokens.links(n_b)
                row = np.searchsorted(ends, link_end)
                base = np.int64(int(pair.max()) + 1) if len(pair) else np.int64(1)
                cells, times = np.unique(row * base + pair, return_counts=True)
                at = np.searchsorted(cells, np.arange(n + 1) * base).astype(np.int32)
                listing, sizes = tokens.listing(aligner.digits) if len(cuts) else (b"", np.zeros(0, np.int64))
                upto = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(cuts, edges, side="right")]
                sha = [hashlib.sha256(listing[a : b - 1]).hexdigest() if o else "" for o, a, b in zip(ok, upto, upto[1:])]
                cols = [part.column("_row"), part.column(key)]
                cols += [pa.array(x.astype(np.int64)) for x in (of(tokens.ends_a), of(tokens.ends_b), of(cuts), of(link_end))]
                cols.append(pa.array(sha, pa.string()))
                cols.append(pa.ListArray.from_arrays(pa.array(at), pa.array(cells % base)))
                cols.append(pa.ListArray.from_arrays(pa.array(at), pa.array(times.astype(np.int32))))
                names = ["_row", key, "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def _counted(tokens: Tokens, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(tokens.links(n_b)[1], return_counts=True) if len(tokens.a) else (np.zeros(0, np.int64),) * 2


def _pieces(tokens: Tokens, digits) -> list[str]:
    """The listing of whole groups, in pieces of about PIECE characters."""
    if not len(tokens.a):
        return []
    text, sizes = tokens.listing(digits)
    ends = np.cumsum(sizes)
    marks = np.unique(np.append(ends[np.searchsorted(ends, np.arange(PIECE, len(text), PIECE))], len(text)))
    return [text[a:b].decode() for a, b in zip([0, *marks], marks)]


def _fragments(files):
    """The fragment of each chunk, with the listing and the pairs of its closed groups."""

    def run(batches):
        aligner = _aligner(*files.value)
        n_b = aligner.b.get_piece_size()
        for batch in batches:
            for one in slices(batch, "part", SLICE):
                rows, closed = [], []
                seq, low, high, start = (one.column(c).to_numpy() for c in ("seq", "low", "high", "start"))
                for k, text in enumerate(one.column("part").to_pylist()):
                    ok, t, _ = aligner.encode([text[1:]])
                    t = Tokens(t.a, t.ends_a + start[k], t.b, t.ends_b + start[k]).within(low[k], high[k])
                    f, whole = fragment(t, bool(ok[0]), seq[k] == 0)
                    rows.append(f)
                    closed.append(whole)
                counted = [_counted(t, n_b) for t in closed]
                cols = [one.column("_row"), one.column("seq")]
                cols += [pa.array([f[k] for f in rows]) for k in range(5)]
                cols += [_runs([f.prefix for f in rows]), _runs([f.suffix for f in rows])]
                cols.append(pa.array([_pieces(t, aligner.digits) for t in closed], pa.list_(pa.string())))
                cols += [_lists([c[0] for c in counted]), _lists([c[1] for c in counted], pa.int32())]
                names = ["_row", "seq", "ok", "open", "n_a", "n_b", "n_groups", "prefix", "suffix", "pieces", "pairs", "times"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def _compose(table: pa.Table) -> pa.Table:
    """One row for the fragments of a row that share seq div FAN."""

    def tokens(x) -> Tokens:
        return Tokens(*[np.array(x[f], dtype=np.int64) for f in Tokens._fields])

    rows = sorted(table.to_pylist(), key=lambda r: r["seq"])
    whole = None
    for r in rows:
        joints = tuple((j["number"], tokens(j["run"])) for j in r["joints"])
        f = Fragment(r["ok"], r["open"], r["n_a"], r["n_b"], r["n_groups"], tokens(r["prefix"]), tokens(r["suffix"]), joints)
        # A joint closes in the range where the right fragment's first cut is: it has the number of that range.
        whole = f if whole is None else whole.then(f, r["cut"])
    first_cut = next((r["cut"] for r in rows if not r["open"]), rows[-1]["cut"])
    numbers = pa.array([n for n, _ in whole.joints], pa.int64())
    joint = pa.StructArray.from_arrays([numbers, _runs([t for _, t in whole.joints])], names=["number", "run"])
    cols = [pa.array([x]) for x in (rows[0]["_row"], rows[0]["seq"] // FAN, first_cut, *whole[:5])]
    cols += [_runs([whole.prefix]), _runs([whole.suffix])]
    cols.append(pa.ListArray.from_arrays(pa.array([0, len(numbers)], pa.int32()), joint))
    names = ["_row", "seq", "cut", "ok", "open", "n_a", "n_b", "n_groups", "prefix", "suffix", "joints"]
    return pa.Table.from_arrays(cols, names=names)


def reduce_fragments(fragments: DataFrame) -> DataFrame:
    """One row per text from its fragments, by rounds that compose FAN neighbours each."""
    ddl = FRAGMENT.replace("seq bigint,", "seq bigint, cut bigint,") + f", joints array<struct<number:bigint,run:{RUN}>>"
    names = [c.split()[0] for c in FRAGMENT.split(", ")]
    joints = F.array().cast(f"array<struct<number:bigint,run:{RUN}>>")
    level = fragments.select(*names).withColumns({"cut": F.col("seq"), "joints": joints})
    most = fragments.agg(F.max("seq")).first()[0] or 0
    while True:
        dealt = level.withColumn("_group", F.floor(F.col("seq") / FAN))
        composed = dealt.groupBy("_row", "_group").applyInArrow(lambda t: _compose(t.drop_columns(["_group"])), ddl)
        level, most = materialize(composed, "fragments"), most // FAN
        if not most:
            return level


def _joints(files):
    """(_row, seq, pieces, pairs, times) of the groups that composing has closed."""

    def run(batches):
        aligner = _aligner(*files.value)
        n_b = aligner.b.get_piece_size()
        for batch in batches:
            rows, found = [], []
            for r in batch.to_pylist():
                for j in r["joints"]:
                    rows.append((r["_row"], j["number"]))
                    found.append(Tokens(*[np.array(j["run"][f], dtype=np.int64) for f in Tokens._fields]))
            if rows:
                counted = [_counted(t, n_b) for t in found]
                cols = [pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)]
                cols.append(pa.array([_pieces(t, aligner.digits) for t in found], pa.list_(pa.string())))
                cols += [_lists([c[0] for c in counted]), _lists([c[1] for c in counted], pa.int32())]
                yield pa.RecordBatch.from_arrays(cols, names=["_row", "seq", "pieces", "pairs", "times"])

    return run


def _hashes(batches):
    """SHA-256 of each row's pieces, in order, without the last separator."""
    row, state = None, None
    out = []
    for batch in batches:
        for r, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if r != row:
                if row is not None:
                    out.append((row, state.hexdigest()))
                row, state = r, hashlib.sha256()
            else:
                state.update(b";")
            state.update(piece[:-1].encode())
        if len(out) > 1000:
            yield _hash_rows(out)
            out = []
    if row is not None:
        out.append((row, state.hexdigest()))
    if out:
        yield _hash_rows(out)


def _hash_rows(out):
    return pa.RecordBatch.from_arrays(
        [pa.array([r for r, _ in out], pa.int64()), pa.array([h for _, h in out], pa.string())], names=["_row", "groups_sha256"]
    )


def _tally(batches):
    """In how many rows each pair stands; counts of a task are put together before they leave it."""
    pairs, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        new, count = np.unique(batch.column(0).flatten().to_numpy(), return_counts=True)
        both, inverse = np.unique(np.concatenate([pairs, new]), return_inverse=True)
        n = np.bincount(inverse, np.concatenate([n, count]), minlength=len(both)).astype(np.int64)
        pairs = both
        if len(pairs) > HELD:
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], names=["pair", "n"])
            pairs, n = pairs[:0], n[:0]
    if len(pairs):
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], names=["pair", "n"])


def pair_counts(short: DataFrame, long: DataFrame, n_b: int) -> DataFrame:
    """(pair, n, best): in how many texts each pair is linked, and whether no pair of its id of a is in more.

    `short` has each text's distinct pairs, `long` those of parts of texts.
    """
    counted = short.select("pairs").mapInArrow(_tally, "pair bigint, n bigint")
    parts = long.select("_row", F.explode("pairs").alias("pair")).distinct()
    counts = counted.unionByName(parts.groupBy("pair").agg(F.count(F.lit(1)).alias("n")))
    counts = materialize(counts.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    of = F.floor(F.col("pair") / n_b).alias("_a")
    top = counts.groupBy(of).agg(F.max("n").alias("_top"))  # a row per vocabulary entry at most
    marked = counts.withColumn("_a", of).join(F.broadcast(top), "_a").select("pair", "n", (F.col("n") == F.col("_top")).alias("best"))
    return materialize(marked, "pair-marks")


def _most_common(counts: DataFrame) -> DataFrame:
    """The pairs from a count on, the least count for which they are COMMON at most (counts in steps of about 1 %)."""
    leveled = counts.withColumn("_level", F.floor(F.log2("n") * 64))
    bins = sorted(leveled.groupBy("_level").count().collect(), reverse=True)  # a few thousand, whatever the input
    sums = np.cumsum([b["count"] for b in bins])
    fit = [b["_level"] for b, n in zip(bins, sums) if n <= COMMON]
    return leveled.filter(F.col("_level") >= (fit[-1] if fit else 1 << 20)).select("pair", "n", "best")


def _with_sums(rows: DataFrame, counts: DataFrame, by: str) -> DataFrame:
    """`rows` (by: a number of its own, pairs, times, other columns) with n_best and count_sum in place of the pairs.

    The COMMON most frequent pairs go to every task (a table of fixed size); the others of a text meet their
    counts in a join, in which no pair is frequent.
    """
    table = _most_common(counts).orderBy("pair").toPandas()  # COMMON rows at most
    shared = rows.sparkSession.sparkContext.broadcast(tuple(table[c].to_numpy().tobytes() for c in ("pair", "n", "best")))
    keep = [c for c in rows.columns if c not in ("pairs", "times")]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches):
        pair, n, best = (np.frombuffer(x, t) for x, t in zip(shared.value, (np.int64, np.int64, np.bool_)))
        for batch in batches:
            lists = batch.column("pairs")
            at = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            keys, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy().astype(np.int64)
            place = np.minimum(np.searchsorted(pair, keys), max(0, len(pair) - 1))
            known = pair[place] == keys if len(pair) else np.zeros(len(keys), bool)
            place = place * known
            value = (n[place] if len(pair) else np.zeros(len(keys), np.int64)) * times * known
            top = times * (best[place] & known) if len(pair) else np.zeros(len(keys), np.int64)
            sums = [np.diff(np.concatenate([[0], np.cumsum(x)])[at]) for x in (top, value)]
            left = np.concatenate([[0], np.cumsum(~known)])[at].astype(np.int32)
            cols = [batch.column(c) for c in keep] + [pa.array(s) for s in sums]
            cols += [pa.ListArray.from_arrays(pa.array(left), pa.array(x[~known])) for x in (keys, times)]
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, "_top", "_sum", "_pairs", "_times"])

    ddl = ", ".join([*[f"`{c}` {kinds[c]}" for c in keep], "_top bigint, _sum bigint, _pairs array<bigint>, _times array<bigint>"])
    done = materialize(rows.mapInArrow(run, ddl), "link-sums")
    rare = done.select(by, F.explode(F.arrays_zip("_pairs", "_times")).alias("_z"))
    rare = rare.select(by, F.col("_z._pairs").alias("pair"), F.col("_z._times").alias("_t")).join(counts, "pair")
    rare = rare.groupBy(by).agg(
        F.sum(F.when(F.col("best"), F.col("_t")).otherwise(0)).alias("_rt"), F.sum(F.col("_t") * F.col("n")).alias("_rs")
    )
    sums = {
        "n_best": F.col("_top") + F.coalesce("_rt", F.lit(0)),
        "count_sum": F.col("_sum") + F.coalesce("_rs", F.lit(0)),
    }
    return done.join(rare, by, "left").withColumns(sums).select(*keep, "n_best", "count_sum")


def align(
    docs: DataFrame,
    path_a: str | None = None,
    path_b: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    chunk: int = CHUNK,
) -> DataFrame:
    """Per row: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Tokenizer A (a file of the tokenizers library, byte level) encodes space + text, B (a sentencepiece model)
    the text. Bytes where tokens of both end cut them into groups; tokens whose byte ranges overlap are
    linked. A pair's count is how many rows of `docs` have it linked; count_sum adds the counts of all links,
    n_best counts the links whose count is the highest of their id of A.

    Texts up to `chunk` bytes are worked on whole. Longer ones are cut into byte ranges, anywhere, that go
    to tasks of their own: each yields a fragment (open prefix, closed groups, open suffix), and rounds compose
    neighbouring fragments until there is one per text. Closed groups stay where they were made; only their
    listing passes a task once more in order, piece by piece, to be hashed.

    NULL and empty texts, and texts that one of the tokenizers does not give back, have zeros and ''. The
    key is carried along only (NULL or repeated keys keep their rows). Other columns are not read. The vocabulary
    files are read once and sent to the executors.
    """
    paths = path_a or public_tokenizers.path(TOKENIZER_A), path_b or public_tokenizers.path(TOKENIZER_B)
    files = docs.sparkSession.sparkContext.broadcast(tuple(map(_read, paths)))  # two vocabularies, a few MB
    n_b = _aligner(*files.value).b.get_piece_size()
    kind = docs.schema[key].dataType
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(f"`{key}`"), F.col(f"`{text}`").alias(text))
    is_long = F.coalesce(F.octet_length(text) > chunk, F.lit(False))
    head = f"_row bigint, `{key}` {kind.simpleString()}"
    ddl = f"{head}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, {COUNTED}"
    short = materialize(rows.filter(~is_long).mapInArrow(_short(files, key, text), ddl), "short-texts")

    cut = rows.filter(is_long).withColumn("_row", -1 - F.col("_row")).mapInArrow(
        _chunks(key, text, chunk, kind), f"{head}, seq bigint, low bigint, high bigint, start bigint, part string"
    )
    cut = materialize(cut.repartition("_row", "seq"), "chunks")
    made = materialize(cut.drop(key).mapInArrow(_fragments(files), f"{FRAGMENT}, pieces array<string>, {COUNTED}"), "closed")
    whole = reduce_fragments(made)
    fine = whole.filter("ok").select("_row")
    joints = whole.filter("ok").select("_row", "joints").mapInArrow(_joints(files), f"_row bigint, seq bigint, pieces array<string>, {COUNTED}")
    # A joint ends before the closed groups of the range that it closes in.
    parts = made.join(fine, "_row").select("_row", "seq", F.lit(1).alias("_side"), "pieces", "pairs", "times")
    parts = parts.unionByName(joints.withColumn("_side", F.lit(0)))
    parts = materialize(parts.withColumn("_part", F.monotonically_increasing_id()), "groups")
    listed = parts.select("_row", "seq", "_side", F.posexplode("pieces").alias("_k", "piece")).repartition("_row")
    listed = listed.sortWithinPartitions("_row", "seq", "_side", "_k").select("_row", "piece")
    hashes = listed.mapInArrow(_hashes, "_row bigint, groups_sha256 string")

    counts = pair_counts(short, parts.select("_row", "pairs"), n_b)
    cols = [key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    done = _with_sums(short, counts, "_row").select(cols)
    summed = _with_sums(parts.select("_part", "_row", "pairs", "times"), counts, "_part")
    summed = summed.groupBy("_row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    keys = cut.filter("seq = 0").select("_row", key)
    long = keys.join(whole.select("_row", "ok", "n_a", "n_b", "n_groups"), "_row").join(summed, "_row", "left").join(hashes, "_row", "left")
    zero = lambda c: F.when(F.col("ok"), F.coalesce(c, F.lit(0))).otherwise(0).cast("bigint").alias(c)
    long = long.withColumn("n_links", F.col("n_a") + F.col("n_b") - F.col("n_groups"))
    long = long.select(key, *[zero(c) for c in cols[1:-1]], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
    return done.unionByName(long)
