"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches."""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
import os
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from stayline.llm.wordbytes import slices

RANKS = "byte_bpe_multi_50k.tiktoken"


@functools.cache
def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves; the others follow from U+0100 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


def ragged(flat: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """flat[offsets[r] : offsets[r + 1]] for each r in rows, one after the other."""
    length = offsets[rows + 1] - offsets[rows]
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(offsets[rows] - (ends - length), length) + np.arange(total)]


class Codec:
    """Encoder and decoder of one rank file (lines of base64 token and rank).

    The tokenizers library encodes each distinct match of the pattern once; merges never cross a
    match, so a text's ids are those of its matches side by side. The memory of matches is
    emptied when it holds CACHE of them or CHARS characters, which changes no result.
    """

    CACHE = 120_000
    CHARS = 4_000_000

    def __init__(self, ranks_file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
        from tokenizers import Tokenizer, models, pre_tokenizers

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines())}
        chars = byte_characters()

        def shown(token: bytes) -> str:
            return "".join([chars[b] for b in token])

        merges = []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = token[:cut], token[cut:]
                if left in ranks and right in ranks:
                    merges.append((rank, cut, shown(left), shown(right)))
        merges.sort()
        model = models.BPE(
            {shown(t): r for t, r in ranks.items()}, [m[2:] for m in merges], ignore_merges=True
        )
        self.tokenizer = Tokenizer(model)
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.matches = regex.compile(public_tokenizers.PATTERN).findall
        back = {c: b for b, c in enumerate(chars)}
        piece = [b""] * (max(ranks.values()) + 1)  # by id: the bytes, through the reversed byte table
        for text, rank in self.tokenizer.get_vocab().items():
            piece[rank] = bytes([back[c] for c in text])
        self.bytes, self.byte_at = self._table(piece)
        self.digits, self.digit_at = self._table([b"%d," % i for i in range(len(piece))])
        self._forget()

    @staticmethod
    def _table(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        return np.frombuffer(b"".join(rows), dtype=np.uint8), offsets

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.ends, self.chars = array("i"), array("q", [0]), 0

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts side by side, and the offsets of each text in them."""
        found = [self.matches(t) for t in texts]
        new = set(itertools.chain.from_iterable(found)).difference(self.known)
        if len(self.known) + len(new) > self.CACHE:
            self._forget()
            new = set(itertools.chain.from_iterable(found))
        order = sorted(new)
        start = len(self.ends) - 1
        for e in self.tokenizer.encode_batch_fast(order, add_special_tokens=False):
            self.ids.extend(e.ids)
            self.ends.append(len(self.ids))
        self.known.update(zip(order, range(start, start + len(order))))
        n = sum(map(len, found))
        rows = np.fromiter(map(self.known.__getitem__, itertools.chain.from_iterable(found)), np.int64, n)
        flat, ends = np.array(self.ids, dtype=np.int32), np.array(self.ends, dtype=np.int64)
        ids = ragged(flat, ends, rows)
        upto = np.concatenate([[0], np.cumsum(ends[rows + 1] - ends[rows])])
        texts_at = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int64)
        self.chars += sum(map(len, order))
        if self.chars > self.CHARS:
            self._forget()
        return ids, upto[texts_at]

    def decode(self, ids: np.ndarray) -> bytes:
        """The encoded bytes; a character split over several ids comes out whole again."""
        return ragged(self.bytes, self.byte_at, np.asarray(ids, dtype=np.int64)).tobytes()

    def decimal(self, ids: np.ndarray) -> bytes:
        """Decimal ids joined by commas."""
        return ragged(self.digits, self.digit_at, np.asarray(ids, dtype=np.int64))[:-1].tobytes()

    def offsets(self, raw: bytes, ids: np.ndarray) -> np.ndarray:
        """Start and end of each token in characters: the character that holds the token's first byte,
        and one past the one that holds its last; tokens that share a split character overlap."""
        length = np.diff(self.byte_at)[np.asarray(ids, dtype=np.int64)]
        ends = np.cumsum(length)
        lead = (np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80
        char_of = np.cumsum(lead) - 1  # by byte: the character it belongs to
        return np.stack([char_of[ends - length], char_of[ends - 1] + 1], axis=1)


@functools.lru_cache(maxsize=1)
def _codec(ranks_file: bytes) -> Codec:
    return Codec(ranks_file)


def _ranks(docs: DataFrame, path: str | None):
    with open(path or public_tokenizers.path(RANKS), "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def _ddl(df: DataFrame, columns) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in columns)


def encode(
    docs: DataFrame,
    path: str | None = None,
    text: str = "text",
    offsets: bool = False,
    decoded: str | None = None,
) -> DataFrame:
    """All columns of `docs` but the text, with `ids array<int>` (and `starts`, `ends` in characters,
    and the text decoded from the ids in a column named `decoded`).

    NULL and empty texts have no ids; repeated rows are encoded alike. The vocabulary file is read
    once and sent to the executors, its size does not depend on the input. Texts are encoded
    whole; a task holds one slice of a few MB (or one longer text) and its ids. Columns of `docs`
    named ids, starts or ends are replaced.
    """
    ranks = _ranks(docs, path)
    made = ["ids", "starts", "ends"][: 3 if offsets else 1] + [decoded] * bool(decoded)
    rest = [c for c in docs.columns if c != text and c not in made]

    def run(batches):
        codec = _codec(ranks.value)
        for batch in batches:
            for part in slices(batch, text):
                texts = part.column(text).fill_null("").to_pylist()
                ids, at = codec.encode(texts)
                cols = [part.column(c) for c in rest]
                cols.append(pa.ListArray.from_arrays(at.astype(np.int32), ids))
                if offsets:
                    spans = [codec.offsets(t.encode(), ids[a:b]) for t, a, b in zip(texts, at, at[1:]) if t]
                    both = np.concatenate([np.zeros((0, 2), np.int64), *spans]).astype(np.int32)
                    cols += [pa.ListArray.from_arrays(at.astype(np.int32), both[:, k].copy()) for k in (0, 1)]
                if decoded:
                    cols.append(pa.array([codec.decode(ids[a:b]).decode() for a, b in zip(at, at[1:])], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=[*rest, *made])

    kinds = [f"`{c}` {'string' if c == decoded else 'array<int>'}" for c in made]
    ddl = ", ".join(filter(None, [_ddl(docs, rest), *kinds]))
    return docs.select(*[f"`{c}`" for c in [*rest, text]]).mapInArrow(run, ddl)


def decode(tokens: DataFrame, path: str | None = None, ids: str = "ids") -> DataFrame:
    """`bytes binary` from each row's ids; NULL ids give NULL. Other columns are kept."""
    ranks = _ranks(tokens, path)
    rest = [c for c in tokens.columns if c != "bytes"]

    def run(batches):
        codec = _codec(ranks.value)
        for batch in batches:
            column = batch.column(ids)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            sizes = column.value_lengths()
            at = np.concatenate([[0], np.cumsum(sizes.fill_null(0).to_numpy(zero_copy_only=False))])
            known = sizes.is_valid().to_pylist()
            out = [codec.decode(flat[a:b]) if k else None for k, a, b in zip(known, at, at[1:])]
            cols = [batch.column(c) for c in rest]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(out, pa.binary())], names=[*rest, "bytes"])

    return tokens.select(*[f"`{c}`" for c in rest]).mapInArrow(run, _ddl(tokens, rest) + ", bytes binary")


def round_trip(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_tokens, ids_sha256, decoded_sha256, and `exact`, whether decoding gave the text back.

    Ids are encoded and decoded in the same task, so they need not leave the executor. NULL texts
    count as empty; repeated rows give repeated results; other columns are not read.
    """
    ranks = _ranks(docs, path)

    def run(batches):
        codec = _codec(ranks.value)
        for batch in batches:
            for part in slices(batch, text):
                texts = part.column(text).fill_null("").to_pylist()
                ids, at = codec.encode(texts)
                coded, plain, same = [], [], []
                for t, a, b in zip(texts, at, at[1:]):
                    raw = codec.decode(ids[a:b])
                    coded.append(hashlib.sha256(codec.decimal(ids[a:b])).hexdigest())
                    plain.append(hashlib.sha256(raw).hexdigest())
                    same.append(raw == t.encode())
                cols = [part.column(key), pa.array(np.diff(at)), pa.array(coded), pa.array(plain), pa.array(same)]
                yield pa.RecordBatch.from_arrays(
                    cols, names=[key, "n_tokens", "ids_sha256", "decoded_sha256", "exact"]
                )

    return docs.select(f"`{key}`", f"`{text}`").mapInArrow(
        run,
        _ddl(docs, [key]) + ", n_tokens bigint, ids_sha256 string, decoded_sha256 string, exact boolean",
    )
