import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stayline.llm import alignment
from stayline.llm.alignment import Tokens
from stayline.llm.bytebpe import byte_characters


@pytest.fixture(scope="module")
def pair():
    a = Tokenizer.from_file(public_tokenizers.path(alignment.TOKENIZER_A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.TOKENIZER_B))


def tokens_of(text, pair):
    """Brute force: ((id, start, end) of A, of B), or two empty lists."""
    a, b = pair
    back = {c: k for k, c in enumerate(byte_characters())}
    raw = (" " + text).encode() if text else b""
    out = []
    one = a.encode(" " + text, add_special_tokens=False) if text else None
    sides = [[(i, bytes(back[c] for c in t)) for i, t in zip(one.ids, one.tokens)] if text else []]
    side = []
    for i in b.encode(text or ""):
        p = b.id_to_piece(i)
        side.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
    sides.append(side)
    for side in sides:
        if b"".join(x for _, x in side) != raw:
            return [], []
        at, found = 0, []
        for i, x in side:
            found.append((i, at, at + len(x)))
            at += len(x)
        out.append(found)
    return out


def brute(rows, pair):
    """Per row: (key, n_a, n_b, n_groups, n_links, n_best, count_sum, sha)."""
    linked, groups = [], []
    for _, text in rows:
        a, b = tokens_of(text, pair)
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        listing, low = [], 0
        for c in cuts:
            part = [",".join(str(i) for i, s, e in side if low <= s and e <= c) for side in (a, b)]
            listing.append("|".join(part))
            low = c
        groups.append((len(a), len(b), len(cuts), ";".join(listing)))
        linked.append([(i, j) for i, s, e in a for j, u, v in b if s < v and u < e])
    n = collections.Counter(p for links in linked for p in set(links))
    top = collections.defaultdict(int)
    for (i, _), c in n.items():
        top[i] = max(top[i], c)
    return sorted(
        (
            (key, *g[:3], len(links), sum(n[p] == top[p[0]] for p in links), sum(n[p] for p in links))
            + (hashlib.sha256(g[3].encode()).hexdigest() if g[0] else "",)
            for (key, _), g, links in zip(rows, groups, linked)
        ),
        key=repr,
    )


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def run(df, **kw):
    return sorted((tuple(r) for r in alignment.align(df, **kw).select(COLUMNS).collect()), key=repr)


def texts_of(prose):
    rnd = random.Random(13)
    signs = "abc de  f\n\t,.!?0123é ñ 中文字 😀🎉  x 　y <s> </s> <|endoftext|> <0x41> 's 're\x1c\x85\x00"
    odd = ["".join(rnd.choices(signs, k=rnd.randint(1, 120))) for _ in range(25)]
    return [
        None, "", " ", "  ", "a", "é", "😀", "x▁y", "▁", "the the the", "tail ", " lead", "\r\n", "a" * 700, "中" * 300,
        "<s> </s> <|endoftext|> <unk>", *odd, *[prose(k, 40 + 30 * k) for k in range(8)], prose(3, 130),
    ]


@pytest.mark.parametrize("chunk, common", [(1 << 15, 1 << 17), (64, 1 << 17), (64, 5), (7, 0)])
def test_equals_brute_force(docs_of, prose, pair, chunk, common, monkeypatch):
    """Whole texts and texts in ranges, counts from the common table and from the join; odd and repeated rows."""
    monkeypatch.setattr(alignment, "COMMON", common)
    monkeypatch.setattr(alignment, "PIECE", 50)
    texts = texts_of(prose)
    ids = [*range(len(texts) - 2), 5, None]
    got = run(docs_of(texts, ids=ids), chunk=chunk)
    assert got == brute(list(zip(ids, texts)), pair)


def test_empty_table(docs_of):
    assert run(docs_of([])) == []


def test_very_long_text_takes_several_rounds(docs_of, prose, pair):
    text = "\n".join(prose(k, 400) for k in range(40)) + "é" * 3000 + " end"
    assert run(docs_of([text, "short one"]), chunk=256) == brute([(0, text), (1, "short one")], pair)


def test_unlucky_columns(docs_of):
    df = docs_of(["one two", "three"]).withColumns({c: F.lit(9) for c in ("_row", "seq", "pairs", "n_a", "times", "part")})
    assert run(df) == run(docs_of(["one two", "three"]))


def test_no_piece_crosses_a_safe_point(pair):
    """A piece of B has its space mark at its beginning, or consists of marks."""
    b = pair[1]
    for i in range(b.get_piece_size()):
        assert "▁" not in b.id_to_piece(i).lstrip("▁")


def ranges(text, aligner, edges):
    ok, t, _ = aligner.encode([text])
    n = len((" " + text).encode())
    out = []
    for k, (low, high) in enumerate(zip(edges, [*edges[1:], n])):
        out.append((alignment.fragment(t.within(low, high), bool(ok[0]), k == 0)[0], k))
    return out


def same(x, y):
    if isinstance(x, Tokens):
        return all(np.array_equal(a, b) for a, b in zip(x, y))
    if isinstance(x, tuple):
        return len(x) == len(y) and all(same(a, b) for a, b in zip(x, y))
    return x == y


def test_product_is_associative(prose):
    aligner = alignment.Aligner(*[alignment._read(public_tokenizers.path(p)) for p in (alignment.TOKENIZER_A, alignment.TOKENIZER_B)])
    rnd = random.Random(7)
    for k in range(60):
        text = prose(k, 6) + "é😀中" * rnd.randint(0, 3) + " " + prose(k + 1, 4)
        n = len(text.encode())
        edges = [0, *sorted(rnd.sample(range(1, n), rnd.randint(2, 9)))]
        parts = ranges(text, aligner, edges)

        def joined(lo, hi, pick):
            """(product of parts lo..hi, number of the range with its first cut), bracketed by `pick`."""
            if hi - lo == 1:
                return parts[lo]
            mid = pick(lo + 1, hi)
            left, right = joined(lo, mid, pick), joined(mid, hi, pick)
            return left[0].then(*right), left[1] if not left[0].open else right[1]

        one = joined(0, len(parts), lambda a, b: a)[0]
        assert same(one, joined(0, len(parts), lambda a, b: b - 1)[0])
        assert same(one, joined(0, len(parts), lambda a, b: rnd.randint(a, b - 1))[0])
        _, whole, _ = aligner.encode([text])
        assert one.n_groups == len(whole.cuts()) and not len(one.prefix.a) and not len(one.suffix.a)


def test_stretches_reach_into_neighbours_only():
    rnd = random.Random(5)
    for _ in range(200):
        raw = np.frombuffer((" " + "".join(rnd.choices("ab  é\n", k=rnd.randint(1, 90)))).encode(), np.uint8)
        out = alignment.chunk_ranges(raw, rnd.randint(2, 20))
        assert out[0][0] == 0 and out[-1][1] == len(raw) and [o[1] for o in out[:-1]] == [o[0] for o in out[1:]]
        for k, (low, high, start, stop) in enumerate(out):
            assert start <= low < high <= stop
            assert start >= (out[k - 1][0] if k else 0) and stop <= (out[k + 1][1] if k + 1 < len(out) else len(raw))
