import hashlib
import re
import zlib
from fractions import Fraction

import base64

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from stayline.llm import bytebpe, mixing, quality

WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def encoding():
    with open(public_tokenizers.path(bytebpe.RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = ["", None, "Hello, world's  end\n\n ", "naïve 日本語 \U0001f600‍ x", "a" * 5000, "1234567 <|endoftext|>", "\x00\x85 tab\t", " "]


def test_ids_and_bytes_equal_the_other_library(docs_of, prose, encoding):
    texts = [*TEXTS, prose(1, 20_000), prose(1, 20_000)]
    rows = bytebpe.round_trip(docs_of(texts)).collect()
    for r in rows:
        text = texts[r.doc_id] or ""
        ids = encoding.encode_ordinary(text)
        assert r.n_tokens == len(ids) and r.exact
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bytebpe.round_trip(docs_of([])).count() == 0


def test_encode_decode_and_offsets(docs_of, encoding):
    df = docs_of(TEXTS)
    coded = bytebpe.encode(df, offsets=True, decoded="again")
    assert coded.columns == [c for c in df.columns if c != "text"] + ["ids", "starts", "ends", "again"]
    back = {r.doc_id: r for r in bytebpe.decode(coded).collect()}
    for i, text in enumerate(TEXTS):
        r, text = back[i], text or ""
        assert bytes(r.bytes).decode() == text == r.again
        assert list(r.ids) == encoding.encode_ordinary(text)
        pieces = encoding.decode_tokens_bytes(r.ids)
        for piece, a, b in zip(pieces, r.starts, r.ends):
            assert piece in text[a:b].encode()  # a token lies in the characters it touches
    some = coded.select("doc_id", "ids").selectExpr("doc_id", "if(doc_id = 0, null, ids) as ids")
    assert {r.doc_id: r.bytes for r in bytebpe.decode(some).collect()}[0] is None


def test_cache_limit_changes_nothing(prose, encoding, monkeypatch):
    with open(public_tokenizers.path(bytebpe.RANKS), "rb") as f:
        codec = bytebpe.Codec(f.read())
    monkeypatch.setattr(codec, "CACHE", 5)
    for seed in range(4):
        text = prose(seed, 60)
        ids, at = codec.encode([text, "", text])
        assert ids[: at[1]].tolist() == encoding.encode_ordinary(text) == ids[at[2] :].tolist()


def filled(sizes, cycle=(5, 2, 1), share=Fraction(3, 2), cap=2):
    """Targets by exact arithmetic: clamp and share again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(names)}
    left, fixed = share * sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in fixed]
        total = sum(weight[s] for s in open_)
        out = {s: Fraction(left) * weight[s] / total for s in open_}
        over = [s for s in open_ if out[s] > cap * sizes[s]]
        if not over:
            return {**out, **fixed}
        for s in over:
            fixed[s] = Fraction(cap * sizes[s])
            left -= fixed[s]


def test_mix_reaches_targets(docs_of, prose):
    sources = [["b", "a", None, "é", "zz", "a", "a", ""][i % 8] for i in range(400)]
    texts = [prose(i, i % 37) if i % 11 else None for i in range(400)]
    df = docs_of(texts, sources=sources)
    rows = mixing.mix(df).collect()
    sizes = {}
    for s, t in zip(sources, texts):
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    want = filled(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in rows:
        assert r.size == len(WORD.findall(texts[r.doc_id] or "")) and r.source_size == sizes[r.source]
        assert abs(r.target - float(want[r.source])) < 1e-6
        assert 0 <= r.taken <= 2 * r.size and r.score == f"x{r.doc_id}"
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 5 for s in sizes)
    assert sorted(map(str, mixing.mix(df.repartition(7)).collect())) == sorted(map(str, rows))
    words = {}
    for r in mixing.sample(mixing.mix(df)).collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(WORD.findall(r.text))
    assert words == {r.doc_id: r.taken for r in rows if r.taken}


def test_pipeline_mix_takes_whole_texts(spark, docs_of, prose):
    n = 300
    texts = [prose(i, 20 + i % 50) for i in range(n)] + ["same text here"] * 60
    ids = [None if i % 3 == 0 else i for i in range(n)] + [7] * 30 + [None] * 30
    sources = [["a", "b", "c", "d"][i % 4] for i in range(n)] + ["e"] * 60
    sources = [s if i is not None or s == "e" else "none" for i, s in zip(ids, sources)]
    df = docs_of(texts, ids=ids, sources=sources)
    mixed = mixing.mix(df, whole_texts=True).collect()
    assert len(mixed) == len(texts) and all(r.part in (0, r.size) for r in mixed)
    for s in set(sources):
        rows = [r for r in mixed if r.source == s]
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= max(r.size for r in rows)
    got = corpus_pipeline.mix_sources(spark, df, "").collect()
    assert {r.text for r in got} <= set(texts) and all(r.n_chars == len(r.text) for r in got)
    again = corpus_pipeline.mix_sources(spark, df.repartition(5), "").collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mix_odd_rows(docs_of):
    assert mixing.mix(docs_of([])).count() == 0
    rows = mixing.mix(docs_of([None, "", "  "], sources=[None, "a", "a"])).collect()
    assert [(r.size, r.taken, r.target) for r in rows] == [(0, 0, 0.0)] * 3
    same = mixing.mix(docs_of(["a b c d"] * 4, ids=[1, 1, None, None])).collect()
    assert sum(r.taken for r in same) == 24
    assert mixing.sample(mixing.mix(docs_of(["a b"], sources=["s"]))).count() == 2


def junk(prose, i):
    return " ".join(w + "!!" for w in prose(i, 40).upper().split()) if i % 2 else " ".join([prose(i, 1)] * 30)


def test_classifier_on_held_out_rows(spark, docs_of, prose):
    texts = [prose(i, 30) if i % 3 else junk(prose, i) for i in range(900)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(900) if i % 7] + [(7, None), (None, 1), (9999, 0)], "doc_id long, quality int")
    rows = quality.classify(docs_of(texts), labels).collect()
    assert len(rows) == 900 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(r.predicted == (r.doc_id % 3 > 0) for r in held) >= 0.97 * len(held)


def test_labels_of_held_out_rows_change_nothing(spark, docs_of, prose):
    texts = [prose(i, 30) if i % 3 else junk(prose, i) for i in range(200)]
    df = docs_of(texts)

    def scores(flip):
        rows = [(i, int(i % 3 > 0) ^ (flip and zlib.crc32(str(i).encode()) % 5 == 0)) for i in range(200)]
        labels = spark.createDataFrame(rows, "doc_id long, quality int")
        return {r.doc_id: r.score for r in quality.classify(df, labels).collect()}

    assert scores(0) == scores(1)


def test_classifier_odd_rows(spark, docs_of, prose):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality.classify(docs_of([None, "", "x", prose(1, 30_000)], ids=[1, 1, None, 2]), none).collect()
    assert [(r.score, r.predicted) for r in rows] == [(0.5, 1)] * 4
    assert quality.classify(docs_of([]), none).count() == 0


def test_sample_of_labels_is_bounded(spark):
    labels = spark.range(5000).withColumnRenamed("id", "doc_id")
    n = quality.bounded_sample(labels, max_rows=1000).count()
    assert 850 < n < 1150 and quality.bounded_sample(labels, max_rows=9000).count() == 5000
