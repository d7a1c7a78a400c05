import collections
import math
import random
import re
import zlib

import pytest

import corpus_pipeline
from stayline.llm import langid, lattice, passages
from tests.llm.test_near_copies import brute, shared_runs

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PIECES = [(b"\xe2\x96\x81", -1.0), (b"\xe2\x96\x81a", -2.0), (b"ab", -1.5), (b"a", -2.5), (b"b", -3.0), (b"ba", -2.2), (b"\xe2", -9.0), (b"\x96", -9.0), (b"\x81", -9.0)]


def all_segmentations(text, table):
    if not text:
        return [0.0]
    out = []
    for p, s in table.items():
        if text.startswith(p):
            out += [s + r for r in all_segmentations(text[len(p) :], table)]
    return out


def log_sum(xs):
    top = max(xs)
    return top + math.log(sum(math.exp(x - top) for x in xs))


@pytest.fixture(scope="module")
def small():
    import numpy as np

    return lattice.Lattice(lattice.trie_arcs([p for p, _ in PIECES]), np.array([s for _, s in PIECES]))


def test_forward_sums_over_all_segmentations(small):
    words = [b"a", b"ab", b"abab", b"bbaab", b"", b"aabbab"]
    got = small.log_probability(words)
    for w, x in zip(words, got):
        assert x == pytest.approx(log_sum(all_segmentations(lattice.MARK + w, dict(PIECES))))


def test_long_words_take_the_same_sums(small, monkeypatch):
    import numpy as np

    words = [b"abab" * 3, b"ba" * 8, b"b"]
    want, counts = small.log_probability(words), np.zeros(len(PIECES))
    small.piece_counts(words, counts)
    monkeypatch.setattr(lattice, "LONG", 2)
    again = np.zeros(len(PIECES))
    small.piece_counts(words, again)
    assert np.allclose(small.log_probability(words), want) and np.allclose(counts, again)
    assert small.log_probability([b"ab" * 50_000])[0] < -1000


def test_unigram_base_equals_brute_force_and_model_is_a_probability(docs_of, prose):
    texts = [prose(i, 5 + i) + " Rare%d" % i for i in range(60)] + [None, "", "  ", prose(1, 30_000), "x" * 3000, prose(3, 9), prose(3, 9)]
    ids = [*range(66), 65]
    rows = lattice.score(docs_of(texts, ids), group="lang").collect()
    tokens = {i: WORD.findall((t or "").translate(LOWER)) + [""] for i, t in zip(ids, texts)}
    counts = collections.Counter()
    for i, t in zip(ids, texts):
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update(WORD.findall((t or "").translate(LOWER)) + [""])
    n, v = sum(counts.values()), len(counts)
    assert sorted(r.doc_id for r in rows) == sorted(ids)
    for r in rows:
        w = tokens[r.doc_id]
        base = sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(counts[x] > 0 for x in w), n)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
        assert r.base_score == pytest.approx(base) and r.score < 0 and math.isfinite(r.score)


def test_word_probabilities_sum_to_at_most_one(docs_of, prose):
    docs = docs_of([prose(i, 40) for i in range(30)])
    counts = lattice.word_counts(docs)
    words, _ = lattice.word_scores(counts, 1)
    assert 0.9 < sum(10**r.m0 for r in words.filter("length(word) > 0").collect()) <= 1


def test_scores_without_training_rows(docs_of):
    only = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    (r,) = lattice.score(docs_of(["new words"], [only])).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and math.isfinite(r.score)
    assert lattice.score(docs_of([])).count() == 0
    (r,) = lattice.score(docs_of(["a"]).selectExpr("cast(null as long) as doc_id", "text")).collect()
    assert not r.held_out and r.train_tokens == 0


EN = "the cat and the dog went to the house with this and that thing"
DE = "der hund und die katze gingen in das haus mit einem schönen ding"


def page(i, text, lang=None, host="a.example.com"):
    tag = f' lang="{lang}"' if lang else ""
    return (i, f"https://{host}/p/{i}" if host else None, f"<!DOCTYPE html><HTML{tag}><script>der die das</script><p>{text}</p>" if text is not None else None)


def identified(spark, docs, pages):
    pages = spark.createDataFrame(pages, "page_id long, url string, html string")
    return langid.identify(docs, pages).collect()


@pytest.fixture()
def two_languages(spark):
    rows = [(i, (EN if i % 2 else DE) + f" {i}", "en" if i % 2 else "de", f"s{i % 2}") for i in range(60)]
    rows += [(100, None, None, None), (None, DE, "de", "s0"), (101, "", "en", "s1")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_evidence_is_fused(spark, two_languages):
    pages = [page(i, DE, "de", "de.example.net") for i in range(40)] + [page(i, EN, "en", "en.example.org") for i in range(40, 80)]
    pages += [
        page(80, "x", "de", "new.example.info"),  # hardly any text: the declared language decides
        page(81, "", None, "de.example.net"),  # none at all: the host does
        page(82, EN * 5, "de", "de.example.net"),  # much text against the rest
        page(83, None, None, None),
        page(84, "", "en", None),
    ]
    got = {r.page_id: r for r in identified(spark, two_languages, pages) if r.page_id is not None}
    assert all(got[i].lang == "de" for i in range(40)) and all(got[i].lang == "en" for i in range(40, 80))
    assert [got[i].lang for i in (80, 81, 82, 84)] == ["de", "de", "en", "en"] and got[83].lang in ("de", "en")
    assert got[80].declared == "de" and got[81].host == "de.example.net" and all(0 < r.probability <= 1 for r in got.values())


def test_documents_are_identified_and_rows_are_kept(spark, two_languages):
    rows = identified(spark, two_languages, [page(1, EN), page(1, EN), (None, "no url", "<p>" + DE)])
    docs = {r.doc_id: r.lang for r in rows if r.page_id is None and r.doc_id is not None}
    assert len(rows) == 63 + 3 and all(docs[i] == ("en" if i % 2 else "de") for i in range(60))
    none = two_languages.limit(0)
    assert identified(spark, none, [])== [] and [r.lang for r in identified(spark, none, [page(1, EN)])] == [None]


def test_rare_labels_beyond_64_are_learned(spark):
    words = [["".join(random.Random(f"{k} {w}").choices("abcdefghijklmnopqrstuvwxyz", k=7)) for w in range(9)] for k in range(70)]
    rows = [
        (100 * k + i, " ".join(words[k][(w + i) % 9] for w in range(40)), f"l{k:02}", None)
        for k in range(70) for i in range(9 if k < 66 else 6)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    want = {r[0]: r[2] for r in rows}
    got = {r.doc_id: r.lang for r in identified(spark, docs, [(1, None, None)]) if r.doc_id is not None}
    assert len(langid.train(docs)[0]) == 70
    assert sum(got[i] == want[i] for i in want) > 0.97 * len(want)
    rare = [i for i in want if want[i] >= "l66"]
    assert all(got[i] == want[i] for i in rare)


def test_visible_text_and_declared_language():
    assert langid.visible_text("<a>x</a><!-- y --><style>z</style>&amp;<b").split() == ["x", "&<b"]


@pytest.fixture()
def corpus(spark, prose, tmp_path):
    passage = " ".join(f"shared{k}" for k in range(60))
    texts = [prose(i, 60) + f" id{i}" for i in range(120)]
    for i in range(0, 60, 5):
        texts[i + 1] = texts[i]  # copies
        texts[i + 2] = texts[i].replace("id", "no")  # near copies
    for i in range(60, 66):
        texts[i] = texts[i] + "\n" + passage
    texts += [w * 2 + "!! $$" for w in prose(5, 40).upper().split()]  # junk
    rows = [(i, t, "en", f"s{i % 3}", len(t), f"x{i}", i) for i, t in enumerate(texts)]
    rows += [(None, None, None, None, None, "n", 1), (500, "", "en", "s1", 0, "e", 2)]
    sf = str(tmp_path / "sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string, size int").write.parquet(f"{sf}/documents.parquet")
    labels = [(i, int(i < 120), 0) for i in range(160) if i % 4]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    return sf, {r[0]: r[1] for r in rows}


def test_stages_take_effect_and_keep_columns(spark, corpus):
    sf, texts = corpus
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert len(stages) == 5

    good = stages["quality classifier"](spark, docs, sf)
    kept = {r.doc_id: r for r in good.collect()}
    assert good.columns == names and set(range(120)) <= set(kept) and len(set(range(120, 160)) & set(kept)) <= 4
    assert kept[3].score == "x3" and kept[3].size == 3

    apart = stages["MinHash near-dedup"](spark, docs, sf)
    left = [r.doc_id for r in apart.collect()]
    want = brute([(i, t) for i, t in texts.items() if i is not None], 5)
    assert apart.columns == names and sorted(i for i in left if i is not None) == sorted(i for i, w in want.items() if w[2]) and None in left

    cut = stages["substring dedup"](spark, docs.filter("doc_id >= 60 or doc_id is null"), sf)
    after = {r.doc_id: r for r in cut.collect()}
    assert cut.columns == names and all(after[i].text == texts[i] for i in after if i != 500 and i is not None and not 60 < i < 66)
    assert all("shared30" not in after[i].text and after[i].n_chars == len(after[i].text) for i in range(61, 66))
    assert not shared_runs([(i, r.text) for i, r in after.items()], 50) and "shared30" in after[60].text

    mixed = stages["source mixing"](spark, docs, sf)
    assert mixed.columns == names and all(r.n_chars == len(r.text) for r in mixed.collect())
    coded = stages["byte-level BPE"](spark, mixed, sf)
    assert coded.columns == [*names, "ids", "n_tokens"]
    assert sorted(r.text for r in coded.collect()) == sorted(r.text for r in mixed.collect())


def test_one_doc_id_with_several_texts_loses_none(spark, prose):
    a, b, c = (prose(i, 80) for i in (1, 2, 3))
    rows = [(1, a), (7, a + " end"), (7, b), (7, b), (9, b + " more"), (9, c), (9, ""), (11, c + " last"), (12, None), (12, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    stage = dict(corpus_pipeline.STAGES)["MinHash near-dedup"]
    left = [(r.doc_id, r.text) for r in stage(spark, docs, "").collect()]
    kind = lambda t: next((k for k, x in enumerate((a, b, c)) if (t or "").startswith(x)), None)
    assert sorted(kind(t) for _, t in left if t) == [0, 1, 2]  # one of each group
    assert sorted(i for i, t in left if not t) == [9, 12]


def test_pipeline_runs_on_full_and_empty_tables(spark, corpus, tmp_path):
    sf, _ = corpus
    rows = corpus_pipeline.run(spark, sf).collect()
    assert rows and all(r.n_tokens == len(r.ids) > 0 for r in rows)
    empty = str(tmp_path / "empty")
    for t in ("documents", "labels"):
        spark.read.parquet(f"{sf}/{t}.parquet").limit(0).write.parquet(f"{empty}/{t}.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_passage_parameters():
    assert passages.WINDOW + passages.SPAN - 1 <= 50
