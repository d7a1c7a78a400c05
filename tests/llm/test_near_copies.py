import random
import re

import numpy as np
import pytest

from stayline.llm import forest, linking, passages
from stayline.llm.wordbytes import Words, distinct_sets, shingles

import pyarrow as pa

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


def sets_of(text, n):
    w = words_of(text)
    if not w:
        return set()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or {tuple(w)}


def brute(rows, n):
    """{doc_id: (n_shingles, component_id, kept)}."""
    sets = {i: sets_of(t, n) for i, t in rows}
    comp = {i: i for i in sets}

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                comp[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def run(df, **kw):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in forest.near_duplicates(df, **kw).collect()}


def edited(text, rnd, edits):
    w = text.split()
    for _ in range(edits):
        w[rnd.randrange(len(w))] = f"new{rnd.random()}"
    return " ".join(w)


@pytest.mark.parametrize("cap", [256, 6])
def test_forest_equals_brute_force(docs_of, prose, cap):
    """Copies, near copies on both sides of the limit, a large group that a small cap cuts deep."""
    rnd = random.Random(3)
    texts = [prose(i, rnd.randint(5, 120)) for i in range(80)]
    texts += [edited(texts[rnd.randrange(20)], rnd, rnd.randint(1, 3)) for _ in range(60)]
    texts += [texts[5].upper(), texts[5], "  " + texts[6].replace(" ", "\t\n")]
    base = prose(999, 150)
    texts += [edited(base, rnd, rnd.randint(1, 5)) for _ in range(70)]
    rnd.shuffle(texts)
    assert run(docs_of(texts), n_words=4, cap=cap) == brute(list(enumerate(texts)), 4)


def test_forest_odd_rows(spark, docs_of, prose):
    long = prose(1, 30_000)
    texts = ["", None, " \t\n", "one", "One", "two words", "two\nwords", "é", "É", long, long, "one", long + " end", "x" * 100_000]
    ids = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 9, None, 10, 11]
    got = sorted(
        (-1 if r.doc_id is None else r.doc_id, r.n_shingles, r.component_id, r.kept)
        for r in forest.near_duplicates(docs_of(texts, ids), n_words=4).collect()
    )
    want = brute([(i, t) for i, t in zip(ids, texts) if i is not None], 4)
    rows = [(i, *want[i]) for i in ids if i is not None] + [(-1, 1, None, True)]
    assert got == sorted(rows)
    assert forest.near_duplicates(docs_of([]), n_words=4).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    pairs = [(i, i + 1) for i in range(100, 160)] + [(5, k) for k in range(6, 40)] + [(70, 70), (160, 39)]
    got = {r.id: r.component for r in linking.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: 5 for i in [*range(6, 40), *range(100, 161)]}
    assert linking.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words_and_shingles_equal_plain_python(prose):
    texts = ["", "a", "A b\x0bC", None, "é ü\x85x", prose(1, 50), "\x1f\x1c y", "a a a a a a"]
    w = Words(pa.array(texts))
    assert list(w.counts) == [len(words_of(t)) for t in texts]
    for n in (1, 4, 5):
        at, _ = distinct_sets(*shingles(w, n), len(texts))
        assert list(np.diff(at)) == [len(sets_of(t, n)) for t in texts]


def shared_runs(rows, n):
    own = {}
    for i, t in rows:
        w = words_of(t)
        for k in range(len(w) - n + 1):
            own.setdefault(tuple(w[k : k + n]), set()).add(i)
    return {k: v for k, v in own.items() if len(v) > 1}


def test_repeated_passages_go_and_clean_texts_stay(docs_of, prose):
    rnd = random.Random(8)
    own = [" ".join(f"u{i}w{k}{rnd.randrange(99)}" for k in range(200)) for i in range(30)]
    passage = [" ".join(f"p{i}q{k}" for k in range(51 + 20 * i)) for i in range(3)]
    texts = list(own)
    for k, p in enumerate(passage):
        for i in range(10 * k, 10 * k + 6):  # inside a line, at its start, as a line of its own
            w = own[i].split()
            texts[i] = [" ".join(w[:70] + p.split() + w[70:]), p + " " + own[i], own[i] + "\n" + p + "\n" + own[i + 1][:50]][i % 3]
    df = docs_of(texts)
    got = {r.doc_id: r for r in passages.remove_repeats(df).collect()}
    flagged = {i for i, r in got.items() if r.n_removed}
    assert flagged == {i for k in range(3) for i in range(10 * k + 1, 10 * k + 6)}
    assert all(got[i].text == texts[i] for i in range(30) if i not in flagged)
    assert not shared_runs([(i, r.text) for i, r in got.items()], 50)
    assert all(10 * (i // 10) in got[i].first_docs for i in flagged)
    assert got[3].score == "x3"


def test_every_run_of_37_words_is_found(docs_of, prose):
    rnd = random.Random(4)
    unique = lambda i, n: " ".join(f"v{i}x{k}" for k in range(n))
    texts = []
    for i in range(300):
        run = unique(f"r{i}", 37)
        texts += [f"{unique(f'{i}{s}a', rnd.randint(20, 60))} {run} {unique(f'{i}{s}b', 40)}" for s in "lr"]
    got = {r.doc_id: r.n_removed for r in passages.remove_repeats(docs_of(texts)).collect()}
    assert got == {i: i % 2 for i in range(600)}


def test_nothing_of_a_repeated_passage_is_left(docs_of):
    rnd = random.Random(5)
    unique = lambda i, n: " ".join(f"v{i}x{k}" for k in range(n))
    texts, want = [], []
    for i in range(60):
        run = unique(f"r{i}", rnd.randint(37, 90))
        for k in range(3):  # the second one shares a longer run with the third than with the first
            a, b = unique(f"{i}a{k}", rnd.randint(0, 50)), unique(f"{i}b{k}", 40)
            more = unique(f"m{i}", 6) if k else ""
            texts.append(" ".join(f"{a} {run} {more} {b}".split()))
            want.append(texts[-1].split() if k == 0 else f"{a} {more} {b}".split() if k == 1 else f"{a} {b}".split())
    rows = passages.remove_repeats(docs_of(texts)).collect()
    assert {r.doc_id: r.text.split() for r in rows} == dict(enumerate(want))


def test_short_lines_and_wrapped_paragraphs_are_compared(docs_of):
    unique = lambda i, n: [f"v{i}x{k}" for k in range(n)]
    wrap = lambda words, n: "\n".join(" ".join(words[k : k + n]) for k in range(0, len(words), n))
    short, five, block = " ".join(unique("s", 12)), " ".join(unique("f", 5)), unique("b", 120)
    other = ["changed" if k in (35, 75) else w for k, w in enumerate(block)]  # Jaccard 106 / 126
    texts = [
        f"{short}\none more\n\n{wrap(block, 11)}\n\n{five}",
        f"head one\n{short}\ntail one",
        f"head two\n\n{wrap(other, 9)}\n \ntail two",
        f"{five.upper()}\n\nhead three\n\n{' '.join(block)}",
        wrap(unique("c", 40), 8) + "\n\na b c d",
        "a b c d\n\n" + wrap(unique("d", 40), 8),
    ]
    got = {r.doc_id: r.text for r in passages.remove_repeats(docs_of(texts)).collect()}
    want = {0: texts[0].split(), 1: "head one tail one".split(), 2: "head two tail two".split(), 3: "head three".split()}
    assert {i: got[i].split() for i in want} == want and got[4] == texts[4] and got[5] == texts[5]


def test_near_equal_paragraphs_and_odd_rows(docs_of, prose):
    line = " ".join(f"w{k}" for k in range(60))
    near = line.replace("w0 ", "other ").replace("w59", "last")
    texts = [line + "\nunique one", "head\n" + near + "\ntail", None, "", "short\n" * 5, "short\n" * 5, line, line]
    ids = [3, 5, 6, 7, 8, 9, None, 11]
    rows = passages.remove_repeats(docs_of(texts, ids)).collect()
    got = {r.doc_id: (r.text, r.n_removed) for r in rows}
    assert got[3] == (texts[0], 0) and got[6] == (None, 0) and got[7] == ("", 0)
    assert got[5][1] == 1 and got[5][0].split() == ["head", "tail"]
    assert got[8] == (texts[4], 0) and got[9] == (texts[5], 0) and got[None] == (line, 0) and got[11] == ("", 1)
    assert passages.remove_repeats(docs_of([])).count() == 0


def test_bands_are_tuned_for_recall():
    bands, rows = passages.tune_bands(0.8, 0.999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 and bands * rows <= passages.MAX_HASHES


def test_one_id_with_two_texts(docs_of, prose):
    """Spans belong to a row's own text: nothing is cut by places of another text that shares its id."""
    shared = " ".join(f"shared{k}" for k in range(60))
    texts = [shared, shared + " and own", "éé " * 7 + "\n" + shared + " ünd", "x" * 50 + " " + prose(2, 30), None, ""]
    rows = passages.remove_repeats(docs_of(texts, [1, 7, 7, 7, 7, 7])).collect()
    want = [(1, shared, 0), (7, "", 1), (7, "éé " * 7 + "\n", 1), (7, texts[3], 0), (7, None, 0), (7, "", 0)]
    assert sorted(((r.doc_id, r.text, r.n_removed) for r in rows), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("cap", [256, 4])
def test_paragraph_components_equal_brute_force(docs_of, prose, cap, monkeypatch):
    """Lines on both sides of the limit: a line goes if its component has a line in a text with a smaller key."""
    monkeypatch.setattr(passages, "CAP", cap)
    monkeypatch.setattr(passages.band_blocks, "__defaults__", (cap,))
    rnd = random.Random(11)
    lines = [edited(prose(k % 6, 40), rnd, rnd.randint(0, 4)) for k in range(60)] + [prose(100 + k, 12) for k in range(10)]
    rnd.shuffle(lines)
    docs = [(i, "\n\n".join(lines[7 * i : 7 * i + 7])) for i in range(10)]
    numbered = [(n, line) for n, line in enumerate(lines)]
    groups = brute(numbered, 5)
    least = {}
    for n, _ in numbered:
        least[groups[n][1]] = min(least.get(groups[n][1], 99), n // 7)
    want = {(n // 7, line) for n, line in numbered if n // 7 > least[groups[n][1]]}
    spans = passages._near_paragraphs(
        docs_of([t for _, t in docs]).selectExpr("doc_id", "text", "xxhash64(text) as _hash"), 5, (80, 100), "doc_id", "text", 5
    ).collect()
    texts = {i: t.encode() for i, t in docs}
    assert {(r.doc_id, texts[r.doc_id][r.start : r.end].decode().strip()) for r in spans} == want
