import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from stayline.llm import queries, secrets, trie

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def base_of(text):
    """Brute force by the plain patterns; what is too short is used up all the same."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(found)


SOURCE = '''db_pass = "Tr0ub4dor&3x"
part = "abcd1234"
client_secret_value = part + 'EFGH5678'
cfg = { "private_key": "MIIEpQIBAAK+9", name: "bob smith jones" };
os.environ["SIGNING_KEY"] = ("aaa1131bbb"
   "CCC222ddd")
auth: str = 'k9#mL2$p'
PWD=s3cr3tV4lue
pwd: ${FROM_ENV}
passphrase_length = "12345678"
<clientSecret>zz99-yy88-xx77</clientSecret>
run --auth-key q1w2e3r4t5y6
x = y = "Zx81-Spectrum"
master_key = x
loop = loop
title = "A1b2C3d4E5"
é: passwd = "éàü-Üß12"
'''
SECRETS = [
    "Tr0ub4dor&3x", "abcd1234", "EFGH5678", "MIIEpQIBAAK+9", "aaa1131bbb", "CCC222ddd", "k9#mL2$p", "s3cr3tV4lue",
    "zz99-yy88-xx77", "q1w2e3r4t5y6", "Zx81-Spectrum", "éàü-Üß12",
]


def test_literals_that_reach_sensitive_names():
    found = [SOURCE[p.start : p.end] for p in secrets.spans(SOURCE) if p.kind == "literal"]
    assert sorted(found) == sorted(SECRETS)


@pytest.mark.parametrize(
    "text",
    ["password: changeme_", "secret = None", "The secret: it is here.", "if token == 'abc': pass", "key = 'value one'", "a = b\nb = a\nsecret = a", 'pwd = "', "token_count = 123456789"],
)
def test_no_literals(text):
    assert not [p for p in secrets.spans(text) if p.kind == "literal"]


def test_scan_equals_brute_force_on_base_spans(docs_of):
    rnd = random.Random(11)
    bits = ["password=", "Token: ", "API_KEY='", "apikey = \"", "AKIA", "ABCDEFGH01234567", "deadbeef", "0123456789ab", " ", "\n", "é", "x", "passwd=token:", "abcdefgh", "=", "ſecret=abcdefgh", "toKen=abcdefgh"]
    texts = ["".join(rnd.choices(bits, k=rnd.randint(1, 14))) for _ in range(300)] + [None, "", SOURCE, "passwd=token:abcdefgh", "a=" * 30_000 + "secret=q1w2e3r4"]
    ids = [*range(len(texts) - 1), 0]
    df = docs_of(texts, ids).withColumn("found", F.lit(1))
    rows = secrets.scan(df).collect()
    assert [r.doc_id for r in rows] == ids and rows[0].score == "x0"
    for r, t in zip(rows, texts):
        assert [(p.start, secrets.KINDS.index(p.kind), p.end) for p in r.found if p.kind != "literal"] == base_of(t or "")
        ends = [(p.start, p.end) for p in r.found if p.kind != "literal"]
        assert all(p.end <= a or p.start >= b for p in r.found if p.kind == "literal" for a, b in ends)
    assert secrets.scan(docs_of([])).count() == 0


def test_query_digests(spark, docs_of, tmp_path):
    texts = ["secret=abc123 deadbeefdeadbeefdeadbeef", SOURCE, None]
    docs_of(texts).write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.op11_secrets(spark, str(tmp_path)).collect():
        base = base_of(texts[r.doc_id] or "")
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == n for _, k, _ in base) for n in range(3)]
        line = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert r.spans == ",".join(f"{p.kind}:{p.start}:{p.end}" for p in secrets.spans(texts[r.doc_id]))


def brute_trie(rows):
    """Rows of the query, by lists of (role, text)."""
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    seqs = {}
    for c, ts in own.items():
        h = (zlib.crc32(str(c).encode()) & 0xFFFFFFFF) % 9
        seqs[c] = own.get(c - c % 5, [])[:h] + ts[h:]
    members = collections.defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    kids = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, ms in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(ms) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, ms in members.items():
        ends = ",".join(str(c) for c in sorted(ms) if len(seqs[c]) == len(p))
        up = min(members[p[:-1]]) if p else None
        out.append((min(ms), len(p), up, len(ms), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def tried(spark, rows, **kw):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("depth", F.lit("x"))
    got = trie.trie(*trie.regraft(trie.turns_of(df)), **kw)
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("block", [4, 1])
def test_trie_equals_brute_force(spark, block):
    """Copies, shared beginnings, conversations that end inside others, long and turnless ones, NULLs, repeated rows."""
    rnd = random.Random(12)
    rows = []
    for c in [*range(60), 1003, 1004]:  # the last two have no stem
        n = rnd.choice([1, 2, 3, 5, 9, 14])
        rows += [(c, t, "user" if t % 2 else None, rnd.choice(["a", "é", "", None])) for t in range(n)]
    rows += [(c, t, "user", f"turn {t}") for c in range(70, 95) for t in range(10)]  # one conversation many times
    rows += [(c, t, "user", f"turn {t}" if t < 7 else f"own {c}") for c in range(100, 112) for t in range(9)]
    rows += [(200, None, None, None), (200, 1, "a", "bc"), (200, 1, "ab", "c"), (200, 1, "ab", "c"), (None, 0, "x", "y")]
    assert tried(spark, rows, block=block) == brute_trie(rows)


def test_trie_of_few_rows(spark):
    assert tried(spark, []) == []
    for rows in ([(5, 0, "u", "x")], [(7, 0, "u", "x")], [(5, 0, "u", "x"), (10, 0, "u", "x")]):
        assert tried(spark, rows) == brute_trie(rows)
    one = spark.createDataFrame([(1, 0, "u", "x"), (2, 0, "u", "x"), (2, 1, "a", "yy")], "conv_id long, turn int, role string, text string")
    got = {(r.depth, r.n_convs, r.n_leaves, r.saved_tokens) for r in trie.trie(trie.turns_of(one)).collect()}
    assert got == {(0, 2, 1, 1), (1, 2, 1, 1), (2, 1, 1, 0)}
