import base64
import gzip
import hashlib

import pytest

from stayline.llm import warc

DDL = "page_id long, url string, html string, record_type string"


def plain(rows):
    """Brute force: sorted (page_id, bytes, digest, type, refers_to)."""
    out = []
    for i, _, t, _ in rows:
        same = [j for j, _, u, _ in rows if (u or "") == (t or "") and j is not None]
        first = max(same, default=None)
        body = (t or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        again = first is not None and i != first
        out.append((i, len(body), digest, "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


ROWS = [
    (1, "http://a/1", "<p>x</p>", "c"), (2, "http://a/2", "<p>x</p>", "c"), (3, None, "<p>é\U0001f600</p>", "c"), (4, "u\r\nWARC-Type: x", "", "c"),
    (5, "", None, "c"), (None, "n", "<p>x</p>", "c"), (None, "n", "alone", "c"), (6, "big", "word\r\n\r\n" * 300_000, "c"), (7, "dup", "twice", "c"), (7, "dup", "twice", "c"),
]


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame(ROWS, DDL)


def test_archives_read_back(spark, pages, tmp_path):
    path = (tmp_path / "a").as_uri()
    got = sorted((tuple(r) for r in warc.archive_pages(pages, path).collect()), key=str)
    assert got == plain(ROWS)
    files = list((tmp_path / "a").glob("*.warc.gz"))
    assert files and not list((tmp_path / "a").glob("_pending*"))
    whole = b"".join(gzip.open(f).read() for f in files)  # plain gzip members, one record each
    assert whole.count(b"WARC/1.1\r\n") == len(ROWS)


def test_small_payloads_are_responses(spark, pages):
    rows = warc.page_records(pages, least_bytes=100).collect()
    assert {r.record_type for r in rows} == {"response"}


def test_empty_table(spark, pages):
    assert warc.archive_pages(pages.limit(0)).count() == 0


def read(spark, path, **options):
    return spark.read.format("warc").options(**options).load(path)


def test_predicates_are_pushed_down_and_payloads_skipped(spark, pages, tmp_path):
    path = str(tmp_path / "b")
    warc.archive_pages(pages, path).count()
    df = read(spark, path).filter("record_type = 'revisit'")
    again = sum(r[3] == 'revisit' for r in plain(ROWS))
    assert df.count() == again == 3 and {r.payload for r in df.collect()} == {None}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan
    one = read(spark, path).filter("record_id in ('urn:page:3', 'urn:page:9')").collect()
    assert [bytes(r.payload).decode() for r in one] == ["<p>é\U0001f600</p>"]
    both = read(spark, path).filter("record_type = 'response' and payload_bytes > 1000")
    assert [len(r.payload) for r in both.collect()] == [2_400_000]
    assert {r.payload for r in read(spark, path, payload="false").collect()} == {None}
    assert read(spark, path).filter("refers_to is not null").count() == again


def test_members_of_other_writers_and_damage(tmp_path):
    row = {"record_id": "urn:x:1", "record_type": "response", "target_uri": "t", "refers_to": None, "payload": b"body" * 9}
    raw = warc.record(row, "2000-01-01T00:00:00Z")
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(raw) + warc.member(raw) + gzip.compress(raw))
    reader = warc.WarcReader({"path": str(tmp_path), "verify": "true"})
    (part,) = reader.partitions()
    rows = [r for b in reader.read(part) for r in b.to_pylist()]
    assert [r["payload"] for r in rows] == [b"body" * 9] * 3
    bad = gzip.compress(raw.replace(b"bodybody", b"bodyBODY"))
    (tmp_path / "x.warc.gz").write_bytes(bad)
    with pytest.raises(OSError, match="digest"):
        list(reader.read(part))
    (tmp_path / "x.warc.gz").write_bytes(warc.member(raw)[:-40])
    with pytest.raises(OSError):
        list(reader.read(part))


def test_overwrite_replaces_and_append_adds(spark, pages, tmp_path):
    warc.register(spark)
    path = str(tmp_path / "c")
    records = warc.page_records(pages)
    for mode, n in (("append", 10), ("append", 20), ("overwrite", 10)):
        records.write.format("warc").mode(mode).save(path)
        assert read(spark, path, payload="false").count() == n
