"""WARC archives as a PySpark data source: `spark.dataSource.register(WarcDataSource)`, format "warc".

Files are `*.warc.gz` with one gzip member per record. Members written here carry their compressed
length in the gzip extra field, so a reader can step over a record without inflating it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    WriterCommitMessage,
)

from stayline.session import new_path

SCHEMA = (
    "record_id string, record_type string, target_uri string, payload_digest string, "
    "payload_bytes bigint, refers_to string, payload binary"
)
ROLL_BYTES = 64 << 20  # compressed size at which a writer starts the next file
SPLIT_BYTES = 32 << 20  # files are planned together up to this size
HEAD_BYTES = 4096
PIECE = 256 << 10
BATCH_BYTES = 4 << 20

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SUBFIELD = b"sl"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def file_system(uri: str):
    """(file system, path) of a folder that the driver and all executors share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/*", "file:///", uri))


def member(raw: bytes) -> bytes:
    """One gzip member with its whole length in the extra field."""
    z = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = z.compress(raw) + z.flush()
    extra = SUBFIELD + struct.pack("<HI", 4, 12 + 8 + len(body) + 8)
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


def record(row: dict, date: str) -> bytes:
    """A response or revisit record. The HTTP head is kept in both, the payload in responses only."""
    payload = row["payload"] or b""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if row["record_type"] == "revisit" else http + payload
    head = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": f"<{row['record_id']}>",
        "WARC-Date": date,
        "WARC-Target-URI": row["target_uri"],
        "WARC-Payload-Digest": "sha1:" + sha1_base32(payload),
        "WARC-Refers-To": f"<{row['refers_to']}>" if row["refers_to"] else None,
        "WARC-Profile": REVISIT_PROFILE if row["record_type"] == "revisit" else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = [f"{k}: {re.sub('[\r\n]+', ' ', v)}".encode() for k, v in head.items() if v is not None]
    return VERSION + b"\r\n" + b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class Files(InputPartition):
    paths: list


@dataclass
class Written(WriterCommitMessage):
    names: list


class WarcWriter(DataSourceArrowWriter):
    """Each attempt of a task writes files of its own names; the commit moves those of the attempts
    that count into the folder, so a lost or repeated task leaves no record twice."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.date = options["path"], options.get("date", "2000-01-01T00:00:00Z")
        self.overwrite, self.pending = overwrite, f"_pending-{uuid.uuid4().hex}"

    def write(self, iterator):
        fs, root = file_system(self.path)
        fs.create_dir(f"{root}/{self.pending}", recursive=True)
        names, out, size = [], None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None or size >= ROLL_BYTES:
                        if out is not None:
                            out.close()
                        names.append(f"{uuid.uuid4().hex}.warc.gz")
                        out, size = fs.open_output_stream(f"{root}/{self.pending}/{names[-1]}", compression=None), 0
                    raw = member(record(row, self.date))
                    out.write(raw)
                    size += len(raw)
        finally:
            if out is not None:
                out.close()
        return Written(names)

    def commit(self, messages):
        from pyarrow import fs as pafs

        fs, root = file_system(self.path)
        if self.overwrite:
            for f in fs.get_file_info(pafs.FileSelector(root)):
                if f.base_name.endswith(".warc.gz"):
                    fs.delete_file(f.path)
        for message in messages:
            for name in message.names if message else ():
                fs.move(f"{root}/{self.pending}/{name}", f"{root}/{name}")
        self.abort(messages)

    def abort(self, messages):
        from pyarrow import fs as pafs

        fs, root = file_system(self.path)
        if fs.get_file_info(f"{root}/{self.pending}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/{self.pending}")


class Member:
    """One gzip member of an open file, inflated only as far as asked for."""

    def __init__(self, file, at: int):
        self.file, self.at = file, at
        file.seek(at)
        self.raw = file.read(HEAD_BYTES)
        self.known = None
        if self.raw[3:4] == b"\x04" and self.raw[12:14] == SUBFIELD:
            self.known = struct.unpack("<I", self.raw[16:20])[0]
        self.z = zlib.decompressobj(31)
        self.out = bytearray(self.z.decompress(self.raw, HEAD_BYTES))

    def inflate(self, need=None) -> bool:
        """More inflated bytes, at least up to `need` (all, if None); False at the member's end."""
        while not self.z.eof and (need is None or len(self.out) < need):
            raw = self.z.unconsumed_tail or self.file.read(PIECE)
            if not raw:
                raise OSError("archive ends inside a record")
            self.out += self.z.decompress(raw, PIECE)
        return not self.z.eof

    def end(self) -> int:
        """Where the next member begins; members of unknown length are inflated and thrown away."""
        if self.known is not None:
            return self.at + self.known
        while not self.z.eof:
            raw = self.z.unconsumed_tail or self.file.read(PIECE)
            if not raw:
                raise OSError("archive ends inside a record")
            self.z.decompress(raw, PIECE)
        return self.file.tell() - len(self.z.unused_data)


def fields(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines if line)}


class WarcReader(DataSourceReader):
    """Plans files, parses the heads of records, and inflates payloads only of records that pass.

    Predicates on record_type, record_id, target_uri, payload_digest and refers_to (=, <=>, in,
    is not null) are decided from the head. Option payload=false leaves all payloads out (NULL);
    verify=true compares each payload that is read with its digest.
    """

    DECIDED = ("record_type", "record_id", "target_uri", "payload_digest", "refers_to")

    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() != "false"
        self.verify = options.get("verify", "false").lower() == "true"
        self.filters: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            kind = type(f)
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name in self.DECIDED and kind in (EqualTo, EqualNullSafe):
                self.filters.append((name, "in", (f.value,)))
            elif name in self.DECIDED and kind is In:
                self.filters.append((name, "in", tuple(f.value)))
            elif name in self.DECIDED and kind is IsNotNull:
                self.filters.append((name, "set", None))
            else:
                yield f

    def passes(self, row: dict) -> bool:
        return all(
            row[name] in value if op == "in" else row[name] is not None for name, op, value in self.filters
        )

    def partitions(self):
        from pyarrow import fs as pafs

        fs, root = file_system(self.path)
        found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        files = sorted((f.path, f.size) for f in found if f.base_name.endswith(".warc.gz"))
        groups, size = [[]], 0
        for path, n in files:
            if groups[-1] and size + n > SPLIT_BYTES:
                groups.append([])
                size = 0
            groups[-1].append(path)
            size += n
        return [Files(g) for g in groups]

    def read(self, partition):
        fs, _ = file_system(self.path)
        for path in partition.paths:
            with fs.open_input_file(path) as file:
                yield from self._batches(file)

    def _batches(self, file):
        names = [f.split(" ")[0] for f in SCHEMA.split(", ")]
        kinds = [pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string() for n in names]
        rows, size = [], 0

        def batch():
            cols = [pa.array([r[n] for r in rows], t) for n, t in zip(names, kinds)]
            return pa.RecordBatch.from_arrays(cols, names=names)

        at, total = 0, file.size()
        while at < total:
            part = Member(file, at)
            row = self._record(part)
            at = part.end()
            if row is not None:
                rows.append(row)
                size += len(row["payload"] or b"") + 200
                if size >= BATCH_BYTES:
                    yield batch()
                    rows, size = [], 0
        if rows:
            yield batch()

    def _record(self, part: Member) -> dict | None:
        while (cut := part.out.find(b"\r\n\r\n")) < 0 and part.inflate(len(part.out) + 1):
            pass
        head = fields(bytes(part.out[:cut]))
        bare = {k: head[k].strip("<>") for k in ("warc-record-id", "warc-refers-to") if k in head}
        digest = head.get("warc-payload-digest")
        row = {
            "record_id": bare.get("warc-record-id"),
            "record_type": head.get("warc-type"),
            "target_uri": head.get("warc-target-uri"),
            "payload_digest": digest.removeprefix("sha1:") if digest else None,
            "payload_bytes": None,
            "refers_to": bare.get("warc-refers-to"),
            "payload": None,
        }
        if not self.passes(row):
            return None
        start, length = cut + 4, int(head.get("content-length", 0))
        if head.get("content-type", "").startswith("application/http"):
            while (cut := part.out.find(b"\r\n\r\n", start)) < 0 and part.inflate(len(part.out) + 1):
                pass
            row["payload_bytes"] = int(fields(bytes(part.out[start:cut])).get("content-length", 0))
            body = cut + 4
        else:
            row["payload_bytes"], body = length, start
        if self.payload and row["record_type"] != "revisit":
            part.inflate(start + length)
            row["payload"] = bytes(part.out[body : start + length])
            if self.verify and sha1_base32(row["payload"]) != row["payload_digest"]:
                raise OSError(f"payload of {row['record_id']} does not have its digest")
        return row


class WarcDataSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def page_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """A record per row of `pages` (page_id, url, html). Of rows with equal payloads of at least
    `least_bytes`, the largest page_id is a response and the others revisit it.

    A NULL html is an empty payload. A NULL page_id is no target: its row revisits another one if it
    can and is a response otherwise; repeated rows of the largest page_id are all responses. The
    join splits a payload that many rows share, since Spark splits skewed partitions of its left side.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.col("url").alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumn("same", F.sha2("payload", 256))
    first = rows.groupBy("same").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    first = first.filter("n > 1").drop("n")
    joined = rows.join(first, "same", "left")
    again = (F.octet_length("payload") >= least_bytes) & F.col("first").isNotNull()
    again = again & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        urn(F.col("page_id")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.when(again, urn(F.col("first"))).alias("refers_to"),
        "payload",
    )


def urn(page_id):
    return F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")))


def page_of(record_id: str):
    return F.nullif(F.substring_index(record_id, ":", -1), F.lit("none")).cast("bigint")


def archive_pages(pages: DataFrame, path: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Writes `pages` as WARC files into `path` (by default a new folder in the shared scratch folder)
    and reads the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Responses are read with their payloads, which must have their digests; of revisits only the
    heads are read. An empty table gives an empty archive and result.
    """
    spark = pages.sparkSession
    register(spark)
    path = path or new_path(spark, "warc")
    page_records(pages, least_bytes).write.format("warc").mode("append").save(path)
    whole = spark.read.format("warc").option("verify", "true").load(path).filter("record_type = 'response'")
    heads = spark.read.format("warc").option("payload", "false").load(path).filter("record_type = 'revisit'")
    return (
        whole.unionByName(heads)
        .select(
            page_of("record_id").alias("page_id"),
            "payload_bytes",
            "payload_digest",
            "record_type",
            page_of("refers_to").alias("refers_to"),
        )
    )
