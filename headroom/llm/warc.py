"""WARC archives as a Spark data source (``spark.read.format("warc")``), written and read in Python.

Writing: each task writes its own files under new names, one gzip member per record, and the commit
puts the finished ones into a manifest; readers take what a manifest names, so files of lost or
repeated tasks are never read. Every member carries its compressed length (gzip extra field ``sl``).

Reading: partitions are byte ranges between record starts that the manifest names (whole files where
there is none, gzip or plain). Of each record the headers are inflated and parsed first; predicates
on record_type and the other header columns are pushed down and decided there, and the payload of a
record that isn't wanted, or of any with option ``payload`` false, is skipped without inflating it.

Defined cases of ``archive``: null html is an empty payload; a null url has no target header; equal
payloads under 1000 bytes are all response; of larger equal ones the largest page_id is response
(all rows that share it, if it repeats; all, if every id is null) and the others, null ids included, are revisit records without payload; line breaks in a url are percent-encoded. An empty
table makes an archive without records. Only the named columns are read.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, WriterCommitMessage

from headroom.llm.text import table
from headroom.session import fresh_path

REVISIT_BYTES = 1000
FILE_BYTES = 256 << 20
RANGE_BYTES = 16 << 20
LEVEL = 4
#: Header of each column.
HEADERS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
           "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest", "payload_bytes": "X-Payload-Length"}
SCHEMA = "record_id string, record_type string, target_uri string, date string, refers_to string, payload_digest string, payload_bytes bigint"
_END = b"\r\n\r\n"


def _files(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return pafs.LocalFileSystem(), path


def member(headers: dict[str, str | None], payload: bytes) -> bytes:
    """One gzip member with one record; headers and payload are deflated apart."""
    lines = [f"{k}: {re.sub('[\r\n]', lambda m: '%%%02X' % ord(m[0]), v)}" for k, v in headers.items() if v is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(payload)}"]).encode() + _END
    deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    body = deflate.compress(head) + deflate.flush(zlib.Z_FULL_FLUSH) + deflate.compress(payload) + deflate.compress(_END) + deflate.flush()
    crc = zlib.crc32(_END, zlib.crc32(payload, zlib.crc32(head)))
    size = len(head) + len(payload) + len(_END)
    extra = struct.pack("<2sHII", b"sl", 8, 24 + len(body) + 8, size & 0xFFFFFFFF)
    return struct.pack("<BBBBIBBH", 0x1F, 0x8B, 8, 4, 0, 0, 255, len(extra)) + extra + body + struct.pack("<II", crc, size & 0xFFFFFFFF)


class Range(InputPartition):
    def __init__(self, path: str, start: int, stop: int):
        self.path, self.start, self.stop = path, start, stop


class Written(WriterCommitMessage):
    def __init__(self, files: list):
        self.files = files


class _Window:
    """Random reads of a file through one buffer."""

    def __init__(self, file, size: int = 1 << 20):
        self.file, self.size, self.at, self.data = file, size, 0, b""

    def get(self, at: int, n: int) -> bytes:
        if at < self.at or at + n > self.at + len(self.data):
            self.file.seek(at)
            self.at, self.data = at, self.file.read(max(n, self.size))
        return self.data[at - self.at:at - self.at + n]


def _parse(head: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


class Record(NamedTuple):
    headers: dict[str, str]
    payload: bytes | None
    stop: int


def record_at(window: _Window, at: int, wants) -> Record | None:
    """The record that starts at byte ``at``; its payload only if ``wants(headers)``. None at the end."""
    start = window.get(at, 2)
    if len(start) < 2:
        return None
    if start != b"\x1f\x8b":  # a plain record
        n = 4096
        while (cut := (raw := window.get(at, n)).find(_END)) < 0:
            if len(raw) < n:
                return None
            n *= 2
        headers = _parse(raw[:cut])
        body, size = at + cut + len(_END), int(headers.get("content-length", 0))
        return Record(headers, window.get(body, size) if wants(headers) else None, body + size + len(_END))
    fixed = window.get(at, 12)
    body, length = 10, 0
    if fixed[3] & 4:
        extra = window.get(at + 12, struct.unpack("<H", fixed[10:12])[0])
        body = 12 + len(extra)
        if extra[:2] == b"sl":
            length = struct.unpack("<I", extra[4:8])[0]
    for flag in (8, 16):
        if fixed[3] & flag:
            while window.get(at + body, 1) != b"\0":
                body += 1
            body += 1
    body += 2 if fixed[3] & 2 else 0
    inflate, out, take = zlib.decompressobj(-15), b"", at + body
    while _END not in out and not inflate.eof:
        chunk = window.get(take, min(2048, length + at - take) if length else 2048)
        if not chunk:
            return None
        take += len(chunk)
        out += inflate.decompress(chunk)
    cut = out.index(_END)
    headers = _parse(out[:cut])
    wanted = wants(headers)
    if length and not wanted:
        return Record(headers, None, at + length)
    size = int(headers.get("content-length", 0))
    parts = [out[cut + len(_END):]]
    while not inflate.eof:
        chunk = window.get(take, min(1 << 18, length + at - take) if length else 1 << 16)
        if not chunk:
            break
        take += len(chunk)
        part = inflate.decompress(chunk)
        if wanted:
            parts.append(part)
    return Record(headers, b"".join(parts)[:size] if wanted else None, at + length if length else take - len(inflate.unused_data) + 8)


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload, self.tests = path, payload, []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In)) else None
            if column in HEADERS and column != "payload_bytes":
                self.tests.append((HEADERS[column].lower(), {f.value} if isinstance(f, EqualTo) else set(f.value)))
            else:
                yield f

    def partitions(self):
        files, root = _files(self.path)
        found = files.get_file_info(pafs.FileSelector(root, recursive=True))
        named = [json.loads(files.open_input_file(f.path).read()) for f in found if "/_manifest-" in f.path]
        if named:
            return [Range(f"{root}/{name}", a, b) for m in named for name, cuts in m for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return [Range(f.path, 0, f.size) for f in found if re.search(r"\.warc(\.gz)?$", f.path) and f.size]

    def read(self, partition):
        names = [*HEADERS, *(["payload"] if self.payload else [])]
        types = [pa.string()] * 6 + [pa.int64(), pa.binary()]
        rows, held = [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], types[i]) for i in range(len(names))], names=names)

        if partition is None:  # an archive without records
            yield batch()
            return
        passes = lambda headers: all(headers.get(k) in values for k, values in self.tests)
        with _files(self.path)[0].open_input_file(partition.path) as file:
            window, at = _Window(file), partition.start
            while at < partition.stop and (record := record_at(window, at, lambda h: self.payload and passes(h))):
                at = record.stop
                if not passes(record.headers):
                    continue
                own = [record.headers.get(h.lower()) for h in HEADERS.values()]
                own[-1] = int(own[-1] or record.headers.get("content-length", 0))
                rows.append((*own, record.payload))
                held += len(record.payload or b"") + 256
                if held > 4 << 20:
                    yield batch()
                    rows, held = [], 0
        yield batch()


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool = False):
        self.path, self.overwrite = path, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]):
        files, root = _files(self.path)
        files.create_dir(root, recursive=True)
        done, out, cuts, at = [], None, [], 0

        def close() -> None:
            out.close()
            done.append((name, [*cuts, at]))

        name = ""
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        close()
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    out, cuts, at = files.open_output_stream(f"{root}/{name}", compression=None), [0], 0
                if at - cuts[-1] >= RANGE_BYTES:
                    cuts.append(at)
                text = {h: None if row.get(c) is None else str(row[c]) for c, h in HEADERS.items()}
                own = member(text, row.get("payload") or b"")
                out.write(own)
                at += len(own)
        if out is not None:
            close()
        return Written(done)

    def commit(self, messages):
        files, root = _files(self.path)
        files.create_dir(root, recursive=True)
        new = [f for m in messages if m for f in m.files]
        old = files.get_file_info(pafs.FileSelector(root, recursive=True)) if self.overwrite else []
        with files.open_output_stream(f"{root}/_manifest-{uuid.uuid4().hex}.json", compression=None) as out:
            out.write(json.dumps(new).encode())
        # The new manifest is there before the old ones and then their files go.
        mine = {name for name, _ in new}
        for f in sorted((f.path for f in old if f.type == pafs.FileType.File), key=lambda x: "/_manifest-" not in x):
            if "/_manifest-" in f or (re.search(r"\.warc(\.gz)?$", f) and f.rsplit("/", 1)[-1] not in mine):
                files.delete_file(f)

    def abort(self, messages):
        files, root = _files(self.path)
        for name, _ in [f for m in messages if m for f in m.files]:
            files.delete_file(f"{root}/{name}")


class WarcSource(DataSource):
    """Options: path; payload (default true)."""

    @classmethod
    def name(cls):
        return "warc"

    def _payload(self) -> bool:
        return self.options.get("payload", "true").lower() != "false"

    def schema(self):
        return SCHEMA + (", payload binary" if self._payload() else "")

    def reader(self, schema):
        return WarcReader(self.options["path"], self._payload())

    def writer(self, schema, overwrite):
        return WarcWriter(self.options["path"], overwrite)


def register(spark) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def archive(pages: DataFrame, path: str, *, page: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write a record per row; larger equal payloads once, as the response of the largest page id."""
    register(pages.sparkSession)
    own = pages.select(F.col(page).alias("page"), F.col(url).alias("target_uri"), F.encode(F.coalesce(F.col(html), F.lit("")), "utf-8").alias("payload"))
    own = own.withColumn("digest", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    equal = (own.filter(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("digest").agg(F.max("page").alias("keeper"), F.count("*").alias("n"))
             .filter("n > 1 and keeper is not null").select("digest", "keeper"))
    revisit = F.col("keeper").isNotNull() & ~F.col("page").eqNullSafe(F.col("keeper"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    records = own.join(equal, "digest", "left").select(
        name("page").alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"), "target_uri",
        F.lit("1970-01-01T00:00:00Z").alias("date"), F.when(revisit, name("keeper")).alias("refers_to"),
        F.concat(F.lit("sha1:"), "digest").alias("payload_digest"), "payload_bytes", F.when(~revisit, F.col("payload")).alias("payload"))
    records.write.format("warc").mode("append").save(path)


def op4_warc(spark, sf_dir: str) -> DataFrame:
    """Every page archived, and the archive read back; digests and lengths of responses are taken from what was read."""
    pages = table(spark, sf_dir, "pages")
    path = fresh_path(spark, "warc")
    archive(pages, path)
    kind = pages.schema["page_id"].dataType
    number = lambda c: F.nullif(F.regexp_extract(c, "^<urn:page:(.*)>$", 1), F.lit("")).cast(kind)
    response = F.col("record_type") == "response"
    return spark.read.format("warc").load(path).select(
        number("record_id").alias("page_id"),
        F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, F.sha1("payload")).otherwise(F.regexp_replace("payload_digest", "^sha1:", "")).alias("payload_digest"),
        "record_type", number("refers_to").alias("refers_to"))
