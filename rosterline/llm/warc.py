"""WARC: a PySpark Python data source that writes and reads web archives.

Writing: each task writes archives of one gzip member per record and starts a new
file at FILE_BYTES.  Files carry a random name and count only when the commit
lists them in the manifest, so a task that was run twice leaves no double rows.

Reading: the manifest gives the files, which are the partitions.  Filters on
record type, page, digest and address are pushed into the reader; it parses a
record's headers first and decodes the payload only if the record passes and the
payload is asked for.  Paths are opened through Arrow's file systems, so the
archive can lie wherever the cluster's shared folder is.

Of records with equal payloads the one with the largest page id is the response
and the others revisit it (rows that repeat that page are all responses); a
payload below ``least`` bytes is always a response.

Cases: null html is the empty payload; null url has no address header; a null
page id is the smallest, and among pages that all lack an id each is a response;
an empty table gives an archive without files and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    WriterCommitMessage,
)

from rosterline.llm.common import scratch_path

FILE_BYTES = 32 << 20
DATE = "2024-01-01T00:00:00Z"
MANIFEST = "_manifest.json"
READ_SCHEMA = (
    "page_id long, record_type string, url string, payload_digest string, payload_bytes long, refers_to long, payload binary"
)
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_URN = "urn:page:"
#: column -> header (and what stands around the value)
_HEADERS = {
    "page_id": "WARC-Record-ID", "record_type": "WARC-Type", "url": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest", "payload_bytes": "X-Payload-Length", "refers_to": "WARC-Refers-To",
}


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, refers_to, revisit: bool) -> bytes:
    """One record: headers, HTTP head and, for a response, the payload."""
    block = _HTTP if revisit else _HTTP + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}"]
    head.append(f"WARC-Record-ID: <{_URN}{'' if page_id is None else page_id}>")
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head += [f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest(payload)}", f"X-Payload-Length: {len(payload)}"]
    if revisit:
        head.append(f"WARC-Refers-To: <{_URN}{refers_to}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parse_headers(text: bytes) -> dict[str, str]:
    lines = text.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return dict(line.split(": ", 1) for line in lines[1:] if line)


def header_value(headers: dict[str, str], column: str):
    """A column's value as the headers give it."""
    v = headers.get(_HEADERS[column])
    if v is None:
        return None
    if column in ("page_id", "refers_to"):
        v = v[1 + len(_URN) : -1]
        return int(v) if v else None
    if column == "payload_bytes":
        return int(v)
    return v.removeprefix("sha1:") if column == "payload_digest" else v


def members(chunks: Iterator[bytes], wanted) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(headers, payload) of the records ``wanted`` (headers -> 0 skip, 1 headers, 2 payload).

    A record is inflated piece by piece.  Headers come first; for an unwanted
    payload what follows is inflated into nothing, to find the next record.
    """
    rest = b""
    chunks = iter(chunks)
    while True:
        if not rest:
            rest = next(chunks, b"")
            if not rest:
                return
        inflate, got, headers, need = zlib.decompressobj(31), [], None, 2
        while not inflate.eof:
            if not rest:
                rest = next(chunks, b"")
                if not rest:
                    raise EOFError("archive ends inside a record")
            out = inflate.decompress(rest, 1 << 16)
            rest = inflate.unconsumed_tail or inflate.unused_data
            if need == 2:
                got.append(out)
                if headers is None:
                    head, mark, body = b"".join(got).partition(b"\r\n\r\n")
                    if mark:
                        headers, got = parse_headers(head), [body]
                        need = wanted(headers)
        if need:
            yield headers, b"".join(got)[len(_HTTP) : -4] if need == 2 else None


@dataclass
class ArchiveFile(InputPartition):
    path: str

    def __init__(self, path: str):
        self.path = path


@dataclass
class WrittenFiles(WriterCommitMessage):
    files: list[str] = field(default_factory=list)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, batches: Iterator[pa.RecordBatch]) -> WrittenFiles:
        fs, root = _file_system(self.path)
        done, out, size = WrittenFiles([]), None, 0
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to", "revisit")]
            for row in zip(*cols):
                if out is None:
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    out, size = fs.open_output_stream(f"{root}/{name}", compression=None), 0
                    done.files.append(name)
                packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                data = packer.compress(record(*row)) + packer.flush()
                out.write(data)
                size += len(data)
                if size >= FILE_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return done

    def commit(self, messages) -> None:
        fs, root = _file_system(self.path)
        names = sorted(f for m in messages if m for f in m.files)
        with fs.open_output_stream(f"{root}/{MANIFEST}") as out:
            out.write(json.dumps(names).encode())

    def abort(self, messages) -> None:
        fs, root = _file_system(self.path)
        for m in messages:
            for f in m.files if m else ():
                fs.delete_file(f"{root}/{f}")


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: str):
        self.path = path
        self.payload = payload  # all, response or none
        self.tests: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters):
        for f in filters:
            value = {EqualTo: lambda: (f.value,), In: lambda: f.value}.get(type(f))
            if value is not None and len(f.attribute) == 1 and f.attribute[0] in _HEADERS:
                self.tests.append((f.attribute[0], frozenset(value())))
            else:
                yield f

    def partitions(self):
        fs, root = _file_system(self.path)
        with fs.open_input_stream(f"{root}/{MANIFEST}") as f:
            names = json.loads(f.read())
        return [ArchiveFile(n) for n in names] or [ArchiveFile("")]

    def _wanted(self, headers: dict[str, str]) -> int:
        if any(header_value(headers, c) not in allowed for c, allowed in self.tests):
            return 0
        kind = header_value(headers, "record_type")
        return 2 if self.payload == "all" or self.payload == kind else 1

    def read(self, partition: ArchiveFile):
        kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        schema = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in READ_SCHEMA.split(", "))])
        if not partition.path:
            return
        fs, root = _file_system(self.path)
        with fs.open_input_stream(f"{root}/{partition.path}", compression=None) as f:
            rows, size = [], 0
            for headers, payload in members(iter(lambda: f.read(1 << 20), b""), self._wanted):
                kind = header_value(headers, "record_type")
                has = payload is not None and kind == "response"
                if has and digest(payload) != header_value(headers, "payload_digest"):
                    raise ValueError(f"payload does not match its digest: {headers}")
                rows.append([*(header_value(headers, c) for c in _HEADERS), payload if has else None])
                size += len(payload or b"")
                if size >= 4 << 20 or len(rows) >= 5000:
                    yield self._batch(rows, schema)
                    rows, size = [], 0
            if rows:
                yield self._batch(rows, schema)

    @staticmethod
    def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class WarcDataSource(DataSource):
    """Options: path; payload = all, response or none (default)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "none"))

    def writer(self, schema, overwrite) -> WarcWriter:
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_archive(pages: DataFrame, path: str, least: int = 0) -> None:
    """One record for every row of ``pages`` (page_id, url, html)."""
    spark = pages.sparkSession
    register(spark)
    fs, root = _file_system(path)
    fs.create_dir(root, recursive=True)
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), "url", payload.alias("html")).withColumn(
        "_key", F.concat(F.sha1(F.col("html").cast("binary")), F.octet_length("html").cast("string"))
    )
    # The largest page of each payload; counts are summed before the shuffle, and
    # the join may split a payload that many pages share.
    first = rows.groupBy("_key").agg(F.max("page_id").alias("_first"))
    revisit = (F.octet_length("html") >= least) & F.coalesce(F.col("page_id") < F.col("_first"), F.col("_first").isNotNull())
    out = rows.join(first, "_key").select(
        "page_id", "url", F.col("html").cast("binary").alias("payload"), F.col("_first").alias("refers_to"), revisit.alias("revisit")
    )
    out.write.format("warc").option("path", path).mode("append").save()


def read_archive(spark: SparkSession, path: str, payload: str = "none") -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("path", path).option("payload", payload).load()


def archived(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to an archive in the shared folder and read it back.

    Responses are decoded and held against their digest; a revisit's payload is
    not in the archive, so its length and digest are those of its headers.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, f"llm/warc-{uuid.uuid4().hex}")
    write_archive(pages, path)
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    full = read_archive(spark, path, "response").where("record_type = 'response'")
    again = read_archive(spark, path).where("record_type = 'revisit'")
    return full.select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), *cols[2:], F.lit(None).cast("long").alias("refers_to")
    ).unionByName(again.select(*cols, "refers_to"))
