"""WARC archives as a Spark data source, and pages written as WARC.

``spark.read.format("warc")`` plans one partition per group of archive files
and reads each record's header first.  Comparisons of header columns with
constants are evaluated on the header; the blocks of records that fail them,
and all blocks when the requested schema has no ``payload``, are skipped by a
seek and never decoded.  ``df.write.format("warc")`` writes one archive per
task under a temporary name and renames it when the job commits, so a failed or
repeated task leaves nothing behind.

Archives are reached through Arrow's file systems, by the path's scheme.  Files
end in ``.warc`` or ``.warc.gz`` (whose blocks are skipped by decompressing over
them); hidden ones are passed over, and any other file is an error, so that no
archive is left out without a word.

Identical payloads: of the records with one payload the one with the largest
page_id is a ``response``, all others are ``revisit`` records that name it and
store no payload.  Null and empty html are the same payload of no bytes.

Defined results: rows repeating the largest page_id of their payload are all
responses; records of other writers have no page_id unless they name one; their
folded header lines are joined; a payload without a digest is not checked; a null page_id is written without an id and sorts below all others;
a null url is left out, and line ends in a url are written as %0D and %0A;
other columns are not written; no pages make no archive, which reads as no
rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import operator
import os
import posixpath
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyline.llm.tables import few
from tallyline.sources.stage import stage

HEADERS = (
    "page_id BIGINT, target_uri STRING, record_type STRING, payload_digest STRING, "
    "payload_bytes BIGINT, refers_to BIGINT"
)
SCHEMA = HEADERS + ", payload BINARY"
WRITTEN = ("page_id", "target_uri", "record_type", "refers_to", "payload")
PARTITION_BYTES = 64 << 20
BATCH_BYTES = 8 << 20
# Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE = "urn:page:"
TESTS = {
    D.EqualTo: operator.eq,
    D.GreaterThan: operator.gt,
    D.GreaterThanOrEqual: operator.ge,
    D.LessThan: operator.lt,
    D.LessThanOrEqual: operator.le,
}


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else _uri(path))


def _uri(path: str) -> str:
    # Spark writes file:/folder for local folders.
    return path.replace("file:/", "file:///", 1) if path.startswith("file:/") else os.path.abspath(path)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, uri: str | None, kind: str, refers_to: int | None, payload: bytes) -> bytes:
    """One record: WARC header, HTTP header, and the payload unless it is a revisit."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + payload if kind == "response" else http
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<{PAGE}{page_id}>" if page_id is not None else f"<{uuid.uuid4().urn}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", "sha1:" + base32_sha1(payload)),
        ("WARC-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if uri is not None:
        fields.append(("WARC-Target-URI", uri.replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<{PAGE}{refers_to}>"), ("WARC-Profile", PROFILE)]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields).encode()
    return VERSION + head + b"\r\n" + block + b"\r\n\r\n"


def page_of(value: str | None) -> int | None:
    number = (value or "").strip("<>").removeprefix(PAGE)
    return int(number) if (value or "").startswith(f"<{PAGE}") and re.fullmatch("-?[0-9]{1,18}", number) else None


def header_row(fields: dict[str, str]) -> dict:
    """The header columns of a record."""
    digest = fields.get("warc-payload-digest", "")
    length = fields.get("warc-payload-length")
    return {
        "page_id": page_of(fields.get("warc-record-id")),
        "target_uri": fields.get("warc-target-uri"),
        "record_type": fields.get("warc-type"),
        "payload_digest": digest.removeprefix("sha1:") or None,
        "payload_bytes": int(length) if length is not None else None,
        "refers_to": page_of(fields.get("warc-refers-to")),
    }


def read_fields(source: io.BufferedReader) -> dict[str, str] | None:
    """The next record's header fields by lower-case name; None at the end."""
    line = source.readline()
    while line in (b"\r\n", b"\n"):
        line = source.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record where one should start: {line[:40]!r}")
    fields: dict[str, str] = {}
    name = ""
    while (line := source.readline()) not in (b"\r\n", b"\n", b""):
        text = line.decode(errors="replace").rstrip("\r\n")
        if text[:1] in (" ", "\t") and name:
            # A folded line goes on with the field before it.
            fields[name] = f"{fields[name]} {text.strip()}".strip()
            continue
        name, _, value = text.partition(":")
        name = name.strip().lower()
        fields[name] = value.strip()
    return fields


def opened(raw: pa.NativeFile, name: str) -> io.BufferedReader:
    """An archive's bytes; gzip members, usually one a record, are read one after another."""
    if name.endswith(".gz"):
        return io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 18)
    return io.BufferedReader(raw, 1 << 18)


def payload_of(block: bytes) -> bytes:
    return block.partition(b"\r\n\r\n")[2]


@dataclass
class Archives(D.InputPartition):
    files: list[str]


class WarcReader(D.DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.path = options["path"]
        self.names = schema.fieldNames()
        self.arrow = pa.schema(
            [(n, {"payload": pa.binary()}.get(n, pa.int64() if n in INTEGERS else pa.string())) for n in self.names]
        )
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[D.Filter]) -> Iterable[D.Filter]:
        """Keep comparisons of header columns; the rest is left to Spark."""
        for f in filters:
            column = getattr(f, "attribute", ("",))
            if len(column) != 1 or column[0] == "payload":
                yield f
            elif type(f) in TESTS:
                self.tests.append((column[0], type(f).__name__, f.value))
            elif isinstance(f, D.In):
                self.tests.append((column[0], "In", tuple(f.value)))
            elif isinstance(f, D.IsNotNull):
                self.tests.append((column[0], "IsNotNull", None))
            else:
                yield f

    def partitions(self) -> list[Archives]:
        """Whole archives, gathered up to ``PARTITION_BYTES``."""
        system, path = file_system(self.path)
        found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
        shown = [f for f in found if f.is_file and f.base_name[0] not in "._"]
        other = [f.path for f in shown if not f.path.endswith((".warc", ".warc.gz"))]
        if other:
            raise ValueError(f"not an archive: {other[0]}")
        # Compressed archives take more work a byte.
        files = sorted((f.path, f.size * (4 if f.path.endswith(".gz") else 1)) for f in shown)
        groups: list[Archives] = []
        room = 0
        for file, size in files:
            if not groups or size > room:
                groups.append(Archives([]))
                room = PARTITION_BYTES
            groups[-1].files.append(file)
            room -= size
        return groups or [Archives([])]

    def wanted(self, row: dict) -> bool:
        for column, name, value in self.tests:
            own = row[column]
            if own is None:
                return False
            if name == "In" and own not in value:
                return False
            if name not in ("In", "IsNotNull") and not BY_NAME[name](own, value):
                return False
        return True

    def read(self, partition: Archives) -> Iterator[pa.RecordBatch]:
        system = file_system(self.path)[0]
        rows: list[dict] = []
        size = 0
        for file in partition.files:
            with system.open_input_file(file) as raw, opened(raw, file) as source:
                while (fields := read_fields(source)) is not None:
                    length = int(fields["content-length"])
                    row = header_row(fields)
                    if not self.wanted(row):
                        source.seek(length, io.SEEK_CUR)
                        continue
                    if "payload" in self.names and row["record_type"] == "response":
                        row["payload"] = payload_of(source.read(length))
                        if row["payload_digest"] not in (None, base32_sha1(row["payload"])):
                            raise ValueError(f"{file}: payload of page {row['page_id']} is damaged")
                    else:
                        source.seek(length, io.SEEK_CUR)
                    rows.append(row)
                    size += 200 + len(row.get("payload", b""))
                    if size > BATCH_BYTES:
                        yield self.batch(rows)
                        rows, size = [], 0
        if rows:
            yield self.batch(rows)

    def batch(self, rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r.get(f.name) for r in rows], f.type) for f in self.arrow], schema=self.arrow
        )


INTEGERS = ("page_id", "payload_bytes", "refers_to")
BY_NAME = {kind.__name__: test for kind, test in TESTS.items()}


@dataclass
class Written(D.WriterCommitMessage):
    file: str | None


class WarcWriter(D.DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        if overwrite:
            raise ValueError("archives are added to a folder, never overwritten: use mode('append')")
        self.path = options["path"]

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        system, path = file_system(self.path)
        file = None
        out = None
        for batch in batches:
            columns = [batch[name].to_pylist() for name in WRITTEN]
            if batch.num_rows and out is None:
                system.create_dir(path, recursive=True)
                file = posixpath.join(path, f".{uuid.uuid4().hex}.warc.open")
                out = system.open_output_stream(file)
            for page_id, uri, kind, refers_to, payload in zip(*columns, strict=True):
                out.write(record(page_id, uri, kind, refers_to, payload or b""))
        if out is not None:
            out.close()
        return Written(file)

    def commit(self, messages: list[Written | None]) -> None:
        system, path = file_system(self.path)
        system.create_dir(path, recursive=True)
        for m in messages:
            if m is not None and m.file is not None:
                name = posixpath.basename(m.file)[1:].removesuffix(".open")
                system.move(m.file, posixpath.join(path, name))

    def abort(self, messages: list[Written | None]) -> None:
        system, _ = file_system(self.path)
        for m in messages:
            if m is not None and m.file is not None:
                system.delete_file(m.file)


class WarcSource(D.DataSource):
    """Options: path, a folder of ``.warc`` and ``.warc.gz`` files."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def marked(pages: DataFrame) -> DataFrame:
    """Pages as records: response, or revisit of the largest page_id with the payload."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    slim = pages.select("page_id", F.sha1(payload).alias("sha"))
    largest = (
        slim.groupBy("sha")
        .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND refers_to IS NOT NULL")
    )
    revisits = stage(
        slim.join(largest.drop("n"), "sha")
        .where("NOT page_id <=> refers_to")
        .select(F.col("page_id").alias("_id"), F.col("sha").alias("_sha"), "refers_to")
        .distinct(),
        "warc-revisits",
    )
    full = pages.select(
        "page_id", F.col("url").alias("target_uri"), payload.alias("payload"), F.sha1(payload).alias("sha")
    )
    joined = full.join(
        few(revisits), F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("sha") == F.col("_sha")), "left"
    )
    kind = F.when(F.col("refers_to").isNull(), "response").otherwise("revisit")
    return joined.select("page_id", "target_uri", kind.alias("record_type"), "refers_to", "payload")


def write(pages: DataFrame, path: str) -> None:
    """Append the pages to the archives in ``path``."""
    register(pages.sparkSession)
    marked(pages).select(*WRITTEN).write.format("warc").mode("append").save(path)


def headers(spark: SparkSession, path: str) -> DataFrame:
    """Header columns only; no block is decoded."""
    register(spark)
    return spark.read.format("warc").schema(HEADERS).load(path)


def records(spark: SparkSession, path: str) -> DataFrame:
    """Header columns and payloads; digests of responses are checked while reading."""
    register(spark)
    return spark.read.format("warc").load(path)
